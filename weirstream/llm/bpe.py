"""Byte-pair encoding by dynamic programming over prefixes.

For every byte prefix of a piece of text there is exactly one token with which its encoding can end: the one that ends
there and goes validly after the last token of the prefix before it. The table of these last tokens (one id per byte) is
all that is stored; ids are read off it backwards. Appending bytes extends the table without touching what is there, and
an edit leaves the table valid up to the edit.

A token may follow another if merging their bytes would not join across the boundary. Between its own merges, the symbol
next to the boundary on the left is one of the right ends of the first token's history, on the right one of the left ends
of the second's; a pair of them that merges while both exist would be a merge across, and makes the two tokens invalid.
"""

from __future__ import annotations

import base64

import regex

#: Fixed value: the public pattern that splits text into pieces before byte-level merges.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

NEVER = 1 << 60


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a vocabulary file: lines of base64 token and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


class PrefixCoder:
    def __init__(self, ranks: dict[bytes, int], pieces: str = PIECES, most_cached: int = 200_000):
        self.ranks, self.bytes = ranks, {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.split = regex.compile(pieces).finditer
        self.most_cached = most_cached
        self.pairs: dict[int, bool] = {}
        self.cache: dict[str, tuple[int, ...]] = {}
        self._born: dict[int, tuple[int, int] | None] = {}
        self._ends: tuple[dict, dict] = ({}, {})

    # histories of tokens

    def parents(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made this one; None for a single byte."""
        if token not in self._born:
            data = self.bytes[token]
            parts = [data[i : i + 1] for i in range(len(data))]
            while len(parts) > 2:
                at = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], NEVER))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self._born[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self._born[token]

    def history(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """(symbol, from, until) in order of merges: the symbols at the token's left (0) or right (1) end and the ranks between which they stand."""
        known = self._ends[side]
        if token not in known:
            line, t = [token], token
            while (p := self.parents(t)) is not None:
                t = p[side]
                line.append(t)
            line.reverse()
            known[token] = [(s, -1 if i == 0 else s, line[i + 1] if i + 1 < len(line) else NEVER) for i, s in enumerate(line)]
        return known[token]

    def follows(self, first: int, second: int) -> bool:
        """Whether ``second`` can stand right after ``first`` in an encoding."""
        key = first * 1_000_003 + second
        known = self.pairs.get(key)
        if known is None:
            known = self._follows(first, second)
            if len(self.pairs) > 4 * self.most_cached:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def _follows(self, first: int, second: int) -> bool:
        for a, a_from, a_until in self.history(first, 1):
            for b, b_from, b_until in self.history(second, 0):
                if a_from < b_until and b_from < a_until:
                    joined = self.ranks.get(self.bytes[a] + self.bytes[b])
                    # of equal ranks the left one is merged first
                    if joined is not None and max(a_from, b_from) < joined and joined < a_until and joined <= b_until:
                        return False
        return True

    # tables

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """Grow the table ``last`` (of the first ``len(last)`` bytes) to all of ``data``, in place."""
        get, follows = self.ranks.get, self.follows
        for end in range(len(last) + 1, len(data) + 1):
            for start in range(max(0, end - self.longest), end):
                token = get(data[start:end])
                if token is not None and (start == 0 or follows(last[start - 1], token)):
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a single byte")
        return last

    def read_off(self, last: list[int]) -> list[int]:
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.bytes[last[end - 1]])
        return out[::-1]

    def piece(self, text: str) -> tuple[int, ...]:
        ids = self.cache.get(text)
        if ids is None:
            data = text.encode("utf-8", "replace")
            ids = tuple(self.read_off(self.extend(data, [])))
            if len(self.cache) >= self.most_cached:
                self.cache.clear()
            if len(text) <= 64:
                self.cache[text] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; a null and an empty text both give an empty list."""
        out: list[int] = []
        if text:
            cached, piece = self.cache.get, self.piece
            for m in self.split(text):
                p = m.group()
                out.extend(cached(p) or piece(p))
        return out


class EncodedText:
    """A text with its pieces, that can be appended to and edited; only what changes is encoded again."""

    def __init__(self, coder: PrefixCoder, text: str = ""):
        self.coder, self.text = coder, ""
        self.starts: list[int] = []
        self.tables: list[list[int]] = []
        self.append(text)

    def ids(self) -> list[int]:
        return [i for t in self.tables for i in self.coder.read_off(t)]

    def append(self, more: str) -> None:
        """The last piece may grow; its table is extended where it does, all earlier pieces stand."""
        self.splice(len(self.text), len(self.text), more)

    def splice(self, start: int, end: int, new: str) -> None:
        """Replace ``text[start:end]`` by ``new``."""
        old, shift = self.text, len(new) - (end - start)
        self.text = old[:start] + new + old[end:]
        # a piece is decided by the text up to the second character after it (a run of blanks leaves its last one to what
        # follows), so the pieces that end two characters before ``start`` stand
        keep = 0
        while keep < len(self.starts) and (self.starts[keep + 1] if keep + 1 < len(self.starts) else len(old)) + 1 < start:
            keep += 1
        later = {s + shift: k for k, s in enumerate(self.starts) if s >= end}
        at = self.starts[keep] if keep < len(self.starts) else len(old) if keep else 0
        starts, tables, first = [], [], keep
        rest_starts, rest_tables = [], []
        for m in self.coder.split(self.text, at):
            if m.start() in later and m.start() >= start + len(new):
                k = later[m.start()]
                rest_starts, rest_tables = [s + shift for s in self.starts[k:]], self.tables[k:]
                break
            data = m.group().encode("utf-8", "replace")
            table: list[int] = []
            if m.start() == at and first < len(self.tables):
                # the same beginning has the same table
                was = old[at : self.starts[first + 1] if first + 1 < len(self.starts) else len(old)].encode("utf-8", "replace")
                same = next((i for i, (x, y) in enumerate(zip(was, data)) if x != y), min(len(was), len(data)))
                table = self.tables[first][:same]
            starts.append(m.start())
            tables.append(self.coder.extend(data, table))
        self.starts = self.starts[:keep] + starts + rest_starts
        self.tables = self.tables[:keep] + tables + rest_tables
