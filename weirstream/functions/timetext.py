"""Texts that name a time, taken apart: what day they may mean under each order, the time of day, the zone they carry.

Plain Python for the workers. A day that many records share is taken apart once (``dates_of`` is cached).

Defined results: NULL, empty and blank texts and texts of no known notation give nothing; white space around and within
counts as one blank; letters count without regard to case.
"""

from __future__ import annotations

import datetime
import re
from functools import lru_cache

# Minutes east of Greenwich of the zone names that a text may carry.
ZONE_MINUTES = {
    "Z": 0, "UTC": 0, "UT": 0, "GMT": 0, "WET": 0,
    "BST": 60, "WEST": 60, "CET": 60, "MET": 60,
    "CEST": 120, "MEST": 120, "EET": 120, "EEST": 180,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
ORDERS = ("ymd", "dmy", "mdy")

_ZONE = r"(Z|[A-Z]{2,4}|[+-]\d{2}(?::?\d{2})?)"
_BLANK = re.compile(r"[\s  -​ 　﻿]+")
_COUNT = re.compile(r"-?(?:\d{10}|\d{13}|\d{16})")
_COMPACT = re.compile(rf"(\d{{4}})(\d\d)(\d\d)T?(\d\d)(\d\d)(\d\d)?(?: ?{_ZONE})?", re.A)
_CLOCK = re.compile(rf"(\d{{1,2}}):(\d\d)(?::(\d\d)(?:[.,](\d{{1,9}}))?)?(?: ?([AP]M))?(?: ?{_ZONE})?", re.A)
_NUMERIC = re.compile(r"(\d{1,4})([-/.])(\d{1,2})\2(\d{1,4})", re.A)
_WORD = re.compile(r"(?:[A-Z]{3,9},? ?)?(\d{1,2})[- ]([A-Z]{3})[A-Z]*[- ,]+(\d{4}|\d\d)", re.A)
_OFFSET = re.compile(r"([+-])(\d\d):?(\d\d)?", re.A)


@lru_cache(65_536)
def dates_of(head: str) -> tuple:
    """``(order, year, month, day)`` of every way to read a day; whether such a day exists is left open."""
    m = _NUMERIC.fullmatch(head)
    if m:
        a, b, c = m.group(1), m.group(3), m.group(4)
        out = []
        year = lambda x: int(x) if len(x) == 4 else int(x) + 2000 if len(x) == 2 else None
        if len(c) <= 2 and year(a) is not None:
            out.append(("ymd", year(a), int(b), int(c)))
        if len(a) <= 2 and year(c) is not None:
            out += [("dmy", year(c), int(b), int(a)), ("mdy", year(c), int(a), int(b))]
        return tuple(out)
    m = _WORD.fullmatch(head)
    if m and m.group(2) in MONTHS:
        y = m.group(3)
        return (("word", int(y) if len(y) == 4 else int(y) + 2000, MONTHS.index(m.group(2)) + 1, int(m.group(1))),)
    return ()


@lru_cache(65_536)
def day_number(y: int, m: int, d: int) -> int | None:
    """Days since 1970, None where no such day exists."""
    try:
        return datetime.date(y, m, d).toordinal() - 719_163
    except ValueError:
        return None


@lru_cache(4096)
def minutes_east(zone: str) -> int | None:
    m = _OFFSET.fullmatch(zone)
    if m is None:
        return ZONE_MINUTES.get(zone)
    hours, minutes = int(m.group(2)), int(m.group(3) or 0)
    return (-1 if m.group(1) == "-" else 1) * (hours * 60 + minutes) if hours <= 18 and minutes <= 59 else None


def take_apart(text: str | None) -> tuple | None:
    """``(count_us, None, None, None)`` of a count since 1970, else ``(None, head, clock, zone)``; None for no known notation.

    ``clock`` is (hour, minute, second, microsecond) as written, the hour on the 24-hour clock; ``zone`` is None without one.
    """
    if not text:
        return None
    up = (" ".join(text.split()) if text.isascii() else _BLANK.sub(" ", text).strip(" ")).upper()
    first = up[:1]
    if (first.isdigit() or first == "-") and _COUNT.fullmatch(up):
        n = len(up.lstrip("-"))
        return int(up) * (1_000_000 if n == 10 else 1000 if n == 13 else 1), None, None, None
    m = _COMPACT.fullmatch(up) if up[:8].isdigit() else None
    if m:
        y, mo, d, h, mi, s, zone = m.groups()
        return None, f"{y}-{mo}-{d}", (int(h), int(mi), int(s or 0), 0), zone
    # the time of day begins at the digits before the first colon, after a T or a blank
    at = up.find(":")
    at -= 2 if at > 2 and up[at - 2].isdigit() else 1
    cut = at - 2 if at > 2 and up[at - 1] == " " and up[at - 2] in "T " else at - 1
    if cut < 1 or up[cut] not in "T ":
        return None
    m = _CLOCK.fullmatch(up, at)
    if m is None:
        return None
    head, (h, mi, s, frac, half, zone) = up[:cut], m.groups()
    hour = int(h)
    if half:
        if not 1 <= hour <= 12:
            return None
        hour = hour % 12 + (12 if half == "PM" else 0)
    return None, head, (hour, int(mi), int(s or 0), int((frac or "0")[:6].ljust(6, "0"))), zone


def clock_us(clock: tuple) -> int | None:
    """Microseconds since midnight; 24:00 is the end of the day; None where no such time exists."""
    h, mi, s, f = clock
    if mi > 59 or s > 59 or h > 24 or h == 24 and (mi or s or f):
        return None
    return ((h * 60 + mi) * 60 + s) * 1_000_000 + f


def declared(dates: tuple, head: str, order: str | None) -> tuple | None:
    """The one way to read ``head`` that its own form or the declared order gives."""
    for d in dates:
        if d[0] == "word" or d[0] == "ymd" and head[:4].isdigit() or d[0] == order:
            return d
    return None


def as_iso(text: str | None, order: str | None) -> str | None:
    """The text in one notation, its zone left off; whether such a day and time exist is left open. None: no time of day named."""
    got = take_apart(text)
    if got is None:
        return None
    count, head, clock, zone = got
    if count is not None:
        return (datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=count)).isoformat(" ")
    d = declared(dates_of(head), head, order)
    if d is None or zone is not None and minutes_east(zone) is None:
        return None
    return "%04d-%02d-%02d %02d:%02d:%02d.%06d" % (*d[1:], *clock)
