"""Encoding of a corpus with a public tokenizer, and token counts.

Defined results: a NULL and an empty text both give an empty list; very long texts are encoded whole; repeated rows are
encoded alike; an empty table gives an empty result; other columns are ignored.

Plan: one narrow stage, no shuffle; Arrow batches go to the workers and come back as Arrow lists. The vocabulary (under
1 MB for 50,256 tokens; ``MOST_VOCABULARY`` bounds it) travels as a broadcast; a worker builds its coder once.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from weirstream.llm.bpe import PIECES, PrefixCoder, read_ranks
from weirstream.session import ship

DEFAULT_VOCABULARY = os.environ.get("WEIRSTREAM_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
MOST_VOCABULARY = 64_000_000


def _shared(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        data = f.read(MOST_VOCABULARY + 1)
    if len(data) > MOST_VOCABULARY:
        raise ValueError(f"{path} is larger than {MOST_VOCABULARY} bytes")
    return spark.sparkContext.broadcast((hashlib.sha256(data).hexdigest(), data))


#: Coders of this worker process; the package is imported there once, so they outlive a task.
_CODERS: dict[tuple[str, str], PrefixCoder] = {}


def _coder(shared, pieces: str) -> PrefixCoder:
    name, data = shared.value
    if (name, pieces) not in _CODERS:
        _CODERS[name, pieces] = PrefixCoder(read_ranks(data), pieces)
    return _CODERS[name, pieces]


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, pieces: str = PIECES, also: tuple[str, ...] = ()) -> DataFrame:
    """(key, *also, ids): token ids of every text."""
    return _map(df, key, text, vocabulary, pieces, also, "ids array<int>")


def count_tokens(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, pieces: str = PIECES, also: tuple[str, ...] = ()) -> DataFrame:
    """(key, *also, tokens): number of tokens of every text."""
    return _map(df, key, text, vocabulary, pieces, also, "tokens bigint")


def _map(df: DataFrame, key: str, text: str, vocabulary: str | None, pieces: str, also: tuple[str, ...], out: str) -> DataFrame:
    ship(df.sparkSession)
    shared = _shared(df.sparkSession, vocabulary or DEFAULT_VOCABULARY)
    kept = [key, *also]
    narrow = df.select(*kept, text)
    schema = ", ".join(f"`{c}` {narrow.schema[c].dataType.simpleString()}" for c in kept) + ", " + out
    lists = out.startswith("ids")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        coder = _coder(shared, pieces)
        for batch in batches:
            texts = batch.column(len(kept))
            for a in range(0, max(batch.num_rows, 1), 1000):
                part = texts.slice(a, 1000)
                if lists:
                    offsets, flat = [0], []
                    for t in part:
                        flat.extend(coder.encode(t.as_py()))
                        offsets.append(len(flat))
                    last = pa.ListArray.from_arrays(pa.array(np.asarray(offsets, np.int32)), pa.array(np.asarray(flat, np.int32)))
                else:
                    last = pa.array([len(coder.encode(t.as_py())) for t in part], pa.int64())
                yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(a, 1000) for i in range(len(kept))], last], names=[*kept, out.split(" ")[0]])

    return narrow.mapInArrow(run, schema)
