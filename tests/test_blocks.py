import random

from pyspark.sql import functions as F

from test_qc import frame

from weirstream.operators import blocks, qc
from weirstream.operators.qc import BLOCKED, Spec


def both(spark, monkeypatch, checks, values, kind, block=300, context=128):
    """The checks over whole series and over short row blocks, row by row."""
    df = frame(spark, values, kind).unionByName(frame(spark, values[:37], kind, "other").withColumn("reading_id", F.col("reading_id") + 100_000))
    whole = checks(df, Spec())
    names = [c for c in whole.columns if c not in df.columns]
    cut = checks(blocks.in_blocks(df, BLOCKED.keys, BLOCKED.order, block=block, context=context), BLOCKED).filter("_own")
    a = sorted(tuple(r) for r in whole.select("reading_id", *names).collect())
    b = sorted(tuple(r) for r in cut.select("reading_id", *names).collect())
    assert a == b and len(a) == len(values) + min(37, len(values))


def test_blocks_do_not_show(spark, monkeypatch):
    rnd = random.Random(8)
    v = [None if rnd.random() < 0.05 else round(2 + 0.001 * i + rnd.choice([0, 0, 0.3, 3.0]) * rnd.random(), 1) for i in range(1500)]
    for i in range(0, 1500, 97):
        v[i] = 60.0
    both(spark, monkeypatch, qc.flow_checks, v, "Q")
    both(spark, monkeypatch, qc.stage_checks, v, "H")
    both(spark, monkeypatch, qc.rain_checks, [None if x is None else 0.0 if x < 2.5 else x for x in v], "P")


def test_numbers_and_sizes(spark):
    x = blocks.in_blocks(frame(spark, [1.0] * 250), BLOCKED.keys, BLOCKED.order, block=50, context=20)
    own = sorted((r._n, r._total) for r in x.filter("_own").select("_n", "_total").collect())
    assert own == [(i, 250) for i in range(1, 251)]
    assert x.count() == 250 + 4 * 2 * 20
    assert blocks.in_blocks(frame(spark, []), BLOCKED.keys, BLOCKED.order).count() == 0
