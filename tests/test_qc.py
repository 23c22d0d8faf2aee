import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weirstream.operators import qc
from weirstream.operators.qc import Spec
from weirstream.plans import pipeline

SPEC = Spec()
V = lambda: F.col("value")
T0 = dt.datetime(2022, 1, 1)


def frame(spark, values, kind="Q", site="39001"):
    rows = [(i, site, kind, T0 + dt.timedelta(minutes=15 * i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "reading_id bigint, site_id string, data_type string, timestamp timestamp, value double")


def flags(df, name):
    return [r[name] for r in df.orderBy("reading_id").select(name).collect()]


@pytest.mark.parametrize(
    "values,column,want",
    [
        ([-1, 0, 1, None], lambda: qc.qc_negative(V()), [True, False, False, False]),
        ([1, 5], lambda: qc.qc_relative_spike(V(), SPEC), [False, False]),
        ([1, 12], lambda: qc.qc_relative_spike(V(), SPEC), [False, True]),
        ([0.05, 1], lambda: qc.qc_relative_spike(V(), SPEC), [False, False]),
        ([0, 5], lambda: qc.qc_relative_spike(V(), SPEC), [False, False]),
        ([10, 0.1], lambda: qc.qc_drop(V(), SPEC), [False, True]),
        ([10, 8], lambda: qc.qc_drop(V(), SPEC), [False, False]),
        ([-0.5, 0, 1, 5, 10.5], lambda: qc.qc_h_range(V(), 0, 10), [True, False, False, False, True]),
        ([1, 25, 75], lambda: qc.qc_p_intensity(V()), [False, False, True]),
    ],
)
def test_vectors(spark, values, column, want):
    assert flags(frame(spark, values).withColumn("x", column()), "x") == want


def test_windows_against_loops(spark):
    rnd = random.Random(11)
    for n in (3, 9, 60):
        v = [None if rnd.random() < 0.06 else rnd.choice([1.0, 1.0, 2.0, 3.5]) for _ in range(n)]
        df = frame(spark, v)
        x = np.array([np.nan if a is None else a for a in v])
        d = np.r_[np.nan, np.diff(x)]
        sg = np.nan_to_num(np.sign(d))
        rev = [j > 0 and sg[j] != 0 and sg[j - 1] != 0 and sg[j] != sg[j - 1] for j in range(n)]
        want = [False] * n
        for e in range(8, n):
            if sum(rev[e - 7 : e + 1]) >= 4:
                for j in range(e - 7, e + 1):
                    want[j] = True
        assert flags(qc.add_fluctuation(df, SPEC), "fluctuation") == want
        run = [False] * n
        for a in range(n):
            b = a
            while b + 1 < n and x[b + 1] == x[a]:
                b += 1
            if not np.isnan(x[a]) and b - a + 1 >= 4:
                run[a : b + 1] = [True] * (b - a + 1)
        assert flags(qc.add_h_flatline(df, SPEC), "h_flatline") == run


def test_daily_cap_dry_run_and_shift(spark):
    assert any(flags(qc.add_p_daily_cap(frame(spark, [4.0] * 120, "P"), SPEC), "p_daily_cap"))
    assert not any(flags(qc.add_p_daily_cap(frame(spark, [0.5] * 120, "P"), SPEC), "p_daily_cap"))
    dry = qc.add_p_dry_run(frame(spark, [0] * 20 + [0.5] * 5, "P").withColumn("wet", F.lit(True)), SPEC, min_steps=10)
    assert flags(dry, "p_dry_run") == [True] * 20 + [False] * 5
    shift = flags(qc.add_h_datum_shift(frame(spark, [1.0] * 50 + [1.8] * 50, "H"), SPEC, window=20, threshold=0.3), "h_datum_shift")
    assert any(shift[50:70]) and not any(shift[:30])


def test_one_exchange_for_all_checks(spark):
    plan = qc.flow_checks(frame(spark, [1.0, 2.0]), SPEC)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_promotion_invariants(spark):
    rnd = random.Random(2)
    df = frame(spark, [rnd.uniform(1, 10) for _ in range(80)] + [None, -2.0]).withColumn("extra", F.lit("x"))
    df = df.unionByName(df.limit(5).withColumn("reading_id", F.col("reading_id") + 1000))
    out = pipeline.promote(df, flagged_at=dt.datetime(2024, 1, 1)).collect()
    assert len(out) == 82
    for r in out:
        assert r.qc_flag in (1, 2, 3, 4) and (r.qc_value is None) == (r.qc_flag == 4 or r.value is None)
    assert pipeline.promote(df.limit(0)).count() == 0
