import datetime as dt
import math
import random

import numpy as np
import pandas as pd

from weirstream.operators import implausible as imp
from weirstream.operators.implausible import implausible

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "reading_id bigint, site_id string, data_type string, timestamp timestamp, value double, shard string, usual int"


def series(n=600, seed=1, base=5.0, noise=0.02):
    r = random.Random(seed)
    out, x = [], base
    for i in range(n):
        x += r.gauss(0, noise)
        flood = 4 * math.exp(-(i - 300) / 40) if i >= 300 else 4 * math.exp((i - 300) / 2)
        out.append(round(x + flood, 3))
    return out


def run(spark, values, kind="Q", site="a", tidal=None):
    rows = [(i, site, kind, T0 + dt.timedelta(minutes=15 * i), v, "clash", 1) for i, v in enumerate(values)]
    return {r.reading_id: r for r in implausible(spark.createDataFrame(rows, SCHEMA), tidal).collect()}


def test_spikes_but_no_flood(spark):
    v = series()
    v[100], v[200], v[201], v[202], v[320] = 60.0, 0.4, 0.5, 0.4, 70.0
    assert set(run(spark, v)) == {100, 200, 201, 202, 320}


def test_range_by_kind_and_tide(spark):
    v = series()
    v[50] = -0.3
    assert run(spark, v)[50].range
    tide = [round(3 * math.sin(i / 8) + random.Random(i).gauss(0, 0.05), 3) for i in range(600)]
    assert not run(spark, tide)
    noted = spark.createDataFrame([("a",)], "site_id string")
    assert not run(spark, v, tidal=noted).get(50) or not run(spark, v, tidal=noted)[50].range
    rain = [0.0] * 400
    for i in range(0, 400, 9):
        rain[i] = round(0.2 * (1 + i % 5), 1)
    rain[30], rain[60] = -1.0, 88.0
    got = run(spark, rain, "P")
    assert set(got) == {30, 60} and got[30].range and got[60].spike


def test_runs_pass_over_nulls_and_shards(spark, monkeypatch):
    monkeypatch.setattr(imp, "SHARD_DAYS", 1)
    v = series()
    v[92:101] = [5.5] * 9
    v[95] = None  # eight equal values across midnight (reading 96)
    v[400:407] = [4.2] * 7
    v[500], v[501] = float("nan"), None
    got = run(spark, v)
    assert set(got) == {92, 93, 94, 96, 97, 98, 99, 100} and all(r.stuck for r in got.values())
    assert set(run(spark, [0.0] * 30, "P")) == set()


def test_the_cut_into_shards_does_not_show(spark, monkeypatch):
    v = series(seed=3)
    for i in (95, 96, 97, 191, 192):
        v[i] = 44.0
    whole = set(run(spark, v))
    monkeypatch.setattr(imp, "SHARD_DAYS", 1)
    assert set(run(spark, v)) == whole == {95, 96, 97, 191, 192}


def test_short_null_and_empty(spark):
    assert run(spark, []) == {} and run(spark, [1.0, 2.0]) == {} and run(spark, [None, None]) == {} and run(spark, [1.0], site=None) == {}


def one_by_one(values):
    """The test as its definition says: the most extreme value is removed, mean and deviation are renewed."""
    left, removed, last = list(values), [], 0
    for _ in range(int(len(values) / 10 + 10)):
        mean, deviation = np.mean(left), np.std(left)
        worst = max(left, key=lambda x: abs(x - mean))
        removed.append(worst)
        if abs(worst - mean) / deviation > imp._critical(np.array([len(left)]))[0]:
            last = len(removed)
        left.remove(worst)
    return sorted(removed[:last])


def test_limit_against_removal_one_by_one():
    r = random.Random(7)
    for planted in ([], [9.0], [8.0, 8.5, -9.0], [6.5, 30.0, 31.0, 32.0]):
        z = np.array([r.gauss(0, 0.8) for _ in range(800)] + planted)
        at = imp._limit(("a", "Q"), pd.DataFrame(imp._histogram(z)))["at"][0]
        assert sorted(x for x in z if abs(x) >= at) == one_by_one(z) == sorted(planted)
