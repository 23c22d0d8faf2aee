import datetime as dt
import random

from weirstream.operators.as_known import as_known

EV = "reading_id bigint, site_id string, timestamp timestamp, e string, best string"
VE = "rating_id string, site_id string, version int, valid_from string, valid_to string, saved_at timestamp, t string, rank string"


def run(spark, events, versions):
    ev = spark.createDataFrame([(*e, "clash", "clash") for e in events], EV)
    ve = spark.createDataFrame([(*v, "clash", "clash") for v in versions], VE)
    return sorted(tuple(r) for r in as_known(ev, ve).collect())


def t(day, h=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=h)


def test_known_later_counts_only_from_then(spark):
    versions = [("v1", "a", 1, "2024-01-01", "2024-01-10", t(-5)), ("v2", "a", 2, "2024-01-02", None, t(2, 12)), ("v2", "a", 2, "2024-01-02", None, t(2, 12))]
    events = [(1, "a", t(2, 11)), (2, "a", t(2, 12)), (3, "a", t(30)), (4, "a", t(9, 23)), (4, "a", t(9, 23)), (5, "b", t(2))]
    assert run(spark, events, versions) == [(1, "v1"), (2, "v2"), (3, "v2"), (4, "v2"), (4, "v2")]


def test_nulls_reversed_and_empty(spark):
    versions = [("n", "a", 9, None, None, t(-1)), ("r", "a", 8, "2024-01-05", "2024-01-01", t(-1)), ("k", "a", 7, "2024-01-01", None, None), ("x", "a", 6, "2024-01-01", "never", t(-1)), ("ok", "a", 1, "2024-01-01", "2024-01-01", t(-1))]
    assert run(spark, [(1, "a", t(0, 23)), (2, None, t(0)), (3, "a", None), (4, "a", t(1))], versions) == [(1, "ok")]
    assert run(spark, [], versions) == [] and run(spark, [(1, "a", t(0))], []) == []


def test_against_brute_force(spark):
    rnd = random.Random(5)
    versions = []
    for i in range(60):
        a = rnd.randint(0, 40)
        versions.append((f"v{i}", rnd.choice("ab"), rnd.randint(1, 30), t(a).date().isoformat(), None if rnd.random() < 0.2 else t(a + rnd.randint(0, 20)).date().isoformat(), t(rnd.randint(-5, 45), rnd.randint(0, 23))))
    events = [(i, rnd.choice("abc"), t(rnd.randint(-2, 60), rnd.randint(0, 23))) for i in range(300)]
    want = []
    for i, s, at in events:
        fit = [(v[2], v[0]) for v in versions if v[1] == s and v[5] <= at and v[3] <= at.date().isoformat() and (v[4] is None or at.date().isoformat() <= v[4])]
        if fit:
            want.append((i, max(fit)[1]))
    assert run(spark, events, versions) == sorted(want)
