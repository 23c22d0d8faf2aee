import datetime as dt

from pyspark.sql import functions as F

from weirstream.functions.timefn import text_of_us
from weirstream.operators import mixed_time
from weirstream.operators.mixed_time import BACK, FOREIGN, NONE, SWITCH, choose, interpretations, path

CASES = [
    ("2014-01-01T04:30:00Z", "dmy", None, "2014-01-01 04:30:00.000000"),
    ("01/02/14 05:45", "dmy", "Europe/London", "2014-02-01 05:45:00.000000"),
    ("01/02/2014 05:45", "mdy", "UTC", "2014-01-02 05:45:00.000000"),
    ("2014-02-27 00:15:00,372", "dmy", "UTC", "2014-02-27 00:15:00.372000"),
    ("31/11/2024 12:51:00", "dmy", "UTC", None),
    ("01/08/2014 24:00", "dmy", "Europe/Berlin", "2014-08-01 22:00:00.000000"),
    ("2014-08-01 24:15", "ymd", "UTC", None),
    ("20140309T001500Z", None, None, "2014-03-09 00:15:00.000000"),
    ("201403090402", None, "+01:00", "2014-03-09 03:02:00.000000"),
    ("02/04/2017 3:45:00 PM", "mdy", "America/New_York", "2017-02-04 20:45:00.000000"),
    ("02/04/2017 13:45:00 PM", "mdy", "UTC", None),
    ("02-Aug-2014 17:30:00", None, "Europe/Berlin", "2014-08-02 15:30:00.000000"),
    ("1405848201", None, None, "2014-07-20 09:23:21.000000"),
    ("1394337498751", None, None, "2014-03-09 03:58:18.751000"),
    ("1394334000257470", None, None, "2014-03-09 03:00:00.257470"),
    ("Fri, 10 Feb 2017 13:30:00 +0000", None, None, "2017-02-10 13:30:00.000000"),
    ("2014-04-23 03:00:00 BST", None, "UTC", "2014-04-23 02:00:00.000000"),
    ("2014-05-03T01:26:17-04", None, None, "2014-05-03 05:26:17.000000"),
    ("30/03/2014 01:30:00", "dmy", "Europe/London", None),  # skipped
    ("26/10/2014 01:30:00", "dmy", "Europe/London", None),  # repeated
    ("26/10/2014 01:30:00 GMT", "dmy", "Europe/London", "2014-10-26 01:30:00.000000"),
    ("03/15/2023 05:41:05", "dmy", "UTC", None),
    ("\t2015-03-08t04:42:42z ", None, None, "2015-03-08 04:42:42.000000"),
    ("2024-12-28T02:45:71Z", None, None, None),
    ("2015-03-08 04:42", "ymd", "No/Where", None),
    ("2015-03-08 04:42", "ymd", None, None),
    ("2015-03-08 04:42 QQQ", "ymd", "UTC", None),
    ("03/11/2019", "dmy", "UTC", None),
    ("", "dmy", "UTC", None),
    (None, "dmy", "UTC", None),
    ("x" * 100_000, "dmy", "UTC", None),
]


def test_cases(spark):
    df = spark.createDataFrame([(i, i, "s", t, o, z) for i, (t, o, z, _) in enumerate(CASES)], "id bigint, n int, src string, text string, o string, z string")
    got = {r.row: r.t for r in choose(interpretations(df, "text", F.col("o"), F.col("z")), ["src"], "n", "id").select("row", text_of_us(F.col("us")).alias("t")).collect()}
    assert {i: got.get(i) for i in range(len(CASES))} == {i: c[3] for i, c in enumerate(CASES)}


def test_blocks_repeat_their_lead_in_without_repeating_rows(spark):
    df = spark.range(9000).select(F.col("id"), F.lit("s").alias("src"), F.lit("01/02/2014 05:45").alias("text"), F.lit("dmy").alias("o"), F.lit("UTC").alias("z"))
    out = choose(interpretations(df, "text", F.col("o"), F.col("z")), ["src"], "id", "id")
    assert out.count() == 9000 and out.select("row").distinct().count() == 9000
    assert choose(interpretations(df.limit(0), "text", F.col("o"), F.col("z")), ["src"], "id", "id").count() == 0


def settle(spark, texts, order, zone="UTC"):
    df = spark.createDataFrame([(i, "s", t, order, zone) for i, t in enumerate(texts)], "id bigint, src string, text string, o string, z string")
    return {r.row: r.t for r in choose(interpretations(df, "text", F.col("o"), F.col("z")), ["src"], "id", "id").select("row", text_of_us(F.col("us")).alias("t")).collect()}


def test_record_order_decides_where_no_order_is_declared(spark):
    texts = ["30/01/2014 00:00", "31/01/2014 00:00", "01/02/2014 00:00", "02/02/2014 00:00", "03/02/2014 00:00", "13/02/2014 00:00"]
    got = settle(spark, texts, None)
    assert [got[i][:10] for i in range(6)] == ["2014-01-30", "2014-01-31", "2014-02-01", "2014-02-02", "2014-02-03", "2014-02-13"]
    turned = ["01/30/2014 00:00", "02/01/2014 00:00", "02/02/2014 00:00", "02/03/2014 00:00", "02/13/2014 00:00"]
    got = settle(spark, turned, None)
    assert [got[i][:10] for i in range(5)] == ["2014-01-30", "2014-02-01", "2014-02-02", "2014-02-03", "2014-02-13"]
    # without the path the first reading of each text would be taken
    df = spark.createDataFrame([(t,) for t in turned], "text string")
    first = [r.us for r in interpretations(df, "text", F.lit(None).cast("string"), F.lit("UTC")).select(F.col("readings")[0]["us"].alias("us")).collect()]
    assert first != sorted(first)


def test_a_declared_order_outweighs_the_neighbours_and_impossible_days_name_no_time(spark):
    got = settle(spark, ["30/01/2014 00:00", "02/01/2014 00:00", "01/31/2014 00:00", "03/02/2014 00:00"], "dmy")
    assert {k: v[:10] for k, v in got.items()} == {0: "2014-01-30", 1: "2014-01-02", 3: "2014-02-03"}


def test_a_stretch_over_many_blocks_is_one_path(spark, monkeypatch):
    monkeypatch.setattr(mixed_time, "BLOCK", 3)
    # only the last record tells the order; eleven uncertain ones lie before it, over four blocks
    days = [f"{d:02d}/{m:02d}/2014 00:00" for m, d in [(1, x) for x in range(2, 13)]]
    got = settle(spark, [*days, "13/01/2014 00:00"], None)
    assert [got[i][:10] for i in range(12)] == [f"2014-01-{d:02d}" for d in range(2, 14)]
    got = settle(spark, [*[f"01/{d:02d}/2014 00:00" for d in range(2, 13)], "01/13/2014 00:00"], None)
    assert [got[i][:10] for i in range(12)] == [f"2014-01-{d:02d}" for d in range(2, 14)]


def test_path_against_all_paths():
    import itertools
    import random

    def cost(states, before, after, way):
        at = [before, *[s[i] for s, i in zip(states, way)], after]
        total = sum(s[i][2] for s, i in zip(states, way))
        for a, b in zip(at, at[1:]):
            if a and b and a[0] and b[0]:
                total += SWITCH * (a[0] != b[0]) + BACK * (b[1] < a[1])
        return total

    rng = random.Random(4)
    for _ in range(200):
        states = [[(rng.choice([None, "dmy", "mdy", "ymd"]), rng.randrange(9), rng.choice([0.0, NONE, FOREIGN])) for _ in range(rng.randrange(1, 4))] for _ in range(rng.randrange(1, 6))]
        before, after = (rng.choice([None, ("dmy", 4, 0.0)]) for _ in range(2))
        best = min(cost(states, before, after, w) for w in itertools.product(*[range(len(s)) for s in states]))
        assert cost(states, before, after, path(states, before, after)) == best


def test_moments_where_clocks_change():
    zone = mixed_time.zone_of("Europe/London")
    us = lambda *a: int((dt.datetime(*a) - dt.datetime(1970, 1, 1)).total_seconds() * 1e6)
    assert mixed_time.moments(us(2014, 3, 30, 1, 30), zone) == ()
    assert mixed_time.moments(us(2014, 10, 26, 1, 30, 5), zone) == (us(2014, 10, 26, 0, 30, 5), us(2014, 10, 26, 1, 30, 5))
    assert mixed_time.moments(us(2014, 6, 1, 1), zone) == (us(2014, 6, 1, 0),) and mixed_time.zone_of("No/Where") is None
    assert mixed_time.moments(us(2014, 6, 1, 1), mixed_time.zone_of("-03:30")) == (us(2014, 6, 1, 4, 30),)
