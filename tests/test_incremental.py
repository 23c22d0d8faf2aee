import datetime as dt

import pytest
from pyspark.sql import functions as F

from weirstream.operators import catalogue
from weirstream.plans import pipeline

DAY = dt.date(2024, 1, 10)


def registry(spark, rows):
    return spark.createDataFrame([(g, "HDE", "flow", "hydrometric", active, live) for g, active, live in rows], "gauge_id string, source_system string, data_type string, category string, active boolean, live boolean")


def bronze(spark, rows):
    return spark.createDataFrame(rows, "reading_id bigint, site_id string, data_type string, timestamp timestamp, received_at timestamp")


def test_statuses_starts_and_log(spark):
    held = bronze(spark, [(1, "a", "Q", dt.datetime(2024, 1, 5, 7), None), (2, "b", "Q", dt.datetime(2024, 1, 10), None), (3, "a", "H", dt.datetime(2024, 1, 9), None)])
    asked = {}

    def fetch(gauge, start, end):
        asked[gauge["gauge_id"]] = (start, end)
        if gauge["gauge_id"] == "bad":
            raise OSError("no answer")
        return None if gauge["gauge_id"] == "none" else held

    reg = registry(spark, [("a", True, True), ("b", True, True), ("bad", True, True), ("none", True, True), ("asleep", True, False), ("gone", False, True)])
    log = {r.gauge_id: r for r in pipeline.run_incremental(spark, reg, held, fetch, lambda df, g: 3, DAY, dt.date(2020, 1, 1)).collect()}
    assert {k: v.status for k, v in log.items()} == {"a": "SUCCESS", "b": "NO_NEW_DATA", "bad": "FAILED", "none": "EMPTY"}
    # the stage of gauge a is ahead of its flow and does not count
    assert asked["a"] == (dt.date(2024, 1, 5), DAY) and asked["none"] == (dt.date(2020, 1, 1), DAY) and "b" not in asked
    assert log["a"].rows == 3 and log["bad"].error == "no answer" and log["a"].watermark == dt.date(2024, 1, 5)
    only = pipeline.run_incremental(spark, reg, None, fetch, lambda df, g: 0, DAY, gauges=["a"]).collect()
    assert [(r.gauge_id, r.status) for r in only] == [("a", "EMPTY")]


def test_newer_by_series_and_arrival(spark):
    loaded = bronze(spark, [(1, "a", "H", dt.datetime(2024, 1, 9), dt.datetime(2024, 1, 9)), (2, "a", "Q", dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6))])
    came = bronze(
        spark,
        [
            (3, "a", "Q", dt.datetime(2024, 1, 7), dt.datetime(2024, 1, 7)),
            (4, "a", "Q", dt.datetime(2024, 1, 4), dt.datetime(2024, 1, 8)),
            (5, "a", "Q", dt.datetime(2024, 1, 4), dt.datetime(2024, 1, 5)),
            (6, "b", "Q", dt.datetime(2024, 1, 1), None),
            (7, None, "Q", dt.datetime(2024, 1, 1), None),
        ],
    )
    ids = lambda df: sorted(r.reading_id for r in df.collect())
    assert ids(pipeline.newer(came, catalogue.high_watermark(loaded))) == [3, 6, 7]
    assert ids(pipeline.newer(came, catalogue.high_watermark(loaded, "received_at"))) == [3, 4, 6, 7]


def test_backfill_side_by_side_and_failed_only(spark):
    reg = registry(spark, [(str(i), True, True) for i in range(6)])

    def fetch(gauge):
        if gauge["gauge_id"] == "3":
            raise ValueError("broken")
        return spark.range(int(gauge["gauge_id"]))

    log = pipeline.backfill(spark, reg, fetch, lambda df, g: df.count())
    assert {r.gauge_id: (r.status, r.rows) for r in log.collect()} == {"0": ("EMPTY", 0), "1": ("SUCCESS", 1), "2": ("SUCCESS", 2), "3": ("FAILED", 0), "4": ("SUCCESS", 4), "5": ("SUCCESS", 5)}
    failed = pipeline.failed_gauges(log)
    again = pipeline.backfill(spark, reg, lambda g: None, lambda df, g: 0, failed).collect()
    assert failed == {"3"} and [(r.gauge_id, r.status) for r in again] == [("3", "EMPTY")]


def test_registry_check_raises_on_unknown_sources(spark):
    reg = registry(spark, [("a", True, True)])
    assert pipeline.check_registry(reg).count() == 1
    with pytest.raises(ValueError, match="unknown"):
        pipeline.check_registry(reg.withColumn("source_system", F.lit("elsewhere")))


def test_places_of_a_distributed_order(spark):
    df = spark.createDataFrame([(5, "b"), (None, "a"), (3, "a"), (5, "a")], "n int, s string")
    assert [(r.n, r.s) for r in sorted(catalogue.placed(df, ["n", "s"]).collect(), key=lambda r: r.place)] == [(None, "a"), (3, "a"), (5, "a"), (5, "b")]
    assert catalogue.placed(df.limit(0), ["n"]).count() == 0


def test_nan_is_no_value_at_ingest(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), float("nan")), (dt.datetime(2024, 1, 1), 2.0)], "timestamp timestamp, value double")
    assert sorted([r.value for r in pipeline.bronze_schema(df).collect()], key=str) == [2.0, None]
