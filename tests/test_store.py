import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from weirstream.functions import vocab
from weirstream.operators import align, export, gaps, pe, rating
from weirstream.plans import pipeline, series
from weirstream.sources import allfile, api, store
from weirstream.streaming import stream

T0 = dt.datetime(2022, 1, 1)


def points(spark, seconds, value=1.0):
    return spark.createDataFrame([(i, "a", "H", T0 + dt.timedelta(seconds=s), value) for i, s in enumerate(seconds)], "reading_id bigint, site_id string, data_type string, timestamp timestamp, value double")


@pytest.mark.parametrize("offsets,rows,snapped", [([0, 60, 900], 2, 0), ([60, 900], 2, 1), ([0, 60, 900, 1800, 2580, 2700], 4, 0), ([930], 1, 0)])
def test_snap(spark, offsets, rows, snapped):
    out = align.snap_offgrid(points(spark, offsets))
    assert out.count() == rows and out.filter("snapped").count() == snapped


def test_dedup_and_gaps(spark):
    df = points(spark, [0, 0, 900, 3600])
    assert sorted(r.reading_id for r in align.dedup(df, ["site_id", "timestamp"], "reading_id").collect()) == [1, 2, 3]
    assert sorted(r.reading_id for r in align.dedup(df, ["site_id", "timestamp"], "reading_id", "first").collect()) == [0, 2, 3]
    g = gaps.check_gaps(points(spark, [0, 900, 1800, 3600, 4500, 7200]), ["site_id"]).orderBy("gap_start").collect()
    assert [r.n_missing for r in g] == [1, 2]
    assert gaps.gap_counts(points(spark, [5]), ["site_id"]).collect()[0].n_missing == 0


LIMBS = [(1, 0.0, 0.095, 12.2495, -0.003, 1.641, False), (2, 0.095, 2.0, 23.252, -0.098, 2.706, False), (3, 2.0, float("inf"), 23.252, -0.098, 2.706, True)]


def limbs(spark):
    return spark.createDataFrame([(*x, 1) for x in LIMBS], "limb_no int, lower double, upper double, c double, a double, b double, doubtful boolean, k int")


def test_rating_round_trip_and_nulls(spark):
    curve = rating.limb_table(limbs(spark), ["k"])
    h = spark.createDataFrame([(x, 1) for x in (0.05, 0.1, 0.5, 1.0, 1.8, 3.0, -1.0, None)], "value double, k int")
    q = rating.rate(h, curve, ["k"])
    back = rating.unrate(q, curve, ["k"]).select("value", "flow", "stage").collect()
    for r in back:
        if r.value is None or r.value < 0:
            assert r.flow is None and r.stage is None
        else:
            assert r.stage == pytest.approx(r.value, abs=1e-3)
    assert rating.rate(h.limit(0), curve, ["k"]).count() == 0
    fixed = {r.limb_no: r.c for r in rating.fix_continuity(limbs(spark), ["k"]).collect()}
    adjusted = limbs(spark).drop("c").join(spark.createDataFrame(list(fixed.items()), "limb_no int, c double"), "limb_no")
    assert all(r.connected for r in rating.limb_continuity(adjusted, ["k"]).collect())


def test_limb_validation():
    good = [dict(lower=0.0, upper=1.0, c=1.0, a=0.0, b=2.0), dict(lower=1.0, upper=2.0, c=1.0, a=0.0, b=2.0)]
    rating.validate_limbs(good)
    for change in ({"lower": None}, {"lower": 1.5}, {"c": 0.0}, {"b": -1.0}, {"a": float("nan")}, {"lower": 2.5}):
        with pytest.raises(ValueError):
            rating.validate_limbs([good[0], good[1] | change])
    with pytest.raises(ValueError):
        rating.validate_set([("2019-01-01", "2020-06-30"), ("2020-01-01", None)])


def test_pe(spark):
    p = spark.createDataFrame([(1, 2.5, 2.0, 172.0)], "k int, B double, A double, phi double")
    days = pe.generate_sine(p, "2010-01-01", "2019-12-31").drop("B", "A", "phi")
    fit = pe.fit_sine(days, ["k"]).collect()[0]
    assert (fit.B, fit.A, fit.phi) == (pytest.approx(2.5, abs=1e-6), pytest.approx(2.0, abs=1e-6), pytest.approx(172.0, abs=1e-3)) and fit.n == 3652
    assert pe.fit_sine(days.limit(5), ["k"]).count() == 0
    both = spark.createDataFrame([(1.0, 1.0, 360.0), (1.0, 1.0, 5.0), (None, None, None)], "B double, A double, phi double")
    assert pe.regionalise(both).collect()[0].phi == pytest.approx(0.125, abs=1e-6) or pe.regionalise(both).collect()[0].phi == pytest.approx(365.125, abs=1e-6)
    daily = points(spark, [0, 86400], 9.6)
    out = pe.disaggregate(daily, "daily")
    assert out.count() == 192 and out.agg(F.sum("value")).collect()[0][0] == pytest.approx(19.2)
    with pytest.raises(ValueError):
        pe.to_volume("level", F.lit(1.0), "daily")


def test_vocabulary_and_export(spark):
    y, n = vocab.hydro_year(F.col("d"))
    rows = spark.createDataFrame([(dt.date(2023, 9, 30),), (dt.date(2023, 10, 1),), (dt.date(2024, 1, 1),), (dt.date(2020, 9, 30),)], "d date").select(y, n).collect()
    assert [tuple(r) for r in rows] == [(2023, 365), (2024, 1), (2024, 93), (2020, 366)]
    assert vocab.date_chunks(dt.date(2020, 2, 29), dt.date(2022, 1, 1)) == [(dt.date(2020, 2, 29), dt.date(2021, 2, 28)), (dt.date(2021, 2, 28), dt.date(2022, 1, 1))]
    assert export.fmp_header("t", "c", ["x", "y"]) == ["t,,", "c,,", ",,", "Time,x,y"]


def test_text_export_to_bronze(spark, tmp_path):
    block = "Station Site:\tA\nStation Number:\t3401TH\nParameter Name:\tStage\nTime series Name:\tN/3401TH/SG_DS/15m\nTime stamp,Value,Quality Code,Remarks\n01/01/2020 00:00:00,1.234,1,Gerät\n01/01/2020 00:15:00,---,1,note, with, commas\n"
    (tmp_path / "x.all").write_bytes(("preamble\n" + block + block + block.replace("Station Number:\t3401TH\n", "") + "Station Site:\tZ\nStation Number:\t9\n").encode("latin-1"))
    parsed = allfile.parse_blocks(allfile.read_blocks(spark, str(tmp_path / "x.all")))
    assert parsed.count() == 4 and {r.remarks for r in parsed.collect()} == {"Gerät", "note, with, commas"}
    out = allfile.to_bronze(parsed, "2024-01-05").collect()
    assert len(out) == 1 and out[0].dataset_id == "WISKI_3401TH_H_sg_ds_20240105" and out[0].value == 1.234


def test_store_round_trip(spark, tmp_path):
    root = str(tmp_path)
    assert store.setup_store(spark, root).filter("created").count() > 10 and store.setup_store(spark, root).filter("created").count() == 0
    df = points(spark, [0, 900]).withColumn("dataset_id", F.lit("EA_a_H_20220101")).withColumn("period", F.lit("15min"))
    store.write_bronze(df, root, "hydrometric")
    assert spark.read.parquet(f"{root}/bronze/category=hydrometric").count() == 2
    silver = pipeline.promote(df, flagged_at=T0)
    for _ in range(2):
        store.write_silver(silver, root, "hydrometric")
    assert spark.read.parquet(f"{root}/silver").count() == 2
    reg = store.provenance(df)
    assert tuple(reg.columns) == store.REGISTER and reg.count() == 1
    store.replace_table(df, f"{root}/t")
    store.replace_table(spark.read.parquet(f"{root}/t").limit(1), f"{root}/t")
    assert spark.read.parquet(f"{root}/t").count() == 1 and not os.path.exists(f"{root}/t.old")


def test_api_and_backfill(spark):
    body = '{"items": [{"measure": {"@id": "http://x/id/measures/u-u-u-u-u-flow-i-900-m3s-qualified"}, "dateTime": "2024-01-01T00:00:00Z", "value": 1.5}, {"measure": {"@id": "m"}, "date": "2024-01-02", "value": 2}]}'
    rows = api.parse_readings(spark.createDataFrame([(body,), ("{}",), (None,)], "value string")).collect()
    assert [r.value for r in rows] == [1.5, 2.0] and rows[1].timestamp == dt.datetime(2024, 1, 2)
    got, ok = api.sync(spark, "m", dt.date(2020, 1, 1), dt.date(2022, 1, 1), lambda p, q: body.encode(), pause_s=0)
    assert ok and got.count() == 4
    reg = spark.createDataFrame([("a", "flow", True), ("b", "flow", True), ("c", "flow", True), ("d", "flow", False)], "gauge_id string, data_type string, active boolean")

    def fetch(g):
        if g["gauge_id"] == "b":
            raise OSError("down")
        return reg if g["gauge_id"] == "a" else None

    log = {r.gauge_id: r.status for r in pipeline.backfill(spark, reg, fetch, lambda df, g: df.count()).collect()}
    assert log == {"a": "SUCCESS", "b": "FAILED", "c": "EMPTY"}


def test_series_classes(spark):
    df = points(spark, [0]).select(F.col("timestamp").alias("dateTime"), F.to_date("timestamp").alias("date"), "value", F.lit("m").alias("measure_notation"))
    s = series.flow_15min(df)
    assert s.as_long().columns[0] == "parameter" and "flow" in repr(s)
    with pytest.raises(ValueError):
        series.flow_daily(df.drop("value"))
    pe15 = series.PESeries(df.drop("measure_notation"), "daily").to_15min()
    assert pe15.df.count() == 96 and pe15.disagg_method == "uniform_daily"
    with pytest.raises(ValueError):
        series.PESeries(df, "weekly")


def test_stream_dedup(spark, tmp_path):
    df = points(spark, [0, 0, 900]).withColumn("received_at", F.lit(T0).cast("timestamp"))
    df.write.parquet(str(tmp_path / "bronze.parquet"))
    assert stream.run_dedup(spark, str(tmp_path)).count() == 2
