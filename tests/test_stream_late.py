import datetime as dt

from pyspark.sql import functions as F

from weirstream.streaming.stream import KEYS, dedup_stream, read_stream


def test_late_repeats_within_the_delay_are_dropped(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    schema = "site_id string, data_type string, timestamp timestamp, received_at timestamp"
    batches = [[("a", "Q", t, t)], [("a", "Q", t, t + dt.timedelta(days=2)), ("b", "Q", t, t + dt.timedelta(days=40))], [("c", "Q", t, t + dt.timedelta(days=41)), ("d", "Q", t, t + dt.timedelta(days=1))]]
    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        q = dedup_stream(read_stream(spark, src, 1)).select(*KEYS).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        q.awaitTermination()
    got = sorted(r.site_id for r in spark.read.parquet(out).select(F.col("site_id")).collect())
    # the repeat of a is known still; d comes more than seven days behind the latest arrival and is too late
    assert got == ["a", "b", "c"]
