"""Streams of readings: deduplication within a watermark, the latest reading per gauge, and checks by micro-batch."""

from __future__ import annotations

import glob
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstream.plans.pipeline import promote
from weirstream.session import checkpoint_dir, keep_until_end, prepare

KEYS = ["site_id", "data_type", "timestamp"]


def read_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """File stream over a folder of Bronze Parquet files (or one file)."""
    schema = spark.read.parquet(path).schema
    if os.path.isdir(path):
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    folder, name = os.path.split(path)
    return spark.readStream.schema(schema).option("pathGlobFilter", glob.escape(name)).parquet(folder)


def dedup_stream(readings: DataFrame, delay: str = "7 days", at: str = "received_at") -> DataFrame:
    """Each (site, type, time) once; repeats arriving more than ``delay`` later are not remembered."""
    return readings.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", delay).dropDuplicatesWithinWatermark(KEYS).drop("_at")


def watermarks(readings: DataFrame) -> DataFrame:
    """Latest time per gauge as it grows; state is one row per gauge."""
    return readings.groupBy("site_id").agg(F.max("timestamp").alias("watermark"))


def promote_batches(readings: DataFrame, history, write, checkpoint: str):
    """Check each micro-batch together with the last rows before it: the checks look ``max window`` rows back and ahead.

    ``history(batch)`` gives the earlier rows needed, ``write(silver)`` takes the checked rows.
    """

    def run(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            write(promote(batch.unionByName(history(batch), allowMissingColumns=True)))

    return readings.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_dedup(spark: SparkSession, sf_dir: str, delay: str = "7 days") -> DataFrame:
    """Run the deduplicated stream of ``bronze`` over what there is, into the shared checkpoint folder, and read it back.

    State is kept for ``delay``: a repeat that arrives in a later batch and later than that is let through. The files go when
    the application ends.
    """
    prepare(spark)
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    out = dedup_stream(read_stream(spark, f"{sf_dir}/bronze.parquet"), delay).select(*KEYS)
    keep_until_end(spark, base)
    q = out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{base}/out")
