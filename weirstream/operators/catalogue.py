"""Catalogues of what the store holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirstream.functions.timefn import period_seconds
from weirstream.operators.blocks import numbered_rows


def only(df: DataFrame, **wanted: list | None) -> DataFrame:
    """Optional IN-lists: a None keeps everything."""
    for name, values in wanted.items():
        if values is not None:
            df = df.filter(F.col(name).isin(list(values)))
    return df


def supplier_of(dataset: Column) -> Column:
    return F.split(dataset, "_")[0]


def gauge_catalogue(bronze: DataFrame, keys: tuple[str, ...] = ("site_id", "supplier_code", "data_type", "period")) -> DataFrame:
    """First time, last time and number of rows of each series."""
    df = bronze.withColumn("supplier_code", supplier_of(F.col("dataset_id")))
    return df.groupBy(*keys).agg(F.min("timestamp").alias("start"), F.max("timestamp").alias("end"), F.count(F.lit(1)).alias("n"))


def coverage(bronze: DataFrame) -> DataFrame:
    """The catalogue with days held and the number of readings its period would give (NULL for an unknown period)."""
    held = gauge_catalogue(bronze)
    span = F.unix_micros(F.col("end").cast("timestamp")) - F.unix_micros(F.col("start").cast("timestamp"))
    expected = F.rint(span / 1e6 / period_seconds(F.col("period"))).cast("bigint") + 1
    return held.withColumn("days_held", F.floor(span / 86_400_000_000).cast("bigint")).withColumn("expected_obs", expected)


def silver_catalogue(silver: DataFrame) -> DataFrame:
    return silver.groupBy("data_type", "site_id").agg(
        F.min(F.year("timestamp")).alias("min_year"), F.max(F.year("timestamp")).alias("max_year"), F.countDistinct("dataset_id").alias("n_datasets")
    )


def silver_coverage(silver: DataFrame) -> DataFrame:
    """Rows by quality flag and per cent good of each series."""
    flag = F.col("qc_flag")
    return (
        silver.groupBy("data_type", "site_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(flag == i).alias(n) for i, n in ((1, "good"), (2, "estimated"), (3, "suspect"), (4, "rejected"))],
            F.to_date(F.min("timestamp")).alias("first_day"),
            F.to_date(F.max("timestamp")).alias("last_day"),
        )
        .withColumn("pct_good", F.round(100 * F.col("good") / F.col("n"), 1))
    )


def high_watermark(bronze: DataFrame, arrival: str | None = None) -> DataFrame:
    """Latest time of each series (site and data type), and with ``arrival`` also the latest arrival, as ``seen``."""
    seen = [F.max(arrival).alias("seen")] if arrival else []
    return bronze.groupBy("site_id", "data_type").agg(F.max("timestamp").alias("watermark"), *seen)


def run_summary(log: DataFrame, alert_pct: float = 5.0) -> DataFrame:
    """Counts by status, per cent failed and whether that calls for an alert."""
    s = F.col("status")
    return log.agg(
        F.count(F.lit(1)).alias("gauges"),
        *[F.count_if(s == x).alias(x.lower()) for x in ("SUCCESS", "EMPTY", "FAILED")],
    ).withColumn("pct_failed", F.round(100 * F.col("failed") / F.nullif(F.col("gauges"), F.lit(0)), 1)).withColumn("alert", F.coalesce(F.col("pct_failed") > alert_pct, F.lit(False)))


def placed(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows in order, with ``place`` from 1; NULLs come first.

    A distributed sort by ranges, then numbers within each range and the sizes of the ranges before: no task holds all rows.
    """
    ranged = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).withColumn("_part", F.spark_partition_id())
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_off", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).drop("_n")  # one row a partition
    w = Window.partitionBy("_part").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return ranged.withColumn("_k", F.row_number().over(w)).join(before, "_part").withColumn("place", F.col("_k") + F.col("_off")).drop("_k", "_off", "_part")


def head(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows, as a listing shows them."""
    return df.orderBy(*order).limit(n)


def thin(df: DataFrame, keys: list[str], order: list[str], most: int) -> DataFrame:
    """Every k-th row of a series, so that at most ``most`` stay: points for a plot. Rows with a NULL key are left out."""
    numbered, _ = numbered_rows(df, tuple(keys), tuple(order))
    every = F.greatest(F.lit(1), F.ceil(F.col("_total") / most))
    return numbered.filter((F.col("_n") - 1) % every == 0).drop("_n", "_total")
