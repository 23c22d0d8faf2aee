"""Gaps of series against their own step.

Times are put in order within (series, day) only; the time before a day's first comes from a summary of one row per series
and day, so a series with a third of all rows is many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirstream.functions.timefn import epoch_s, floor_div


def _times(df: DataFrame, keys: list[str]) -> DataFrame:
    t = df.select(*keys, epoch_s(F.col("timestamp")).alias("t")).filter("t is not null").distinct()
    return t.withColumn("day", floor_div(F.col("t"), 86_400))


def _with_before(t: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``before``: the time before ``t`` in its series."""
    days = t.groupBy(*keys, "day").agg(F.max("t").alias("last"))
    days = days.withColumn("carry", F.lag("last").over(Window.partitionBy(*keys).orderBy("day"))).drop("last")
    w = Window.partitionBy(*keys, "day").orderBy("t")
    return t.withColumn("_lag", F.lag("t").over(w)).join(days, [*keys, "day"]).withColumn("before", F.coalesce("_lag", "carry")).drop("_lag", "carry")


def steps(df: DataFrame, keys: list[str], interval: Column | None = None) -> DataFrame:
    """Per series: first and last time, number of times, median difference ``m`` and the step (given, else ``m`` cut to seconds)."""
    d = _with_before(_times(df, keys), keys).withColumn("d", F.col("t") - F.col("before"))
    dist = d.groupBy(*keys, "d").agg(F.count(F.lit(1)).alias("w"), F.min("t").alias("t0"), F.max("t").alias("t1"))
    out = dist.groupBy(*keys).agg(F.min("t0").alias("t0"), F.max("t1").alias("t1"), F.sum("w").alias("n"), F.percentile("d", F.lit(0.5), F.col("w")).alias("m"))
    step = F.floor("m").cast("bigint")
    return out.withColumn("step", F.coalesce(interval, step) if interval is not None else step)


def gap_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of missing steps per series."""
    s = steps(df, keys)
    expected = F.rint((F.col("t1") - F.col("t0")) / F.col("step")).cast("bigint") + 1
    return s.select(*keys, F.when((F.col("n") < 2) | ~F.coalesce(F.col("step") > 0, F.lit(False)), F.lit(0).cast("bigint")).otherwise(F.greatest(F.lit(0), expected - F.col("n"))).alias("n_missing"))


def check_gaps(df: DataFrame, keys: list[str]) -> DataFrame:
    """``gap_start, gap_end, n_missing`` of each run of missing times on the grid that starts at the series' first time.

    A reading off that grid fills nothing. The missing runs lie between neighbouring readings on the grid, so no grid is
    unfolded and no anti-join is needed.
    """
    s = steps(df, keys).filter("n >= 2 and step > 0").select(*keys, "t0", "t1", "step")
    t = _times(df, keys)
    # one row per series and day, so that the join meets days and not series
    per_day = t.select(*keys, "day").distinct().join(s, keys)
    on = t.join(per_day, [*keys, "day"]).filter((F.col("t") - F.col("t0")) % F.col("step") == 0).select(*keys, "t", "day", "t0", "step", F.lit(False).alias("end"))
    end = F.col("t0") + (F.floor((F.col("t1") - F.col("t0")) / F.col("step")) + 1).cast("bigint") * F.col("step")
    last = s.select(*keys, end.alias("t"), floor_div(end, 86_400).alias("day"), "t0", "step", F.lit(True).alias("end"))
    on = _with_before(on.unionByName(last), keys)
    on = on.withColumn("k", ((F.col("t") - F.col("t0")) / F.col("step")).cast("bigint")).withColumn("before", ((F.col("before") - F.col("t0")) / F.col("step")).cast("bigint"))
    text = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    return (
        on.filter(F.col("k") > F.col("before") + 1)
        .select(
            *keys,
            text(F.col("t0") + (F.col("before") + 1) * F.col("step")).alias("gap_start"),
            text(F.col("t0") + (F.col("k") - 1) * F.col("step")).alias("gap_end"),
            (F.col("k") - F.col("before") - 1).alias("n_missing"),
        )
    )


def infer_period(df: DataFrame, keys: list[str], limits: tuple = ((900, "15min"), (3600, "hourly")), otherwise: str = "daily", alone: str = "15min") -> DataFrame:
    """Period label of each series from its median step; ``alone`` for a series with fewer than two times."""
    label = F.when(F.col("m").isNull(), alone)
    for most, name in limits:
        label = label.when(F.col("m") <= most, name)
    return steps(df, keys).select(*keys, label.otherwise(otherwise).alias("period_name"))


def with_period(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every row with ``period``, the label of its series; 15 minutes for a series without two times and for NULL keys."""
    known = infer_period(df, keys)
    return df.drop("period").join(known, keys, "left").withColumn("period", F.coalesce("period_name", F.lit("15min"))).drop("period_name")
