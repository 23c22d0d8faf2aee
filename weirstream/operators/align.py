"""Deduplication, snapping to the grid and alignment of series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirstream.functions.timefn import epoch_s, floor_div


def dedup(df: DataFrame, keys: list[str], order: str, keep: str = "last") -> DataFrame:
    """One row per key, the last or first by ``order``. Aggregates before the shuffle, so repeated keys never pile up in one task."""
    rest = [c for c in df.columns if c not in keys]
    whole = F.struct(*rest)
    pick = (F.max_by if keep == "last" else F.min_by)(whole, F.col(order)).alias("_x")
    return df.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"_x.{c}").alias(c) for c in rest]).select(*df.columns)


def snap_offgrid(df: DataFrame, keys: tuple[str, ...] = ("site_id", "data_type"), step: int = 900) -> DataFrame:
    """Move readings off the quarter hour to the nearest one (ties to even) unless a reading on the grid holds it; else drop them.

    A reading is off the grid by its minute; seconds do not count. Adds ``snapped``.
    """
    s = epoch_s(F.col("timestamp"))
    on = F.minute("timestamp") % 15 == 0
    slot = F.when(on, floor_div(s, step)).otherwise(F.rint(s / step).cast("bigint"))
    held = F.max(on.cast("int")).over(Window.partitionBy(*keys, "_slot"))
    moved = F.timestamp_seconds(F.col("_slot") * step).cast(df.schema["timestamp"].dataType)
    return (
        df.withColumn("_slot", slot)
        .withColumn("_held", held)
        .filter(on | (F.col("_held") == 0))
        .withColumn("snapped", ~on)
        .withColumn("timestamp", F.when(F.col("snapped"), moved).otherwise(F.col("timestamp")))
        .drop("_slot", "_held")
    )


def outer_align(df: DataFrame, series: list[str], key: str = "series", at: str = "timestamp", value: str = "value", by: tuple[str, ...] = ("site_id",)) -> DataFrame:
    """One column per named series, one row per gauge and time; one shuffle for any number of series.

    ``by`` names what tells gauges apart; it may be empty only where a time has one value of each series. Of repeated values the greatest is taken.
    """
    return df.groupBy(*by, at).pivot(key, series).agg(F.max(value))
