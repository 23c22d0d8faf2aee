"""Irregular readings onto a regular grid.

Every series (``keys``) becomes one row per period between its first and last usable reading. All kinds of measurement go
through the same arithmetic, that of a cumulative counter: what accrued between two consecutive readings is an increment
that belongs to the time between them and is shared out over the grid cells in proportion to the overlap.

* ``counter``: the increment is the difference of the two readings. A fall is a reset: the meter started again from
  zero, so the increment is the new reading itself.
* ``level`` (flow, stage): the counter is the integral of the series over time; the increment is the mean of the two
  readings times the seconds between them, and the cell's value is the accrued integral over the covered seconds.
* ``total`` (rainfall): the reading is the increment; it belongs to the time since the previous reading, at most one period.

Two readings further apart than ``max_gap`` periods leave the time between them uncovered.

Defined results: NULL and NaN values, NULL times and NULL keys are no readings; for one time several readings count as one,
the last in order of ``order`` (a revision); a series without a known period is left out; a series with one reading gives
one cell; an empty table gives an empty result. Other columns of the input are ignored, whatever their names.

Plan: the shuffle key is (series, UTC day), so a series with a third of all rows is spread over its days. What crosses
midnight (the previous reading) comes from a summary of one row per series and day, joined on the same key: the data is
shuffled once, then once more as partial sums per cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirstream.functions.timefn import floor_div, period_seconds, text_of_s
from weirstream.sources.tables import usable

#: Cells of one outage that are unfolded from one row.
CHUNK = 1024


def regular_grid(
    df: DataFrame,
    keys: tuple[str, ...] = ("site_id", "data_type"),
    ts: str = "timestamp",
    value: str = "value",
    period: str = "period",
    order: str = "reading_id",
    kind: Column | None = None,
    max_gap: float = 1.5,
) -> DataFrame:
    """One row per series and period: ``keys, slot_start_s, step_s, n_readings, amount, covered_s, resets, value, status``.

    ``kind`` is a column expression giving ``counter``, ``level`` or ``total`` (default: P is total, all else level).
    ``status``: ``observed`` (a reading lies in the cell), ``filled`` (no reading, but the whole cell lies between two
    readings no further apart than ``max_gap`` periods), ``gap`` (no reading, not wholly covered; ``value`` is NULL).
    """
    k = [f"_k{i}" for i in range(len(keys))]
    kind = kind if kind is not None else F.when(F.col(keys[-1]) == "P", "total").otherwise("level")
    rows = df.select(
        *[F.col(c).alias(a) for c, a in zip(keys, k)],
        F.unix_micros(F.col(ts).cast("timestamp")).alias("t"),
        F.col(value).cast("double").alias("v"),
        period_seconds(F.col(period)).alias("p"),
        F.col(order).alias("o"),
        kind.alias("kind"),
    )
    for a in k:
        rows = rows.filter(F.col(a).isNotNull())
    # the period of a series may stand in rows without a usable value, so it is taken from all rows
    rows = rows.withColumn("day", F.coalesce(floor_div(F.col("t"), 86_400_000_000), F.lit(0)))
    good = usable(F.col("v")) & F.col("t").isNotNull()
    by_day = Window.partitionBy(*k).orderBy("day")
    days = (
        rows.groupBy(*k, "day")
        .agg(F.max("p").alias("p"), F.max(F.when(good, F.struct("t", "o", "v"))).alias("last"))
        .withColumn("step", F.max("p").over(Window.partitionBy(*k)))
        .withColumn("carry", F.last("last", ignorenulls=True).over(by_day.rowsBetween(Window.unboundedPreceding, -1)))
        .filter(F.col("step").isNotNull() & F.col("last").isNotNull())
        .select(*k, "day", "step", F.col("carry.t").alias("ct"), F.col("carry.v").alias("cv"))
    )
    w = Window.partitionBy(*k, "day").orderBy("t", "o")
    run = (
        rows.filter(good)
        .drop("p")
        .withColumn("superseded", F.coalesce(F.lead("t").over(w) == F.col("t"), F.lit(False)))
        .filter(~F.col("superseded"))
        .withColumn("pt", F.lag("t").over(w))
        .withColumn("pv", F.lag("v").over(w))
        .join(days, [*k, "day"])
        .withColumn("first", F.col("pt").isNull())
        .withColumn("pt", F.when(F.col("first"), F.col("ct")).otherwise(F.col("pt")))
        .withColumn("pv", F.when(F.col("first"), F.col("cv")).otherwise(F.col("pv")))
    )
    step_us = F.col("step") * 1_000_000
    apart = F.col("t") - F.col("pt")
    covered = F.coalesce(apart <= step_us * F.lit(max_gap), F.lit(False))
    reset = (F.col("kind") == "counter") & (F.col("v") < F.col("pv"))
    seconds = apart / 1e6
    increment = (
        F.when(F.col("kind") == "total", F.col("v"))
        .when(F.col("kind") == "counter", F.when(reset, F.col("v")).otherwise(F.col("v") - F.col("pv")))
        .otherwise((F.col("v") + F.col("pv")) / 2 * seconds)
    )
    run = run.select(
        *k,
        "t",
        "step",
        "kind",
        "v",
        step_us.alias("u"),
        # a total accrued within at most one period
        F.when(covered, F.when(F.col("kind") == "total", F.greatest(F.col("pt"), F.col("t") - step_us)).otherwise(F.col("pt"))).alias("since"),
        F.when(covered | (F.col("kind") == "total"), increment).alias("inc"),
        F.coalesce(reset & covered, F.lit(False)).cast("int").alias("reset"),
        floor_div(F.col("t"), step_us).alias("own"),
        F.coalesce(floor_div(F.col("pt"), step_us), floor_div(F.col("t"), step_us)).alias("from"),
    )
    cells = (
        run.withColumn("block", F.explode(F.sequence(floor_div(F.col("from"), CHUNK), floor_div(F.col("own"), CHUNK))))
        .withColumn(
            "slot",
            F.explode(F.sequence(F.greatest(F.col("from"), F.col("block") * CHUNK), F.least(F.col("own"), F.col("block") * CHUNK + CHUNK - 1))),
        )
        .withColumn("lap", F.greatest(F.lit(0), F.least(F.col("t"), (F.col("slot") + 1) * F.col("u")) - F.greatest(F.col("since"), F.col("slot") * F.col("u"))))
        .withColumn("mine", (F.col("slot") == F.col("own")).cast("int"))
        .withColumn("lap", F.when(F.col("since").isNotNull(), F.col("lap")).otherwise(F.lit(0)))
        .withColumn(
            "part",
            F.when(F.col("since").isNotNull() & (F.col("t") > F.col("since")), F.col("inc") * F.col("lap") / (F.col("t") - F.col("since")))
            .when((F.col("kind") == "total") & (F.col("mine") == 1), F.col("inc")),
        )
        .groupBy(*k, "slot", "step", "kind")
        .agg(
            F.sum("mine").alias("n_readings"),
            F.sum("part").alias("amount"),
            F.least(F.sum("lap") / 1e6, F.max("step").cast("double")).alias("covered_s"),
            F.sum(F.col("reset") * F.col("mine")).alias("resets"),
            F.avg(F.when(F.col("mine") == 1, F.col("v"))).alias("mean_v"),
        )
    )
    whole = F.col("covered_s") >= F.col("step")
    return cells.select(
        *[F.col(a).alias(c) for c, a in zip(keys, k)],
        (F.col("slot") * F.col("step")).alias("slot_start_s"),
        F.col("step").alias("step_s"),
        "n_readings",
        "amount",
        "covered_s",
        "resets",
        F.when((F.col("n_readings") == 0) & ~whole, F.lit(None).cast("double"))
        .when(F.col("kind") == "level", F.coalesce(F.when(F.col("covered_s") > 0, F.col("amount") / F.col("covered_s")), F.col("mean_v")))
        .otherwise(F.col("amount"))
        .alias("value"),
        F.when(F.col("n_readings") > 0, "observed").when(whole, "filled").otherwise("gap").alias("status"),
    )


def empty_cells(grid: DataFrame, keys: tuple[str, ...] = ("site_id", "data_type")) -> DataFrame:
    """The cells of a grid in which no reading lies, with their start as text."""
    return grid.filter(F.col("n_readings") == 0).select(*keys, text_of_s(F.col("slot_start_s")).alias("slot_start"))
