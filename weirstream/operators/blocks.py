"""Row blocks: ordered series cut so that one series never has to fit one task.

Rows get their number within the series without ordering the series in one task: they are numbered within (series, day), and
a summary of one row per series and day, summed up by day, gives each day's offset. Blocks of ``BLOCK`` consecutive rows then
take the ``CONTEXT`` rows on either side along, so a window over rows looks the same inside a block as over the whole series.

Statistics of whole series (medians, deviations, quantiles) come from the distribution of values, counted before the shuffle:
exact, and the work of one task is bounded by the different values of a series, not by its rows.

Defined results: rows with a NULL key are left out, rows without a time come first; a series without values has NULL
statistics; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirstream.functions.timefn import DAY_US, floor_div

BLOCK, CONTEXT = 8192, 128


def in_blocks(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], value: str = "value", block: int = BLOCK, context: int = CONTEXT, low: float = 0.1, high: float = 0.9, stats: bool = True) -> DataFrame:
    """Add ``_block, _own`` (False for context), ``_n`` (number in the series), ``_total`` (rows of the series) and the statistics ``_st_*``.

    Statistics: ``a`` of the size of steps, ``s`` of signed steps, ``v`` of values; each with ``_med``, ``_mad``, ``_lo``, ``_hi``.
    Checks that need none of them save half of the plan by ``stats=False``.
    """
    if context >= block:
        raise ValueError("a block must be longer than its context")
    numbered, sizes = numbered_rows(df, keys, order)
    at = F.pmod(F.col("_n") - 1, F.lit(block))
    home = floor_div(F.col("_n") - 1, block)
    places = F.array_compact(
        F.array(home, F.when((at < context) & (home > 0), home - 1), F.when((at >= block - context) & (F.col("_n") + (block - at) <= F.col("_total")), home + 1))
    )
    blocks = numbered.withColumn("_home", home).withColumn("_block", F.explode(places)).withColumn("_own", F.col("_block") == F.col("_home")).drop("_home")
    if not stats:
        return blocks
    w = Window.partitionBy(*keys, "_block").orderBy(*order)
    step = F.col(value) - F.lag(value).over(w)
    own = blocks.select(*keys, "_block", *order, value, "_own").withColumn("_s", step).filter("_own")
    x = lambda name, c: F.struct(F.lit(name).alias("what"), c.cast("double").alias("x"))
    spread = own.select(*keys, F.explode(F.array(x("a", F.abs("_s")), x("s", F.col("_s")), x("v", F.col(value)))).alias("e")).select(*keys, "e.*")
    dist = spread.filter("x is not null").groupBy(*keys, "what", "x").agg(F.count(F.lit(1)).alias("w"))
    quant = dist.groupBy(*keys, "what").agg(F.percentile("x", F.array(F.lit(low), F.lit(0.5), F.lit(high)), F.col("w")).alias("q"))
    mad = dist.join(quant, [*keys, "what"]).groupBy(*keys, "what").agg(F.max("q").alias("q"), F.percentile(F.abs(F.col("x") - F.col("q")[1]), F.lit(0.5), F.col("w")).alias("mad"))
    pick = lambda name, c: F.max(F.when(F.col("what") == name, c))
    stats = mad.groupBy(*keys).agg(
        *[pick(n, c).alias(f"_st_{n}_{m}") for n in ("a", "s", "v") for m, c in (("med", F.col("q")[1]), ("mad", F.col("mad")), ("lo", F.col("q")[0]), ("hi", F.col("q")[2]))]
    )
    # one row per series and block, so that the join meets blocks and not series
    per_block = sizes.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), floor_div(F.col("_total") - 1, block)))).join(stats, list(keys), "left").drop("_total")
    return blocks.join(per_block, [*keys, "_block"])


def numbered_rows(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Rows with ``_n`` (number in the series) and ``_total``, and the sizes of the series."""
    rows = df.withColumn("_day", F.coalesce(floor_div(F.unix_micros(F.col(order[0]).cast("timestamp")), DAY_US), F.lit(-(1 << 40))))
    days = rows.groupBy(*keys, "_day").agg(F.count(F.lit(1)).alias("_c"))
    by_day = Window.partitionBy(*keys).orderBy("_day")
    days = days.withColumn("_off", F.sum("_c").over(by_day) - F.col("_c")).withColumn("_total", F.sum("_c").over(Window.partitionBy(*keys)))
    w = Window.partitionBy(*keys, "_day").orderBy(*order)
    numbered = rows.withColumn("_rn", F.row_number().over(w)).join(days.drop("_c"), [*keys, "_day"]).withColumn("_n", F.col("_off") + F.col("_rn")).drop("_rn", "_off", "_day")
    return numbered, days.select(*keys, "_total").distinct()
