"""Overlapping and gapped time intervals, as run bitmaps.

Time is cut into whole days, days into words of 32 and words into shards of 64. A window becomes, per entity and shard, a
compressed run: the words at its edges carry a bit mask, words covered wholly carry the full mask, and a shard covered
wholly is one row without words. Masks of one (entity, word) are united by ``bit_or``, which aggregates before the
shuffle, so an entity with a third of all windows still sends one mask per word and task. Set runs and clear runs are read
off the united words: a run starts at a bit whose predecessor is clear and ends at a bit whose successor is clear.

An entity's united words are bounded by the calendar, not by its rows: 200 years are 2,283 words.

Defined results: windows with a NULL entity or start, an unreadable start, or an end before the start take no part; a NULL
end is open; an end that is no date makes its window take no part; repeated, nested and touching windows are one period;
an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirstream.functions.timefn import floor_div

BITS = 32
WORDS = 64
FULL = (1 << BITS) - 1


def _pow2(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), n.cast("int"))


def day_number(text: Column) -> Column:
    """Days since 1970 of a ``yyyy-MM-dd`` text (or date); NULL where it is none."""
    return F.unix_date(F.try_to_date(F.trim(text.cast("string")), "yyyy-MM-dd"))


def run_bitmaps(df: DataFrame) -> DataFrame:
    """(e, lo, hi) day runs, ``hi`` NULL for open -> (e, word, mask, open): the united words, the open tail kept apart."""
    open_from = df.filter(F.col("hi").isNull()).groupBy("e").agg(F.min("lo").alias("open_lo"))
    closed = df.filter(F.col("hi").isNotNull())
    w0, w1 = floor_div(F.col("lo"), BITS), floor_div(F.col("hi"), BITS)
    shards = (
        closed.withColumn("w0", w0)
        .withColumn("w1", w1)
        .withColumn("shard", F.explode(F.sequence(floor_div(F.col("w0"), WORDS), floor_div(F.col("w1"), WORDS))))
        .withColumn("whole", (F.col("lo") <= F.col("shard") * BITS * WORDS) & (F.col("hi") >= (F.col("shard") + 1) * BITS * WORDS - 1))
    )
    edge_words = (
        shards.filter(~F.col("whole"))
        .withColumn("word", F.explode(F.sequence(F.greatest(F.col("w0"), F.col("shard") * WORDS), F.least(F.col("w1"), F.col("shard") * WORDS + WORDS - 1))))
        .withColumn("b0", F.greatest(F.col("lo") - F.col("word") * BITS, F.lit(0)))
        .withColumn("b1", F.least(F.col("hi") - F.col("word") * BITS, F.lit(BITS - 1)))
        .select("e", "word", (_pow2(F.col("b1") + 1) - _pow2(F.col("b0"))).alias("mask"))
    )
    whole_shards = (
        shards.filter("whole")
        .select("e", "shard")
        .distinct()
        .withColumn("word", F.explode(F.sequence(F.col("shard") * WORDS, F.col("shard") * WORDS + WORDS - 1)))
        .select("e", "word", F.lit(FULL).cast("bigint").alias("mask"))
    )
    opened = open_from.select("e", floor_div(F.col("open_lo"), BITS).alias("word"), F.lit(0).cast("bigint").alias("mask"), "open_lo")
    null_lo = F.lit(None).cast("bigint").alias("open_lo")
    return (
        edge_words.select("*", null_lo)
        .unionByName(whole_shards.select("*", null_lo))
        .unionByName(opened.withColumn("open_lo", F.col("open_lo").cast("bigint")))
        .groupBy("e", "word")
        .agg(F.expr("bit_or(mask)").alias("mask"), F.min("open_lo").alias("open_lo"))
    )


def continuous_periods(df: DataFrame, entity: str = "site_id", start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """``entity, kind, first_day, last_day``: the periods of each entity and the gaps between them; ``last_day`` may be ``open``."""
    lo, hi = day_number(F.col(start)), day_number(F.col(end))
    runs = (
        df.select(F.col(entity).alias("e"), lo.cast("bigint").alias("lo"), hi.cast("bigint").alias("hi"), F.col(end).isNull().alias("open"))
        .filter(F.col("e").isNotNull() & F.col("lo").isNotNull() & (F.col("open") | (F.col("hi") >= F.col("lo"))))
        .select("e", "lo", "hi")
        .distinct()
    )
    words = run_bitmaps(runs)
    by_e = Window.partitionBy("e").orderBy("word")
    tail = F.min("open_lo").over(Window.partitionBy("e"))
    # from the first open window on, every day is set
    first_bit = F.col("tail") - F.col("word") * BITS
    filled = (
        F.when(F.col("tail").isNull() | (first_bit > BITS - 1), F.col("mask"))
        .when(first_bit <= 0, F.lit(FULL).cast("bigint"))
        .otherwise(F.col("mask").bitwiseOR(F.lit(FULL).cast("bigint") - (_pow2(first_bit) - 1)))
    )
    words = (
        words.withColumn("tail", tail)
        .filter(F.col("tail").isNull() | (F.col("word") * BITS <= F.col("tail")))
        .withColumn("mask", filled)
        .filter(F.col("mask") != 0)
        .withColumn("before", F.when(F.lag("word").over(by_e) == F.col("word") - 1, F.lag("mask").over(by_e)).otherwise(F.lit(0)))
        .withColumn("after", F.when(F.lead("word").over(by_e) == F.col("word") + 1, F.lead("mask").over(by_e)).otherwise(F.lit(0)))
    )
    ends_open = F.col("tail").isNotNull() & (F.col("word") == floor_div(F.col("tail"), BITS))

    def bit(mask: Column, i: Column) -> Column:
        return F.call_function("shiftright", mask, i.cast("int")).bitwiseAND(F.lit(1).cast("bigint"))

    def set_before(i: Column) -> Column:
        return F.when(i == 0, bit(F.col("before"), F.lit(BITS - 1))).otherwise(bit(F.col("mask"), F.greatest(i - 1, F.lit(0))))

    def set_after(i: Column) -> Column:
        return F.when(i == BITS - 1, F.when(ends_open, F.lit(1)).otherwise(bit(F.col("after"), F.lit(0)))).otherwise(bit(F.col("mask"), F.least(i + 1, F.lit(BITS - 1))))

    places = F.sequence(F.lit(0), F.lit(BITS - 1))
    edges = words.select(
        "e",
        "tail",
        F.explode(
            F.filter(
                F.transform(
                    places,
                    lambda i: F.struct(
                        (F.col("word") * BITS + i).alias("day"),
                        ((bit(F.col("mask"), i) == 1) & (set_before(i) == 0)).alias("starts"),
                        ((bit(F.col("mask"), i) == 1) & (set_after(i) == 0)).alias("ends"),
                    ),
                ),
                lambda x: x["starts"] | x["ends"],
            )
        ).alias("x"),
    ).select("e", "tail", "x.*")
    by_day = Window.partitionBy("e").orderBy("day")
    spans = (
        edges.withColumn("next_day", F.lead("day").over(by_day))
        .withColumn("last", F.when(F.col("ends"), F.col("day")).otherwise(F.col("next_day")))
        .filter("starts")
        .withColumn("next_start", F.lead("day").over(by_day))
    )

    def text(day: Column) -> Column:
        return F.date_format(F.date_from_unix_date(day.cast("int")), "yyyy-MM-dd")

    out = spans.select(
        F.col("e").alias(entity),
        F.explode(
            F.array_compact(
                F.array(
                    F.struct(F.lit("period").alias("kind"), text(F.col("day")).alias("first_day"), F.coalesce(text(F.col("last")), F.lit("open")).alias("last_day")),
                    F.when(
                        F.col("next_start").isNotNull(),
                        F.struct(F.lit("gap").alias("kind"), text(F.col("last") + 1).alias("first_day"), text(F.col("next_start") - 1).alias("last_day")),
                    ),
                )
            )
        ).alias("x"),
    )
    return out.select(entity, "x.*")
