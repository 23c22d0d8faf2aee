"""Attributes as known at event time.

An attribute version holds from the later of the start of its window and the moment it became known, up to (not including)
the day after its last day. Successive change times of an entity cut each day into half-open intervals on which one
version is the best; events meet them by an equi-join on (entity, day) and half-open containment.

The bucket is the UTC day: versions meet the days on which their entity has events (``BUCKET`` days at a time, so that one
long version is not one row against all days) and are reduced before the join to the best version at the start of the day
plus those that begin within it, by aggregations with a partial step. An event meets at most one interval, so the join never
multiplies rows, and a hot entity is spread over its days.

Defined results: a version with a NULL key, start, number or known-time takes no part, nor does one whose end is given but
is no date or lies before its start; a NULL end is open; events with a NULL key or time, and events no version covers, are
left out (repeated events are kept); of equal version numbers the greater id wins; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirstream.functions.timefn import DAY_US, floor_div
from weirstream.operators.interval_union import day_number

BUCKET = 64


def as_known(
    events: DataFrame,
    versions: DataFrame,
    entity: str = "site_id",
    event_id: str = "reading_id",
    event_time: str = "timestamp",
    version_id: str = "rating_id",
    rank: str = "version",
    start: str = "valid_from",
    end: str = "valid_to",
    known: str = "saved_at",
    keep: list[str] | None = None,
) -> DataFrame:
    """(event_id, version_id): each event with the highest-ranked version whose window holds the event's UTC day and that was known by then.

    With ``keep``, every event comes back, with those columns in place of its id and NULL where no version covers it.
    """
    held = [event_id] if keep is None else keep
    ev = events.select(
        *[F.col(c).alias(f"_k_{c}") for c in held], F.col(entity).alias("e"), F.unix_micros(F.col(event_time).cast("timestamp")).alias("t")
    )
    if keep is None:
        ev = ev.filter(F.col("e").isNotNull() & F.col("t").isNotNull())
    ev = ev.withColumn("day", floor_div(F.col("t"), DAY_US))
    # open windows reach to the last day on which anything happened: scalar subqueries, two numbers for the whole table
    bound = ev.agg(F.struct(F.max("day").alias("last"), F.min("day").alias("first")).alias("b")).scalar()
    lo, hi = day_number(F.col(start)).cast("bigint"), day_number(F.col(end)).cast("bigint")
    vs = (
        versions.select(
            F.col(entity).alias("e"),
            F.col(version_id).alias("id"),
            F.col(rank).alias("rank"),
            lo.alias("lo"),
            hi.alias("hi"),
            F.col(end).isNull().alias("open"),
            F.unix_micros(F.col(known).cast("timestamp")).alias("known"),
        )
        .filter("e is not null and id is not null and rank is not null and lo is not null and known is not null and (open or hi >= lo)")
        .distinct()
        .withColumn("bound", bound)
        .withColumn("hi", F.least(F.coalesce("hi", "bound.last"), F.col("bound.last")))
        .withColumn("from_t", F.greatest(F.col("lo") * DAY_US, F.col("known")))
        .withColumn("from_day", F.greatest(floor_div(F.col("from_t"), DAY_US), F.col("bound.first")))
        .filter("from_day <= hi")
    )
    best = F.max(F.struct("rank", "id")).alias("best")
    days = ev.filter("e is not null and day is not null").select("e", "day").distinct().withColumn("bucket", floor_div(F.col("day"), BUCKET))
    # few versions cover many days: they are spread before they are unfolded over buckets, and over the days of events in the join
    spread = vs.repartition("e", "id", "lo").withColumn("bucket", F.explode(F.sequence(floor_div(F.col("from_day"), BUCKET), floor_div(F.col("hi"), BUCKET))))
    per_day = (
        days.join(spread, ["e", "bucket"])
        .filter(F.col("day").between(F.col("from_day"), F.col("hi")))
        .withColumn("since", F.greatest(F.col("from_t"), F.col("day") * DAY_US))
        .groupBy("e", "day", "since")
        .agg(best)
    )
    w = Window.partitionBy("e", "day").orderBy("since")
    intervals = per_day.select(
        F.col("e").alias("v_e"),
        F.col("day").alias("v_day"),
        "since",
        F.coalesce(F.lead("since").over(w), (F.col("day") + 1) * DAY_US).alias("until"),
        F.max("best").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("best"),
    )
    met = (F.col("e") == F.col("v_e")) & (F.col("day") == F.col("v_day")) & (F.col("t") >= F.col("since")) & (F.col("t") < F.col("until"))
    return ev.join(intervals, met, "inner" if keep is None else "left").select(*[F.col(f"_k_{c}").alias(c) for c in held], F.col("best.id").alias(version_id))
