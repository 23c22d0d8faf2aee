"""The measurements API: its JSON from a landing folder, requests in yearly chunks, and the router of sources.

The engine reads landed responses; live requests go through a callable the caller supplies (``get(path, params) -> bytes``),
so that nothing here opens a connection by itself.
"""

from __future__ import annotations

import datetime
import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstream.functions.vocab import date_chunks, measure_parts

# Fixed values.
PARAMETERS = {
    "rainfall": {"observed_property": "rainfall", "value_type": None, "period": "15min"},
    "flow": {"observed_property": "waterFlow", "value_type": "instantaneous", "period": "15min"},
    "level": {"observed_property": "waterLevel", "value_type": "instantaneous", "period": "15min"},
}
HARD_LIMIT = 2_000_000
READINGS = "items array<struct<measure: struct<`@id`: string>, dateTime: string, date: string, value: double, quality: string, completeness: string>>"
STATIONS = "items array<struct<notation: string, label: string, wiskiID: string, RLOIid: string, lat: double, `long`: double, measures: array<struct<`@id`: string, parameter: string>>>>"


def parse_props(events: DataFrame) -> DataFrame:
    """Scalar of a JSON text column, with an explicit schema."""
    return events.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


def parse_readings(responses: DataFrame, body: str = "value") -> DataFrame:
    """Readings of landed responses: ``measure_notation, timestamp, value, quality``. Offsets are discarded, not applied; the date stands in for a missing time."""
    x = responses.select(F.explode(F.from_json(body, READINGS)["items"]).alias("i"))
    at = F.regexp_replace(F.coalesce("i.dateTime", "i.date"), r"(Z|[+-]\d{2}:?\d{2})$", "")
    return x.select(F.element_at(F.split("i.measure.@id", "/"), -1).alias("measure_notation"), F.try_to_timestamp(at).cast("timestamp_ntz").alias("timestamp"), F.col("i.value").alias("value"), F.col("i.quality").alias("quality"))


def parse_stations(responses: DataFrame, body: str = "value", order: str = "seq") -> DataFrame:
    """Stations of landed responses, first of each notation by ``order``, one row per rainfall, flow or level measure."""
    x = responses.select(order, F.posexplode(F.from_json(body, STATIONS)["items"]).alias("pos", "i"))
    first = x.groupBy(F.col("i.notation").alias("notation")).agg(F.min_by("i", F.struct(order, "pos")).alias("i"))
    m = first.select("notation", "i.label", "i.wiskiID", "i.RLOIid", "i.lat", "i.long", F.explode_outer("i.measures").alias("m"))
    m = m.withColumn("measure", F.element_at(F.split("m.@id", "/"), -1)).drop("m")
    return m.select("*", *[c.alias(k) for k, c in measure_parts(F.col("measure")).items()]).filter(F.col("parameter").isin("rainfall", "flow", "level"))


def choose_measures(stations: DataFrame, parameter: str, period: str | None = None, value_type: str | None = None) -> DataFrame:
    """Measures of a parameter; ``all`` keeps every period or value type."""
    cfg = PARAMETERS[parameter]
    out = stations.filter(F.col("parameter") == parameter)
    for name, wanted in (("period_name", period or cfg["period"]), ("value_type", value_type or cfg["value_type"])):
        if wanted and wanted != "all":
            out = out.filter(F.col(name) == wanted)
    return out


def sync(spark: SparkSession, measure: str, start: datetime.date, end: datetime.date, get: Callable[[str, dict], bytes], pause_s: float = 1.0) -> tuple[DataFrame, bool]:
    """Yearly requests one after another; a failed chunk is left out and makes the second result False."""
    bodies, ok = [], True
    for i, (a, b) in enumerate(date_chunks(start, end)):
        if i and pause_s:
            time.sleep(pause_s)
        try:
            bodies.append((i, get(f"measures/{measure}/readings", {"mineq-date": a.isoformat(), "max-date": b.isoformat(), "_limit": HARD_LIMIT}).decode()))
        except OSError:
            ok = False
    return parse_readings(spark.createDataFrame(bodies, "seq int, value string")), ok


def poll(status: Callable[[], bytes], max_wait_s: float = 600, interval_s: float = 15) -> str:
    """Result address of a batch request; error if it fails or takes longer than ``max_wait_s``."""
    until = time.monotonic() + max_wait_s
    while True:
        reply = json.loads(status())
        if reply.get("status") == "Completed":
            return reply["url"]
        if reply.get("status") == "Failed":
            raise RuntimeError("the batch request failed")
        if time.monotonic() >= until:
            raise TimeoutError("the batch request took too long")
        time.sleep(interval_s)


def not_available(gauge: dict, *_):
    raise NotImplementedError("there is no direct access to this source; ingest its text exports")


def route(gauge: dict, sources: dict[str, Callable]) -> DataFrame | None:
    """Fetch a gauge from the source that its registry row names; errors go to the caller."""
    source = sources.get(gauge["source_system"])
    if source is None:
        raise ValueError(f"unknown source {gauge['source_system']!r}")
    return source(gauge)
