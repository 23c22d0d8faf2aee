"""Medallion pipeline: Bronze rows, promotion to Silver, reading back, incremental loading and run logs."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstream.functions.vocab import CATEGORIES, SOURCES, TYPE_PARAMETERS, data_type_code
from weirstream.operators import qc
from weirstream.operators.align import dedup, snap_offgrid
from weirstream.operators.as_known import as_known
from weirstream.operators.catalogue import high_watermark
from weirstream.operators.interval_union import day_number
from weirstream.operators.qc import Spec
from weirstream.operators.rating import limb_table, rate
from weirstream.sources.tables import usable

BRONZE = ("timestamp", "value", "supplier_flag", "dataset_id", "site_id", "data_type", "period")
CHECKS = ("negative", "relative_spike", "absolute_spike", "drop", "fluctuation", "truncation_low", "truncation_high")


def bronze_schema(df: DataFrame, timestamp: str = "timestamp", value: str = "value", flag: str | None = "supplier_flag", **fixed: str) -> DataFrame:
    """The seven Bronze columns, cast; ``fixed`` gives constants (dataset_id, site_id, data_type, period). Error without time or value column."""
    for c in (timestamp, value):
        if c not in df.columns:
            raise ValueError(f"column {c!r} is missing")
    text = lambda n: F.lit(fixed[n]) if n in fixed else F.col(n) if n in df.columns else F.lit(None)
    kind = df.schema[timestamp].dataType.simpleString()
    at = F.col(timestamp) if kind.startswith("timestamp") else F.col(timestamp).cast("timestamp")
    return df.select(
        at.alias("timestamp"),
        F.nullif(F.col(value).cast("double"), F.lit(float("nan"))).alias("value"),  # NaN is no value
        (F.col(flag) if flag and flag in df.columns else F.lit(None)).cast("string").alias("supplier_flag"),
        *[text(n).cast("string").alias(n) for n in ("dataset_id", "site_id", "data_type", "period")],
    )


def valid_registry(df: DataFrame) -> DataFrame:
    """Gauges of known sources and categories (``check_registry`` raises on others); missing columns raise, NULL flags mean not set."""
    missing = [c for c in ("gauge_id", "source_system", "data_type", "category") if c not in df.columns]
    if missing:
        raise ValueError(f"registry lacks {missing}")
    for c in ("active", "live"):
        df = df.withColumn(c, F.coalesce(c, F.lit(False)) if c in df.columns else F.lit(True))
    return df.filter(F.col("source_system").isin(*SOURCES) & F.col("category").isin(*CATEGORIES))


def check_registry(df: DataFrame) -> DataFrame:
    """The registry as it is; raises if a row has an unknown source or category."""
    bad = df.filter(~F.coalesce(F.col("source_system").isin(*SOURCES) & F.col("category").isin(*CATEGORIES), F.lit(False))).select("gauge_id", "source_system", "category").head(5)
    if bad:
        raise ValueError(f"registry has unknown sources or categories, such as {[tuple(r) for r in bad]}")
    return valid_registry(df)


def append_unseen(registry: DataFrame, new: DataFrame, key: str = "gauge_id") -> DataFrame:
    """The registry with those of ``new`` whose key it lacks."""
    return registry.unionByName(new.join(registry.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def between(df: DataFrame, at: str, start: str, end: str) -> DataFrame:
    """Half-open range of times."""
    kind = df.schema[at].dataType
    return df.filter((F.col(at) >= F.lit(start).cast(kind)) & (F.col(at) < F.lit(end).cast(kind)))


def on_days(df: DataFrame, at: str = "timestamp", start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of the days from ``start`` to ``end``, both included."""
    kind = df.schema[at].dataType
    if start:
        df = df.filter(F.col(at) >= F.lit(start[:10]).cast(kind))
    if end:
        after = (datetime.date.fromisoformat(end[:10]) + datetime.timedelta(days=1)).isoformat()
        df = df.filter(F.col(at) < F.lit(after).cast(kind))
    return df


def at_least(df: DataFrame, min_quality: int | None) -> DataFrame:
    return df if min_quality is None else df.filter(F.col("qc_flag") <= min_quality)


def promote(bronze: DataFrame, order: str = "reading_id", flagged_at: datetime.datetime | None = None) -> DataFrame:
    """Bronze to Silver: last reading per key, onto the grid, checks by data type, codes, flags and accepted values.

    Each row is checked by its own data type; types without checks get flag 1. The checks run over row blocks, so that a
    gauge with a third of all rows is many tasks.
    """
    keys = ["site_id", "data_type"]
    clean = bronze.filter(F.col("timestamp").isNotNull()).withColumn("value", F.when(usable(F.col("value")), F.col("value")))
    grid = snap_offgrid(dedup(clean, [*keys, "timestamp"], order))
    spec = Spec(tuple(keys), ("timestamp", order), "_block")
    checked = qc.rain_checks(qc.stage_checks(qc.flow_checks(qc.blocked(grid, spec), spec), spec), spec).filter("_own")
    kind = F.col("data_type")
    checked = checked.withColumns({"qc_y_code": F.when(kind == "Q", qc.y_code()), "qc_h_code": F.when(kind == "H", qc.h_code()), "qc_p_code": F.when(kind == "P", qc.p_code())})
    flag = F.when(kind == "Q", qc.y_flag(F.col("qc_y_code"))).when(kind == "H", qc.h_flag(F.col("qc_h_code"))).when(kind == "P", qc.p_flag(F.col("qc_p_code"))).otherwise(1)
    checked = checked.withColumn("qc_flag", flag).withColumn("qc_flag", F.when(F.col("snapped") & (F.col("qc_flag") == 1), 2).otherwise(F.col("qc_flag")))
    at = F.lit(flagged_at) if flagged_at else F.current_timestamp()
    return checked.select(
        *[c for c in bronze.columns], "qc_flag", F.when(F.col("qc_flag") < 4, F.col("value")).alias("qc_value"), "qc_y_code", "qc_h_code", "qc_p_code", at.alias("qc_flagged_at"), "snapped"
    )


def silver_readings(silver: DataFrame) -> DataFrame:
    """Readings as models take them: the accepted value, the raw one beside it, all codes."""
    return silver.select(
        F.col("timestamp").alias("dateTime"), F.to_date("timestamp").alias("date"), F.col("qc_value").alias("value"), F.col("value").alias("raw_value"),
        F.col("dataset_id").alias("measure_notation"), "qc_y_code", "qc_h_code", "qc_p_code",
    )


def read_silver(silver: DataFrame, gauges: Iterable[str], data_type: str, start: str | None = None, end: str | None = None, min_quality: int | None = 1, cols: list[str] | None = None) -> DataFrame:
    """Series of one or many gauges; filters reach the scan."""
    if data_type not in TYPE_PARAMETERS:
        raise ValueError(f"no parameter for data type {data_type!r}")
    df = silver.filter(F.col("site_id").isin(list(gauges)) & (F.col("data_type") == data_type))
    df = at_least(on_days(df, "timestamp", start, end), min_quality)
    if cols is not None:
        df = df.select(*[c for c in df.columns if c in {*cols, "timestamp", "site_id", "value", "qc_value"}])
    return df


def of_catchment(silver: DataFrame, registry: DataFrame, catchment: str) -> DataFrame:
    gauges = registry.filter(F.col("catchment") == catchment).select(F.col("gauge_id").alias("site_id")).distinct()
    return silver.join(gauges, "site_id", "left_semi")


def newer(bronze: DataFrame, watermarks: DataFrame, by: str = "timestamp", keys: tuple[str, ...] = ("site_id", "data_type")) -> DataFrame:
    """Rows later than the watermark of their series; all rows of a series without one.

    Where ``watermarks`` also has ``seen`` (the latest arrival that was loaded), rows that arrived later are new whatever their
    time, so late readings and revisions are not lost.
    """
    known = watermarks.select(*[F.col(k).alias(f"_{k}") for k in keys], "watermark", *[c for c in watermarks.columns if c == "seen"])
    same = [bronze[k].eqNullSafe(known[f"_{k}"]) for k in keys]
    fresh = F.col("watermark").isNull() | (F.col(by) > F.col("watermark"))
    if "seen" in watermarks.columns:
        fresh = fresh | (F.col("received_at") > F.col("seen"))
    return bronze.join(known, same, "left").filter(fresh).select(*bronze.columns)


def rate_series(levels: DataFrame, ratings: DataFrame) -> DataFrame:
    """Stage to flow by the curve valid on the day; the later version wins. Adds ``rating_id`` and ``flow``, NULL without a valid curve."""
    ratings = ratings.withColumn("_always", F.timestamp_seconds(F.lit(-62_135_596_800)))  # validity alone decides: every version counts as always known
    held = as_known(levels, ratings, known="_always", keep=levels.columns)
    curves = limb_table(ratings.filter(day_number(F.col("valid_from")).isNotNull()).select("rating_id", "limb_no", "lower", "upper", "c", "a", "b", "doubtful"), ["rating_id"])
    return rate(held, curves, ["rating_id"])


def run_incremental(
    spark: SparkSession, registry: DataFrame, bronze: DataFrame | None, fetch: Callable[[dict, datetime.date, datetime.date], "DataFrame | None"], write: Callable[[DataFrame, dict], int],
    end_date: datetime.date, default_start: datetime.date = datetime.date(2000, 1, 1), gauges: Iterable[str] | None = None, now: datetime.datetime | None = None,
) -> DataFrame:
    """Load what is new of every live, active gauge and log it: NO_NEW_DATA, SUCCESS, EMPTY or FAILED.

    A gauge begins on the day of its watermark, or at ``default_start`` without one; a gauge at or beyond ``end_date`` has no new
    data. An error is logged and stops no other gauge. The driver walks the gauges, as their requests go out one after another;
    the watermarks come from one aggregation, and a gauge's data stays distributed.
    """
    chosen = valid_registry(registry).filter("active and live")
    if gauges is not None:
        chosen = chosen.filter(F.col("gauge_id").isin(list(gauges)))
    chosen = chosen.withColumn("_type", data_type_code(F.col("data_type")))
    if bronze is not None:
        marks = high_watermark(bronze).select(F.col("site_id").alias("gauge_id"), F.col("data_type").alias("_type"), "watermark")
        chosen = chosen.join(marks, ["gauge_id", "_type"], "left")
    else:
        chosen = chosen.withColumn("watermark", F.lit(None).cast("timestamp"))
    log = []
    for row in chosen.toLocalIterator():
        gauge = row.asDict()
        began = datetime.datetime.now()
        start = gauge["watermark"].date() if gauge["watermark"] is not None else default_start
        status, rows, error = "NO_NEW_DATA", 0, None
        if start < end_date:
            try:
                df = fetch(gauge, start, end_date)
                rows = write(df, gauge) if df is not None else 0
                status = "SUCCESS" if rows else "EMPTY"
            except Exception as e:  # noqa: BLE001
                status, error = "FAILED", str(e)[:500]
        log.append((now or began, gauge["gauge_id"], start, end_date, status, rows, (datetime.datetime.now() - began).total_seconds(), error))
    return spark.createDataFrame(log, "run_at timestamp, gauge_id string, watermark date, end_date date, status string, rows bigint, elapsed_s double, error string")


def backfill(
    spark: SparkSession, registry: DataFrame, fetch: Callable[[dict], "DataFrame | None"], write: Callable[[DataFrame, dict], int], failed_before: set[str] | None = None, workers: int = 4
) -> DataFrame:
    """Fetch every active gauge and log SUCCESS, EMPTY or FAILED; an error of one gauge is logged and does not stop the others.

    ``workers`` gauges are under way at a time, each as jobs of its own; a gauge's data stays distributed. ``failed_before``
    restricts the run to gauges that failed (see ``failed_gauges``).
    """

    def one(gauge: dict) -> tuple:
        status, rows, error = "EMPTY", 0, None
        try:
            df = fetch(gauge)
            if df is not None:
                rows = write(df, gauge)
                status = "SUCCESS" if rows else "EMPTY"
        except Exception as e:  # noqa: BLE001
            status, error = "FAILED", str(e)[:500]
        return gauge["gauge_id"], gauge["data_type"], status, rows, error

    chosen = (row.asDict() for row in registry.filter("active").toLocalIterator())
    if failed_before is not None:
        chosen = (g for g in chosen if g["gauge_id"] in failed_before)
    with ThreadPoolExecutor(workers) as pool:
        log = list(pool.map(one, chosen))
    return spark.createDataFrame(log, "gauge_id string, data_type string, status string, rows bigint, error string")


def failed_gauges(log: DataFrame) -> set[str]:
    """Gauges that a run's log calls failed."""
    return {r[0] for r in log.filter("status = 'FAILED'").select("gauge_id").distinct().toLocalIterator()}
