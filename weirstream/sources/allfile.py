"""Text exports from files to Bronze: lines with numbers, blocks, traces, one row per station, trace and time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstream.functions.vocab import dataset_id, infer_type, trace_code
from weirstream.operators.align import dedup

MARK = "Station Site:"


def read_blocks(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """One row per block, split at the block mark by the reader itself, so that a large file is read in parts."""
    # the text reader keeps the bytes of a record as they are, so they can be decoded afterwards
    raw = spark.read.option("lineSep", MARK).text(path).withColumn("value", F.decode(F.col("value").cast("binary"), encoding))
    return raw.withColumn("file", F.col("_metadata.file_path")).filter(F.col("value").contains("Time stamp,"))


def parse_blocks(blocks: DataFrame) -> DataFrame:
    """``station, trace, name, parameter, n, timestamp, value, quality, remarks`` of every data row with a valid time.

    Blocks without station number or header give nothing; ``---`` and empty are missing; commas beyond the last column stay in Remarks.
    """
    lines = F.split(F.regexp_replace("value", "\r", ""), "\n")
    named = lambda n: F.nullif(F.trim(F.regexp_extract("value", rf"(?m)^{n}:\t([^\r\n]*)", 1)), F.lit(""))
    b = blocks.select("file", lines.alias("lines"), named("Station Number").alias("station"), named("Time series Name").alias("name"), named("Parameter Name").alias("parameter"))
    b = b.withColumn("at", F.array_position(F.transform("lines", lambda x: x.startswith("Time stamp,")), True).cast("int")).filter("station is not null and at > 0")
    names = F.transform(F.split(F.element_at("lines", F.col("at")), ","), lambda x: F.lower(F.trim(x)))
    r = b.withColumn("names", names).withColumn("n_cols", F.size("names")).select("*", F.posexplode(F.slice("lines", F.col("at") + 1, F.size("lines"))).alias("n", "line")).filter(F.trim("line") != "")
    r = r.withColumn("f", F.split("line", ",", F.col("n_cols")))
    cell = lambda name: F.nullif(F.nullif(F.trim(F.try_element_at("f", F.nullif(F.array_position("names", name), F.lit(0)).cast("int"))), F.lit("---")), F.lit(""))
    return r.select(
        "file", "station", trace_code(F.col("name")).alias("trace"), "name", "parameter", "n",
        F.try_to_timestamp(F.get("f", F.lit(0)), F.lit("dd/MM/yyyy HH:mm:ss")).cast("timestamp_ntz").alias("timestamp"),
        cell("value").try_cast("double").alias("value"),
        cell("quality code").alias("supplier_flag"), F.try_element_at("f", F.col("n_cols")).alias("remarks"),
    ).filter("timestamp is not null")


def to_bronze(rows: DataFrame, run_date: str) -> DataFrame:
    """Bronze rows: first of each station, trace and time in order of file and line; rows without value dropped."""
    one = dedup(rows.withColumn("_o", F.struct("file", "n")), ["station", "trace", "timestamp"], "_o", "first").filter("value is not null")
    kind = infer_type(F.coalesce(F.col("parameter"), F.col("name"), F.lit("")))
    return one.select(
        "timestamp", "value", "supplier_flag", dataset_id(F.lit("WISKI"), F.col("station"), kind, F.lit(run_date).cast("date"), F.col("trace")).alias("dataset_id"),
        F.col("station").alias("site_id"), kind.alias("data_type"), F.lit(None).cast("string").alias("period"),
    )


def ingest(spark: SparkSession, path: str, run_date: str, encoding: str = "ISO-8859-1") -> DataFrame:
    return to_bronze(parse_blocks(read_blocks(spark, path, encoding)), run_date)


# Names of value and flag columns, in order of preference.
VALUE_NAMES = ("value", "flow", "level", "stage", "rainfall", "discharge")
FLAG_NAMES = ("quality code", "quality", "flag", "status")


def infer_columns(names: Column) -> tuple[Column, Column]:
    """The value and the flag column among the names of a header; NULL where none is known."""
    low = F.transform(names, lambda x: F.lower(F.trim(x)))
    pick = lambda known: F.coalesce(*[F.trim(F.try_element_at(names, F.nullif(F.array_position(low, n), F.lit(0)).cast("int"))) for n in known])
    return pick(VALUE_NAMES), pick(FLAG_NAMES)


def ingest_log(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy(F.col("site_id").alias("gauge_id"), "dataset_id").agg(F.count(F.lit(1)).alias("rows"))


def unknown_gauges(bronze: DataFrame, registry: DataFrame) -> DataFrame:
    """Registry rows for stations that it lacks: not live, already backfilled."""
    parameter = F.when(F.col("data_type") == "Q", "flow").when(F.col("data_type") == "H", "level").when(F.col("data_type") == "P", "rainfall")
    new = bronze.select(F.col("site_id").alias("gauge_id"), parameter.alias("data_type")).distinct()
    new = new.join(registry.select("gauge_id").distinct(), "gauge_id", "left_anti")
    return new.select("gauge_id", F.lit("WISKI_ALL").alias("source_system"), "data_type", F.lit(True).alias("active"), F.lit(False).alias("live"), F.lit(True).alias("backfill_done"))
