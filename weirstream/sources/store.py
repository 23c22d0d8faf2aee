"""Sinks: the partitioned store, the register of provenance, and replacement of small tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What a new store holds.
CATEGORIES = {
    "hydrometric": {"suppliers": ["EA", "WISKI", "NRFA"], "data_types": ["Q", "H", "P"]},
    "radarH19": {"suppliers": ["MO"], "data_types": ["P"]},
    "MOSES": {"suppliers": ["MO"], "data_types": ["SM", "PE"]},
}
PURPOSES = {"hydrometric": {"Q": ["FFA"], "P": ["catchment_average"]}}
REGISTER = (
    "dataset_id", "tier", "status", "supplier", "supplier_code", "site_id", "data_type", "time_period_start", "time_period_end", "temporal_resolution", "units",
    "file_format_received", "date_received", "received_by", "method_of_receipt", "supplier_quality_flags", "known_limitations", "file_path", "notes",
)


def setup_store(spark: SparkSession, root: str, categories: dict = CATEGORIES, purposes: dict = PURPOSES) -> DataFrame:
    """Create the folders that are missing; gives ``path, created``."""
    dirs = []
    for name, cfg in categories.items():
        for s in cfg["suppliers"]:
            dirs += [f"bronze/{name}/{s}/{t}" for t in cfg["data_types"] if s != "NRFA" or t == "Q"]
        for t in cfg["data_types"]:
            dirs += [f"silver/{name}/{t}", f"gold/{name}/{t}"]
            dirs += [f"gold/{name}/{t}/{p}" for p in purposes.get(name, {}).get(t, [])]
    if "hydrometric" in categories:
        dirs += [f"{tier}/hydrometric/ratings" for tier in ("bronze", "silver", "gold")]
    out = []
    for d in [*dirs, "register"]:
        path = os.path.join(root, d)
        out.append((path, not os.path.isdir(path)))
        os.makedirs(path, exist_ok=True)
    return spark.createDataFrame(out, "path string, created boolean")


def write_bronze(df: DataFrame, root: str, category: str, tasks: int = 8) -> None:
    """Append under ``bronze/category/supplier/type/year``, rows of one folder gathered into ``tasks`` files, so that files stay large."""
    x = df.withColumns({"category": F.lit(category), "supplier_code": F.split("dataset_id", "_")[0], "year": F.year("timestamp")})
    spread = F.pmod(F.xxhash64("site_id", F.to_date("timestamp")), F.lit(tasks))  # to be raised with the size of the load, as one folder may hold a third of all rows
    x.repartition("supplier_code", "data_type", "year", spread).write.mode("append").partitionBy("category", "supplier_code", "data_type", "year").parquet(f"{root}/bronze")


def write_silver(df: DataFrame, root: str, category: str, tasks: int = 8) -> None:
    """Replace the (category, type, year) folders that ``df`` touches, leaving others; ``tasks`` files a folder."""
    x = df.withColumns({"category": F.lit(category), "year": F.year("timestamp")})
    spread = F.pmod(F.xxhash64("site_id", F.to_date("timestamp")), F.lit(tasks))
    x.repartition("data_type", "year", spread).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("category", "data_type", "year").parquet(f"{root}/silver")


def provenance(bronze: DataFrame, **fixed: str) -> DataFrame:
    """One register row per dataset, all nineteen columns."""
    g = bronze.groupBy("dataset_id", "site_id", "data_type").agg(F.min("timestamp").alias("time_period_start"), F.max("timestamp").alias("time_period_end"), F.max("period").alias("temporal_resolution"))
    known = {"tier": F.lit("Bronze"), "status": F.lit("Active"), "supplier_code": F.split("dataset_id", "_")[0], "file_format_received": F.lit("Parquet"), "date_received": F.to_date(F.element_at(F.split("dataset_id", "_"), -1), "yyyyMMdd").cast("string")}
    return g.select(*[F.col(c) if c in g.columns else known[c].alias(c) if c in known else F.lit(fixed.get(c)).cast("string").alias(c) for c in REGISTER])


def append_register(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Write beside the table, then put it in its place; ``df`` may read the table it replaces."""
    staging = f"{path}.{uuid.uuid4().hex}"
    df.write.parquet(staging)
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    new, old = jvm.org.apache.hadoop.fs.Path(staging), jvm.org.apache.hadoop.fs.Path(path)
    fs = old.getFileSystem(conf)
    aside = jvm.org.apache.hadoop.fs.Path(f"{path}.old")
    if fs.exists(old):
        fs.rename(old, aside)
    fs.rename(new, old)
    if fs.exists(aside):
        fs.delete(aside, True)


