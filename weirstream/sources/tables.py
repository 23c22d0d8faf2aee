"""Readers for the Parquet tables; a table is one file or one directory of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstream.session import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table. Filters and projections placed on the result reach the Parquet reader."""
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def usable(value) -> "F.Column":
    """True where a measurement is a number: neither NULL nor NaN."""
    return value.isNotNull() & ~F.isnan(value)
