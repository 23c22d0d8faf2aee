"""Vocabularies, identifiers and paths of the store, as plain dictionaries and column expressions."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
DATA_TYPES = {"flow": "Q", "level": "H", "rainfall": "P", "soil_moisture": "SM", "snow": "SWE", "pe": "PE"}
SUPPLIERS = {"HDE": "EA", "WISKI": "WISKI", "WISKI_ALL": "WISKI", "NRFA": "NRFA", "MO": "MO", "CEH": "CEH"}
CATEGORIES = ("hydrometric", "radarH19", "MOSES")
SOURCES = ("HDE", "WISKI", "WISKI_ALL")
TYPE_PARAMETERS = {"Q": "flow", "H": "level", "P": "rainfall"}
VALUE_TYPES = {"m": "mean", "min": "min", "max": "max", "t": "total", "i": "instantaneous"}
PERIOD_NAMES = {"900": "15min", "3600": "hourly", "86400": "daily"}


def lookup(mapping: dict, key: Column) -> Column:
    """Value of ``key`` in a small dictionary; NULL where it is unknown."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), key)


def data_type_code(parameter: Column) -> Column:
    return lookup(DATA_TYPES, parameter)


def supplier_code(source: Column) -> Column:
    return lookup(SUPPLIERS, source)


def type_to_parameter(data_type: str) -> str:
    if data_type not in TYPE_PARAMETERS:
        raise ValueError(f"no parameter for data type {data_type!r}")
    return TYPE_PARAMETERS[data_type]


def dataset_id(supplier: Column, site: Column, data_type: Column, received: Column, trace: Column | None = None) -> Column:
    """``SUPPLIER_SITE_TYPE[_trace]_yyyyMMdd``; an empty trace is none."""
    parts = [supplier, site, data_type]
    if trace is not None:
        parts.append(F.when(trace != "", trace))
    return F.concat_ws("_", *parts, F.date_format(received, "yyyyMMdd"))


def bronze_path(root: Column, category: Column, supplier: Column, data_type: Column, dataset: Column, year: Column | None = None) -> Column:
    y = year.cast("string") if year is not None else F.substring(dataset, -8, 4)
    return F.concat_ws("/", root, F.lit("bronze"), category, supplier, data_type, y, F.concat(dataset, F.lit(".parquet")))


def silver_path(root: Column, category: Column, data_type: Column, dataset: Column) -> Column:
    return F.concat_ws("/", root, F.lit("silver"), category, data_type, F.substring(dataset, -8, 4), F.concat(dataset, F.lit(".parquet")))


def category_of_path(path: Column, root: str) -> Column:
    """First folder under ``<root>/bronze/``."""
    return F.regexp_extract(path, "^" + root.rstrip("/").replace(".", "\\.") + "/bronze/([^/]+)/", 1)


def measure_parts(notation: Column) -> dict[str, Column]:
    """Parameter, value type and period from the dash-separated tail of a measure id; unknown codes are kept as they are."""
    parts = F.split(notation, "-")
    part = lambda i: F.get(parts, F.lit(i))
    return {
        "parameter": part(5),
        "value_type": F.coalesce(lookup(VALUE_TYPES, part(6)), part(6)),
        "period_name": F.coalesce(lookup(PERIOD_NAMES, part(7)), part(7)),
    }


def trace_code(name: Column) -> Column:
    """Third part of a time-series name, in lower case with ``_`` for other characters; the whole name if it has fewer; ``unknown`` without one."""
    parts = F.split(name, "/")
    return F.coalesce(F.regexp_replace(F.lower(F.when(F.size(parts) >= 3, F.get(parts, F.lit(2))).otherwise(name)), "[^a-z0-9]", "_"), F.lit("unknown"))


def infer_type(name: Column) -> Column:
    return F.when(name.rlike("(?i)flow|discharge"), "Q").when(name.rlike("(?i)level|stage"), "H").when(name.rlike("(?i)rain"), "P").otherwise("Q")


def hydro_year(day: Column) -> tuple[Column, Column]:
    """Hydrological year (from 1 October, named after the year it ends in) and day within it."""
    year = F.year(day) + (F.month(day) >= 10).cast("int")
    return year, F.datediff(day, F.make_date(year - 1, F.lit(10), F.lit(1))) + 1


def date_chunks(start: datetime.date, end: datetime.date) -> list[tuple[datetime.date, datetime.date]]:
    """Chunks of a year from ``start`` (29 February steps to the 28th), the last ending at ``end``."""
    out, at, n = [], start, 0
    while at < end:
        n += 1
        try:
            following = start.replace(year=start.year + n)
        except ValueError:
            following = start.replace(year=start.year + n, day=28)
        out.append((at, min(following, end)))
        at = following
    return out
