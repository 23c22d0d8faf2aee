"""Typed series: a lazy DataFrame with what is known of it. Checks look at the schema only; printing starts no job."""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARAMETERS = ("rainfall", "flow", "level")
PERIODS = ("daily", "15min")
PE_PERIODS = ("daily", "hourly", "15min")
METHODS = ("uniform_hourly", "uniform_daily")


def _need(df: DataFrame, columns: dict[str, tuple[str, ...]]) -> None:
    kinds = dict(df.dtypes)
    for name, allowed in columns.items():
        if name not in kinds:
            raise ValueError(f"readings lack column {name!r}")
        if kinds[name] not in allowed:
            raise ValueError(f"column {name!r} is {kinds[name]}, not {' or '.join(allowed)}")


_TIMES = ("timestamp", "timestamp_ntz")


@dataclass(frozen=True)
class Series:
    """Readings ``dateTime, date, value, measure_notation`` of one parameter and period."""

    df: DataFrame
    parameter: str
    period_name: str
    from_date: datetime.date | None = None
    to_date: datetime.date | None = None
    downloaded_at: datetime.datetime | None = field(default=None, compare=False)

    def __post_init__(self):
        if self.parameter not in PARAMETERS:
            raise ValueError(f"unknown parameter {self.parameter!r}")
        if self.period_name not in PERIODS:
            raise ValueError(f"no series of period {self.period_name!r}")
        _need(self.df, {"dateTime": _TIMES, "date": ("date",), "value": ("double",), "measure_notation": ("string",)})

    def as_long(self) -> DataFrame:
        lead = ["parameter", "dateTime", "date", "value", "measure_notation"]
        df = self.df.withColumn("parameter", F.lit(self.parameter))
        return df.select(*lead, *[c for c in df.columns if c not in lead])

    def counts(self) -> DataFrame:
        return self.df.agg(F.countDistinct("measure_notation").alias("n_measures"), F.count(F.lit(1)).alias("n_rows"))

    def __repr__(self):
        return f"<{self.parameter} {self.period_name}: {self.from_date} to {self.to_date}>"


@dataclass(frozen=True)
class PESeries:
    """Potential evaporation ``dateTime, date, value``."""

    df: DataFrame
    period_name: str
    source_name: str = ""
    from_date: datetime.date | None = None
    to_date: datetime.date | None = None
    disagg_method: str | None = None

    def __post_init__(self):
        if self.period_name not in PE_PERIODS:
            raise ValueError(f"no evaporation of period {self.period_name!r}")
        if self.disagg_method is not None and (self.period_name != "15min" or self.disagg_method not in METHODS):
            raise ValueError(f"unknown method {self.disagg_method!r}")
        _need(self.df, {"dateTime": _TIMES, "date": ("date",), "value": ("double",)})

    def to_15min(self) -> "PESeries":
        from weirstream.operators.pe import disaggregate

        if self.period_name == "15min":
            raise ValueError("already 15 minutes")
        df = disaggregate(self.df.withColumn("dateTime", F.col("dateTime") if self.period_name == "hourly" else F.col("date").cast("timestamp_ntz")), self.period_name, "dateTime")
        return PESeries(df.withColumn("date", F.to_date("dateTime")), "15min", self.source_name, self.from_date, self.to_date, f"uniform_{self.period_name}")

    def __repr__(self):
        return f"<potential evaporation {self.period_name} of {self.source_name or 'unknown source'}>"


CLASSES = {(p, d): (lambda df, f=None, t=None, p=p, d=d: Series(df, p, d, f, t)) for p in PARAMETERS for d in PERIODS}


def rainfall_daily(df, start=None, end=None):
    return Series(df, "rainfall", "daily", start, end)


def rainfall_15min(df, start=None, end=None):
    return Series(df, "rainfall", "15min", start, end)


def flow_daily(df, start=None, end=None):
    return Series(df, "flow", "daily", start, end)


def flow_15min(df, start=None, end=None):
    return Series(df, "flow", "15min", start, end)


def level_daily(df, start=None, end=None):
    return Series(df, "level", "daily", start, end)


def level_15min(df, start=None, end=None):
    return Series(df, "level", "15min", start, end)
