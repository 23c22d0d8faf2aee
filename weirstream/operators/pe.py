"""Potential evaporation: annual sine, disaggregation to 15 minutes, and cumulative volumes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

YEAR = 365.25
OMEGA = 2 * math.pi / YEAR
UNITS = {"m3": 1.0, "Ml": 1e3, "Gl": 1e6}
SLOTS = {"15min": 96, "hourly": 24, "daily": 1}


def fit_sine(df: DataFrame, keys: list[str], day: str = "date", value: str = "pe", least: int = 14) -> DataFrame:
    """``pe = B + A sin(w (doy - phi))`` by least squares on sine and cosine, solved in closed form from covariances.

    One aggregation per fit. A series with fewer than ``least`` days has no fit.
    """
    d = F.dayofyear(day)
    x = df.withColumns({"_s": F.sin(OMEGA * d), "_c": F.cos(OMEGA * d)}).filter(F.col(value).isNotNull())
    cov = F.covar_pop
    m = x.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg("_s").alias("ms"), F.avg("_c").alias("mc"), F.avg(value).alias("my"),
        cov("_s", "_s").alias("ss"), cov("_c", "_c").alias("cc"), cov("_s", "_c").alias("sc"), cov("_s", value).alias("sy"), cov("_c", value).alias("cy"), F.var_pop(value).alias("yy"),
    )
    det = F.nullif(F.col("ss") * F.col("cc") - F.col("sc") * F.col("sc"), F.lit(0.0))
    m = m.filter(F.col("n") >= least).withColumns({"c1": (F.col("sy") * F.col("cc") - F.col("cy") * F.col("sc")) / det, "c2": (F.col("cy") * F.col("ss") - F.col("sy") * F.col("sc")) / det})
    rest = F.greatest(F.col("yy") - F.col("c1") * F.col("sy") - F.col("c2") * F.col("cy"), F.lit(0.0))
    return m.select(
        *keys,
        (F.col("my") - F.col("c1") * F.col("ms") - F.col("c2") * F.col("mc")).alias("B"),
        F.sqrt(F.col("c1") ** 2 + F.col("c2") ** 2).alias("A"),
        F.pmod(F.atan2(-F.col("c2"), F.col("c1")) / OMEGA, F.lit(YEAR)).alias("phi"),
        F.when(F.col("yy") > 0, 1 - rest / F.nullif(F.col("yy"), F.lit(0.0))).alias("r2"),
        F.sqrt(rest).alias("rmse"),
        F.col("n").cast("bigint").alias("n"),
    )


def sine(day: Column, b: Column, a: Column, phi: Column) -> Column:
    return F.greatest(F.lit(0.0), b + a * F.sin(OMEGA * (F.dayofyear(day) - phi)))


def generate_sine(params: DataFrame, start: str, end: str) -> DataFrame:
    """Daily values of each row of (B, A, phi), from ``start`` to ``end``."""
    if end < start:
        raise ValueError("end lies before start")
    days = F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    return params.withColumn("date", days).withColumn("pe", sine(F.col("date"), F.col("B"), F.col("A"), F.col("phi")))


def regionalise(params: DataFrame, weight: str | None = None) -> DataFrame:
    """Weighted means of B and A and circular mean of phi; rows without a fit count for nothing."""
    p = params.filter(F.col("B").isNotNull() & F.col("A").isNotNull() & F.col("phi").isNotNull())
    w = F.col(weight) if weight else F.lit(1.0)
    mean = lambda c: F.sum(w * c) / F.sum(w)
    angle = F.atan2(F.sum(w * F.sin(OMEGA * F.col("phi"))), F.sum(w * F.cos(OMEGA * F.col("phi"))))
    return p.agg(mean(F.col("B")).alias("B"), mean(F.col("A")).alias("A"), F.pmod(angle / OMEGA, F.lit(YEAR)).alias("phi"))


def compare_sine(df: DataFrame, keys: list[str], day: str = "date", value: str = "pe") -> DataFrame:
    """Bias (fitted less observed), RMSE and R2 of the clamped sine against observations; rows carry B, A, phi."""
    f = sine(F.col(day), F.col("B"), F.col("A"), F.col("phi"))
    x = df.filter(F.col(value).isNotNull()).withColumn("_e", f - F.col(value))
    g = x.groupBy(*keys).agg(F.avg("_e").alias("bias"), F.sqrt(F.avg(F.col("_e") ** 2)).alias("rmse"), F.avg(F.col("_e") ** 2).alias("_m"), F.var_pop(value).alias("_v"))
    return g.withColumn("r2", F.when(F.col("_v") > 0, 1 - F.col("_m") / F.nullif(F.col("_v"), F.lit(0.0)))).drop("_m", "_v")


def disaggregate(df: DataFrame, period: str, at: str = "timestamp", value: str = "value") -> DataFrame:
    """Equal 15-minute shares of hourly or daily totals, from the start of the hour or of the day."""
    n = {"hourly": 4, "daily": 96}[period]
    kind = df.schema[at].dataType
    start = F.col(at).cast("timestamp") if period == "hourly" else F.date_trunc("day", F.col(at).cast("timestamp"))
    us = F.unix_micros(start) + F.col("_i").cast("bigint") * 900_000_000
    return df.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn(at, F.timestamp_micros(us).cast(kind)).withColumn(value, F.col(value) / n).drop("_i")


def add_cumulative(df: DataFrame, keys: list[str], order: list[str], totals: dict[str, str]) -> DataFrame:
    """Add running sums (new column -> value column) in which NULL counts as nothing.

    Summed within (series, day); a summary of one row per series and day gives what came before, so no series is one task.
    A row without a time comes first; rows with a NULL key are left out.
    """
    x = df.withColumn("_day", F.coalesce(F.to_date(order[0]), F.lit("0001-01-01").cast("date")))
    days = x.groupBy(*keys, "_day").agg(*[F.sum(F.coalesce(F.col(v), F.lit(0.0))).alias(f"_d_{out}") for out, v in totals.items()])
    before = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(*keys, "_day", *[F.coalesce(F.sum(f"_d_{out}").over(before), F.lit(0.0)).alias(f"_b_{out}") for out in totals])
    w = Window.partitionBy(*keys, "_day").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumns({f"_r_{out}": F.sum(F.coalesce(F.col(v), F.lit(0.0))).over(w) for out, v in totals.items()}).join(days, [*keys, "_day"])
    return x.withColumns({out: F.col(f"_b_{out}") + F.col(f"_r_{out}") for out in totals}).drop("_day", *[f"_{p}_{out}" for out in totals for p in "br"])


def to_volume(kind: str, value: Column, period: str, units: str = "Ml", weight: float = 1.0, area_km2: float = 1.0, pe_daily: Column | None = None) -> Column:
    """Volume of one step: rain or evaporation (mm) over an area, less daily evaporation shared over its steps; flow (m3/s) times its seconds."""
    if kind in ("rainfall", "pe"):
        net = value - F.coalesce(pe_daily, F.lit(0.0)) / SLOTS[period] if pe_daily is not None else value
        return net * (weight * area_km2 * 1e3 / UNITS[units])
    if kind == "flow":
        return value * ({"15min": 900, "hourly": 3600, "daily": 86400}[period] / UNITS[units])
    raise ValueError(f"{kind} has no volume")


def with_daily(df: DataFrame, daily: DataFrame, at: str = "timestamp", value: str = "pe") -> DataFrame:
    """Every reading with ``pe_daily``, the evaporation of its day; NULL on days without one. ``daily`` has one row per ``date``."""
    x = daily.groupBy("date").agg(F.max(value).alias("pe_daily"))
    return df.withColumn("date", F.to_date(at)).join(x, "date", "left").drop("date")


def combine(*parts: DataFrame, at: str = "timestamp", value: str = "value") -> DataFrame:
    """Sum of several series by time, a missing value counting as nothing."""
    out = parts[0].select(at, value)
    for p in parts[1:]:
        out = out.unionByName(p.select(at, value))
    return out.groupBy(at).agg(F.sum(F.coalesce(F.col(value), F.lit(0.0))).alias(value))


def double_mass(x: DataFrame, y: DataFrame, keys: list[str], at: str = "timestamp", value: str = "value") -> DataFrame:
    """Running totals of two series at their common times."""
    j = x.select(*keys, at, F.col(value).alias("x")).join(y.select(*keys, at, F.col(value).alias("y")), [*keys, at])
    return add_cumulative(j, keys, [at], {"cum_x": "x", "cum_y": "y"}).select(*keys, at, "cum_x", "cum_y")
