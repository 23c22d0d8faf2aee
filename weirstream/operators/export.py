"""Model-input exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstream.operators.align import outer_align


def pdm(df: DataFrame, measure: str, at: str = "timestamp", value: str = "value") -> DataFrame:
    """Date parts in columns and the value under the measure's name."""
    t = F.col(at)
    return df.select(*[f(t).alias(n) for n, f in (("year", F.year), ("month", F.month), ("day", F.dayofmonth), ("hour", F.hour), ("minute", F.minute))], F.second(t).cast("int").alias("second"), F.col(value).alias(measure))


def three_decimals(c: Column, fill: str = "") -> Column:
    """``%.3f`` of the nearest double at three decimals; ``fill`` for NULL."""
    return F.when(c.isNotNull(), F.format_string("%.3f", F.bround(c, 3))).otherwise(fill)


def fmp_rows(df: DataFrame, series: list[str], start: Column, fill: str = "", key: str = "series", at: str = "timestamp", value: str = "value", by: tuple[str, ...] = ("site_id",)) -> DataFrame:
    """Hours since ``start`` and one text column per series, by gauge."""
    wide = outer_align(df, series, key, at, value, by)
    hours = (F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 3.6e9
    return wide.select(*by, F.round(hours, 3).alias("hours"), *[three_decimals(F.col(f"`{s}`"), fill).alias(s) for s in series])


def fmp_header(title: str, comment: str, labels: list[str], gauge_ids: list[str] | None = None) -> list[str]:
    """The four header lines: title, comment, gauge ids, column names; each padded to the number of columns."""
    pad = [""] * len(labels)
    return [",".join(x) for x in ([title, *pad], [comment, *pad], ["", *(gauge_ids or pad)], ["Time", *labels])]
