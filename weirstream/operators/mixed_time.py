"""Mixed timestamp formats and time zones to one UTC time.

``interpretations`` gives every value the array of all its valid readings: each notation and order of day, month and year
that yields an existing date, times each UTC moment the local time may mean (two where a clock change repeats it, none
where it is skipped). ``choose`` runs Viterbi over each source's record order, over all those readings:

* A reading that departs from the order the source declares costs ``FOREIGN``. Where no reading follows it, "names no
  time" is one more state, at ``NONE``. A source that declares no order leaves all orders free, and the path decides.
* A record in another notation than the one before costs ``SWITCH``, a time before the previous one ``BACK``; steps from
  and to "names no time" cost nothing.

The path is the cheapest over the whole source, however long a stretch of uncertain records is. What it gives is checked
by one rule after: a value whose notation on the path has two moments (a repeated local time) names no one time.

Defined results: NULL, empty and blank texts, texts without a time of day, impossible parts and unknown zones have no
reading; a text with a zone needs no source; an unknown order counts as none declared; ties in record order are taken in
order of id, ties in cost in the order of ``ORDERS``; a record without number comes first; an empty table gives an empty
result.

Plan: interpretations are made in Arrow batches without a shuffle. A record with one reading fixes the path, so the
stretches between such records are independent: a record belongs to the block of ``BLOCK`` record numbers in which the
last fixed record before it lies. Finding that takes a window within (source, block) and a summary of one row per block;
Viterbi then runs by (source, home block). A source with a third of all rows is many tasks. The readings are written to the
shared checkpoint folder once, as both the rows and the summary need them.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirstream.functions.timefn import DAY_US, floor_div
from weirstream.functions.timetext import ORDERS, clock_us, dates_of, day_number, minutes_east, take_apart
from weirstream.session import staged

BLOCK = 4096
FOREIGN, NONE, SWITCH, BACK = 1000.0, 500.0, 1.0, 3.0
READINGS = "array<struct<notation: string, agrees: boolean, us: bigint>>"
_FIXED = re.compile(r"([+-])(0\d|1[0-7]):([0-5]\d)")
_EPOCH = datetime.datetime(1970, 1, 1)


def arrow_readings():
    import pyarrow as pa

    return pa.list_(pa.struct([("notation", pa.string()), ("agrees", pa.bool_()), ("us", pa.int64())]))


@lru_cache(4096)
def zone_of(name: str | None):
    """Minutes east of Greenwich for a fixed zone, a zone with clock changes otherwise; None for an unknown name."""
    from zoneinfo import ZoneInfo

    if not name:
        return None
    m = _FIXED.fullmatch(name)
    if m:
        return (-1 if m.group(1) == "-" else 1) * (int(m.group(2)) * 60 + int(m.group(3)))
    try:
        return ZoneInfo(name)
    except (KeyError, ValueError, OSError):
        return None


@lru_cache(262_144)
def _quarter(zone, quarter: int) -> tuple[int, ...]:
    """The moments at which the clocks of ``zone`` show the start of a quarter hour, in quarters of microseconds since 1970."""
    local = _EPOCH + datetime.timedelta(microseconds=quarter * 900_000_000)
    out = []
    for fold in (0, 1):
        t = local.replace(tzinfo=zone, fold=fold)
        us = quarter * 900_000_000 - int(t.utcoffset().total_seconds() * 1e6)
        back = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc) + datetime.timedelta(microseconds=us)
        if back.astimezone(zone).replace(tzinfo=None) == local and us not in out:
            out.append(us)
    return tuple(sorted(out))


def moments(local_us: int, zone) -> tuple[int, ...]:
    """Every UTC moment at which the clocks of ``zone`` show ``local_us``: none, one or two. Clocks change at quarter hours."""
    if isinstance(zone, int):
        return (local_us - zone * 60_000_000,)
    quarter, rest = divmod(local_us, 900_000_000)
    if not -200_000_000 < quarter < 200_000_000:
        return ()
    return tuple(us + rest for us in _quarter(zone, quarter))


def readings_of(text: str | None, order: str | None, zone) -> list[tuple[str, bool | None, int]]:
    """All readings (notation, whether it follows the declared order; None if none is declared, microseconds since 1970 UTC)."""
    got = take_apart(text)
    if got is None:
        return []
    count, head, clock, named = got
    if count is not None:
        return [("count", True, count)]
    t = clock_us(clock)
    east = minutes_east(named) if named is not None else zone
    if t is None or east is None:
        return []
    out = []
    for notation, y, m, d in dates_of(head):
        day = day_number(y, m, d)
        if day is None:
            continue
        agrees = True if notation == "word" or notation == "ymd" and head[:4].isdigit() else None if order not in ORDERS else notation == order
        out += [(notation, agrees, us) for us in moments(day * DAY_US + t, east)]
    return out


def interpretations(df: DataFrame, text: str, order: Column, zone: Column, out: str = "readings") -> DataFrame:
    """Add ``out``: the array of (notation, agrees, us) of every valid reading.

    ``order`` is the declared order of all-numeric days (ymd, dmy, mdy), ``zone`` the declared zone; either may be NULL.
    """
    x = df.withColumns({"_text": F.col(text), "_order": order, "_zone": zone})
    kept = df.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{out}` {READINGS}"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts, orders, zones = (batch.column(c).to_pylist() for c in ("_text", "_order", "_zone"))
            found = pa.array([readings_of(t, o, zone_of(z)) for t, o, z in zip(texts, orders, zones)], arrow_readings())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], found], names=[*kept, out])

    return x.mapInArrow(run, schema)


def choose(df: DataFrame, source: list[str], number: str, row: str, readings: str = "readings") -> DataFrame:
    """(source, row, us): the UTC microseconds of each value that is settled.

    ``number`` is the record number within its source; ``source`` is given back with its parts joined by a unit separator.
    """
    s = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in source]
    r = F.col(readings)
    fixed = (F.size(r) == 1) & ~F.coalesce(~r[0]["agrees"], F.lit(False))
    rows = df.filter(F.size(r) > 0).select(
        F.concat_ws("\x1f", *s).alias("source"),
        F.coalesce(F.col(number).cast("bigint"), F.lit(-(1 << 62))).alias("number"),
        F.col(row).alias("row"),
        F.when(fixed, F.struct(r[0]["us"].alias("us"), r[0]["notation"].alias("notation"))).alias("only"),
        F.when(~fixed, r).alias("many"),
    )
    # the rows and the summary both need the readings; written once, they are not made twice
    rows = staged(rows.withColumn("block", floor_div(F.col("number"), BLOCK)), "times")
    inside = Window.partitionBy("source", "block").orderBy("number", "row").rowsBetween(Window.unboundedPreceding, 0)
    met = F.count("only").over(inside) > 0
    # one row per block: the last block before with a fixed record, and the first fixed record from this block on and after it
    at = F.when(F.col("only").isNotNull(), F.struct("number", "row", "only"))
    by_block = Window.partitionBy("source").orderBy("block")
    onward = lambda a: F.first(F.col("first.only"), ignorenulls=True).over(by_block.rowsBetween(a, Window.unboundedFollowing))
    blocks = (
        rows.groupBy("source", "block")
        .agg(F.min(at).alias("first"))
        .select(
            "source", "block", onward(0).alias("here"), onward(1).alias("later"),
            F.last(F.when(F.col("first").isNotNull(), F.col("block")), ignorenulls=True).over(by_block.rowsBetween(Window.unboundedPreceding, -1)).alias("home_before"),
        )
    )
    rows = rows.withColumn("met", met).join(blocks, ["source", "block"])
    home = F.when(F.col("met"), F.col("block")).otherwise(F.coalesce("home_before", F.lit(-(1 << 62))))
    after = F.when(F.col("many").isNotNull(), F.when(F.col("met"), F.col("later")).otherwise(F.col("here")))
    rows = rows.select("source", home.alias("home"), "number", "row", "only", "many", after.alias("after"))
    schema = f"source string, row {df.schema[row].dataType.simpleString()}, us bigint"
    return rows.groupBy("source", "home").applyInPandas(_viterbi, schema)


def _viterbi(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """The settled rows of the stretches that begin in one block. The stretches of a block follow on each other without break."""
    pdf = pdf.sort_values(["number", "row"], kind="stable").reset_index(drop=True)
    only, many = pdf["only"].tolist(), pdf["many"].tolist()
    us = np.array([o["us"] if o is not None else 0 for o in only], np.int64)
    keep = np.array([o is not None for o in only], bool)
    for stretch in _stretches(np.flatnonzero(~keep)):
        a, z = stretch[0], stretch[-1]
        before = _state(only[a - 1]) if a else None
        after = _state(only[z + 1]) if z + 1 < len(only) else _state(pdf["after"].iat[z])
        states = [_states(many[i]) for i in stretch]
        for i, best in zip(stretch, path(states, before, after)):
            name, t, _ = states[i - a][best]
            if name is not None and sum(s[0] == name for s in states[i - a]) == 1:
                us[i], keep[i] = t, True
    return pd.DataFrame({"source": key[0], "row": pdf["row"][keep], "us": us[keep]})


def _state(only) -> tuple | None:
    return None if only is None else (only["notation"], int(only["us"]), 0.0)


def _states(readings) -> list[tuple]:
    """(notation, us, cost) of each reading, and the state that the text names no time where no reading follows the declared order."""
    ranked = sorted(readings, key=lambda r: ORDERS.index(r["notation"]) if r["notation"] in ORDERS else -1)
    out = [(r["notation"], int(r["us"]), FOREIGN if r["agrees"] is False else 0.0) for r in ranked]
    return out if any(c == 0.0 for _, _, c in out) else [*out, (None, None, NONE)]


def _stretches(index: np.ndarray) -> Iterator[list[int]]:
    """Runs of neighbouring positions: a record with one reading fixes the path, so the stretches between are independent."""
    if len(index):
        yield from (list(x) for x in np.split(index, np.flatnonzero(np.diff(index) > 1) + 1))


def _step(a: tuple, b: tuple) -> float:
    if a[0] is None or b[0] is None:
        return 0.0
    return SWITCH * (a[0] != b[0]) + BACK * (b[1] < a[1])


def path(states: list[list[tuple]], before: tuple | None, after: tuple | None) -> list[int]:
    """Index of the chosen state of each record: the cheapest way from ``before`` to ``after`` (None: free)."""
    cost, back = [], []
    for k, options in enumerate(states):
        now, came = [], []
        for s in options:
            if k:
                ways = [c + _step(p, s) for c, p in zip(cost, states[k - 1])]
                b = ways.index(min(ways))
                c = ways[b]
            else:
                b, c = -1, _step(before, s) if before else 0.0
            now.append(c + s[2])
            came.append(b)
        cost = now
        back.append(came)
    if after:
        cost = [c + _step(s, after) for c, s in zip(cost, states[-1])]
    at = cost.index(min(cost))
    chosen = [at]
    for came in reversed(back[1:]):
        at = came[at]
        chosen.append(at)
    return chosen[::-1]
