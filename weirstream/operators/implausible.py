"""Readings that cannot be true, relative to what is normal for their own series.

Three checks per series, each its own flag:

* ``spike``: robust seasonal-trend decomposition per source. The trend is the median of the three readings on either side,
  leaving the reading itself out; the season is the median departure from it by hour of day, over the whole source; what is
  left is the residual. Residuals are studentised by the movement around them (the greater of the source's median residual
  and the medians of residuals and steps nearby), brought to a common spread by the inverse hyperbolic sine, as river
  residuals have heavy tails, and tested per source by the generalised extreme studentised deviate test with renewed mean
  and deviation after each removal, at level ``ALPHA``. An exact check follows: a spike lasts one to three readings and the
  course after it goes on where it was before; a flood recedes slowly and stays. Rainfall has no course; its residuals are
  the square roots of wet readings less their median.
* ``range``: negative flow where the gauge is not tidal (noted so, or with negative flow in more than ``tidal_share`` of
  its readings), negative rainfall, and values beyond ``reach`` times the spread of the series.
* ``stuck``: eight or more equal values in a row (zeros of rainfall do not count).

Defined results: NULL and NaN values are passed over; rows with a NULL key, time or id take no part; tied times are taken in
order of id; repeated rows are readings like others; a series too short for neighbours has no spikes; an empty table gives
an empty result; other columns are ignored.

Plan: a series is cut into shards of ``SHARD_DAYS`` days, the only shuffle of the data, so a series with a third of all rows
is many tasks. Each shard gets the last and first ``CONTEXT`` readings of its neighbours, the season and the statistics of the
whole series from a summary by shard and hour; that makes runs exact and residuals independent of the cuts. A shard gives its
candidates and a histogram of its residuals (bins of ``BIN``); both are written once to the shared checkpoint folder, the
histograms of a series are tested together (a few thousand bins at most) and the candidates meet the limit of their series.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirstream.functions.timefn import DAY_US, floor_div
from weirstream.session import staged
from weirstream.sources.tables import usable

SHARD_DAYS, CONTEXT, RUN = 64, 16, 8
ALPHA, RETURN, REACH, TIDAL_SHARE = 0.001, 0.3, 40.0, 0.02
BIN = 0.02


def implausible(
    df: DataFrame,
    tidal: DataFrame | None = None,
    keys: tuple[str, str] = ("site_id", "data_type"),
    ts: str = "timestamp",
    value: str = "value",
    row: str = "reading_id",
    tidal_share: float = TIDAL_SHARE,
) -> DataFrame:
    """(row, spike, range, stuck): the flagged rows. ``tidal`` lists (``site_id``) gauges known to be tidal."""
    rows = df.select(
        F.col(keys[0]).alias("site"), F.col(keys[1]).alias("type"), F.unix_micros(F.col(ts).cast("timestamp")).alias("t"), F.col(row).alias("id"), F.col(value).cast("double").alias("v")
    ).filter(F.col("site").isNotNull() & F.col("type").isNotNull() & F.col("t").isNotNull() & F.col("id").isNotNull() & usable(F.col("v")))
    rows = rows.withColumn("shard", floor_div(F.col("t"), SHARD_DAYS * DAY_US))
    notes = _shard_notes(rows, tidal, tidal_share)
    key = ["site", "type", "shard"]
    kind = df.schema[row].dataType.simpleString()
    notes = notes.select(*[F.col(c).alias(f"n_{c}") if c in key else F.col(c) for c in notes.columns])
    schema = f"site {df.schema[keys[0]].dataType.simpleString()}, type {df.schema[keys[1]].dataType.simpleString()}, id {kind}, score double, range boolean, stuck boolean, bins array<struct<bin: int, n: bigint, s: double, q: double>>"
    judged = staged(rows.groupBy(*key).cogroup(notes.groupBy(*[f"n_{c}" for c in key])).applyInPandas(_detect, schema), "residuals")
    bins = judged.filter("bins is not null").select("site", "type", F.explode("bins").alias("b")).groupBy("site", "type", "b.bin").agg(F.sum("b.n").alias("n"), F.sum("b.s").alias("s"), F.sum("b.q").alias("q"))
    limits = bins.groupBy("site", "type").applyInPandas(_limit, f"{schema.split(', id ')[0]}, at double".replace("site ", "l_site ").replace(", type ", ", l_type "))
    out = judged.filter("bins is null").join(limits, (F.col("site") == F.col("l_site")) & (F.col("type") == F.col("l_type")), "left")
    out = out.withColumn("spike", F.coalesce(F.col("score") >= F.col("at"), F.lit(False)))
    return out.filter("spike or range or stuck").select(F.col("id").alias(row), "spike", "range", "stuck")


def _shard_notes(rows: DataFrame, tidal: DataFrame | None, tidal_share: float) -> DataFrame:
    """One row per series and shard: context from the neighbouring shards, statistics of the whole series."""
    key = ["site", "type", "shard"]
    w = Window.partitionBy(*key).orderBy("t", "id")
    beside = F.array_sort(F.array_compact(F.array(*[f("v", k).over(w) for f in (F.lag, F.lead) for k in (1, 2, 3)])))
    numbered = (
        rows.withColumn("rn", F.row_number().over(w))
        .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*key)))
        .withColumn("beside", beside)
        .withColumn("rest", F.col("v") - (F.get("beside", ((F.size("beside") - 1) / 2).cast("int")) + F.get("beside", (F.size("beside") / 2).cast("int"))) / 2)
        .withColumn("hour", F.pmod(floor_div(F.col("t"), 3_600_000_000), F.lit(24)))
    )
    some = lambda cond: F.collect_list(F.when(cond, F.struct("rn", "t", "v")))
    middle = lambda c: F.percentile_approx(c, 0.5, 1000)
    size = F.abs("rest")
    cells = numbered.groupBy(*key, "hour").agg(
        some(F.col("rn") <= CONTEXT).alias("head"), some(F.col("rn") > F.col("n") - CONTEXT).alias("tail"), middle("rest").alias("rest"), middle(size).alias("move"), middle(F.when(size > 0, size)).alias("stir")
    )
    over = lambda c, *by: F.percentile(c, F.lit(0.5)).over(Window.partitionBy("site", "type", *by))  # noqa: E731 - one row per shard and hour
    cells = cells.withColumns({"season": over("rest", "hour"), "usual": over("move"), "stir": over("stir")})
    gather = lambda c: F.sort_array(F.flatten(F.collect_list(c)))
    shards = cells.groupBy(*key).agg(
        gather("head").alias("head"), gather("tail").alias("tail"), F.collect_list(F.struct("hour", "season")).alias("season"), F.max("usual").alias("usual"), F.max("stir").alias("stir")
    )
    wet = F.when(F.col("v") > 0, F.sqrt("v"))
    series = rows.groupBy("site", "type").agg(
        F.percentile_approx("v", [0.05, 0.5, 0.95], 1000).alias("q"),
        F.percentile_approx(wet, [0.25, 0.5, 0.75], 1000).alias("wet"),
        F.avg((F.col("v") < 0).cast("double")).alias("negative"),
    )
    if tidal is not None:
        series = series.join(tidal.select(F.col("site_id").alias("site"), F.lit(True).alias("noted")).filter("site is not null").distinct(), "site", "left")
    else:
        series = series.withColumn("noted", F.lit(None).cast("boolean"))
    series = series.select("site", "type", "q", "wet", (F.coalesce("noted", F.lit(False)) | (F.col("negative") > tidal_share)).alias("tidal"))
    order = Window.partitionBy("site", "type").orderBy("shard")
    gathered = lambda c, a, b: F.flatten(F.collect_list(c).over(order.rowsBetween(a, b)))
    return (
        shards.withColumn("before", gathered("tail", -CONTEXT, -1))
        .withColumn("after", gathered("head", 1, CONTEXT))
        .join(series, ["site", "type"])
        .select(
            *key, "usual", "stir", "q", "wet", "season", "tidal",
            F.transform(F.slice("before", F.greatest(F.size("before") - CONTEXT + 1, F.lit(1)), CONTEXT), lambda x: x["v"]).alias("before"),
            F.transform(F.slice("after", 1, CONTEXT), lambda x: x["v"]).alias("after"),
        )
    )


def _critical(left: np.ndarray) -> np.ndarray:
    """Critical values of the generalised extreme studentised deviate test for the most extreme of ``left`` values."""
    left = np.maximum(left, 4)
    z = np.array([NormalDist().inv_cdf(1 - ALPHA / (2 * x)) for x in left])
    f = left - 2
    t = z + (z**3 + z) / (4 * f) + (5 * z**5 + 16 * z**3 + 3 * z) / (96 * f * f)  # Student's quantile from the normal one
    return (left - 1) * t / np.sqrt((f + t * t) * left)


def _limit(key: tuple, bins: pd.DataFrame) -> pd.DataFrame:
    """The size from which residuals of a series are outliers: bins are removed from the top, mean and deviation renewed each time.

    Up to a tenth of the values (and ten) may be removed; all bins down to the last that exceeds its critical value are outliers.
    """
    bins = bins.sort_values("bin", ascending=False)
    n, s, q, at = (bins[c].to_numpy(float) for c in ("n", "s", "q", "bin"))
    before = lambda x: x.sum() - np.r_[0.0, np.cumsum(x)[:-1]]
    left, total, squares = before(n), before(s), before(q)
    may = (n.sum() - left <= n.sum() / 10 + 10) & (left >= 8)
    left, total, squares, at = left[may], total[may], squares[may], at[may]
    limit = np.inf
    if len(left):
        mean = total / left
        deviation = np.sqrt(np.maximum(squares / left - mean * mean, 1e-24))
        over = np.flatnonzero((at + 0.5) * BIN - np.abs(mean) > _critical(left) * deviation)
        if len(over):
            limit = at[over[-1]] * BIN
    return pd.DataFrame({"l_site": [key[0]], "l_type": [key[1]], "at": [limit]})


def _histogram(residuals: np.ndarray) -> list[dict]:
    """Number, sum and sum of squares of the residuals by size."""
    bins, inverse = np.unique((np.abs(residuals) / BIN).astype(np.int64), return_inverse=True)
    sums = lambda w: np.bincount(inverse, w, len(bins))
    return [{"bin": int(b), "n": int(n), "s": float(x), "q": float(y)} for b, n, x, y in zip(bins, sums(None), sums(residuals), sums(residuals * residuals))]


def _runs(v: np.ndarray) -> np.ndarray:
    """Length of the run of equal values that each value belongs to."""
    starts = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
    lengths = np.diff(np.r_[starts, len(v)])
    return np.repeat(lengths, lengths)


def _trend(v: np.ndarray) -> np.ndarray:
    """Median of the three readings on either side of each; NaN for a reading without any."""
    pad = np.r_[np.full(3, np.nan), v, np.full(3, np.nan)]
    beside = np.sort(np.stack([pad[3 + i : 3 + i + len(v)] for i in (-3, -2, -1, 1, 2, 3)]), axis=0)  # NaN go last
    known = (~np.isnan(beside)).sum(0)
    pick = lambda i: np.take_along_axis(beside, np.maximum(i, 0)[None], 0)[0]
    return (pick((known - 1) // 2) + pick(known // 2)) / 2 if len(v) else v


def _departures(v: np.ndarray) -> np.ndarray:
    """For each reading, how far it (and the one to three readings it stands out with) lies beyond the course on both sides."""
    n, best = len(v), np.zeros(len(v))
    if n < 5:
        return best
    pad = np.r_[np.full(3, np.nan), v, np.full(3, np.nan)]
    at = lambda i: pad[3 + i : 3 + i + n] if i <= 3 else None
    with np.errstate(invalid="ignore"):
        p1 = at(-1)
        left = np.stack([at(-3), at(-2), at(-1)])
        p3 = np.where(np.isnan(left).sum(0) == 0, np.median(left, 0), p1)
        right = np.stack([at(1), at(2), at(3)])
        f1 = at(1)
        f3 = np.where(np.isnan(right).sum(0) == 0, np.median(right, 0), f1)
        for k in (1, 2, 3):
            m = n - k + 1
            if m < 1:
                break
            seg_lo, seg_hi = v[:m].copy(), v[:m].copy()
            for i in range(1, k):
                seg_lo, seg_hi = np.minimum(seg_lo, v[i : i + m]), np.maximum(seg_hi, v[i : i + m])
            sides = np.stack([p1[:m], p3[:m], f1[k - 1 :][:m], f3[k - 1 :][:m]])
            none = np.isnan(sides[0]) | np.isnan(sides[2])  # at an end of the series nobody knows whether the course goes on
            top, low = np.nanmax(np.where(none, 0, sides), 0), np.nanmin(np.where(none, 0, sides), 0)
            out = np.maximum(seg_lo - top, low - seg_hi)
            out = np.where(none | ~(out > 0) | ~((top - low) <= RETURN * out), 0, out)
            for i in range(k):
                best[i : i + m] = np.maximum(best[i : i + m], out)
    return best


def _detect(key: tuple, rows: pd.DataFrame, notes: pd.DataFrame) -> pd.DataFrame:
    """Rows of a shard that may be flagged, each with the size of its residual, and one more row with the histogram of all residuals."""
    names = ["site", "type", "id", "score", "range", "stuck", "bins"]
    if not len(rows) or not len(notes):
        return pd.DataFrame({c: pd.Series(dtype=object) for c in names})
    rows = rows.sort_values(["t", "id"], kind="stable")
    kind, note = key[1], notes.iloc[0]
    own = rows["v"].to_numpy(float)
    before, after = np.asarray(note["before"], float), np.asarray(note["after"], float)
    v = np.r_[before, own, after]
    mine = slice(len(before), len(before) + len(own))
    low, middle, high = (float(x) for x in note["q"])
    spread = max(high - low, 1e-3 * abs(middle), 1e-9)
    out = (own > high + REACH * spread) | (own < low - REACH * spread) | np.isinf(own)
    stuck = _runs(v)[mine] >= RUN
    finite = np.where(np.isfinite(v), v, np.sign(np.nan_to_num(v, posinf=1, neginf=-1)) * 1e12)
    if kind == "P":
        out = (own < 0) | np.isinf(own)
        stuck &= own != 0
        wet, rain = note["wet"], own > 0
        residual = np.zeros(len(own))
        if wet is not None and len(wet):
            scale = max((wet[2] - wet[0]) / 1.349, 0.3 * wet[1], 1e-6)
            residual = np.where(rain, (np.sqrt(np.maximum(finite[mine], 0)) - wet[1]) / scale, 0)
        tested, score = residual[rain], np.where(rain & (residual > 0), residual, 0)
    else:
        if kind == "Q" and not note["tidal"]:
            out |= own < 0
        usual, stir = (float(note[c]) if pd.notna(note[c]) else 0.0 for c in ("usual", "stir"))
        season = np.zeros(24)
        for h in note["season"]:
            season[int(h["hour"])] = h["season"] if h["season"] is not None else 0.0
        rest = finite - _trend(finite)
        rest[np.isnan(rest)] = 0
        around = lambda x: pd.Series(np.abs(x)).rolling(25, center=True, min_periods=1).median().to_numpy()
        scale = 1.4826 * np.maximum(np.maximum(around(rest), around(np.diff(finite, prepend=finite[:1]))), max(usual, 0.25 * stir, 1e-9))[mine]
        tested = np.arcsinh((rest[mine] - season[(rows["t"].to_numpy(np.int64) // 3_600_000_000) % 24]) / scale)
        score = np.where(_departures(finite)[mine] > 0, np.abs(tested), 0)
    hit = (score > 0) | out | stuck
    found = pd.DataFrame({"site": key[0], "type": key[1], "id": rows["id"].to_numpy()[hit], "score": score[hit], "range": out[hit], "stuck": stuck[hit], "bins": None})
    if len(tested):
        found = pd.concat([found.astype({"bins": object}), pd.DataFrame({"site": [key[0]], "type": [key[1]], "id": [rows["id"].iat[0]], "score": [0.0], "range": [False], "stuck": [False], "bins": [_histogram(tested)]})], ignore_index=True)
    return found


def noted_tidal(registry: DataFrame) -> DataFrame:
    """Gauges that the registry notes as tidal."""
    return registry.filter(F.lower("notes").contains("tidal")).select(F.col("gauge_id").alias("site_id"))
