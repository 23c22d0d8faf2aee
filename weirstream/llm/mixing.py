"""Mixing sources to target weights.

Every source shall contribute its target share of all tokens, taking a document at most ``max_repeats`` times. The largest
total at which that is possible is set by the source that runs out first; each source then has a budget of tokens.

Entropy balancing: among all rates with 0 < rate < max_repeats that meet the budgets, the ones nearest (in relative
entropy) to one copy each are the exponentially tilted ``m / (1 + odds * exp(-lambda_s * tokens / mean))``. The
multipliers solve a convex dual with one token constraint a source; they are found by Newton iterations, each of which is
one aggregation over the histogram of document lengths (distributed; one row a source comes back). Rates are rounded into
copies by a threshold that a hash of the document's id shifts, and the threshold of each source is then moved until its
tokens meet the budget, by two rounds of histograms over the places at which copies change.

The iterations raise an error if they do not converge; so does a target table that names a source twice.

Defined results: a document with NULL source or id, of a source without target, or without tokens (NULL, empty) gets no
copies; targets are normed to sum 1; a target source without tokens or with ``max_repeats`` below one has share 0 and the
others keep their relation; repeated rows are documents of their own with equal hash; empty tables give an empty result.

Plan: texts are read and tokenized once; the counts (no texts) are written to the shared checkpoint folder. All loops run
over the length histogram, which meets the numbers of each source by a join with a small table (at most ``MOST_SOURCES`` rows). Documents are never grouped by source in one task: only partial sums are shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from weirstream.llm.encode import count_tokens
from weirstream.session import staged

MOST_SOURCES = 10_000
BINS = 4096


def read_targets(targets: DataFrame, most: int = MOST_SOURCES) -> dict[str, tuple[float, int]]:
    """source -> (share, max_repeats); a configuration table of at most ``most`` rows."""
    rows = targets.select("source", "target_share", "max_repeats").filter("source is not null").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} target sources")
    out = {r[0]: (float(r[1] or 0), int(r[2] or 0)) for r in rows}
    if len(out) < len(rows):
        raise ValueError("a target source is named more than once")
    total = sum(s for s, _ in out.values())
    return {k: (s / total, m) for k, (s, m) in out.items()} if total > 0 else {}


def with_numbers(df: DataFrame, **numbers: dict[str, float]) -> DataFrame:
    """Rows whose source has all of ``numbers``, each as a column; a join with one row a source, at most MOST_SOURCES."""
    common = [s for s in next(iter(numbers.values())) if all(s in v for v in numbers.values())]
    if len(common) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    rows = [(s, *[float(v[s]) for v in numbers.values()]) for s in common]
    small = df.sparkSession.createDataFrame(rows, "source string, " + ", ".join(f"`{n}` double" for n in numbers))
    return df.join(F.broadcast(small), "source")


def budgets(targets: dict[str, tuple[float, int]], held: dict[str, float]) -> dict[str, float]:
    """Tokens that each source shall give: the largest total at which every source can meet its share."""
    able = {s: (w, m * held.get(s, 0)) for s, (w, m) in targets.items() if w > 0 and m * held.get(s, 0) > 0}
    if not able:
        return {}
    weight = sum(w for w, _ in able.values())
    total = min(most * weight / w for w, most in able.values())
    return {s: total * w / weight for s, (w, _) in able.items()}


def solve_tilts(hist: DataFrame, targets: dict, goal: dict[str, float], held: dict[str, tuple[float, float]], rounds: int = 60, tol: float = 1e-9) -> dict[str, float]:
    """Multiplier of each source, by Newton's method on the dual, kept within a shrinking bracket; inf where the source is used up."""
    tilt, lo, hi = {}, {}, {}
    for s in goal:
        if goal[s] >= targets[s][1] * held[s][0] * (1 - 1e-12):
            tilt[s] = math.inf
        else:
            tilt[s], lo[s], hi[s] = 0.0, -700.0, 700.0
    for _ in range(rounds):
        if not lo:
            break
        got = (
            rated(hist, targets, {s: tilt[s] for s in lo}, held)
            .groupBy("source")
            .agg(
                F.sum(F.col("n") * F.col("rate") * F.col("tokens")).alias("given"),
                F.sum(F.col("n") * F.col("rate") * (1 - F.col("rate") / F.col("m")) * F.col("tokens") * F.col("tokens") / F.col("mean")).alias("slope"),
            )
            .collect()  # one row a source
        )
        for s, given, slope in got:
            miss = given - goal[s]
            if abs(miss) <= tol * goal[s]:
                lo.pop(s)
                continue
            if miss > 0:
                hi[s] = tilt[s]
            else:
                lo[s] = tilt[s]
            step = tilt[s] - miss / slope if slope > 0 else math.nan
            tilt[s] = step if lo[s] < step < hi[s] else (lo[s] + hi[s]) / 2
    if lo:
        raise ArithmeticError(f"no convergence within {rounds} rounds for {sorted(lo)[:5]}")
    return tilt


def rated(df: DataFrame, targets: dict, tilt: dict[str, float], held: dict[str, tuple[float, float]]) -> DataFrame:
    """Add ``rate``, the tilted rate of a document with ``tokens`` of ``source``, and ``m``: base one copy (half a copy where only one is allowed)."""
    df = with_numbers(
        df, m={s: targets[s][1] for s in tilt}, odds={s: (targets[s][1] - 1) or 1 for s in tilt}, tilt={s: min(x, 1e6) for s, x in tilt.items()}, mean={s: held[s][1] for s in tilt}
    )
    power = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -F.col("tilt") * F.col("tokens") / F.col("mean")))
    return df.withColumn("rate", F.when(F.col("tilt") >= 1e6, F.col("m")).otherwise(F.col("m") / (1 + F.col("odds") * F.exp(power))))


def mix(documents: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(key, source, tokens, copies): the chosen documents, copies at least 1."""
    goals = read_targets(targets)
    docs = documents.filter(F.col(key).isNotNull() & F.col("source").isin(list(goals)))
    docs = staged(count_tokens(docs, key, text, vocabulary, also=("source",)), "mix-tokens").filter("tokens > 0")
    hist = staged(docs.groupBy("source", "tokens").agg(F.count(F.lit(1)).alias("n")), "mix-lengths")
    held = {r[0]: (float(r[1]), float(r[1]) / r[2]) for r in hist.groupBy("source").agg(F.sum(F.col("n") * F.col("tokens")), F.sum("n")).collect()}  # one row a source
    goal = budgets(goals, {s: x[0] for s, x in held.items()})
    tilt = solve_tilts(hist, goals, goal, held)
    return _rounded(docs, key, goals, goal, tilt, held)


def _rounded(docs: DataFrame, key: str, goals: dict, goal: dict[str, float], tilt: dict[str, float], held: dict) -> DataFrame:
    shift = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 40)) / float(1 << 40)
    docs = rated(docs, goals, tilt, held).drop("odds", "tilt", "mean").withColumn("x", F.col("rate") + shift)

    def copies(d: Column) -> Column:
        return F.greatest(F.lit(0.0), F.least(F.col("m"), F.floor(F.col("x") + d)))

    # within [-1, 1) a document changes its copies where x + d passes a whole number
    low, width = F.lit(-1.0), F.lit(2.0)
    found = None
    for _ in range(2):
        rows = docs if found is None else docs.join(F.broadcast(found), "source")  # one row a source, at most MOST_SOURCES
        low, width = (F.lit(-1.0), F.lit(2.0)) if found is None else (F.col("low"), F.col("width"))
        steps = F.sequence(F.ceil(F.col("x") + low), F.ceil(F.col("x") + low + width))
        moves = (
            rows.withColumn("k", F.explode(steps))
            .withColumn("at", F.col("k") - F.col("x") - low)
            .filter((F.col("at") > 0) & (F.col("at") <= width) & (F.col("k") >= 1) & (F.col("k") <= F.col("m")))
            .withColumn("bin", F.least(F.ceil(F.col("at") / width * BINS), F.lit(BINS)))
        )
        base = rows.groupBy("source").agg(F.sum(copies(low) * F.col("tokens")).alias("base"), F.max(low).alias("low"), F.max(width).alias("width"))
        w = Window.partitionBy("source").orderBy("bin")  # at most BINS rows a source
        filled = moves.groupBy("source", "bin").agg(F.sum("tokens").alias("more")).withColumn("upto", F.sum("more").over(w)).join(base, "source")
        best = (
            with_numbers(filled, goal=goal)
            .filter(F.col("base") + F.col("upto") <= F.col("goal"))
            .groupBy("source")
            .agg(F.max("bin").alias("bin"))
        )
        found = staged(
            base.join(best, "source", "left").select(
                "source", (F.col("low") + F.coalesce("bin", F.lit(0)) * F.col("width") / BINS).alias("low"), (F.col("width") / BINS).alias("width")
            ),
            "mix-threshold",
        )
    return (
        docs.join(F.broadcast(found), "source")  # one row a source, at most MOST_SOURCES
        .withColumn("copies", copies(F.col("low")).cast("int"))
        .filter("copies > 0")
        .select(key, "source", "tokens", "copies")
    )


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Actual against target share of every target source."""
    given = mixed.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("copies").cast("bigint").alias("copies"), F.sum(F.col("tokens") * F.col("copies")).cast("bigint").alias("tokens"), F.max("copies").alias("most_repeats")
    )
    total = Window.partitionBy(F.lit(1))  # one row a source
    return (
        targets.select("source", "target_share", "max_repeats")
        .join(given, "source", "left")
        .fillna(0, ["documents", "copies", "tokens", "most_repeats"])
        .withColumn("actual_share", F.col("tokens") / F.nullif(F.sum("tokens").over(total), F.lit(0)))
    )
