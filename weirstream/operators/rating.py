"""Rating curves: stage to flow and back, over limb tables ``site_id, version, valid_from, valid_to, limb_no, lower, upper, c, a, b, doubtful``."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Names under which limb columns are accepted, in order of preference.
SYNONYMS = {
    "lower": ("lower", "lower_level", "lower.level", "Lower", "Lower_level", "Lower.level"),
    "upper": ("upper", "upper_level", "upper.level", "Upper", "Upper_level", "Upper.level"),
    "c": ("c", "C", "c_param", "multiplier", "Multiplier"),
    "a": ("a", "A", "a_param", "offset", "Offset", "datum"),
    "b": ("b", "B", "b_param", "exponent", "Exponent"),
    "doubtful": ("doubtful", "Doubtful", "doubtful_flag", "flag"),
}


def rename_limbs(df: DataFrame) -> DataFrame:
    """The first synonym of each limb column that is present."""
    for name, known in SYNONYMS.items():
        hit = next((k for k in known if k in df.columns), None)
        if hit and hit != name:
            df = df.withColumnRenamed(hit, name)
    return df


def validate_limbs(limbs: list[dict], tol: float = 1e-9) -> None:
    """Raise ValueError unless the limbs of one curve are complete, ordered and contiguous."""
    if not limbs:
        raise ValueError("a curve needs at least one limb")
    for x in limbs:
        missing = [k for k in ("lower", "upper", "c", "a", "b") if x.get(k) is None]
        if missing:
            raise ValueError(f"limb lacks {missing}")
        if not all(math.isfinite(x[k]) for k in ("c", "a", "b")):
            raise ValueError("limb parameters must be finite")
        if x["c"] <= 0 or x["b"] <= 0:
            raise ValueError("c and b must be positive")
        if not x["lower"] < x["upper"]:
            raise ValueError("lower must lie below upper")
    for x, y in zip(limbs, limbs[1:]):
        if abs(x["upper"] - y["lower"]) > tol:
            raise ValueError("limbs must be sorted and contiguous")


def validate_set(curves: list[tuple]) -> None:
    """Raise ValueError if two curves (valid_from, valid_to) with known starts overlap."""
    known = sorted((c for c in curves if c[0] is not None), key=lambda c: c[0])
    for (_, end), (start, _) in zip(known, known[1:]):
        if end is None or end >= start:
            raise ValueError("validity of curves overlaps")


def flow_at(h: Column, c: Column, a: Column, b: Column) -> Column:
    """``max(0, c * max(h - a, 0) ** b)``; NULL stays NULL, NaN gives 0."""
    depth = F.greatest(F.nanvl(h, a) - a, F.lit(0.0))
    return F.when(h.isNotNull() & c.isNotNull(), F.greatest(c * F.pow(depth, b), F.lit(0.0)))


def limb_table(limbs: DataFrame, keys: list[str]) -> DataFrame:
    """One row per curve with its limbs as a sorted array; what a curve holds is a handful of limbs."""
    return limbs.groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct("lower", "limb_no", "upper", "c", "a", "b", "doubtful"))).alias("limbs"))


def rate(levels: DataFrame, curves: DataFrame, on: list[str], h: str = "value") -> DataFrame:
    """Add ``flow`` and ``doubtful`` by the curve with the same ``on``; NULL below the lowest limb, the last limb is open above."""
    x = levels.join(curves, on, "left")
    limb = F.element_at(F.filter("limbs", lambda m: m["lower"] <= F.col(h)), -1)
    held = F.when(F.size(F.filter("limbs", lambda m: m["lower"] <= F.col(h))) > 0, limb)
    return x.withColumn("_l", held).withColumn("flow", flow_at(F.col(h), F.col("_l.c"), F.col("_l.a"), F.col("_l.b"))).withColumn("doubtful", F.col("_l.doubtful")).drop("_l", "limbs")


def unrate(flows: DataFrame, curves: DataFrame, on: list[str], q: str = "flow") -> DataFrame:
    """Add ``stage``: NULL for NULL or negative flow; in a gap between limbs the upper bound of the lower one; above all the last limb."""
    x = flows.join(curves, on, "left")
    at = lambda m, lv: m["c"] * F.pow(F.greatest(lv - m["a"], F.lit(0.0)), m["b"])
    marked = F.transform(
        "limbs",
        lambda m, i: F.struct(m["lower"].alias("lower"), m["upper"].alias("upper"), m["c"].alias("c"), m["a"].alias("a"), m["b"].alias("b"), at(m, m["lower"]).alias("q0"), F.when(m["upper"] < float("inf"), at(m, m["upper"])).otherwise(float("inf")).alias("q1"), i.alias("i")),
    )
    x = x.withColumn("_m", marked).withColumn("_l", F.coalesce(F.get(F.filter("_m", lambda m: m["q1"] >= F.col(q)), F.lit(0)), F.element_at("_m", -1)))
    low = F.get("_m", F.col("_l.i") - 1)
    stage = (
        F.when(F.col(q).isNull() | (F.col(q) < 0) | F.col("_l").isNull(), F.lit(None).cast("double"))
        .when(F.col(q) == 0, F.get("_m", F.lit(0))["lower"])
        .when((F.col(q) < F.col("_l.q0")) & (F.col("_l.i") > 0), low["upper"])
        .otherwise(F.pow(F.col(q) / F.col("_l.c"), 1 / F.col("_l.b")) + F.col("_l.a"))
    )
    return x.withColumn("stage", stage).drop("_m", "_l", "limbs")


def limb_continuity(limbs: DataFrame, keys: list[str], tol_pct: float = 1.0) -> DataFrame:
    """Flow on both sides of each junction, the gap and whether it is within ``tol_pct`` per cent of the lower flow."""
    w = Window.partitionBy(*keys).orderBy("limb_no")
    at = lambda c, a, b: c * F.pow(F.greatest(F.col("upper") - a, F.lit(0.0)), b)
    n = lambda c: F.lead(c).over(w)
    j = limbs.withColumns({"nc": n("c"), "na": n("a"), "nb": n("b")}).filter("nc is not null")
    j = j.withColumn("q_lower", at(F.col("c"), F.col("a"), F.col("b"))).withColumn("q_upper", at(F.col("nc"), F.col("na"), F.col("nb")))
    gap = F.col("q_upper") - F.col("q_lower")
    pct = F.when(F.col("q_lower") > 0, 100 * F.abs(gap) / F.col("q_lower"))
    return j.select(*keys, "limb_no", F.col("upper").alias("junction"), "q_lower", "q_upper", gap.alias("gap"), pct.alias("gap_pct"), F.coalesce(pct <= tol_pct, F.lit(False)).alias("connected"))


def fix_continuity(limbs: DataFrame, keys: list[str]) -> DataFrame:
    """Each limb's c so that it meets the limb below, which is adjusted first; a junction that cannot be met is left."""
    arr = F.array_sort(F.collect_set(F.struct("limb_no", "lower", "upper", "c", "a", "b")))
    folded = F.aggregate(
        F.slice("x", 2, F.greatest(F.size("x") - 1, F.lit(0))),
        F.struct(F.array(F.element_at("x", 1)["c"]).alias("cs"), F.element_at("x", 1).alias("m")),
        lambda s, m: _meet(s, m),
        lambda s: s["cs"],
    )
    out = limbs.groupBy(*keys).agg(arr.alias("x")).withColumn("cs", folded)
    return out.select(*keys, F.explode(F.arrays_zip("x", "cs")).alias("z")).select(*keys, F.col("z.x.limb_no").alias("limb_no"), F.col("z.cs").alias("c"))


def _meet(s: Column, m: Column) -> Column:
    low = s["m"]
    q = low["c"] * F.pow(F.greatest(low["upper"] - low["a"], F.lit(0.0)), low["b"])
    per = F.pow(F.greatest(m["lower"] - m["a"], F.lit(0.0)), m["b"])
    c = F.when((q > 0) & (per > 0) & (q < float("inf")), q / F.nullif(per, F.lit(0.0))).otherwise(m["c"])
    nxt = F.struct(m["limb_no"].alias("limb_no"), m["lower"].alias("lower"), m["upper"].alias("upper"), c.alias("c"), m["a"].alias("a"), m["b"].alias("b"))
    return F.struct(F.concat(s["cs"], F.array(c)).alias("cs"), nxt.alias("m"))


def next_version(register: DataFrame, keys: tuple[str, ...] = ("site_id", "tier")) -> DataFrame:
    return register.groupBy(*keys).agg((F.coalesce(F.max("version"), F.lit(0)) + 1).alias("next_version"))


def supersede(register: DataFrame, new: DataFrame) -> DataFrame:
    """Append new ratings with the next version of their site and tier as Active; what was Active there is Superseded."""
    keys = ["site_id", "tier"]
    old = register.join(new.select(*keys).distinct().withColumn("_new", F.lit(True)), keys, "left")
    old = old.withColumn("status", F.when(F.col("_new") & (F.col("status") == "Active"), "Superseded").otherwise(F.col("status"))).drop("_new")
    added = new.join(next_version(register), keys, "left").withColumn("version", F.coalesce("next_version", F.lit(1)).cast("int")).withColumn("status", F.lit("Active")).drop("next_version")
    added = added.withColumn("rating_id", F.concat(F.col("site_id"), F.lit("_RATING_"), F.col("tier"), F.lit("_v"), F.col("version").cast("string")))
    return old.unionByName(added, allowMissingColumns=True)


CURVE = ("rating_id", "site_id", "version", "valid_from", "valid_to")


def load_set(stored: DataFrame) -> DataFrame:
    """Stored limbs, under any accepted names, as one row per curve with its limbs in order; repeated limbs count once, rows without id are left out."""
    limbs = rename_limbs(stored).filter("rating_id is not null")
    if "doubtful" not in limbs.columns:
        limbs = limbs.withColumn("doubtful", F.lit(False))
    return limb_table(limbs, list(CURVE))


def flatten_set(curves: DataFrame) -> DataFrame:
    """One row per limb, as ratings are stored; a top without end is NULL."""
    x = curves.select(*CURVE, F.explode("limbs").alias("l")).select(*CURVE, "l.limb_no", "l.lower", "l.upper", "l.c", "l.a", "l.b", "l.doubtful")
    return x.withColumn("upper", F.nullif("upper", F.lit(float("inf"))))
