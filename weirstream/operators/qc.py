"""Quality-control checks of ordered series, as columns over one window.

Every check gives a boolean that is never NULL: a NULL value fails no check. All windows share one partitioning and order
(``Spec.w``), so a plan with every check has one exchange and one sort.

``blocked(df)`` cuts the series into row blocks with context first (see ``blocks``): the checks are then the same, row for
row, but a series with a third of all rows is many tasks. Rows of context are to be dropped afterwards (``_own``).

Checks whose limits come from the whole series (median absolute deviation, quantiles) are exact; they never fire where the
deviation is zero or unknown.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirstream.operators.blocks import in_blocks

UP, DOWN = Window.unboundedPreceding, Window.unboundedFollowing


@dataclass(frozen=True)
class Spec:
    """Keys and order of a series."""

    keys: tuple[str, ...] = ("site_id", "data_type")
    order: tuple[str, ...] = ("timestamp", "reading_id")
    block: str | None = None

    @property
    def w(self):
        return Window.partitionBy(*self.keys, *([self.block] if self.block else [])).orderBy(*self.order)

    @property
    def p(self):
        if self.block:
            raise ValueError("statistics of a series in blocks come with the blocks")
        return Window.partitionBy(*self.keys)

    def size(self) -> Column:
        return F.col("_total") if self.block else F.count(F.lit(1)).over(self.p)

    def rows(self, a: int, b: int):
        return self.w.rowsBetween(a, b)

    def lag(self, c: Column, n: int = 1) -> Column:
        return F.lag(c, n).over(self.w)

    def rn(self) -> Column:
        """Number of the row within its series."""
        return F.col("_n") if self.block else F.row_number().over(self.w)


BLOCKED = Spec(block="_block")


def blocked(df: DataFrame, spec: Spec = BLOCKED, value: str = "value", stats: bool = True) -> DataFrame:
    """The series in row blocks, with the statistics that the checks need; to be used with a Spec that has ``block``."""
    return in_blocks(df, spec.keys, spec.order, value, stats=stats)


def sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def mad_limits(df: DataFrame, spec: Spec, of: str, out: str, signed: str | None = None, known: tuple[str, str] | None = None) -> DataFrame:
    """Add ``out_med`` (median of ``of``) and ``out_mad`` (constant-1 deviation of ``signed`` or ``of`` around its own median).

    ``known`` names the statistics of the blocks that are the same: of the median and of the deviation.
    """
    if spec.block:
        return df.withColumns({f"{out}_med": F.col(f"_st_{known[0]}_med"), f"{out}_mad": F.col(f"_st_{known[1]}_mad")})
    s = signed or of
    half = F.lit(0.5)
    df = df.withColumn(f"{out}_med", F.percentile(of, half).over(spec.p))
    df = df.withColumn(f"_{out}_centre", F.percentile(s, half).over(spec.p) if signed else F.col(f"{out}_med"))
    return df.withColumn(f"{out}_mad", F.percentile(F.abs(F.col(s) - F.col(f"_{out}_centre")), half).over(spec.p)).drop(f"_{out}_centre")


def with_runs(df: DataFrame, spec: Spec, value: Column, out: str = "run_len", by: str = "_run") -> DataFrame:
    """Add the length of the run of equal values; NULL breaks a run and has none."""
    df = df.withColumn(by, value).withColumn("_rn", spec.rn())
    changed = ~sure(F.col(by) == spec.lag(F.col(by)))
    next_changed = ~sure(F.col(by) == F.lead(by).over(spec.w))
    df = df.withColumn("_c", changed).withColumn("_nc", next_changed)
    start = F.max(F.when(F.col("_c"), F.col("_rn"))).over(spec.rows(UP, 0))
    end = F.min(F.when(F.col("_nc"), F.col("_rn"))).over(spec.rows(0, DOWN))
    return df.withColumn(out, F.when(F.col(by).isNotNull(), end - start + 1)).drop("_c", "_nc", "_rn", by)


# flow


def qc_negative(v: Column) -> Column:
    return sure(v < 0)


def qc_relative_spike(v: Column, spec: Spec, ratio: float = 10, min_baseline: float = 0.1) -> Column:
    before = spec.lag(v)
    return sure((before > min_baseline) & ((v - before) / F.nullif(before, F.lit(0.0)) > ratio))


def qc_drop(v: Column, spec: Spec, ratio: float = 0.9, min_flow: float = 1) -> Column:
    before = spec.lag(v)
    return sure((before > min_flow) & ((before - v) / F.nullif(before, F.lit(0.0)) > ratio))


def add_absolute_spike(df: DataFrame, spec: Spec, v: str = "value", k: float = 5, min_spike_flow: float = 1, out: str = "absolute_spike") -> DataFrame:
    df = df.withColumn("_d", F.abs(F.col(v) - spec.lag(F.col(v))))
    df = mad_limits(df, spec, "_d", "_a", known=("a", "a"))
    limit = F.col("_a_med") + k * F.col("_a_mad")
    return df.withColumn(out, sure((F.col("_a_mad") > 0) & (F.col(v) > min_spike_flow) & (F.col("_d") > limit))).drop("_d", "_a_med", "_a_mad")


def add_fluctuation(df: DataFrame, spec: Spec, v: str = "value", window: int = 8, min_reversals: int = 4, out: str = "fluctuation") -> DataFrame:
    df = df.withColumn("_s", F.coalesce(F.signum(F.col(v) - spec.lag(F.col(v))), F.lit(0.0)))
    turn = (F.col("_s") != 0) & (F.coalesce(spec.lag(F.col("_s")), F.lit(0.0)) != 0) & (F.col("_s") != spec.lag(F.col("_s")))
    df = df.withColumn("_t", sure(turn).cast("int"))
    df = df.withColumn("_hit", ((F.sum("_t").over(spec.rows(-(window - 1), 0)) >= min_reversals) & (spec.rn() >= window + 1)).cast("int"))
    return df.withColumn(out, F.max("_hit").over(spec.rows(0, window - 1)) == 1).drop("_s", "_t", "_hit")


def add_truncation(df: DataFrame, spec: Spec, v: str = "value", min_run: int = 4, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """Add ``truncation_low`` and ``truncation_high``."""
    r = F.round(F.col(v), 4)
    df = with_runs(df, spec, r, "_len")
    if spec.block:
        ql, qh = F.col("_st_v_lo"), F.col("_st_v_hi")  # of the blocks' quantiles
    else:
        ql, qh = F.percentile(v, F.lit(low)).over(spec.p), F.percentile(v, F.lit(high)).over(spec.p)
    long = F.col("_len") >= min_run
    return df.withColumns({"truncation_low": sure(long & (r <= ql)), "truncation_high": sure(long & (r >= qh))}).drop("_len")


# stage


def qc_h_range(v: Column, min_datum: float = float("-inf"), max_credible: float = float("inf")) -> Column:
    return sure((v < min_datum) | (v > max_credible))


def qc_h_rate_of_change(v: Column, spec: Spec, max_rise: float = 0.5, max_fall: float = 0.5) -> Column:
    d = v - spec.lag(v)
    return sure((d > max_rise) | (d < -max_fall))


def add_h_spike(df: DataFrame, spec: Spec, v: str = "value", k: float = 5, return_window: int = 3, out: str = "h_spike") -> DataFrame:
    df = df.withColumn("_d", F.col(v) - spec.lag(F.col(v))).withColumn("_ad", F.abs("_d"))
    df = mad_limits(df, spec, "_ad", "_h", signed="_d", known=("a", "s"))
    df = df.withColumn("_limit", F.when(F.col("_h_mad") > 0, F.col("_h_med") + k * F.col("_h_mad")))
    back = F.min("_d").over(spec.rows(1, return_window))
    df = df.withColumn("_hit", sure((F.col("_d") > F.col("_limit")) & (back < -0.5 * F.col("_limit")) & (spec.size() >= 3)).cast("int"))
    return df.withColumn(out, F.max("_hit").over(spec.rows(-return_window, 0)) == 1).drop("_d", "_ad", "_h_med", "_h_mad", "_limit", "_hit")


def add_h_flatline(df: DataFrame, spec: Spec, v: str = "value", min_run: int = 4, out: str = "h_flatline") -> DataFrame:
    return with_runs(df, spec, F.round(F.col(v), 4), "_len").withColumn(out, sure(F.col("_len") >= min_run)).drop("_len")


def add_h_datum_shift(df: DataFrame, spec: Spec, v: str = "value", window: int = 24, threshold: float = 0.1, out: str = "h_datum_shift") -> DataFrame:
    half = F.lit(0.5)
    df = df.withColumns(
        {"_b": F.percentile(v, half).over(spec.rows(-window, -1)), "_f": F.percentile(v, half).over(spec.rows(0, window - 1)), "_rn": spec.rn(), "_all": spec.size()}
    )
    fits = (F.col("_rn") >= window + 1) & (F.col("_rn") <= F.col("_all") - window + 1)
    df = df.withColumn("_hit", sure(fits & (F.abs(F.col("_f") - F.col("_b")) > threshold)).cast("int"))
    return df.withColumn(out, F.max("_hit").over(spec.rows(-(window - 1), 0)) == 1).drop("_b", "_f", "_rn", "_all", "_hit")


def add_stage_flow_consistency(df: DataFrame, spec: Spec, stage: str = "stage", flow: str = "flow", window: int = 4, out: str = "inconsistent") -> DataFrame:
    """Flag every row of ``window`` consecutive steps in which stage and flow move in opposite directions."""
    ds, dq = F.signum(F.col(stage) - spec.lag(F.col(stage))), F.signum(F.col(flow) - spec.lag(F.col(flow)))
    df = df.withColumn("_x", sure((ds != 0) & (dq != 0) & (ds != dq)).cast("int"))
    df = df.withColumn("_hit", ((F.sum("_x").over(spec.rows(-(window - 1), 0)) >= window) & (spec.rn() >= window + 1)).cast("int"))
    return df.withColumn(out, F.max("_hit").over(spec.rows(0, window - 1)) == 1).drop("_x", "_hit")


# rainfall


def qc_p_negative(v: Column) -> Column:
    return sure(v < 0)


def qc_p_intensity(v: Column, most: float = 50) -> Column:
    return sure(v > most)


def add_p_daily_cap(df: DataFrame, spec: Spec, v: str = "value", max_mm: float = 300, steps: int = 96, out: str = "p_daily_cap") -> DataFrame:
    total = F.sum(F.coalesce(F.col(v), F.lit(0.0))).over(spec.rows(-(steps - 1), 0))
    df = df.withColumn("_hit", ((F.round(total, 6) > max_mm) & (spec.rn() >= steps)).cast("int"))
    return df.withColumn(out, F.max("_hit").over(spec.rows(0, steps - 1)) == 1).drop("_hit")


def add_p_dry_run(df: DataFrame, spec: Spec, v: str = "value", wet: str = "wet", min_steps: int = 12, out: str = "p_dry_run") -> DataFrame:
    """Runs of zero rain while ``wet`` says that it rains; a NULL value or mask breaks a run."""
    dry = F.when((F.col(v) == 0) & F.col(wet), F.lit(1))
    return with_runs(df, spec, dry, "_len").withColumn(out, sure(F.col("_len") >= min_steps)).drop("_len")


def add_p_reset(df: DataFrame, spec: Spec, v: str = "value", k: float = 10, return_window: int = 2, out: str = "p_reset") -> DataFrame:
    df = mad_limits(df, spec, v, "_p", known=("v", "v"))
    back = F.min(v).over(spec.rows(1, return_window))
    hit = (F.col("_p_mad") > 0) & (F.col(v) > F.col("_p_med") + k * F.col("_p_mad")) & (back <= F.col("_p_med") + F.col("_p_mad"))
    return df.withColumn(out, sure(hit)).drop("_p_med", "_p_mad")


def p_temporal_consistency(target: DataFrame, neighbours: DataFrame, links: DataFrame, threshold: float = 0.2, fraction: float = 0.8) -> DataFrame:
    """Rain at a gauge while nearly all declared neighbours are dry.

    ``links`` has (site_id, neighbour_id). The share is over the declared neighbours, also those without a reading; a gauge
    without neighbours is never flagged. Gives ``reading_id, isolated``.
    """
    declared = links.distinct()
    count = declared.groupBy("site_id").agg(F.count(F.lit(1)).alias("n"))
    dry = (
        target.select("reading_id", "site_id", "timestamp")
        .join(declared, "site_id")
        .join(neighbours.select(F.col("site_id").alias("neighbour_id"), "timestamp", F.col("value").alias("nv")), ["neighbour_id", "timestamp"])
        .groupBy("reading_id")
        .agg(F.count_if(F.col("nv") <= threshold).alias("dry"))
    )
    out = target.join(count, "site_id", "left").join(dry, "reading_id", "left")
    return out.select("reading_id", sure((F.col("value") > threshold) & (F.coalesce("dry", F.lit(0)) / F.col("n") >= fraction)).alias("isolated"))


# codes and flags


def y_code(allow_negative: bool = False) -> Column:
    """Flow code from the check columns; the first that holds of 8, 9, 1, 2, 3, 4, 6, 7, 5."""
    c = F.col
    out = F.when(c("relative_spike") & c("absolute_spike"), 8).when(c("drop") & (c("negative") | c("truncation_low")), 9)
    if not allow_negative:
        out = out.when(c("negative"), 1)
    return (
        out.when(c("relative_spike"), 2)
        .when(c("absolute_spike"), 3)
        .when(c("drop"), 4)
        .when(c("truncation_low"), 6)
        .when(c("truncation_high"), 7)
        .when(c("fluctuation"), 5)
        .otherwise(0)
    )


def y_flag(code: Column) -> Column:
    return F.when(code == 0, 1).when(code.isin(1, 8, 9), 4).when(code.isNotNull(), 3)


def h_code() -> Column:
    c = F.col
    return F.when(c("h_range"), 1).when(c("h_spike"), 2).when(c("h_rate"), 3).when(c("h_flatline"), 4).when(c("h_datum_shift"), 5).otherwise(0)


def h_flag(code: Column) -> Column:
    return F.when(code == 0, 1).when(code.isNotNull(), 3)


def p_code() -> Column:
    c = F.col
    return F.when(c("p_negative"), 1).when(c("p_reset"), 5).when(c("p_intensity"), 2).when(c("p_daily_cap"), 3).otherwise(0)


def p_flag(code: Column) -> Column:
    return F.when(code == 0, 1).when(code.isin(1, 5), 4).when(code.isNotNull(), 3)


def flow_checks(df: DataFrame, spec: Spec, v: str = "value") -> DataFrame:
    c = F.col(v)
    df = df.withColumns({"negative": qc_negative(c), "relative_spike": qc_relative_spike(c, spec), "drop": qc_drop(c, spec)})
    return add_truncation(add_fluctuation(add_absolute_spike(df, spec, v), spec, v), spec, v)


def stage_checks(df: DataFrame, spec: Spec, v: str = "value", min_datum: float = float("-inf"), max_credible: float = float("inf")) -> DataFrame:
    c = F.col(v)
    df = df.withColumns({"h_range": qc_h_range(c, min_datum, max_credible), "h_rate": qc_h_rate_of_change(c, spec)})
    return add_h_datum_shift(add_h_flatline(add_h_spike(df, spec, v), spec, v), spec, v)


def rain_checks(df: DataFrame, spec: Spec, v: str = "value") -> DataFrame:
    c = F.col(v)
    df = df.withColumns({"p_negative": qc_p_negative(c), "p_intensity": qc_p_intensity(c)})
    return add_p_reset(add_p_daily_cap(df, spec, v), spec, v)
