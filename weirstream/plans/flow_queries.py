"""Queries of the quality-control checks and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstream.operators import qc
from weirstream.sources.tables import table, usable

QUERIES = {}
SQL = {}
SPEC = qc.BLOCKED


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


def series(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The promoted series of one type; NaN is no value."""
    v = F.when(usable(F.col("value")), F.col("value"))
    return table(spark, sf_dir, "silver").filter(F.col("data_type") == kind).select("reading_id", "site_id", "data_type", "timestamp", v.alias("value"))


def blocks(spark: SparkSession, sf_dir: str, kind: str, stats: bool = True) -> DataFrame:
    return qc.blocked(series(spark, sf_dir, kind), stats=stats)


#: Checks of a row by itself need no order, checks of rows nearby no statistics of the series.
BY_ITSELF = ("qc_negative", "qc_h_range", "qc_p_negative", "qc_p_intensity")
BY_SERIES = ("qc_absolute_spike", "qc_truncation_low", "qc_truncation_high", "qc_h_spike", "qc_p_reset")


def checked(spark: SparkSession, sf_dir: str, kind: str, name: str, column) -> DataFrame:
    if name in BY_ITSELF:
        return column(series(spark, sf_dir, kind)).select("reading_id", "flagged")
    return column(blocks(spark, sf_dir, kind, name in BY_SERIES)).filter("_own").select("reading_id", "flagged")


def base(kind: str) -> str:
    """Common start of the SQL: rows ``s`` with value v, previous values, step d and number rn."""
    return f"""WITH s0 AS (SELECT reading_id, site_id, timestamp AS ts, CASE WHEN isnan(value) THEN NULL ELSE value END AS v FROM silver WHERE data_type = '{kind}'),
s AS (SELECT *, lag(v) OVER w AS pv, v - lag(v) OVER w AS d, round(v, 4) AS r, row_number() OVER w AS rn, count(*) OVER (PARTITION BY site_id) AS n
      FROM s0 WINDOW w AS (PARTITION BY site_id ORDER BY ts, reading_id))"""


W = "PARTITION BY site_id ORDER BY ts, reading_id"
MAD = """, m1 AS (SELECT site_id, median(abs(d)) AS md, median(d) AS ms FROM s GROUP BY 1),
m2 AS (SELECT s.site_id, md, median(abs(abs(d) - md)) AS mad, median(abs(d - ms)) AS smad FROM s JOIN m1 USING (site_id) GROUP BY 1, 2)"""
RUNS = f""", c AS (SELECT *, NOT coalesce(r = lag(r) OVER w, false) AS ch FROM s WINDOW w AS ({W})),
g AS (SELECT *, sum(ch::INT) OVER ({W} ROWS UNBOUNDED PRECEDING) AS run FROM c),
l AS (SELECT *, CASE WHEN r IS NULL THEN NULL ELSE count(*) OVER (PARTITION BY site_id, run) END AS len FROM g)"""
TURNS = f""", t1 AS (SELECT *, coalesce(sign(d), 0) AS sg FROM s),
t2 AS (SELECT *, (sg <> 0 AND coalesce(lag(sg) OVER w, 0) <> 0 AND sg <> lag(sg) OVER w)::INT AS tu FROM t1 WINDOW w AS ({W})),
t3 AS (SELECT *, (sum(coalesce(tu, 0)) OVER ({W} ROWS 7 PRECEDING) >= 4 AND rn >= 9)::INT AS hit FROM t2),
t4 AS (SELECT *, max(hit) OVER ({W} ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) = 1 AS fluctuation FROM t3)"""


def _flow(name: str, sql_test: str, column, extra: str = "", source: str = "s"):
    @query(name, base("Q") + extra + f" SELECT reading_id, coalesce({sql_test}, false) AS flagged FROM {source}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return checked(spark, sf_dir, "Q", name, column)

    return run


def V():
    return F.col("value")


_flow("qc_negative", "v < 0", lambda df: df.withColumn("flagged", qc.qc_negative(V())))
_flow("qc_relative_spike", "pv > 0.1 AND (v - pv) / nullif(pv, 0) > 10", lambda df: df.withColumn("flagged", qc.qc_relative_spike(V(), SPEC)))
_flow("qc_drop", "pv > 1 AND (pv - v) / nullif(pv, 0) > 0.9", lambda df: df.withColumn("flagged", qc.qc_drop(V(), SPEC)))
_flow("qc_absolute_spike", "mad > 0 AND v > 1 AND abs(d) > md + 5 * mad", lambda df: qc.add_absolute_spike(df, SPEC, out="flagged"), MAD, "s JOIN m2 USING (site_id)")
_flow("qc_fluctuation", "fluctuation", lambda df: qc.add_fluctuation(df, SPEC, out="flagged"), TURNS, "t4")
_QUANT = ", q AS (SELECT site_id, quantile_cont(v, 0.1) AS ql, quantile_cont(v, 0.9) AS qh FROM s GROUP BY 1)"
_flow("qc_truncation_low", "len >= 4 AND r <= ql", lambda df: qc.add_truncation(df, SPEC).withColumnRenamed("truncation_low", "flagged"), RUNS + _QUANT, "l JOIN q USING (site_id)")
_flow("qc_truncation_high", "len >= 4 AND r >= qh", lambda df: qc.add_truncation(df, SPEC).withColumnRenamed("truncation_high", "flagged"), RUNS + _QUANT, "l JOIN q USING (site_id)")


def _check(kind: str, name: str, sql_test: str, column, extra: str = "", source: str = "s"):
    @query(name, base(kind) + extra + f" SELECT reading_id, coalesce({sql_test}, false) AS flagged FROM {source}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return checked(spark, sf_dir, kind, name, column)


_SPIKE = f""", x AS (SELECT *, md + 5 * smad AS lim, min(d) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS back FROM s JOIN m2 USING (site_id)),
y AS (SELECT *, coalesce(smad > 0 AND d > lim AND back < -0.5 * lim AND n >= 3, false)::INT AS hit FROM x),
z AS (SELECT *, max(hit) OVER ({W} ROWS 3 PRECEDING) = 1 AS f FROM y)"""
_SHIFT = f""", x AS (SELECT *, quantile_cont(v, 0.5) OVER ({W} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS b, quantile_cont(v, 0.5) OVER ({W} ROWS BETWEEN CURRENT ROW AND 23 FOLLOWING) AS f FROM s),
y AS (SELECT *, coalesce(rn >= 25 AND rn <= n - 23 AND abs(f - b) > 0.1, false)::INT AS hit FROM x),
z AS (SELECT *, max(hit) OVER ({W} ROWS 23 PRECEDING) = 1 AS sh FROM y)"""
_check("H", "qc_h_range", "v < 0 OR v > 10", lambda df: df.withColumn("flagged", qc.qc_h_range(V(), 0.0, 10.0)))
_check("H", "qc_h_rate_of_change", "d > 0.5 OR d < -0.5", lambda df: df.withColumn("flagged", qc.qc_h_rate_of_change(V(), SPEC)))
_check("H", "qc_h_spike", "f", lambda df: qc.add_h_spike(df, SPEC, out="flagged"), MAD + _SPIKE, "z")
_check("H", "qc_h_flatline", "len >= 4", lambda df: qc.add_h_flatline(df, SPEC, out="flagged"), RUNS, "l")
_check("H", "qc_h_datum_shift", "sh", lambda df: qc.add_h_datum_shift(df, SPEC, out="flagged"), _SHIFT, "z")

_CAP = f""", x AS (SELECT *, (round(sum(coalesce(v, 0)) OVER ({W} ROWS 95 PRECEDING), 6) > 300 AND rn >= 96)::INT AS hit FROM s),
z AS (SELECT *, max(hit) OVER ({W} ROWS BETWEEN CURRENT ROW AND 95 FOLLOWING) = 1 AS f FROM x)"""
_RESET = f""", m1 AS (SELECT site_id, median(v) AS med FROM s GROUP BY 1), m2 AS (SELECT s.site_id, med, median(abs(v - med)) AS mad FROM s JOIN m1 USING (site_id) GROUP BY 1, 2),
z AS (SELECT *, min(v) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING) AS back FROM s JOIN m2 USING (site_id))"""
_DRY = f""", k AS (SELECT *, CASE WHEN v = 0 AND extract(hour FROM ts) < 18 THEN 1 END AS r FROM (SELECT * EXCLUDE (r) FROM s)),
c AS (SELECT *, NOT coalesce(r = lag(r) OVER w, false) AS ch FROM k WINDOW w AS ({W})), g AS (SELECT *, sum(ch::INT) OVER ({W} ROWS UNBOUNDED PRECEDING) AS run FROM c),
l AS (SELECT *, CASE WHEN r IS NULL THEN NULL ELSE count(*) OVER (PARTITION BY site_id, run) END AS len FROM g)"""
_check("P", "qc_p_negative", "v < 0", lambda df: df.withColumn("flagged", qc.qc_p_negative(V())))
_check("P", "qc_p_intensity", "v > 50", lambda df: df.withColumn("flagged", qc.qc_p_intensity(V())))
_check("P", "qc_p_daily_cap", "f", lambda df: qc.add_p_daily_cap(df, SPEC, out="flagged"), _CAP, "z")
_check("P", "qc_p_reset", "mad > 0 AND v > med + 10 * mad AND back <= med + mad", lambda df: qc.add_p_reset(df, SPEC, out="flagged"), _RESET, "z")
_check("P", "qc_p_dry_run", "len >= 12", lambda df: qc.add_p_dry_run(df.withColumn("wet", F.hour("timestamp") < 18), SPEC, out="flagged"), _DRY, "l")


@query(
    "qc_p_temporal_consistency",
    """WITH p AS (SELECT reading_id, site_id, timestamp, CASE WHEN isnan(value) THEN NULL ELSE value END AS v FROM silver WHERE data_type = 'P'),
l AS (SELECT DISTINCT a.gauge_id AS site_id, b.gauge_id AS nb FROM gauge_registry a JOIN gauge_registry b ON a.catchment = b.catchment AND a.gauge_id <> b.gauge_id WHERE a.data_type = 'rainfall' AND b.data_type = 'rainfall'),
c AS (SELECT site_id, count(*) AS n FROM l GROUP BY 1),
d AS (SELECT p.reading_id, count(*) FILTER (WHERE q.v <= 0.2) AS dry FROM p JOIN l USING (site_id) JOIN p q ON q.site_id = l.nb AND q.timestamp = p.timestamp GROUP BY 1)
SELECT p.reading_id, coalesce(p.v > 0.2 AND coalesce(dry, 0) / n >= 0.8, false) AS isolated FROM p LEFT JOIN c USING (site_id) LEFT JOIN d USING (reading_id)""",
)
def qc_p_temporal_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rain = series(spark, sf_dir, "P")
    gauges = table(spark, sf_dir, "gauge_registry").filter("data_type = 'rainfall' and catchment is not null")
    a, b = gauges.select(F.col("gauge_id").alias("site_id"), "catchment"), gauges.select(F.col("gauge_id").alias("neighbour_id"), "catchment")
    links = a.join(b, "catchment").filter("site_id <> neighbour_id").select("site_id", "neighbour_id")
    return qc.p_temporal_consistency(rain, rain, links)


@query(
    "qc_h_stage_flow_consistency",
    f"""WITH h AS (SELECT reading_id, site_id, timestamp AS ts, CASE WHEN isnan(value) THEN NULL ELSE value END AS h FROM silver WHERE data_type = 'H'),
q AS (SELECT site_id, timestamp AS ts, CASE WHEN isnan(value) THEN NULL ELSE value END AS q FROM silver WHERE data_type = 'Q'),
j AS (SELECT * FROM h JOIN q USING (site_id, ts)),
x AS (SELECT *, sign(h - lag(h) OVER w) AS a, sign(q - lag(q) OVER w) AS b, row_number() OVER w AS rn FROM j WINDOW w AS ({W})),
y AS (SELECT *, coalesce(a <> 0 AND b <> 0 AND a <> b, false)::INT AS x FROM x),
z AS (SELECT *, (sum(x) OVER ({W} ROWS 3 PRECEDING) >= 4 AND rn >= 5)::INT AS hit FROM y)
SELECT reading_id, max(hit) OVER ({W} ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) = 1 AS inconsistent FROM z""",
)
def qc_h_stage_flow_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    h, q = series(spark, sf_dir, "H").withColumnRenamed("value", "stage"), series(spark, sf_dir, "Q").select("site_id", "timestamp", F.col("value").alias("flow"))
    both = qc.blocked(h.join(q, ["site_id", "timestamp"]), value="stage", stats=False)
    return qc.add_stage_flow_consistency(both, SPEC).filter("_own").select("reading_id", "inconsistent")


_Y = (
    base("Q") + MAD + RUNS + _QUANT + TURNS.replace("FROM s)", "FROM l)")
    + """, k AS (SELECT reading_id, coalesce(v < 0, false) AS neg, coalesce(pv > 0.1 AND (v - pv) / nullif(pv, 0) > 10, false) AS rel,
 coalesce(mad > 0 AND v > 1 AND abs(d) > md + 5 * mad, false) AS ab, coalesce(pv > 1 AND (pv - v) / nullif(pv, 0) > 0.9, false) AS dr,
 coalesce(len >= 4 AND r <= ql, false) AS tl, coalesce(len >= 4 AND r >= qh, false) AS th, fluctuation FROM t4 JOIN m2 USING (site_id) JOIN q USING (site_id)),
y AS (SELECT reading_id, CASE WHEN rel AND ab THEN 8 WHEN dr AND (neg OR tl) THEN 9 WHEN neg THEN 1 WHEN rel THEN 2 WHEN ab THEN 3 WHEN dr THEN 4 WHEN tl THEN 6 WHEN th THEN 7 WHEN fluctuation THEN 5 ELSE 0 END AS code FROM k)"""
)


@query("y_code", _Y + " SELECT reading_id, code, CASE WHEN code = 0 THEN 1 WHEN code IN (1, 8, 9) THEN 4 ELSE 3 END AS flag FROM y")
def y_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = qc.flow_checks(blocks(spark, sf_dir, "Q"), SPEC).withColumn("code", qc.y_code())
    return df.filter("_own").select("reading_id", "code", qc.y_flag(F.col("code")).alias("flag"))


_H = (
    base("H") + MAD + RUNS
    + f""", x AS (SELECT *, md + 5 * smad AS lim, min(d) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS back,
 quantile_cont(v, 0.5) OVER ({W} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS b, quantile_cont(v, 0.5) OVER ({W} ROWS BETWEEN CURRENT ROW AND 23 FOLLOWING) AS f FROM l JOIN m2 USING (site_id)),
y AS (SELECT *, coalesce(smad > 0 AND d > lim AND back < -0.5 * lim AND n >= 3, false)::INT AS h1, coalesce(rn >= 25 AND rn <= n - 23 AND abs(f - b) > 0.1, false)::INT AS h2 FROM x),
z AS (SELECT *, max(h1) OVER ({W} ROWS 3 PRECEDING) = 1 AS sp, max(h2) OVER ({W} ROWS 23 PRECEDING) = 1 AS sh FROM y),
k AS (SELECT reading_id, CASE WHEN coalesce(v < -5 OR v > 20, false) THEN 1 WHEN sp THEN 2 WHEN coalesce(d > 0.5 OR d < -0.5, false) THEN 3 WHEN coalesce(len >= 4, false) THEN 4 WHEN sh THEN 5 ELSE 0 END AS code FROM z)"""
)


@query("h_code", _H + " SELECT reading_id, code, CASE WHEN code = 0 THEN 1 ELSE 3 END AS flag FROM k")
def h_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = qc.stage_checks(blocks(spark, sf_dir, "H"), SPEC, min_datum=-5.0, max_credible=20.0).withColumn("code", qc.h_code())
    return df.filter("_own").select("reading_id", "code", qc.h_flag(F.col("code")).alias("flag"))


_P = (
    base("P") + _RESET.replace("z AS (SELECT *,", f"z0 AS (SELECT *, (round(sum(coalesce(v, 0)) OVER ({W} ROWS 95 PRECEDING), 6) > 300 AND rn >= 96)::INT AS hit,")
    + f""", z AS (SELECT *, max(hit) OVER ({W} ROWS BETWEEN CURRENT ROW AND 95 FOLLOWING) = 1 AS cap FROM z0),
k AS (SELECT reading_id, CASE WHEN coalesce(v < 0, false) THEN 1 WHEN coalesce(mad > 0 AND v > med + 10 * mad AND back <= med + mad, false) THEN 5 WHEN coalesce(v > 50, false) THEN 2 WHEN cap THEN 3 ELSE 0 END AS code FROM z)"""
)


@query("p_code", _P + " SELECT reading_id, code, CASE WHEN code = 0 THEN 1 WHEN code IN (1, 5) THEN 4 ELSE 3 END AS flag FROM k")
def p_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = qc.rain_checks(blocks(spark, sf_dir, "P"), SPEC).withColumn("code", qc.p_code())
    return df.filter("_own").select("reading_id", "code", qc.p_flag(F.col("code")).alias("flag"))
