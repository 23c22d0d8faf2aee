"""Queries of the data-preparation problems over the hydrometric tables, and the SQL that checks those SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstream.functions.timefn import text_of_s, text_of_us
from weirstream.operators.as_known import as_known
from weirstream.operators.implausible import implausible, noted_tidal
from weirstream.operators.interval_union import continuous_periods
from weirstream.operators.mixed_time import choose, interpretations
from weirstream.operators.regular_grid import empty_cells, regular_grid
from weirstream.operators.rejects import parse_rows
from weirstream.sources.tables import table

QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


_SLOTS = """
WITH p AS (SELECT site_id, data_type, max(CASE lower(trim(period)) WHEN '15min' THEN 900 WHEN 'hourly' THEN 3600 WHEN 'daily' THEN 86400 END) AS step
           FROM bronze GROUP BY 1, 2),
r AS (SELECT DISTINCT b.site_id, b.data_type, p.step, CAST(floor(epoch(b.timestamp) / p.step) AS BIGINT) AS slot
      FROM bronze b JOIN p USING (site_id, data_type) WHERE b.value IS NOT NULL AND NOT isnan(b.value) AND p.step IS NOT NULL),
n AS (SELECT *, lead(slot) OVER (PARTITION BY site_id, data_type ORDER BY slot) AS nxt FROM r)
"""


@query(
    "p1_found",
    _SLOTS
    + """SELECT site_id, data_type, strftime(make_timestamp(s * step * 1000000), '%Y-%m-%d %H:%M:%S') AS slot_start
FROM (SELECT site_id, data_type, step, unnest(range(slot + 1, nxt)) AS s FROM n WHERE nxt > slot + 1)""",
)
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return empty_cells(regular_grid(table(spark, sf_dir, "bronze")))


@query(
    "p1_grid_counts",
    _SLOTS
    + """SELECT site_id, data_type, CAST(max(slot) - min(slot) + 1 AS BIGINT) AS cells, CAST(count(*) AS BIGINT) AS observed
FROM n GROUP BY 1, 2""",
)
def p1_grid_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells and observed cells of every series of the regular grid."""
    return (
        regular_grid(table(spark, sf_dir, "bronze"))
        .groupBy("site_id", "data_type")
        .agg(F.count("*").alias("cells"), F.count_if(F.col("status") == "observed").alias("observed"))
    )


@query("p1_grid")
def p1_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of the regular grid, filled and empty ones marked. The tables hold no counters; resets run in the tests only."""
    return regular_grid(table(spark, sf_dir, "bronze")).select("site_id", "data_type", text_of_s(F.col("slot_start_s")).alias("slot_start"), "n_readings", "amount", "covered_s", "value", "status")


@query(
    "p4_found",
    """
WITH r AS (SELECT DISTINCT site_id, TRY_CAST(valid_from AS DATE) AS lo, CASE WHEN valid_to IS NULL THEN DATE '99999-12-31' ELSE TRY_CAST(valid_to AS DATE) END AS hi
           FROM rating_register WHERE site_id IS NOT NULL),
v AS (SELECT * FROM r WHERE lo IS NOT NULL AND hi >= lo),
m AS (SELECT *, max(hi) OVER (PARTITION BY site_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM v),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR lo > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY site_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS n FROM m),
s AS (SELECT site_id, n, min(lo) AS a, max(hi) AS z FROM g GROUP BY 1, 2),
l AS (SELECT *, lead(a) OVER (PARTITION BY site_id ORDER BY a) AS nxt FROM s)
SELECT site_id, 'period' AS kind, strftime(a, '%Y-%m-%d') AS first_day, CASE WHEN z = DATE '99999-12-31' THEN 'open' ELSE strftime(z, '%Y-%m-%d') END AS last_day FROM l
UNION ALL
SELECT site_id, 'gap', strftime(z + 1, '%Y-%m-%d'), strftime(nxt - 1, '%Y-%m-%d') FROM l WHERE nxt IS NOT NULL
""",
)
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return continuous_periods(table(spark, sf_dir, "rating_register"))


@query(
    "p6_found",
    """
WITH v AS (SELECT DISTINCT site_id, rating_id, version, TRY_CAST(valid_from AS DATE) AS lo, valid_to IS NULL AS open, TRY_CAST(valid_to AS DATE) AS hi, saved_at FROM ratings),
j AS (SELECT b.reading_id, v.rating_id, row_number() OVER (PARTITION BY b.reading_id ORDER BY v.version DESC, v.rating_id DESC) AS k
      FROM bronze b JOIN v ON b.site_id = v.site_id AND v.saved_at <= b.timestamp AND CAST(b.timestamp AS DATE) >= v.lo
           AND (v.open OR CAST(b.timestamp AS DATE) <= v.hi)
      WHERE b.data_type = 'H')
SELECT reading_id, rating_id FROM j WHERE k = 1
""",
)
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = table(spark, sf_dir, "bronze").filter(F.col("data_type") == "H")
    return as_known(stage, table(spark, sf_dir, "ratings"))


def _export_rows(spark: SparkSession, sf_dir: str, with_readings: bool = False) -> DataFrame:
    return parse_rows(table(spark, sf_dir, "wiski_all_lines"), table(spark, sf_dir, "quality_codes"), with_readings=with_readings)


@query("p3_found")
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _export_rows(spark, sf_dir).filter("reason is not null").select("line_id", "reason")


@query("p3_valid")
def p3_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid rows as a typed table; the time is still text (problem 5 settles it)."""
    return _export_rows(spark, sf_dir).filter("reason is null").select("line_id", "station", "time_text", "value", F.col("quality").cast("int").alias("quality"), "remarks")


@query("p5_found")
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = (
        table(spark, sf_dir, "bronze_landing")
        .select("landing_id", "timestamp", "feed")
        .join(table(spark, sf_dir, "feeds").groupBy("feed").agg(F.min("zone").alias("zone"), F.min("day_order").alias("day_order")), "feed", "left")
    )
    landing = interpretations(landing, "timestamp", F.lower(F.trim("day_order")), F.col("zone"))
    exports = _export_rows(spark, sf_dir, with_readings=True).filter("reason is null")
    name = F.col("table_name")
    records = landing.select(F.lit("bronze_landing").alias("table_name"), F.col("feed").alias("source"), F.col("landing_id").alias("number"), F.col("landing_id").alias("id"), "readings").unionByName(
        exports.select(F.lit("wiski_all_lines").alias("table_name"), F.col("file").alias("source"), F.col("line_no").alias("number"), F.col("line_id").alias("id"), "readings")
    )
    found = choose(records, ["table_name", "source"], "number", "id").withColumn("table_name", F.split("source", "\x1f")[0])
    return found.select(name, F.col("row").alias("row_id"), text_of_us(F.col("us")).alias("utc_time"))


def _implausible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return implausible(table(spark, sf_dir, "silver"), noted_tidal(table(spark, sf_dir, "gauge_registry")))


@query("p2_found")
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _implausible(spark, sf_dir).select("reading_id")


@query("p2_flags")
def p2_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with the check that each fails."""
    return _implausible(spark, sf_dir)


@query(
    "p2_stuck",
    """WITH s AS (SELECT reading_id, site_id, data_type, timestamp AS t, value AS v FROM silver WHERE value IS NOT NULL AND NOT isnan(value) AND site_id IS NOT NULL AND data_type IS NOT NULL AND timestamp IS NOT NULL AND reading_id IS NOT NULL),
c AS (SELECT *, CASE WHEN v = lag(v) OVER (PARTITION BY site_id, data_type ORDER BY t, reading_id) THEN 0 ELSE 1 END AS fresh FROM s),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY site_id, data_type ORDER BY t, reading_id ROWS UNBOUNDED PRECEDING) AS run FROM c),
n AS (SELECT *, count(*) OVER (PARTITION BY site_id, data_type, run) AS len FROM g)
SELECT reading_id FROM n WHERE len >= 8 AND NOT (data_type = 'P' AND v = 0)""",
)
def p2_stuck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows in runs of equal values."""
    return _implausible(spark, sf_dir).filter("stuck").select("reading_id")
