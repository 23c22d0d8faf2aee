"""Queries of the store: alignment, gaps, catalogue, rating, evaporation and export, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstream.functions import vocab
from weirstream.functions.timefn import period_seconds
from weirstream.operators import align, catalogue, export, gaps, pe, qc, rating
from weirstream.operators.qc import Spec
from weirstream.plans import flow_queries, pipeline, series
from weirstream.sources import allfile
from weirstream.sources.api import parse_props, parse_readings
from weirstream.sources.tables import table, usable
from weirstream.streaming.stream import run_dedup

QUERIES = {}
SQL = {}
KEYS = ["site_id", "data_type"]


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


def clean(df: DataFrame) -> DataFrame:
    return df.withColumn("value", F.when(usable(F.col("value")), F.col("value")))


# sources and schema


@query("scan_projected", "SELECT site_id, data_type, count(*) AS n FROM bronze GROUP BY 1, 2")
def scan_projected(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bronze").groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))


@query("bronze_schema", "SELECT timestamp, CASE WHEN isnan(value) THEN NULL ELSE value END AS value, supplier_flag, dataset_id, site_id, data_type, period FROM bronze")
def bronze_schema(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.bronze_schema(table(spark, d, "bronze"))


@query("dataset_id", "SELECT gauge_id, concat_ws('_', CASE source_system WHEN 'HDE' THEN 'EA' WHEN 'WISKI' THEN 'WISKI' WHEN 'WISKI_ALL' THEN 'WISKI' WHEN 'NRFA' THEN 'NRFA' WHEN 'MO' THEN 'MO' WHEN 'CEH' THEN 'CEH' END, gauge_id, CASE data_type WHEN 'flow' THEN 'Q' WHEN 'level' THEN 'H' WHEN 'rainfall' THEN 'P' END, strftime(date_added, '%Y%m%d')) AS dataset_id FROM gauge_registry")
def dataset_id(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "gauge_registry")
    return g.select("gauge_id", vocab.dataset_id(vocab.supplier_code(F.col("source_system")), F.col("gauge_id"), vocab.data_type_code(F.col("data_type")), F.col("date_added")).alias("dataset_id"))


@query("supplier_code", "SELECT source_system, CASE source_system WHEN 'HDE' THEN 'EA' WHEN 'WISKI' THEN 'WISKI' WHEN 'WISKI_ALL' THEN 'WISKI' WHEN 'NRFA' THEN 'NRFA' WHEN 'MO' THEN 'MO' WHEN 'CEH' THEN 'CEH' END AS supplier_code, CAST(count(*) AS BIGINT) AS n FROM gauge_registry GROUP BY 1, 2")
def supplier_code(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "gauge_registry")
    return g.groupBy("source_system", vocab.supplier_code(F.col("source_system")).alias("supplier_code")).agg(F.count(F.lit(1)).alias("n"))


@query("data_type_code", "SELECT data_type, CASE data_type WHEN 'flow' THEN 'Q' WHEN 'level' THEN 'H' WHEN 'rainfall' THEN 'P' WHEN 'soil_moisture' THEN 'SM' WHEN 'snow' THEN 'SWE' WHEN 'pe' THEN 'PE' END AS code, CAST(count(*) AS BIGINT) AS n FROM gauge_registry GROUP BY 1, 2")
def data_type_code(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "gauge_registry").groupBy("data_type", vocab.data_type_code(F.col("data_type")).alias("code")).agg(F.count(F.lit(1)).alias("n"))


@query("bronze_path", "SELECT DISTINCT dataset_id, 'store/bronze/hydrometric/' || split_part(dataset_id, '_', 1) || '/' || data_type || '/' || substr(dataset_id, -8, 4) || '/' || dataset_id || '.parquet' AS path FROM bronze WHERE dataset_id IS NOT NULL")
def bronze_path(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "bronze").filter("dataset_id is not null").select("dataset_id", "data_type").distinct()
    return b.select("dataset_id", vocab.bronze_path(F.lit("store"), F.lit("hydrometric"), catalogue.supplier_of(F.col("dataset_id")), F.col("data_type"), F.col("dataset_id")).alias("path")).distinct()


@query("silver_path", "SELECT DISTINCT dataset_id, 'store/silver/hydrometric/' || data_type || '/' || substr(dataset_id, -8, 4) || '/' || dataset_id || '.parquet' AS path FROM silver WHERE dataset_id IS NOT NULL")
def silver_path(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "silver").filter("dataset_id is not null").select("dataset_id", "data_type").distinct()
    return s.select("dataset_id", vocab.silver_path(F.lit("store"), F.lit("hydrometric"), F.col("data_type"), F.col("dataset_id")).alias("path")).distinct()


@query("category_from_path", "SELECT DISTINCT file_path, regexp_extract(file_path || '/x', '^store/gold/([^/]+)/', 1) AS category FROM rating_register")
def category_from_path(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "rating_register").select("file_path").distinct()
    return r.select("file_path", F.when(F.col("file_path").isNotNull(), vocab.category_of_path(F.replace(F.concat("file_path", F.lit("/x")), F.lit("store/gold/"), F.lit("store/bronze/")), "store")).alias("category")).withColumn(
        "category", F.when(F.col("file_path").startswith("store/gold/"), F.col("category")).otherwise(F.when(F.col("file_path").isNotNull(), F.lit("")))
    )


@query("interval_seconds", "SELECT DISTINCT period, CAST(CASE lower(trim(period)) WHEN '15min' THEN 900 WHEN 'hourly' THEN 3600 WHEN 'daily' THEN 86400 END AS BIGINT) AS seconds FROM bronze")
def interval_seconds(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bronze").select("period").distinct().select("period", period_seconds(F.col("period")).alias("seconds"))


@query("as_long", "SELECT 'flow' AS parameter, timestamp AS dateTime, strftime(timestamp, '%Y-%m-%d') AS date, CASE WHEN isnan(value) THEN NULL ELSE value END AS value, dataset_id AS measure_notation, site_id FROM silver WHERE data_type = 'Q'")
def as_long(spark: SparkSession, d: str) -> DataFrame:
    x = clean(table(spark, d, "silver").filter("data_type = 'Q'"))
    x = x.select(F.col("timestamp").alias("dateTime"), F.to_date("timestamp").alias("date"), "value", F.col("dataset_id").alias("measure_notation"), "site_id")
    return series.flow_15min(x).as_long().withColumn("date", F.col("date").cast("string"))


@query("registry_build", "SELECT gauge_id, data_type, category, true AS live FROM gauge_registry WHERE source_system IN ('HDE', 'WISKI', 'WISKI_ALL') AND category IN ('hydrometric', 'radarH19', 'MOSES') AND coalesce(live, false)")
def registry_build(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.valid_registry(table(spark, d, "gauge_registry")).filter("live").select("gauge_id", "data_type", "category", "live")


@query("json_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    return parse_props(table(spark, d, "events"))


@query("all_file_param_code", """SELECT DISTINCT line, CASE WHEN len(string_split(t, '/')) >= 3 THEN regexp_replace(lower(string_split(t, '/')[3]), '[^a-z0-9]', '_', 'g') ELSE regexp_replace(lower(t), '[^a-z0-9]', '_', 'g') END AS code
FROM (SELECT line, substr(line, length('Time series Name:') + 2) AS t FROM wiski_all_lines WHERE line LIKE 'Time series Name:' || chr(9) || '%')""")
def all_file_param_code(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "wiski_all_lines").filter(F.col("line").startswith("Time series Name:\t")).select("line").distinct()
    return x.select("line", vocab.trace_code(F.expr("substring(line, length('Time series Name:') + 2)")).alias("code"))


@query("type_infer", """SELECT DISTINCT line, CASE WHEN line ~* 'flow|discharge' THEN 'Q' WHEN line ~* 'level|stage' THEN 'H' WHEN line ~* 'rain' THEN 'P' ELSE 'Q' END AS data_type FROM wiski_all_lines WHERE line LIKE 'Parameter Name:%'""".replace("line ~* 'flow|discharge'", "regexp_matches(line, 'flow|discharge', 'i')").replace("line ~* 'level|stage'", "regexp_matches(line, 'level|stage', 'i')").replace("line ~* 'rain'", "regexp_matches(line, 'rain', 'i')"))
def type_infer(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "wiski_all_lines").filter(F.col("line").startswith("Parameter Name:")).select("line").distinct()
    return x.select("line", vocab.infer_type(F.col("line")).alias("data_type"))


@query("api_readings", "SELECT site_id || '-' || data_type AS measure_notation, date_trunc('second', timestamp) AS timestamp, value, supplier_flag AS quality FROM silver WHERE value IS NOT NULL AND NOT isnan(value) AND NOT isinf(value) AND site_id IS NOT NULL AND data_type IS NOT NULL AND timestamp IS NOT NULL")
def api_readings(spark: SparkSession, d: str) -> DataFrame:
    """The promoted readings as responses of the readings endpoint, parsed again."""
    x = table(spark, d, "silver").filter(usable(F.col("value")) & (F.abs("value") < float("inf")) & F.col("site_id").isNotNull() & F.col("data_type").isNotNull() & F.col("timestamp").isNotNull())
    item = F.struct(
        F.struct(F.concat(F.lit("http://measures/"), "site_id", F.lit("-"), "data_type").alias("@id")).alias("measure"), F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("dateTime"),
        F.date_format("timestamp", "yyyy-MM-dd").alias("date"), F.col("value"), F.col("supplier_flag").alias("quality"),
    )
    return parse_readings(x.select(F.to_json(F.struct(F.array(item).alias("items"))).alias("value")))


@query("measure_id", "SELECT DISTINCT 'a-b-c-d-e-' || event_type || '-i-900' AS notation, event_type AS parameter, 'instantaneous' AS value_type, '15min' AS period_name FROM events")
def measure_id(spark: SparkSession, d: str) -> DataFrame:
    n = F.concat(F.lit("a-b-c-d-e-"), F.col("event_type"), F.lit("-i-900"))
    return table(spark, d, "events").select("event_type").distinct().select(n.alias("notation"), *[c.alias(k) for k, c in vocab.measure_parts(n).items()])


# filters and projections


@query("filter_active", "SELECT gauge_id, data_type FROM gauge_registry WHERE active")
def filter_active(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "gauge_registry").filter("active").select("gauge_id", "data_type")


@query("filter_failed", "SELECT gauge_id, data_type FROM gauge_registry g WHERE EXISTS (SELECT 1 FROM silver s WHERE s.site_id = g.gauge_id AND s.qc_flag = 4)")
def filter_failed(spark: SparkSession, d: str) -> DataFrame:
    bad = table(spark, d, "silver").filter("qc_flag = 4").select(F.col("site_id").alias("gauge_id")).distinct()
    return table(spark, d, "gauge_registry").join(bad, "gauge_id", "left_semi").select("gauge_id", "data_type")


@query("filter_in", "SELECT reading_id FROM silver WHERE data_type IN ('Q', 'H') AND qc_flag IN (3, 4)")
def filter_in(spark: SparkSession, d: str) -> DataFrame:
    return catalogue.only(table(spark, d, "silver"), data_type=["Q", "H"], qc_flag=[3, 4], site_id=None).select("reading_id")


@query("filter_range", "SELECT reading_id FROM silver WHERE timestamp >= TIMESTAMP '2018-01-01' AND timestamp < TIMESTAMP '2021-01-01'")
def filter_range(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.on_days(table(spark, d, "silver"), "timestamp", "2018-01-01", "2020-12-31").select("reading_id")


@query("filter_quality", "SELECT reading_id FROM silver WHERE qc_flag <= 2")
def filter_quality(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.at_least(table(spark, d, "silver"), 2).select("reading_id")


@query("filter_prefix", "SELECT reading_id FROM bronze WHERE starts_with(dataset_id, 'WISKI_')")
def filter_prefix(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bronze").filter(F.col("dataset_id").startswith("WISKI_")).select("reading_id")


@query("drop_null", "SELECT reading_id FROM bronze WHERE timestamp IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)")
def drop_null(spark: SparkSession, d: str) -> DataFrame:
    return clean(table(spark, d, "bronze")).dropna(subset=["timestamp", "value"]).select("reading_id")


@query("offgrid_warn", "SELECT site_id, data_type, CAST(count(*) FILTER (WHERE minute(timestamp) % 15 <> 0) AS BIGINT) AS n_off FROM bronze GROUP BY 1, 2")
def offgrid_warn(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bronze").groupBy(*KEYS).agg(F.count_if(F.minute("timestamp") % 15 != 0).alias("n_off"))


@query("silver_readings", "SELECT timestamp AS dateTime, strftime(timestamp, '%Y-%m-%d') AS date, qc_value AS value, value AS raw_value, dataset_id AS measure_notation, qc_y_code, qc_h_code, qc_p_code FROM silver")
def silver_readings(spark: SparkSession, d: str) -> DataFrame:
    """The readings of all gauges."""
    return pipeline.silver_readings(table(spark, d, "silver")).withColumn("date", F.col("date").cast("string"))


# deduplication and alignment

_DEDUP = "SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY site_id, data_type, timestamp ORDER BY reading_id {}) AS k FROM bronze) WHERE k = 1"


@query("dedup_last", f"SELECT site_id, data_type, timestamp, reading_id FROM ({_DEDUP.format('DESC')})")
def dedup_last(spark: SparkSession, d: str) -> DataFrame:
    return align.dedup(table(spark, d, "bronze").select(*KEYS, "timestamp", "reading_id"), [*KEYS, "timestamp"], "reading_id")


@query("dedup_first", f"SELECT site_id, data_type, timestamp, reading_id FROM ({_DEDUP.format('ASC')})")
def dedup_first(spark: SparkSession, d: str) -> DataFrame:
    return align.dedup(table(spark, d, "bronze").select(*KEYS, "timestamp", "reading_id"), [*KEYS, "timestamp"], "reading_id", "first")


@query("distinct_times", "SELECT DISTINCT site_id, timestamp FROM bronze")
def distinct_times(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bronze").select("site_id", "timestamp").distinct()


_SNAP = f"""WITH b AS (SELECT *, minute(timestamp) % 15 = 0 AS g, epoch(timestamp) AS e FROM ({_DEDUP.format('DESC')})),
s AS (SELECT *, CAST(CASE WHEN g THEN floor(e / 900) ELSE round_even(e_whole / 900.0, 0) END AS BIGINT) AS slot FROM (SELECT *, floor(e) AS e_whole FROM b)),
k AS (SELECT *, max(g::INT) OVER (PARTITION BY site_id, data_type, slot) AS held FROM s)"""


@query("snap_offgrid", _SNAP + " SELECT reading_id, NOT g AS snapped, CASE WHEN g THEN timestamp ELSE make_timestamp(slot * 900000000) END AS timestamp FROM k WHERE g OR held = 0")
def snap_offgrid(spark: SparkSession, d: str) -> DataFrame:
    """Readings of all data types on the grid."""
    b = align.dedup(table(spark, d, "bronze"), [*KEYS, "timestamp"], "reading_id")
    return align.snap_offgrid(b).select("reading_id", "snapped", "timestamp")


@query("outer_align", "SELECT site_id, timestamp, max(value) FILTER (WHERE data_type = 'Q') AS Q, max(value) FILTER (WHERE data_type = 'H') AS H, max(value) FILTER (WHERE data_type = 'P') AS P FROM (SELECT site_id, timestamp, data_type, CASE WHEN isnan(value) THEN NULL ELSE value END AS value FROM silver) GROUP BY 1, 2")
def outer_align(spark: SparkSession, d: str) -> DataFrame:
    return align.outer_align(clean(table(spark, d, "silver")), ["Q", "H", "P"], "data_type")


@query("inner_align", "SELECT h.site_id, h.timestamp, h.value AS h, q.value AS q FROM silver h JOIN silver q ON h.site_id = q.site_id AND h.timestamp = q.timestamp AND h.data_type = 'H' AND q.data_type = 'Q'")
def inner_align(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "silver")
    side = lambda t: s.filter(F.col("data_type") == t.upper()).select("site_id", "timestamp", F.col("value").alias(t))
    return side("h").join(side("q"), ["site_id", "timestamp"])


@query("full_compare", "SELECT coalesce(a.o_orderdate, b.l_shipdate) AS day, a.n AS orders, b.n AS lines FROM (SELECT o_orderdate, count(*) AS n FROM orders GROUP BY 1) a FULL JOIN (SELECT l_shipdate, count(*) AS n FROM lineitem GROUP BY 1) b ON a.o_orderdate = b.l_shipdate")
def full_compare(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "orders").groupBy(F.col("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    b = table(spark, d, "lineitem").groupBy(F.col("l_shipdate").alias("day")).agg(F.count(F.lit(1)).alias("lines"))
    return a.join(b, "day", "full")


@query("catchment_lookup", "WITH c AS (SELECT max(catchment) AS catchment FROM gauge_registry WHERE gauge_id IN (SELECT site_id FROM silver)) SELECT s.site_id, CAST(count(*) AS BIGINT) AS n FROM silver s WHERE s.site_id IN (SELECT gauge_id FROM gauge_registry WHERE catchment = (SELECT catchment FROM c)) GROUP BY 1")
def catchment_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The last catchment by name that holds readings."""
    s, g = table(spark, d, "silver"), table(spark, d, "gauge_registry")
    held = g.join(s.select(F.col("site_id").alias("gauge_id")).distinct(), "gauge_id", "left_semi")
    name = held.agg(F.max("catchment").alias("c")).scalar()
    return pipeline.of_catchment(s, g, name).groupBy("site_id").agg(F.count(F.lit(1)).alias("n"))


@query("register_unknown", "SELECT DISTINCT site_id AS gauge_id, 'WISKI_ALL' AS source_system, CASE data_type WHEN 'Q' THEN 'flow' WHEN 'H' THEN 'level' WHEN 'P' THEN 'rainfall' END AS data_type, true AS active, false AS live, true AS backfill_done FROM bronze WHERE site_id IS NOT NULL AND site_id NOT IN (SELECT gauge_id FROM gauge_registry WHERE data_type = 'rainfall' AND gauge_id IS NOT NULL)")
def register_unknown(spark: SparkSession, d: str) -> DataFrame:
    """Registry rows for the gauges that a registry of rain gauges alone would lack."""
    known = table(spark, d, "gauge_registry").filter("data_type = 'rainfall'")
    return allfile.unknown_gauges(table(spark, d, "bronze").filter("site_id is not null"), known)


@query("union_fill", "SELECT site_id, valid_from, status FROM rating_register UNION ALL SELECT site_id, valid_from, NULL FROM ratings")
def union_fill(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "rating_register").select("site_id", "valid_from", "status")
    return a.unionByName(table(spark, d, "ratings").select("site_id", "valid_from"), allowMissingColumns=True)


@query("first_per_group", "SELECT site_id, min(reading_id) AS reading_id FROM bronze GROUP BY 1")
def first_per_group(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bronze").groupBy("site_id").agg(F.min("reading_id").alias("reading_id"))


# promotion, gaps, catalogue


_PROMOTED = _SNAP + f""", silver AS (SELECT reading_id, site_id, data_type, NOT g AS snapped, CASE WHEN g THEN timestamp ELSE make_timestamp(slot * 900000000) END AS timestamp, CASE WHEN isnan(value) THEN NULL ELSE value END AS value FROM k WHERE (g OR held = 0) AND site_id IS NOT NULL AND data_type IS NOT NULL),
cy AS ({flow_queries._Y} SELECT reading_id, code FROM y), ch AS ({flow_queries._H.replace("coalesce(v < -5 OR v > 20, false)", "false")} SELECT reading_id, code FROM k), cp AS ({flow_queries._P} SELECT reading_id, code FROM k),
c AS (SELECT silver.*, cy.code AS y, ch.code AS h, cp.code AS p FROM silver LEFT JOIN cy USING (reading_id) LEFT JOIN ch USING (reading_id) LEFT JOIN cp USING (reading_id)),
f AS (SELECT *, CASE WHEN coalesce(y, h, p, 0) = 0 THEN CASE WHEN snapped THEN 2 ELSE 1 END WHEN y IN (1, 8, 9) OR p IN (1, 5) THEN 4 ELSE 3 END AS qc_flag FROM c)"""


@query("promote", _PROMOTED + " SELECT reading_id, site_id, data_type, timestamp, snapped, qc_flag, CASE WHEN qc_flag < 4 THEN value END AS qc_value, y AS qc_y_code, h AS qc_h_code, p AS qc_p_code FROM f")
def promote(spark: SparkSession, d: str) -> DataFrame:
    """Every row of the whole promotion, of all data types, with codes, flag and accepted value."""
    return pipeline.promote(table(spark, d, "bronze")).select("reading_id", *KEYS, "timestamp", "snapped", "qc_flag", "qc_value", "qc_y_code", "qc_h_code", "qc_p_code")


_STEPS = """WITH t AS (SELECT DISTINCT site_id, data_type, CAST(floor(epoch(timestamp)) AS BIGINT) AS t FROM silver),
d AS (SELECT *, t - lag(t) OVER (PARTITION BY site_id, data_type ORDER BY t) AS d FROM t),
s AS (SELECT site_id, data_type, min(t) AS t0, max(t) AS t1, count(*) AS n, CAST(floor(quantile_cont(d, 0.5)) AS BIGINT) AS step FROM d GROUP BY 1, 2)"""


@query("gap_counts", _STEPS + " SELECT site_id, data_type, CAST(CASE WHEN n < 2 OR NOT coalesce(step > 0, false) THEN 0 ELSE greatest(0, round_even((t1 - t0) / step, 0) + 1 - n) END AS BIGINT) AS n_missing FROM s")
def gap_counts(spark: SparkSession, d: str) -> DataFrame:
    return gaps.gap_counts(table(spark, d, "silver"), KEYS)


@query("gaps", _STEPS + """, g AS (SELECT site_id, data_type, step, unnest(range(t0, t1 + 1, step)) AS x FROM s WHERE n >= 2 AND step > 0),
m AS (SELECT g.* FROM g LEFT JOIN t ON t.site_id = g.site_id AND t.data_type = g.data_type AND t.t = g.x WHERE t.t IS NULL),
i AS (SELECT *, x - step * row_number() OVER (PARTITION BY site_id, data_type ORDER BY x) AS island FROM m)
SELECT site_id, data_type, make_timestamp(min(x) * 1000000) AS gap_start, make_timestamp(max(x) * 1000000) AS gap_end, count(*) AS n_missing FROM i GROUP BY site_id, data_type, island""")
def check_gaps(spark: SparkSession, d: str) -> DataFrame:
    return gaps.check_gaps(table(spark, d, "silver"), KEYS)


@query("period_infer", _STEPS + ", m AS (SELECT site_id, data_type, quantile_cont(d, 0.5) AS m FROM d GROUP BY 1, 2) SELECT site_id, data_type, CASE WHEN m IS NULL THEN '15min' WHEN m <= 900 THEN '15min' WHEN m <= 3600 THEN 'hourly' ELSE 'daily' END AS period_name FROM m")
def period_infer(spark: SparkSession, d: str) -> DataFrame:
    return gaps.infer_period(table(spark, d, "silver"), KEYS)


@query("gauge_catalogue", "SELECT site_id, split_part(dataset_id, '_', 1) AS supplier_code, data_type, period, min(timestamp) AS start, max(timestamp) AS \"end\", count(*) AS n FROM bronze GROUP BY 1, 2, 3, 4")
def gauge_catalogue(spark: SparkSession, d: str) -> DataFrame:
    return catalogue.gauge_catalogue(table(spark, d, "bronze"))


@query("coverage", """WITH c AS (SELECT site_id, split_part(dataset_id, '_', 1) AS supplier_code, data_type, period, min(timestamp) AS start, max(timestamp) AS "end", count(*) AS n FROM bronze GROUP BY 1, 2, 3, 4)
SELECT *, CAST(floor((epoch_us("end") - epoch_us(start)) / 86400000000) AS BIGINT) AS days_held, CAST(round_even((epoch_us("end") - epoch_us(start)) / 1e6 / CASE lower(trim(period)) WHEN '15min' THEN 900 WHEN 'hourly' THEN 3600 WHEN 'daily' THEN 86400 END, 0) AS BIGINT) + 1 AS expected_obs FROM c""")
def coverage(spark: SparkSession, d: str) -> DataFrame:
    return catalogue.coverage(table(spark, d, "bronze"))


@query("silver_catalogue", "SELECT data_type, site_id, CAST(min(year(timestamp)) AS INTEGER) AS min_year, CAST(max(year(timestamp)) AS INTEGER) AS max_year, count(DISTINCT dataset_id) AS n_datasets FROM silver GROUP BY 1, 2")
def silver_catalogue(spark: SparkSession, d: str) -> DataFrame:
    return catalogue.silver_catalogue(table(spark, d, "silver"))


_SC = "SELECT data_type, site_id, count(*) AS n, count(*) FILTER (WHERE qc_flag = 1) AS good, count(*) FILTER (WHERE qc_flag = 2) AS estimated, count(*) FILTER (WHERE qc_flag = 3) AS suspect, count(*) FILTER (WHERE qc_flag = 4) AS rejected, strftime(min(timestamp), '%Y-%m-%d') AS first_day, strftime(max(timestamp), '%Y-%m-%d') AS last_day, round(100.0 * count(*) FILTER (WHERE qc_flag = 1) / count(*), 1) AS pct_good FROM silver GROUP BY 1, 2"


@query("silver_coverage", f"SELECT * REPLACE (CAST(pct_good AS DOUBLE) AS pct_good) FROM ({_SC})")
def silver_coverage(spark: SparkSession, d: str) -> DataFrame:
    return catalogue.silver_coverage(table(spark, d, "silver")).withColumns({c: F.col(c).cast("string") for c in ("first_day", "last_day")})


@query("high_watermark", "SELECT site_id, data_type, max(timestamp) AS watermark FROM bronze GROUP BY 1, 2")
def high_watermark(spark: SparkSession, d: str) -> DataFrame:
    return catalogue.high_watermark(table(spark, d, "bronze"))


@query("incremental", "WITH m AS (SELECT site_id, data_type, max(timestamp) AS wm FROM silver GROUP BY 1, 2) SELECT b.reading_id FROM bronze b LEFT JOIN m ON b.site_id IS NOT DISTINCT FROM m.site_id AND b.data_type IS NOT DISTINCT FROM m.data_type WHERE m.wm IS NULL OR b.timestamp > m.wm")
def incremental(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.newer(table(spark, d, "bronze"), catalogue.high_watermark(table(spark, d, "silver"))).select("reading_id")


@query("daily_summary", "SELECT strftime(timestamp, '%Y-%m-%d') AS date, round(avg(value), 6) AS mean, max(value) AS max, count(value) AS n FROM silver WHERE data_type = 'Q' AND NOT isnan(value) GROUP BY 1")
def daily_summary(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "silver").filter((F.col("data_type") == "Q") & usable(F.col("value")))
    return s.groupBy(F.to_date("timestamp").cast("string").alias("date")).agg(F.round(F.avg("value"), 6).alias("mean"), F.max("value").alias("max"), F.count("value").alias("n"))


_HY = "year({0}) + CASE WHEN month({0}) >= 10 THEN 1 ELSE 0 END"


@query("hydro_year", f"SELECT DISTINCT o_orderdate, CAST({_HY.format('o_orderdate')} AS INTEGER) AS hydro_year, CAST(date_diff('day', make_date({_HY.format('o_orderdate')} - 1, 10, 1), CAST(o_orderdate AS DATE)) + 1 AS INTEGER) AS hydro_year_day FROM orders")
def hydro_year(spark: SparkSession, d: str) -> DataFrame:
    y, n = vocab.hydro_year(F.to_date("o_orderdate"))
    return table(spark, d, "orders").select("o_orderdate").distinct().select("o_orderdate", y.alias("hydro_year"), n.alias("hydro_year_day"))


@query("hydro_year_summary", f"WITH a AS (SELECT CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS m FROM orders GROUP BY 1) SELECT CAST({_HY.format('day')} AS INTEGER) AS hydro_year, round(avg(m), 4) AS mean, count(DISTINCT day) AS days FROM a GROUP BY 1")
def hydro_year_summary(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.avg("o_totalprice").alias("m"))
    return a.groupBy(vocab.hydro_year(F.col("day"))[0].alias("hydro_year")).agg(F.round(F.avg("m"), 4).alias("mean"), F.countDistinct("day").alias("days"))


@query("flag_breakdown", "SELECT data_type, qc_flag, count(*) AS n FROM silver GROUP BY 1, 2")
def flag_breakdown(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "silver").groupBy("data_type", "qc_flag").agg(F.count(F.lit(1)).alias("n"))


@query("distinct_count", "SELECT data_type, count(DISTINCT dataset_id) AS n FROM bronze GROUP BY 1")
def distinct_count(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bronze").groupBy("data_type").agg(F.countDistinct("dataset_id").alias("n"))


@query("run_summary", "WITH l AS (SELECT gauge_id, CASE WHEN live AND active THEN 'SUCCESS' WHEN active THEN 'EMPTY' ELSE 'FAILED' END AS status FROM gauge_registry), c AS (SELECT count(*) AS gauges, count(*) FILTER (WHERE status = 'SUCCESS') AS success, count(*) FILTER (WHERE status = 'EMPTY') AS empty, count(*) FILTER (WHERE status = 'FAILED') AS failed FROM l) SELECT *, CAST(round(100.0 * failed / gauges, 1) AS DOUBLE) AS pct_failed, round(100.0 * failed / gauges, 1) > 5 AS alert FROM c")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "gauge_registry").select(F.when(F.col("live") & F.col("active"), "SUCCESS").when(F.col("active"), "EMPTY").otherwise("FAILED").alias("status"))
    return catalogue.run_summary(log)


@query("correlation", "SELECT h.site_id, round(corr(h.value, q.value), 8) AS r FROM silver h JOIN silver q ON h.site_id = q.site_id AND h.timestamp = q.timestamp AND h.data_type = 'H' AND q.data_type = 'Q' WHERE NOT isnan(h.value) AND NOT isnan(q.value) GROUP BY 1 HAVING count(*) > 30")
def correlation(spark: SparkSession, d: str) -> DataFrame:
    x = inner_align(spark, d).filter(usable(F.col("h")) & usable(F.col("q")))
    return x.groupBy("site_id").agg(F.round(F.corr("h", "q"), 8).alias("r"), F.count(F.lit(1)).alias("n")).filter("n > 30").drop("n")


@query("robust_stats", "WITH s AS (SELECT site_id, data_type, value AS v FROM silver WHERE NOT isnan(value)), m AS (SELECT site_id, data_type, median(v) AS med FROM s GROUP BY 1, 2) SELECT s.site_id, s.data_type, round(med, 9) AS median, round(median(abs(v - med)), 9) AS mad, round(quantile_cont(v, 0.1), 9) AS q10, round(quantile_cont(v, 0.9), 9) AS q90 FROM s JOIN m USING (site_id, data_type) GROUP BY s.site_id, s.data_type, med")
def robust_stats(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "silver").filter(usable(F.col("value")))
    s = qc.mad_limits(s, Spec(), "value", "x")
    return s.groupBy(*KEYS).agg(
        F.round(F.max("x_med"), 9).alias("median"), F.round(F.max("x_mad"), 9).alias("mad"), *[F.round(F.percentile("value", F.lit(q)), 9).alias(n) for q, n in ((0.1, "q10"), (0.9, "q90"))]
    )


# rating

_LIMBS = "(VALUES (1, 0.0, 0.095, 12.2495, -0.003, 1.641, false), (2, 0.095, 2.0, 23.252, -0.098, 2.706, false), (3, 2.0, CAST('inf' AS DOUBLE), 23.252, -0.098, 2.706, true)) l(limb_no, lower, upper, c, a, b, doubtful)"


def _limbs(spark: SparkSession) -> DataFrame:
    rows = [(1, 0.0, 0.095, 12.2495, -0.003, 1.641, False), (2, 0.095, 2.0, 23.252, -0.098, 2.706, False), (3, 2.0, float("inf"), 23.252, -0.098, 2.706, True)]
    return spark.createDataFrame(rows, "limb_no int, lower double, upper double, c double, a double, b double, doubtful boolean").withColumn("curve", F.lit(1))


def _stage(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", (F.col("value") / 100 - 0.5).alias("value"), F.lit(1).alias("curve"))


@query("rate", f"SELECT event_id, round(CASE WHEN l.limb_no IS NOT NULL THEN greatest(l.c * pow(greatest(v - l.a, 0), l.b), 0) END, 6) AS flow, l.doubtful FROM (SELECT event_id, value / 100 - 0.5 AS v FROM events) e LEFT JOIN {_LIMBS} ON v >= l.lower AND (v < l.upper OR l.limb_no = 3)")
def rate(spark: SparkSession, d: str) -> DataFrame:
    out = rating.rate(_stage(spark, d), rating.limb_table(_limbs(spark), ["curve"]), ["curve"])
    return out.select("event_id", F.round("flow", 6).alias("flow"), "doubtful")


@query("unrate", """WITH q AS (SELECT event_id, value / 10.0 - 2.0 AS q FROM events)
SELECT event_id, round(CASE WHEN q < 0 THEN NULL WHEN q = 0 THEN 0.0 WHEN q <= 12.2495 * pow(0.098, 1.641) THEN pow(q / 12.2495, 1 / 1.641) - 0.003 WHEN q < 23.252 * pow(0.193, 2.706) THEN 0.095 ELSE pow(q / 23.252, 1 / 2.706) - 0.098 END, 6) AS stage FROM q""")
def unrate(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "events").select("event_id", (F.col("value") / 10.0 - 2.0).alias("flow"), F.lit(1).alias("curve"))
    return rating.unrate(q, rating.limb_table(_limbs(spark), ["curve"]), ["curve"]).select("event_id", F.round("stage", 6).alias("stage"))


_CURVES = "(SELECT DISTINCT rating_id, site_id, version, limb_no, lower, upper, c, a, b FROM ratings)"


@query("rate_set", """WITH h AS (SELECT reading_id, site_id, CAST(timestamp AS DATE) AS day, CASE WHEN isnan(value) THEN NULL ELSE value END AS h FROM silver WHERE data_type = 'H'),
v AS (SELECT DISTINCT site_id, rating_id, version, TRY_CAST(valid_from AS DATE) AS lo, CASE WHEN valid_to IS NULL THEN DATE '9999-12-31' ELSE TRY_CAST(valid_to AS DATE) END AS hi FROM ratings),
j AS (SELECT h.*, v.rating_id, row_number() OVER (PARTITION BY reading_id ORDER BY version DESC, rating_id DESC) AS k FROM h LEFT JOIN v ON h.site_id = v.site_id AND day BETWEEN lo AND hi)
SELECT reading_id, j.rating_id, round((SELECT CASE WHEN count(*) > 0 THEN greatest(arg_max(l.c * pow(greatest(j.h - l.a, 0), l.b), l.lower), 0) END FROM """ + _CURVES + """ l WHERE l.rating_id = j.rating_id AND l.lower <= j.h), 6) AS flow FROM j WHERE k = 1""")
def rate_set(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.rate_series(clean(table(spark, d, "silver").filter("data_type = 'H'")), table(spark, d, "ratings")).select("reading_id", "rating_id", F.round("flow", 6).alias("flow"))


@query("limb_continuity", f"""WITH w AS (SELECT *, lead(c) OVER x AS nc, lead(a) OVER x AS na, lead(b) OVER x AS nb FROM {_CURVES} WINDOW x AS (PARTITION BY rating_id ORDER BY limb_no)),
j AS (SELECT *, c * pow(greatest(upper - a, 0), b) AS ql, nc * pow(greatest(upper - na, 0), nb) AS qu FROM w WHERE nc IS NOT NULL)
SELECT rating_id, limb_no, upper AS junction, round(ql, 6) AS q_lower, round(qu, 6) AS q_upper, round(qu - ql, 6) AS gap, round(CASE WHEN ql > 0 THEN 100 * abs(qu - ql) / ql END, 4) AS gap_pct, coalesce(100 * abs(qu - ql) / CASE WHEN ql > 0 THEN ql END <= 1, false) AS connected FROM j""")
def limb_continuity(spark: SparkSession, d: str) -> DataFrame:
    limbs = table(spark, d, "ratings").select("rating_id", "site_id", "version", "limb_no", "lower", "upper", "c", "a", "b").distinct()
    out = rating.limb_continuity(limbs, ["rating_id"])
    return out.select("rating_id", "limb_no", "junction", *[F.round(x, 6).alias(x) for x in ("q_lower", "q_upper", "gap")], F.round("gap_pct", 4).alias("gap_pct"), "connected")


@query("fix_continuity", f"""WITH RECURSIVE l AS (SELECT *, row_number() OVER (PARTITION BY rating_id ORDER BY limb_no, lower) AS k FROM {_CURVES}),
f AS (SELECT rating_id, k, limb_no, upper, c, a, b FROM l WHERE k = 1 UNION ALL
SELECT l.rating_id, l.k, l.limb_no, l.upper, CASE WHEN f.c * pow(greatest(f.upper - f.a, 0), f.b) > 0 AND pow(greatest(l.lower - l.a, 0), l.b) > 0 THEN f.c * pow(greatest(f.upper - f.a, 0), f.b) / pow(greatest(l.lower - l.a, 0), l.b) ELSE l.c END, l.a, l.b
FROM f JOIN l ON l.rating_id = f.rating_id AND l.k = f.k + 1) SELECT rating_id, limb_no, round(c, 6) AS c FROM f""")
def fix_continuity(spark: SparkSession, d: str) -> DataFrame:
    limbs = table(spark, d, "ratings").select("rating_id", "limb_no", "lower", "upper", "c", "a", "b").distinct()
    return rating.fix_continuity(limbs, ["rating_id"]).select("rating_id", "limb_no", F.round("c", 6).alias("c"))


@query("rating_next_version", "SELECT site_id, tier, CAST(coalesce(max(version), 0) + 1 AS INTEGER) AS next_version FROM rating_register GROUP BY 1, 2")
def rating_next_version(spark: SparkSession, d: str) -> DataFrame:
    return rating.next_version(table(spark, d, "rating_register"))


@query("rating_save", """WITH n AS (SELECT DISTINCT site_id, 'gold' AS tier FROM rating_register WHERE site_id IS NOT NULL), v AS (SELECT site_id, tier, max(version) AS m FROM rating_register GROUP BY 1, 2)
SELECT r.site_id, r.tier, r.version, CASE WHEN r.tier = 'gold' AND r.status = 'Active' AND r.site_id IS NOT NULL THEN 'Superseded' ELSE r.status END AS status, r.rating_id FROM rating_register r
UNION ALL SELECT n.site_id, n.tier, CAST(coalesce(m, 0) + 1 AS INTEGER), 'Active', n.site_id || '_RATING_gold_v' || CAST(coalesce(m, 0) + 1 AS VARCHAR) FROM n LEFT JOIN v USING (site_id, tier)""")
def rating_save(spark: SparkSession, d: str) -> DataFrame:
    reg = table(spark, d, "rating_register").select("site_id", "tier", "version", "status", "rating_id")
    new = reg.filter("site_id is not null").select("site_id").distinct().withColumn("tier", F.lit("gold"))
    return rating.supersede(reg, new)


@query("rating_list", "SELECT rating_id, site_id, tier, status, version, valid_from, valid_to, n_limbs FROM rating_register WHERE tier = 'gold' AND status = 'Active'")
def rating_list(spark: SparkSession, d: str) -> DataFrame:
    return catalogue.only(table(spark, d, "rating_register"), tier=["gold"], status=["Active"]).select("rating_id", "site_id", "tier", "status", "version", "valid_from", "valid_to", "n_limbs")


# evaporation and volumes

_DAY = "(SELECT CAST(o_orderdate AS DATE) AS day, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) / 1e6 AS v FROM orders GROUP BY 1)"


def _daily(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg((F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / 1e6).alias("v"))


_W = "(2 * pi() / 365.25)"


@query("pe_fit", f"""WITH x AS (SELECT v AS y, sin({_W} * dayofyear(day)) AS s, cos({_W} * dayofyear(day)) AS c FROM {_DAY}),
m AS (SELECT count(*) AS n, avg(y) AS my, avg(s) AS ms, avg(c) AS mc, covar_pop(s, s) AS ss, covar_pop(c, c) AS cc, covar_pop(s, c) AS sc, covar_pop(s, y) AS sy, covar_pop(c, y) AS cy FROM x),
p AS (SELECT *, (sy * cc - cy * sc) / (ss * cc - sc * sc) AS c1, (cy * ss - sy * sc) / (ss * cc - sc * sc) AS c2 FROM m)
SELECT round(my - c1 * ms - c2 * mc, 6) AS B, round(sqrt(c1 * c1 + c2 * c2), 6) AS A, round(((atan2(-c2, c1) / {_W}) % 365.25 + 365.25) % 365.25, 4) AS phi, n FROM p""")
def pe_fit(spark: SparkSession, d: str) -> DataFrame:
    out = pe.fit_sine(_daily(spark, d).withColumn("k", F.lit(1)), ["k"], "day", "v")
    return out.select(F.round("B", 6).alias("B"), F.round("A", 6).alias("A"), F.round("phi", 4).alias("phi"), "n")


@query("pe_generate", f"SELECT strftime(d, '%Y-%m-%d') AS date, round(greatest(0, 2.5 + 3.0 * sin({_W} * (dayofyear(d) - 172.0))), 8) AS pe FROM (SELECT unnest(generate_series(DATE '2020-01-01', DATE '2021-12-31', INTERVAL 1 DAY)) AS d)")
def pe_generate(spark: SparkSession, d: str) -> DataFrame:
    p = spark.createDataFrame([(2.5, 3.0, 172.0)], "B double, A double, phi double")
    return pe.generate_sine(p, "2020-01-01", "2021-12-31").select(F.col("date").cast("string").alias("date"), F.round("pe", 8).alias("pe"))


@query("pe_regionalise", f"""WITH p AS (SELECT c_custkey % 1000 / 500.0 + 1 AS B, c_custkey % 700 / 500.0 AS A, c_custkey % 365 + 0.0 AS phi, 1.0 + c_custkey % 3 AS w FROM customer)
SELECT round(sum(w * B) / sum(w), 6) AS B, round(sum(w * A) / sum(w), 6) AS A, round(((atan2(sum(w * sin({_W} * phi)), sum(w * cos({_W} * phi))) / {_W}) % 365.25 + 365.25) % 365.25, 3) AS phi FROM p""")
def pe_regionalise(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    p = table(spark, d, "customer").select((k % 1000 / 500.0 + 1).alias("B"), (k % 700 / 500.0).alias("A"), (k % 365 + 0.0).alias("phi"), (1.0 + k % 3).alias("w"))
    return pe.regionalise(p, "w").select(F.round("B", 6).alias("B"), F.round("A", 6).alias("A"), F.round("phi", 3).alias("phi"))


@query("pe_compare", f"""WITH e AS (SELECT v, greatest(0, 1.0 + 0.5 * sin({_W} * (dayofyear(day) - 100.0))) - v AS e FROM {_DAY})
SELECT round(avg(e), 6) AS bias, round(sqrt(avg(e * e)), 6) AS rmse, round(1 - avg(e * e) / var_pop(v), 4) AS r2 FROM e""")
def pe_compare(spark: SparkSession, d: str) -> DataFrame:
    x = _daily(spark, d).withColumns({"B": F.lit(1.0), "A": F.lit(0.5), "phi": F.lit(100.0), "k": F.lit(1)})
    return pe.compare_sine(x, ["k"], "day", "v").select(F.round("bias", 6).alias("bias"), F.round("rmse", 6).alias("rmse"), F.round("r2", 4).alias("r2"))


@query("disagg_daily", "WITH r AS (SELECT site_id, date_trunc('day', timestamp) AS day, sum(value) AS total FROM silver WHERE data_type = 'P' AND NOT isnan(value) GROUP BY 1, 2) SELECT site_id, CAST(day AS TIMESTAMP) + to_minutes(15 * i) AS timestamp, round(total / 96, 8) AS value FROM (SELECT *, unnest(range(96)) AS i FROM r)")
def disagg_daily(spark: SparkSession, d: str) -> DataFrame:
    """Daily rain of every gauge, spread evenly over its day."""
    s = table(spark, d, "silver").filter((F.col("data_type") == "P") & usable(F.col("value")))
    daily = s.groupBy("site_id", F.date_trunc("day", "timestamp").alias("timestamp")).agg(F.sum("value").alias("value"))
    daily = daily.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return pe.disaggregate(daily, "daily").select("site_id", "timestamp", F.round("value", 8).alias("value"))


@query("disagg_hourly", "SELECT reading_id, timestamp + to_minutes(15 * i) AS timestamp, value / 4 AS value FROM (SELECT *, unnest(range(4)) AS i FROM bronze WHERE period = 'hourly' AND NOT isnan(value))")
def disagg_hourly(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "bronze").filter((F.col("period") == "hourly") & usable(F.col("value"))).select("reading_id", "timestamp", "value")
    return pe.disaggregate(b, "hourly")


@query("cumsum", "SELECT reading_id, round(sum(coalesce(CASE WHEN isnan(value) THEN NULL ELSE value END, 0)) OVER (PARTITION BY site_id ORDER BY timestamp, reading_id ROWS UNBOUNDED PRECEDING), 4) AS total FROM silver WHERE data_type = 'P'")
def cumsum(spark: SparkSession, d: str) -> DataFrame:
    s = clean(table(spark, d, "silver").filter("data_type = 'P'"))
    return pe.add_cumulative(s, ["site_id"], ["timestamp", "reading_id"], {"total": "value"}).select("reading_id", F.round("total", 4).alias("total"))


@query("to_volume", "SELECT reading_id, data_type, CASE data_type WHEN 'Q' THEN value * 0.9 ELSE value * 12.5 END AS volume FROM silver WHERE data_type IN ('Q', 'P') AND NOT isnan(value)")
def to_volume(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    s = table(spark, d, "silver").filter(F.col("data_type").isin("Q", "P") & usable(v))
    return s.select("reading_id", "data_type", F.when(F.col("data_type") == "Q", pe.to_volume("flow", v, "15min")).otherwise(pe.to_volume("rainfall", v, "15min", area_km2=12.5)).alias("volume"))


@query("combine_series", "SELECT strftime(day, '%Y-%m-%d') AS day, round(sum(v), 4) AS v FROM (SELECT CAST(o_orderdate AS DATE) AS day, CAST(count(*) AS DOUBLE) AS v FROM orders GROUP BY 1 UNION ALL SELECT CAST(l_shipdate AS DATE), CAST(count(*) AS DOUBLE) FROM lineitem GROUP BY 1) GROUP BY 1")
def combine_series(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).cast("double").alias("v"))
    b = table(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count(F.lit(1)).cast("double").alias("v"))
    return pe.combine(a, b, at="day", value="v").select(F.col("day").cast("string").alias("day"), F.round("v", 4).alias("v"))


@query("double_mass", """WITH j AS (SELECT h.site_id, h.timestamp, h.value AS x, q.value AS y FROM silver h JOIN silver q ON h.site_id = q.site_id AND h.timestamp = q.timestamp AND h.data_type = 'P' AND q.data_type = 'Q')
SELECT site_id, timestamp, round(sum(coalesce(CASE WHEN isnan(x) THEN NULL ELSE x END, 0)) OVER w, 3) AS cum_x, round(sum(coalesce(CASE WHEN isnan(y) THEN NULL ELSE y END, 0)) OVER w, 3) AS cum_y FROM j WINDOW w AS (PARTITION BY site_id ORDER BY timestamp ROWS UNBOUNDED PRECEDING)""")
def double_mass(spark: SparkSession, d: str) -> DataFrame:
    s = clean(table(spark, d, "silver"))
    out = pe.double_mass(s.filter("data_type = 'P'"), s.filter("data_type = 'Q'"), ["site_id"])
    return out.select("site_id", "timestamp", F.round("cum_x", 3).alias("cum_x"), F.round("cum_y", 3).alias("cum_y"))


# exports


@query("pdm", "SELECT CAST(year(timestamp) AS INTEGER) AS year, CAST(month(timestamp) AS INTEGER) AS month, CAST(day(timestamp) AS INTEGER) AS day, CAST(hour(timestamp) AS INTEGER) AS hour, CAST(minute(timestamp) AS INTEGER) AS minute, CAST(second(timestamp) AS INTEGER) AS second, value AS flow FROM silver WHERE data_type = 'Q'")
def pdm(spark: SparkSession, d: str) -> DataFrame:
    return export.pdm(table(spark, d, "silver").filter("data_type = 'Q'"), "flow")


@query("fmp", "SELECT site_id, round((epoch_us(timestamp) - epoch_us(TIMESTAMP '2014-01-01')) / 3.6e9, 3) AS hours, coalesce(printf('%.3f', max(v) FILTER (WHERE data_type = 'Q')), '') AS Q, coalesce(printf('%.3f', max(v) FILTER (WHERE data_type = 'H')), '') AS H FROM (SELECT site_id, timestamp, data_type, round_even(CASE WHEN isnan(value) THEN NULL ELSE value END, 3) AS v FROM silver WHERE data_type IN ('Q', 'H')) GROUP BY site_id, timestamp")
def fmp(spark: SparkSession, d: str) -> DataFrame:
    s = clean(table(spark, d, "silver").filter(F.col("data_type").isin("Q", "H")))
    s = s.withColumn("value", F.bround("value", 3))
    return export.fmp_rows(s, ["Q", "H"], F.lit("2014-01-01 00:00:00").cast("timestamp_ntz"), key="data_type")


@query("read_silver", "SELECT reading_id, qc_value AS value FROM silver WHERE site_id = '100000' AND data_type = 'Q' AND timestamp >= TIMESTAMP '2014-01-01' AND qc_flag <= 2")
def read_silver(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.read_silver(table(spark, d, "silver"), ["100000"], "Q", start="2014-01-01", min_quality=2).select("reading_id", F.col("qc_value").alias("value"))


@query("stream_dedup", "SELECT DISTINCT site_id, data_type, timestamp FROM bronze WHERE received_at IS NOT NULL")
def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """The file stream of readings, each key once, run to its end."""
    return run_dedup(spark, d)


@query("detect_revisions", """WITH f AS (SELECT site_id, data_type, timestamp, arg_min(value, reading_id) AS was, arg_max(value, reading_id) AS now, count(*) AS n FROM (SELECT site_id, data_type, timestamp, reading_id, value FROM bronze WHERE value IS NOT NULL AND NOT isnan(value)) GROUP BY 1, 2, 3) SELECT site_id, data_type, timestamp, was, now FROM f WHERE n > 1 AND was IS DISTINCT FROM now""")
def detect_revisions(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "bronze").filter(usable(F.col("value")))
    g = b.groupBy(*KEYS, "timestamp").agg(F.min_by("value", "reading_id").alias("was"), F.max_by("value", "reading_id").alias("now"))
    return g.filter(~F.col("was").eqNullSafe(F.col("now")))


# typed columns, order, samples


@query("period_infer_all", _STEPS + ", m AS (SELECT site_id, data_type, quantile_cont(d, 0.5) AS m FROM d GROUP BY 1, 2) SELECT s.reading_id, CASE WHEN m.m IS NULL THEN '15min' WHEN m.m <= 900 THEN '15min' WHEN m.m <= 3600 THEN 'hourly' ELSE 'daily' END AS period FROM silver s LEFT JOIN m ON s.site_id = m.site_id AND s.data_type = m.data_type")
def period_infer_all(spark: SparkSession, d: str) -> DataFrame:
    """Every reading with the period of its series."""
    return gaps.with_period(table(spark, d, "silver"), KEYS).select("reading_id", "period")


@query("order_site_time", "SELECT reading_id, row_number() OVER (ORDER BY site_id NULLS FIRST, timestamp NULLS FIRST, reading_id) AS place FROM (SELECT * FROM silver WHERE data_type = 'Q')")
def order_site_time(spark: SparkSession, d: str) -> DataFrame:
    """Flow in order of gauge and time, with each row's place in it."""
    return catalogue.placed(table(spark, d, "silver").filter("data_type = 'Q'"), ["site_id", "timestamp", "reading_id"]).select("reading_id", "place")


@query("order_catalogue", "SELECT site_id, supplier_code, data_type, period, row_number() OVER (ORDER BY data_type NULLS FIRST, site_id NULLS FIRST, supplier_code NULLS FIRST, period NULLS FIRST) AS place FROM (SELECT DISTINCT site_id, split_part(dataset_id, '_', 1) AS supplier_code, data_type, period FROM bronze)")
def order_catalogue(spark: SparkSession, d: str) -> DataFrame:
    c = catalogue.gauge_catalogue(table(spark, d, "bronze"))
    return catalogue.placed(c, ["data_type", "site_id", "supplier_code", "period"]).select("site_id", "supplier_code", "data_type", "period", "place")


@query("sample_head", "SELECT reading_id, site_id, timestamp FROM bronze ORDER BY reading_id LIMIT 5")
def sample_head(spark: SparkSession, d: str) -> DataFrame:
    """The first five readings, as a listing shows them."""
    return catalogue.head(table(spark, d, "bronze"), ["reading_id"], 5).select("reading_id", "site_id", "timestamp")


@query("thin_points", "WITH n AS (SELECT reading_id, row_number() OVER (PARTITION BY site_id, data_type ORDER BY timestamp, reading_id) AS k, count(*) OVER (PARTITION BY site_id, data_type) AS n FROM silver WHERE site_id IS NOT NULL AND data_type IS NOT NULL) SELECT reading_id FROM n WHERE (k - 1) % CAST(greatest(1, ceil(n / 500.0)) AS BIGINT) = 0")
def thin_points(spark: SparkSession, d: str) -> DataFrame:
    """At most 500 points of every series, evenly spaced, for a plot."""
    return catalogue.thin(table(spark, d, "silver"), KEYS, ["timestamp", "reading_id"], 500).select("reading_id")


@query("left_pe", f"SELECT s.reading_id, round(greatest(0, 2.5 + 2.0 * sin({_W} * (dayofyear(s.timestamp) - 172.0))), 8) AS pe_daily, round((s.value - greatest(0, 2.5 + 2.0 * sin({_W} * (dayofyear(s.timestamp) - 172.0))) / 96) * 12.5, 6) AS volume FROM silver s WHERE data_type = 'P' AND NOT isnan(value)")
def left_pe(spark: SparkSession, d: str) -> DataFrame:
    """Rain with the daily evaporation of its day taken off, as a volume over 12.5 square kilometres."""
    s = table(spark, d, "silver").filter((F.col("data_type") == "P") & usable(F.col("value"))).select("reading_id", "timestamp", "value")
    days = s.select(F.to_date("timestamp").alias("date")).distinct()
    daily = days.select("date", pe.sine(F.col("date"), F.lit(2.5), F.lit(2.0), F.lit(172.0)).alias("pe"))
    x = pe.with_daily(s, daily)
    return x.select("reading_id", F.round("pe_daily", 8).alias("pe_daily"), F.round(pe.to_volume("rainfall", F.col("value"), "15min", area_km2=12.5, pe_daily=F.col("pe_daily")), 6).alias("volume"))


@query("rating_flatten", "SELECT DISTINCT rating_id, site_id, version, valid_from, valid_to, limb_no, lower, CASE WHEN isinf(upper) THEN NULL ELSE upper END AS upper, c, a, b FROM ratings WHERE rating_id IS NOT NULL")
def rating_flatten(spark: SparkSession, d: str) -> DataFrame:
    """Rating curves and back: limbs gathered into curves, then flattened to rows with open tops as NULL."""
    return rating.flatten_set(rating.load_set(table(spark, d, "ratings"))).select("rating_id", "site_id", "version", "valid_from", "valid_to", "limb_no", "lower", "upper", "c", "a", "b")


@query("rating_load", "WITH c AS (SELECT DISTINCT rating_id, site_id, version, valid_from, valid_to, limb_no, lower FROM ratings WHERE rating_id IS NOT NULL) SELECT rating_id, site_id, version, valid_from, valid_to, CAST(count(*) AS INTEGER) AS n_limbs, min(lower) AS lowest FROM c GROUP BY 1, 2, 3, 4, 5")
def rating_load(spark: SparkSession, d: str) -> DataFrame:
    """The stored ratings as curves."""
    return rating.load_set(table(spark, d, "ratings")).select("rating_id", "site_id", "version", "valid_from", "valid_to", F.size("limbs").alias("n_limbs"), F.get("limbs", F.lit(0))["lower"].alias("lowest"))


@query("value_column_infer", "SELECT DISTINCT line, CASE WHEN line ILIKE '%,value,%' THEN 'Value' END AS value_column, CASE WHEN line ILIKE '%,quality code,%' THEN 'Quality Code' END AS flag_column FROM wiski_all_lines WHERE line LIKE 'Time stamp,%'")
def value_column_infer(spark: SparkSession, d: str) -> DataFrame:
    """The value and the flag column that each header of an export names."""
    x = table(spark, d, "wiski_all_lines").filter(F.col("line").startswith("Time stamp,")).select("line").distinct()
    value, flag = allfile.infer_columns(F.split("line", ","))
    return x.select("line", value.alias("value_column"), flag.alias("flag_column"))
