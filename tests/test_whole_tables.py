import datetime as dt
from collections import Counter

import duckdb

from weirstream.plans import store_queries

T0 = dt.datetime(2022, 1, 1)
SILVER = "reading_id bigint, timestamp timestamp, value double, dataset_id string, site_id string, data_type string, qc_flag int, qc_value double, qc_y_code int, qc_h_code int, qc_p_code int"


def put(spark, tmp_path, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))


def both(spark, tmp_path, query, table):
    """Rows of the query and of its SQL, as counted tuples."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    df = store_queries.QUERIES[query](spark, str(tmp_path))
    sql = con.sql(f"SELECT {', '.join(df.columns)} FROM ({store_queries.SQL[query]})")
    naive = lambda x: x.replace(tzinfo=None) if isinstance(x, dt.datetime) else x
    return Counter(map(tuple, df.collect())), Counter(tuple(map(naive, r)) for r in sql.fetchall())


def test_silver_readings_of_all_gauges(spark, tmp_path):
    rows = [(i, T0 + dt.timedelta(minutes=15 * i) if i else None, 1.0 * i, "d", site, kind, 1, None if i % 2 else 1.0 * i, 0, None, 3) for i, (site, kind) in enumerate([("100000", "Q"), ("hot", "H"), ("hot", "P"), (None, "Q"), ("", "SM")])]
    put(spark, tmp_path, "silver", rows, SILVER)
    got, want = both(spark, tmp_path, "silver_readings", "silver")
    assert got == want and sum(got.values()) == len(rows)


BRONZE = "reading_id bigint, timestamp timestamp, value double, supplier_flag string, dataset_id string, site_id string, data_type string, period string"


def bronze(series):
    """Rows from (site, type, minutes, value), numbered in order."""
    return [(i, None if m is None else T0 + dt.timedelta(minutes=m), v, None, "d", site, kind, "15min") for i, (site, kind, m, v) in enumerate(series)]


def test_promotion_of_every_type_to_codes_and_flags(spark, tmp_path):
    wave = [2.0 + 0.01 * ((3 * i * i + 5 * i) % 13) for i in range(60)]
    q = [("a", "Q", 15 * i, -1.0 if i == 20 else 90.0 if i == 40 else v) for i, v in enumerate(wave)]
    h = [("a", "H", 15 * i, v + (1.0 if i == 30 else 0.5 if i > 45 else 0)) for i, v in enumerate(wave)]
    p = [("b", "P", 15 * i, 60.0 if i == 10 else -0.2 if i == 20 else 0.1 * (i % 4)) for i in range(60)]
    rest = [("a", "Q", 0, 2.5), ("a", "Q", 902, 2.02), ("a", "H", 902, float("nan")), ("b", "P", 902, None), ("b", "P", 7, 9.0), ("c", "SM", 4, -3.0), ("a", "H", None, 1.0)]
    put(spark, tmp_path, "bronze", bronze([*q, *h, *p, *rest]), BRONZE)
    got, want = both(spark, tmp_path, "promote", "bronze")
    assert got == want
    at = {r[0]: r for r in got}
    assert len(got) == sum(got.values()) == 184  # less a repeated key, a row whose grid time is held and one without time
    flag, value, y, h_code, p_code = slice(5, 6), 6, 7, 8, 9
    assert at[20][flag] == (4,) and at[20][value] is None and at[20][y] in (1, 9) and at[40][y] == 8  # negative flow; a spike by both checks
    assert at[90][flag] == (3,) and at[90][h_code] in (2, 3) and at[90][value] == h[30][3]  # a jump of stage is suspect, and kept
    assert at[130][p_code] == 5 and at[140][p_code] == 1 and at[140][flag] == (4,)  # rain that falls back, negative rain
    assert at[185][3:7] == (T0, True, 2, -3.0) and at[185][y:] == (None, None, None)  # a type without checks, snapped
    assert 0 not in at and 180 in at and 184 not in at and 186 not in at


def test_snapping_of_every_type(spark, tmp_path):
    rows = [("a", k, m, 1.0) for k in ("Q", "H", "P", "SM", None) for m in (0, 4, 20, 20, None)] + [(None, "Q", 8, None)]
    put(spark, tmp_path, "bronze", bronze(rows), BRONZE)
    got, want = both(spark, tmp_path, "snap_offgrid", "bronze")
    assert got == want
    first = T0 + dt.timedelta(minutes=15)
    assert got == Counter([x for i in range(0, 25, 5) for x in ((i, False, T0), (i + 3, True, first))] + [(25, True, first)])  # 8 minutes are nearer to 15
