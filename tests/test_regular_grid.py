import datetime as dt
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weirstream.operators.regular_grid import empty_cells, regular_grid
from weirstream.plans import problems

SCHEMA = "site_id string, data_type string, timestamp timestamp, value double, period string, reading_id bigint, v string, day string, slot int"
T0 = dt.datetime(2024, 3, 1, 22, 0)


def frame(spark, rows):
    return spark.createDataFrame([(s, k, t, v, p, i, "clash", "clash", 1) for i, (s, k, t, v, p) in enumerate(rows)], SCHEMA)


def at(minutes, seconds=0):
    return T0 + dt.timedelta(minutes=minutes, seconds=seconds)


def grid(spark, rows, **kw):
    return {(r.site_id, r.data_type, r.slot_start_s): r for r in regular_grid(frame(spark, rows), **kw).collect()}


def s(minutes):
    return int((T0 + dt.timedelta(minutes=minutes) - dt.datetime(1970, 1, 1)).total_seconds())


def test_gaps_across_midnight_and_unusable_values(spark):
    rows = [("a", "Q", at(0), 1.0, "15min"), ("a", "Q", at(20), None, None), ("a", "Q", at(31), float("nan"), "15min"), ("a", "Q", at(180, 5), 3.0, "15min")]
    found = empty_cells(regular_grid(frame(spark, rows))).collect()
    assert len(found) == 11 and {f.slot_start for f in found} >= {"2024-03-01 22:15:00", "2024-03-02 00:45:00"}


def test_counter_with_reset_is_shared_by_overlap(spark):
    rows = [("a", "C", at(0), 100.0, "15min"), ("a", "C", at(10), 110.0, "15min"), ("a", "C", at(20), 130.0, "15min"), ("a", "C", at(30), 4.0, "15min")]
    g = grid(spark, rows, kind=F.lit("counter"))
    assert g["a", "C", s(0)].amount == pytest.approx(20.0)  # ten, and half of twenty
    assert g["a", "C", s(15)].amount == pytest.approx(14.0)  # the other half, and all since the reset
    assert g["a", "C", s(30)].resets == 1 and sum(r.amount or 0 for r in g.values()) == pytest.approx(34.0)


def test_cells_between_close_readings_are_filled_others_are_gaps(spark):
    rows = [("a", "Q", at(1), 2.0, "15min"), ("a", "Q", at(31), 4.0, "15min"), ("a", "Q", at(121), 4.0, "15min")]
    g = grid(spark, rows, max_gap=2)
    assert g["a", "Q", s(15)].status == "filled" and g["a", "Q", s(15)].value == pytest.approx(3.0)
    assert g["a", "Q", s(60)].status == "gap" and g["a", "Q", s(60)].value is None


def test_a_revision_counts_once_and_the_last_wins(spark):
    rows = [("a", "P", at(0), 1.0, "15min"), ("a", "P", at(0), 5.0, "15min"), ("a", "P", at(0), 5.0, "15min")]
    g = grid(spark, rows)
    assert [(r.n_readings, r.amount) for r in g.values()] == [(1, 5.0)]


def test_null_keys_times_periods_and_empty_table(spark):
    rows = [(None, "Q", at(0), 1.0, "15min"), ("a", "Q", None, 1.0, "15min"), ("b", "Q", at(0), 1.0, None), ("b", "Q", at(60), 1.0, "weekly")]
    assert grid(spark, rows) == {}
    assert regular_grid(frame(spark, [])).count() == 0
    assert len(grid(spark, [("a", "Q", at(7), 1.0, " HOURLY ")])) == 1


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 4000), st.sampled_from([1.0, 0.0, None, float("nan")])), max_size=25))
def test_against_brute_force(spark, data):
    rows = [(k, "Q", at(m), v, "15min") for k, m, v in data]
    held = defaultdict(set)
    for k, m, v in data:
        if v is not None and v == v:
            held[k].add(s(m) // 900)
    want = {(k, i * 900) for k, x in held.items() for i in range(min(x), max(x) + 1) if i not in x}
    got = {(k[0], k[2]) for k, r in grid(spark, rows).items() if r.n_readings == 0}
    assert got == want


def test_the_grid_query_returns_every_cell_with_its_amount(spark, tmp_path):
    level = [(0, 1.0), (20, 3.0), (60, 5.0)]
    rows = [("a", k, at(m), v, "15min") for k in ("Q", "H") for m, v in level] + [("b", "P", at(m), v, "15min") for m, v in ((0, 1.0), (10, 2.0), (45, 6.0))]
    frame(spark, rows).write.parquet(str(tmp_path / "bronze.parquet"))
    got = {(r.site_id, r.data_type, r.slot_start[11:16]): (r.n_readings, r.amount, r.covered_s, r.value, r.status) for r in problems.p1_grid(spark, str(tmp_path)).collect()}
    want = {}
    for k in ("Q", "H"):  # the mean of two readings over the time between; the last reading comes too late to say what was before
        want |= {("a", k, "22:00"): (1, 1800.0, 900.0, 2.0, "observed"), ("a", k, "22:15"): (1, 600.0, 300.0, 2.0, "observed")}
        want |= {("a", k, "22:30"): (0, None, 0.0, None, "gap"), ("a", k, "22:45"): (0, None, 0.0, None, "gap"), ("a", k, "23:00"): (1, None, 0.0, 5.0, "observed")}
    want |= {("b", "P", "22:00"): (2, 3.0, 600.0, 3.0, "observed"), ("b", "P", "22:15"): (0, None, 0.0, None, "gap"), ("b", "P", "22:30"): (0, None, 0.0, None, "gap"), ("b", "P", "22:45"): (1, 6.0, 0.0, 6.0, "observed")}
    assert got == {k: (n, a if a is None else pytest.approx(a), c, v if v is None else pytest.approx(v), s) for k, (n, a, c, v, s) in want.items()}
