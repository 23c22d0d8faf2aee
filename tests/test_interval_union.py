import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from weirstream.operators.interval_union import continuous_periods

SCHEMA = "site_id string, valid_from string, valid_to string, mask int, word string, e int"


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, "clash", 2) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in continuous_periods(df).collect())


def test_overlap_touch_gap_and_open(spark):
    rows = [("a", "2020-01-01", "2020-01-10"), ("a", "2020-01-05", "2020-01-07"), ("a", "2020-01-11", "2020-02-01"), ("a", "2020-03-01", None), ("a", "2021-01-01", "2022-01-01")]
    assert run(spark, rows) == [("a", "gap", "2020-02-02", "2020-02-29"), ("a", "period", "2020-01-01", "2020-02-01"), ("a", "period", "2020-03-01", "open")]


def test_rows_that_take_no_part(spark):
    rows = [(None, "2020-01-01", None), ("a", None, "2020-01-01"), ("a", "2020-01-02", "2020-01-01"), ("a", "soon", None), ("a", "2020-01-01", "later"), ("b", "2020-01-01", "2020-01-01"), ("b", "2020-01-01", "2020-01-01")]
    assert run(spark, rows) == [("b", "period", "2020-01-01", "2020-01-01")]
    assert run(spark, []) == []


def test_whole_shards_and_dates_before_1970(spark):
    rows = [("a", "1900-01-01", "2099-12-31"), ("a", "2100-01-02", "2100-01-02")]
    assert run(spark, rows) == [("a", "gap", "2100-01-01", "2100-01-01"), ("a", "period", "1900-01-01", "2099-12-31"), ("a", "period", "2100-01-02", "2100-01-02")]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-40, 300), st.integers(0, 60), st.booleans()), max_size=12))
def test_against_day_sets(spark, data):
    day0 = dt.date(1970, 1, 1)
    text = lambda n: (day0 + dt.timedelta(days=n)).isoformat()
    rows = [("a", text(a), None if o and n > 50 else text(a + n)) for a, n, o in data]
    days, open_from = set(), None
    for a, n, o in data:
        if o and n > 50:
            open_from = a if open_from is None else min(open_from, a)
        else:
            days |= set(range(a, a + n + 1))
    if open_from is not None:
        days |= set(range(open_from, 500))
    want, prev = [], None
    for d in sorted(days):
        if d - 1 not in days:
            start = d
            if prev is not None:
                want.append(("a", "gap", text(prev + 1), text(d - 1)))
        if d + 1 not in days:
            want.append(("a", "period", text(start), "open" if d == 499 and open_from is not None else text(d)))
            prev = d
    assert run(spark, rows) == sorted(want)
