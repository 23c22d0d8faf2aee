import os
import random

import pytest

from weirstream.llm.encode import DEFAULT_VOCABULARY
from weirstream.llm.mixing import budgets, mix, read_targets, shares

pytestmark = pytest.mark.skipif(not os.path.exists(DEFAULT_VOCABULARY), reason="no vocabulary file here")
TARGETS = "source string, target_share double, max_repeats int"


def docs(spark, sizes):
    rnd = random.Random(4)
    rows = []
    for source, n in sizes.items():
        rows += [(len(rows) + i, source, "vote " * rnd.randint(1, 60), 9, 9) for i in range(n)]
    rows += [(90_001, "a", None, 9, 9), (90_002, "a", "", 9, 9), (90_003, None, "vote", 9, 9), (90_004, "unlisted", "vote", 9, 9)]
    return spark.createDataFrame(rows, "doc_id bigint, source string, text string, tokens int, rate int")


def test_shares_met_and_repeats_capped(spark):
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 4), ("c", 0.2, 2), ("none", 0.0, 3)], TARGETS)
    mixed = mix(docs(spark, {"a": 900, "b": 150, "c": 400}), targets)
    rows = mixed.collect()
    most = {"a": 1, "b": 4, "c": 2}
    assert all(1 <= r.copies <= most[r.source] for r in rows) and len({r.doc_id for r in rows}) == len(rows)
    assert not {90_001, 90_002, 90_003, 90_004} & {r.doc_id for r in rows}
    got = {r.source: r.actual_share for r in shares(mixed, targets).collect()}
    assert got["a"] == pytest.approx(0.5, abs=0.005) and got["b"] == pytest.approx(0.3, abs=0.005) and got["c"] == pytest.approx(0.2, abs=0.005) and got["none"] == 0


def test_source_used_up_is_taken_whole(spark):
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 2)], TARGETS)
    rows = mix(docs(spark, {"a": 300, "b": 20}), targets).filter("source = 'b'").collect()
    assert len(rows) == 20 and {r.copies for r in rows} == {2}


def test_missing_source_empty_tables_and_limits(spark):
    targets = spark.createDataFrame([("a", 1.0, 1), ("z", 1.0, 5)], TARGETS)
    assert mix(docs(spark, {"a": 30}), targets).count() == 30
    assert mix(docs(spark, {}).limit(0), targets).count() == 0
    assert mix(docs(spark, {"a": 3}), targets.limit(0)).count() == 0
    assert budgets({"a": (0.5, 1), "b": (0.5, 0)}, {"a": 10.0, "b": 10.0}) == {"a": 10.0}
    with pytest.raises(ValueError):
        read_targets(targets, most=1)
