"""Plan-shape guards: the properties the operators rely on at scale."""

import datetime as dt
import os

import pytest

from rankforge.operators import (
    asc, best_per_key, consolidate_keys, desc, join_first_available, trailing_window_sum,
)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def no_bad_joins(p: str) -> bool:
    return ("BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
            and "BatchEvalPython" not in p and "ArrowEvalPython" not in p)


@pytest.fixture(scope="module")
def skewed(spark):
    # one key holds a third of the rows
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}", i, dt.date(2024, 1, 1 + i % 28), i % 7) for i in range(3000)]
    return spark.createDataFrame(rows, "k string, v long, d date, w int")


def test_top1_limits_before_the_shuffle(skewed):
    p = plan(best_per_key(skewed, ["k"], [desc("v"), asc("d")]))
    i_partial = p.find("WindowGroupLimit")
    assert "Partial" in p and i_partial >= 0
    # the partial limit sits below (is printed after) the exchange it feeds
    assert p.rfind("WindowGroupLimit") > p.find("Exchange hashpartitioning(k")


def test_hot_key_result_is_exact(skewed):
    r = best_per_key(skewed, ["k"], [desc("v"), asc("d")]).where("k = 'hot'").first()
    assert r.v == 2997


def test_trailing_window_is_hash_join_with_partial_sums(spark, skewed):
    anchors = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 14),)], "a date")
    p = plan(trailing_window_sum(skewed, anchors, "d", "a", ["k"], "v", days=7, out="s"))
    assert no_bad_joins(p) and any(j in p for j in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin")) and "partial_sum" in p


def test_consolidation_aggregates_partially(spark, skewed):
    p = plan(consolidate_keys([skewed.selectExpr("k as a", "cast(v as string) as b")], ["a", "b"]))
    assert "partial_max" in p


def test_first_available_join_is_an_equi_join(spark):
    left = spark.createDataFrame([(1, "a", None), (2, None, "u")], "id int, k1 string, k2 string")
    right = spark.createDataFrame([("a", "x", 10)], "r1 string, r2 string, val int")
    p = plan(join_first_available(left, right, [("k1", "r1"), ("k2", "r2")]))
    assert no_bad_joins(p)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test data not present")
def test_flagship_plan_has_no_nested_loops_or_python(spark):
    import __spark_entry__ as E

    p = plan(E.entry(spark))
    assert no_bad_joins(p)
