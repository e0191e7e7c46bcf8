import random

import pytest
from pyspark.sql import functions as F

from opinara.operators import sampling, selection


@pytest.mark.parametrize("n", [0, 1, 37, 500, 999, 1000, 5000])
def test_ranges_give_what_a_sorted_limit_gives(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([None, 1, 1, 1, 2, 3]), f"v{i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, v string").repartition(5)
    order = [F.desc_nulls_last("k"), F.asc("v")]
    want = sorted(rows, key=lambda r: (-(r[0] or 0), r[1]))[:n]
    for bound in (0, 10_000):
        out = selection.first_rows(df, order, n, one_task=bound)
        assert out.columns == ["k", "v"]
        assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)


def test_empty(spark):
    df = spark.createDataFrame([], "k int")
    assert selection.first_rows(df, [F.asc("k")], 5, one_task=0).count() == 0


def test_whole_ranges_are_not_put_in_order(spark, plan, tmp_path):
    df = spark.range(10_000).repartition(6)
    out = selection.first_rows(df, [F.desc("id")], 9_000, one_task=0)
    assert plan(out).count("TakeOrderedAndProject") == 1 and "_range" in plan(out)
    assert {r["id"] for r in out.collect()} == set(range(1000, 10_000))


def test_preview_is_in_order(spark):
    rows = [(f"c{i}", f"s{i % 3}", i) for i in range(9)]
    sample = spark.createDataFrame(rows, "comment_id string, strata string, likes int")
    assert [r["comment_id"] for r in sampling.preview(sample, 4).collect()] == ["c0", "c3", "c6", "c1"]
