import hashlib
import random

import pytest
from pyspark.sql import functions as F

from opinara.operators import sampling

FRAME = (
    "video_id string, comment_id string, comment_text string, likes int, "
    "sentiment_model_1 string, sentiment_model_2 string"
)
LABELS = ["positive", "negative", "neutral"]


def frame(spark, n, seed=1, missing=0.0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        second = None if rng.random() < missing else rng.choice(LABELS)
        first = rng.choices(LABELS, [8, 1, 1])[0]
        rows.append((f"v{rng.randrange(3)}", f"c{i}", "t", rng.randrange(9), first, second))
    return rows, sampling.with_strata(spark.createDataFrame(rows, FRAME).repartition(5), videos=3)


def strata(spark, counts):
    return spark.createDataFrame(list(counts.items()), "strata string, n long")


def quotas(spark, counts, size):
    return {r.strata: r.quota for r in sampling.quotas(strata(spark, counts), size).collect()}


def test_quotas_add_up_and_stay_near_their_share(spark):
    rng = random.Random(9)
    for _ in range(8):
        counts = {f"s{i}": rng.randrange(2, 400) for i in range(rng.randrange(1, 20))}
        size = rng.randrange(1, sum(counts.values()) + 1)
        taken = quotas(spark, counts, size)
        assert sum(taken.values()) == size
        for s, n in counts.items():
            assert abs(taken[s] - n * size / sum(counts.values())) < 1
            assert taken[s] <= n


@pytest.mark.parametrize(
    ("counts", "size", "possible"),
    [
        ({"a": 10, "b": 10}, 5, True),
        ({"a": 10, "b": 1}, 5, False),
        ({"a": 10, "b": 10}, 20, False),
        ({"a": 2, "b": 2, "c": 2}, 2, False),
        ({"a": 2, "b": 2, "c": 2}, 4, False),
        ({"a": 2, "b": 2, "c": 2}, 3, True),
    ],
)
def test_when_a_sample_is_possible(spark, counts, size, possible):
    assert sampling.can_stratify(strata(spark, counts), size) is possible


def test_many_strata_are_no_obstacle(spark):
    counts = {f"s{i:04}": 2 + i % 3 for i in range(900)}
    taken = quotas(spark, counts, 1000)
    total = sum(counts.values())
    assert sum(taken.values()) == 1000 and set(taken) == set(counts)
    assert all(abs(taken[s] - n * 1000 / total) < 1 for s, n in counts.items())


def test_sample_matches_brute_force(spark):
    rows, df = frame(spark, 900, missing=0.1)
    strata = {r.comment_id: r.strata for r in df.collect()}
    groups = {}
    for c, s in strata.items():
        if s is not None:
            groups.setdefault(s, []).append(c)
    taken = quotas(spark, {s: len(c) for s, c in groups.items()}, 120)
    expected = set()
    for s, ids in groups.items():
        ids.sort(key=lambda c: hashlib.md5(f"42-{c}".encode()).hexdigest())
        expected |= set(ids[: taken[s]])
    out = sampling.stratified_sample(df, size=120).collect()
    assert len(out) == 120 and {r.comment_id for r in out} == expected


def test_bounds_leave_little_to_rank_and_never_change_the_sample(spark, monkeypatch):
    _, df = frame(spark, 4000, seed=8)
    take = sampling.quotas(sampling.strata_counts(df), 60)
    known = df.withColumn("_hash", F.md5(F.concat(F.lit("42-"), F.col("comment_id"))))
    likely = sampling._lowest_hashes(known, take, take.count())
    assert 60 < likely.count() < 1500
    usual = {r.comment_id for r in sampling.stratified_sample(df, size=60).collect()}
    # A bound that is missed by bad luck: everything is ranked.
    monkeypatch.setattr(sampling, "_lowest_hashes", lambda k, c, t: k.limit(0))
    assert {r.comment_id for r in sampling.stratified_sample(df, size=60).collect()} == usual


def test_strata_by_median_with_ties_and_even_counts(spark):
    rows = [("v", f"c{i}", "t", likes, "positive", "neutral") for i, likes in enumerate([1, 2, 3, 9])]
    rows += [("w", f"d{i}", "t", 4, "positive", None) for i in range(3)]
    out = sampling.with_strata(spark.createDataFrame(rows, FRAME)).collect()
    tops = {r.comment_id: r.pop_str for r in out}
    assert tops == {"c0": "Bottom", "c1": "Bottom", "c2": "Top", "c3": "Top",
                    "d0": "Top", "d1": "Top", "d2": "Top"}
    assert {r.strata for r in out if r.video_id == "w"} == {None}
    assert {r.strata for r in out if r.comment_id == "c3"} == {"positive_neutral_Top"}


def test_fallback_gives_the_whole_frame(spark):
    _, df = frame(spark, 50)
    assert sampling.stratified_sample(df, size=50).count() == 50
    lonely = df.limit(0).unionByName(
        spark.createDataFrame(
            [("v", f"c{i}", "t", 1, "positive", "positive" if i else "neutral", True, "Top",
              "a" if i else "b") for i in range(30)],
            df.schema,
        )
    )
    assert sampling.stratified_sample(lonely, size=10).count() == 30


def test_sheet_has_blank_columns(spark):
    _, df = frame(spark, 5)
    r = sampling.annotation_sheet(df).first()
    assert (r.human_sentiment, r.is_sarcasm) == ("", False)


def test_versions_of_top_videos_are_picked_by_a_broadcast(spark, plan, monkeypatch):
    from opinara.operators import comments as ops
    from opinara.plans import fixtures as fx

    sf, seen = "/root/testdata/sf0.001", []
    merge = ops.merge
    monkeypatch.setattr(ops, "merge", lambda df: (seen.append(plan(df)), merge(df))[1])
    versions = fx.raw_comments(spark, sf).withColumn("batch_id", F.lit(1))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        sampling.annotation_frame_of_versions(versions, fx.stats_now(spark, sf))
    finally:
        spark.conf.unset(threshold)
    assert "BroadcastHashJoin [comment_id" in seen[0]
