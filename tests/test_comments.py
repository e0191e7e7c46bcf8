import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from opinara.operators import comments, keyed

START = datetime(2024, 1, 1)


def test_prepare_drops_rows_without_id_or_time(spark):
    rows = [
        ("v", "c1", "hi", "3", "2024-01-01T00:00:00Z"),
        ("v", None, "no id", "3", "2024-01-01T00:00:00Z"),
        ("v", "c2", None, None, "2024-01-01 00:00:00"),
        ("v", "c3", "no time", "1", "soon"),
    ]
    df = spark.createDataFrame(
        rows, "video_id string, comment_id string, text string, likes string, published_at string"
    )
    out = comments.prepare(df).orderBy("comment_id").collect()
    assert [(r.comment_id, r.comment_text, r.likes, r.is_edited) for r in out] == [
        ("c1", "hi", 3, False),
        ("c2", "", 0, False),
    ]


def _hot(spark, n=2000):
    """A video with most of the rows, and many small ones."""
    rng = random.Random(5)
    rows = [
        ("hot" if i % 3 else f"v{i % 50}", f"c{i}", START + timedelta(minutes=rng.randrange(900)))
        for i in range(n)
    ]
    return rows, spark.createDataFrame(
        rows, "video_id string, comment_id string, published_at timestamp"
    ).repartition(6)


def test_newest_is_exact_on_a_hot_video(spark):
    rows, df = _hot(spark)
    expected = set()
    for video in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == video), key=lambda r: r[1])
        mine.sort(key=lambda r: r[2], reverse=True)
        expected |= {r[1] for r in mine[:30]}
    assert {r.comment_id for r in comments.newest(df, 30).collect()} == expected


def test_marks_cut_strictly_and_a_missing_mark_keeps_all(spark):
    rows, df = _hot(spark)
    marks = {"hot": START + timedelta(minutes=450), "v3": None}
    given = spark.createDataFrame(list(marks.items()), "video_id string, last_sync_date timestamp")
    expected = {r[1] for r in rows if marks.get(r[0]) is None or r[2] > marks[r[0]]}
    assert {r.comment_id for r in comments.newer_than_sync(df, given).collect()} == expected
    listed = {r[1] for r in rows if r[0] in marks and r[1] in expected}
    inner = comments.newer_than_sync(df, given, "inner", marks_rows=2)
    assert {r.comment_id for r in inner.collect()} == listed


def test_salted_and_broadcast_lookup_agree(spark, plan):
    _, df = _hot(spark)
    small = df.select("video_id").distinct().withColumn("x", F.length("video_id"))
    salted = keyed.lookup(df, small, "video_id", "comment_id")
    direct = keyed.lookup(df, small, "video_id", "comment_id", small_rows=51)
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, direct.collect()))
    assert "_salt" in plan(salted) and "BroadcastHashJoin" in plan(direct)


def test_a_hot_video_is_spread_where_nothing_may_be_broadcast(spark, plan):
    rows, df = _hot(spark, 6000)
    marks = df.groupBy("video_id").agg(F.min("published_at").alias("last_sync_date"))
    expected = sorted(r.comment_id for r in comments.newer_than_sync(df, marks).collect())
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        new = comments.newer_than_sync(df, marks)
        text = plan(new)
        assert "Broadcast" not in text and "SortMergeJoin [video_id" in text
        assert sorted(r.comment_id for r in new.collect()) == expected
    finally:
        spark.conf.unset(threshold)
    salted = df.where("video_id = 'hot'").groupBy(keyed.salt("comment_id")).count().collect()
    sizes = [r["count"] for r in salted]
    assert len(sizes) == keyed.SALTS and max(sizes) < 2 * sum(sizes) / keyed.SALTS


VERSION = (
    "batch_id long, comment_id string, model_id int, video_id string, comment_text string, "
    "likes int, published_at timestamp, sentiment_label string"
)


def test_merge_rules(spark):
    rows = [
        (1, "c", 1, "v", "old", 1, START, "positive"),
        (2, "c", 1, "other", "new", 0, None, None),
        (2, "c", 2, "v", "x", 2, None, "neutral"),
        (1, "c", None, "v", "legacy", 1, START, "positive"),
        (2, "c", None, "v", "legacy", 1, START, "positive"),
    ]
    out = comments.merge(spark.createDataFrame(rows, VERSION)).collect()
    merged = {r.model_id: r for r in out if r.model_id}
    assert merged[1].asDict() == {
        "comment_id": "c", "model_id": 1, "video_id": "v", "published_at": START,
        "comment_text": "new", "likes": 0, "sentiment_label": None,
    }
    assert merged[2].published_at is None
    assert sum(r.model_id is None for r in out) == 2


def test_redelivered_comment_keeps_its_last_row(spark):
    df = spark.createDataFrame(
        [("c", "old", 1, 0), ("c", "new", 2, 5), ("d", "only", 1, 1)],
        "comment_id string, text string, page int, position int",
    )
    out = comments.drop_redelivered(df, ["page", "position"]).collect()
    assert {(r.comment_id, r.text) for r in out} == {("c", "new"), ("d", "only")}


def test_pivot_splits_a_comment_whose_rows_differ(spark):
    rows = [
        ("a", "t", 1, "v", 1, "positive"), ("a", "t", 1, "v", 2, "negative"),
        ("b", "t", 1, "v", 1, "positive"), ("b", "t", 2, "v", 2, "negative"),
    ]
    df = spark.createDataFrame(
        rows,
        "comment_id string, comment_text string, likes int, video_id string, model_id int, "
        "sentiment_label string",
    )
    out = {
        (r.comment_id, r.likes, r.sentiment_model_1, r.sentiment_model_2)
        for r in comments.label_pivot(df).collect()
    }
    assert out == {
        ("a", 1, "positive", "negative"),
        ("b", 1, "positive", None),
        ("b", 2, None, "negative"),
    }


def _versions(spark):
    rows = [(1, f"c{i}", m, "v", f"t{i}", i, START, "positive") for i in range(40) for m in (1, 2)]
    rows += [(2, f"c{i}", 1, "w", f"later {i}", i, None, "negative") for i in range(3)]
    rows += [(n, "c0", None, "v", "legacy", 1, START, "positive") for n in (1, 2)]
    rows += [(n, None, 1, "v", f"no id {n}", 1, START, "positive") for n in (1, 2)]
    return spark.createDataFrame(rows, VERSION)


def test_merge_deals_rows_out_before_it_sorts_texts_and_carries_each_once(spark, plan):
    text = plan(comments.merge(_versions(spark)))
    assert text.count("Exchange") == 1 and "REPARTITION_BY_COL" in text
    assert "max_by(struct(comment_text" not in text
    pivot = plan(comments.label_pivot(_versions(spark)))
    assert pivot.count("Exchange") == 1 and "REPARTITION_BY_COL" in pivot


def test_stored_versions_of_one_key_alone_are_shuffled(spark, plan, monkeypatch):
    versions = _versions(spark)
    expected = sorted(map(repr, comments.merge(versions).collect()))
    stored = comments.merge_stored(versions)
    text = plan(stored)
    assert sorted(map(repr, stored.collect())) == expected
    assert "LeftAnti" in text and text.count("Exchange hashpartitioning") == 1
    monkeypatch.setattr(keyed, "BROADCAST_ROWS", 2)
    assert sorted(map(repr, comments.merge_stored(versions).collect())) == expected


def test_comments_that_come_once_are_not_shuffled(spark, plan, monkeypatch):
    rows = [(f"c{i}", f"t{i}", 1, 0) for i in range(30)] + [("c3", "again", 2, 5), ("c3", "early", 0, 9)]
    df = spark.createDataFrame(rows, "comment_id string, text string, page int, position int")
    order = ["page", "position"]
    expected = sorted(map(tuple, comments.drop_redelivered(df, order).collect()))
    once = comments.each_once(df, order)
    assert "LeftAnti" in plan(once) and plan(once).count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, once.collect())) == expected and once.columns == df.columns
    monkeypatch.setattr(keyed, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, comments.each_once(df, order).collect())) == expected


def test_an_outcome_that_is_reread_is_written_where_all_texts_were_shuffled(spark, tmp_path, monkeypatch):
    rows = [("c1", "old", 1), ("c1", "new", 2), ("c2", "one", 1)]
    df = spark.createDataFrame(rows, "comment_id string, text string, position int")
    few = comments.each_once(df, ["position"], str(tmp_path / "few"), reread=True)
    monkeypatch.setattr(keyed, "BROADCAST_ROWS", 0)
    many = comments.each_once(df, ["position"], str(tmp_path / "many"), reread=True)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect())) == rows[1:]
    assert (tmp_path / "many_last").exists() and not (tmp_path / "few_last").exists()
