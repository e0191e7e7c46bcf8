from datetime import datetime

from opinara.operators import stats

DELTA = (
    "batch_id long, video_id string, model_id int, video_title_sentiment string, pos_count long, "
    "neg_count long, neu_count long, total_likes long, total_comments long, "
    "last_sync_date timestamp, checked_at timestamp"
)
D1, D2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def test_counts_add_and_the_rest_is_replaced(spark):
    rows = [
        (1, "v", 1, "neutral", 1, 2, 3, 10, 6, D1, D1),
        (2, "v", 1, None, 1, 0, 0, 5, 4, None, D2),
    ]
    r = stats.merge(spark.createDataFrame(rows, DELTA)).first()
    assert (r.pos_count, r.neg_count, r.neu_count, r.total_likes) == (2, 2, 3, 15)
    assert (r.total_comments, r.last_sync_date) == (4, None)
    assert (r.video_title_sentiment, r.checked_at) == ("neutral", D1)


def test_zero_delta_keeps_the_mark(spark):
    scored = spark.createDataFrame(
        [("a", 1, "positive", 3, D2), ("a", 1, "negative", 4, D1)],
        "video_id string, model_id int, sentiment_label string, likes int, published_at timestamp",
    )
    processed = spark.createDataFrame(
        [("a", 9, D1), ("b", 4, D1), ("c", 0, None)],
        "video_id string, yt_count long, last_sync_date timestamp",
    )
    delta = stats.batch_delta(processed, stats.video_mood(scored), [1, 2], 7, D2)
    out = {(r.video_id, r.model_id): r for r in delta.collect()}
    assert len(out) == 6
    a = out["a", 1]
    assert (a.pos_count, a.neg_count, a.total_likes, a.total_comments) == (1, 1, 7, 9)
    assert a.last_sync_date == D2 and out["a", 2].last_sync_date == D1
    b = out["b", 1]
    assert (b.pos_count, b.total_likes, b.total_comments, b.last_sync_date) == (0, 0, 4, D1)
    assert out["c", 1].last_sync_date is None


def test_latest_and_totals(spark):
    rows = [
        (1, "a", 1, None, 1, 1, 1, 1, 3, D1, D1),
        (2, "a", 1, None, 5, 0, 0, 7, 5, D2, D2),
        (1, "b", 1, None, 1, 0, None, 2, 1, D1, D1),
    ]
    versions = spark.createDataFrame(rows, DELTA).drop("batch_id")
    assert {r.video_id: r.pos_count for r in stats.latest(versions).collect()} == {"a": 5, "b": 1}
    models = spark.createDataFrame([(1,), (2,)], "model_id int")
    out = {r.model_id: r for r in stats.global_totals(versions, models).collect()}
    one = out[1].asDict()
    assert one == {
        "model_id": 1, "total_videos": 2, "total_positive": 6, "total_negative": 0,
        "total_neutral": 0, "total_likes": 9, "total_comments": 6,
    }
    assert sum(v for k, v in out[2].asDict().items() if k != "model_id") == 0


def test_top_counts_rows_not_videos(spark):
    rows = [
        (1, v, m, None, 0, 0, 0, likes, 1, D1, D1)
        for v, likes in (("a", 9), ("b", 8), ("c", 7))
        for m in (1, 2)
    ]
    top = stats.top_rows(spark.createDataFrame(rows, DELTA), 3).collect()
    assert [(r.video_id, r.model_id) for r in top] == [("a", 1), ("a", 2), ("b", 1)]
