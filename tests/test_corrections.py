import random
from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from opinara.operators import corrections, stats

START = datetime(2024, 1, 1)
ROW = (
    "video_id string, comment_id string, model_id int, comment_text string, likes long, "
    "sentiment_label string, published_at timestamp"
)


def scored(rows):
    """Both models' rows of comments (id, text, likes); the label follows from text and model."""
    labels = ["positive", "negative", "neutral"]
    return [
        ("hot" if i % 3 else "v", f"c{i}", m, text, likes, labels[(len(text or "") + m) % 3], START + timedelta(hours=i))
        for i, text, likes in rows
        for m in (1, 2)
    ]


def test_counters_follow_the_last_delivery_of_each_comment(spark):
    """Random batches of new, unchanged and changed comments, with empty, missing and long texts."""
    rng = random.Random(1)
    texts = ["", None, "a", "bb", "x" * 70_000]
    stored, account, total = {}, spark.createDataFrame([], ROW), Counter()
    account = corrections.counted(account)
    for _ in range(3):
        given = {i: (i, rng.choice(texts), rng.choice([None, 0, 5])) for i in rng.sample(range(12), 8)}
        rows = spark.createDataFrame(scored(given.values()), ROW)
        late = rows.where("model_id = 1").drop("model_id", "sentiment_label")
        changed = corrections.changes(late, account, [1, 2])
        ids = {r["comment_id"] for r in changed.collect()}

        def seen(row):
            return (row[1] or "", row[2] or 0)

        assert ids == {f"c{i}" for i, r in given.items() if i not in stored or seen(stored[i]) != seen(r)}
        added = rows.join(changed.select("comment_id"), "comment_id", "left_semi")
        removed = corrections.taken_back(changed, account, [1, 2])
        for r in stats.corrected_mood(added, removed).collect():
            for c in ("pos_count", "neg_count", "neu_count", "total_likes"):
                total[r["video_id"], r["model_id"], c] += r[c] or 0
        stored.update(given)
        both = account.withColumn("batch_id", F.lit(0)).unionByName(
            corrections.counted(added).withColumn("batch_id", F.lit(1))
        )
        account = spark.createDataFrame(corrections.merge(both).collect(), account.schema)
    truth = Counter()
    for video, _, model, _, likes, label, _ in scored(stored.values()):
        truth[video, model, f"{label[:3]}_count"] += 1
        truth[video, model, "total_likes"] += likes or 0
    assert +total == +truth


def test_a_model_that_never_counted_a_comment_is_a_change(spark):
    rows = spark.createDataFrame(scored([(1, "a", 1), (2, "b", 2)]), ROW)
    account = corrections.counted(rows.where("model_id = 1 or comment_id = 'c1'"))
    late = rows.where("model_id = 1").drop("model_id", "sentiment_label")
    assert [r["comment_id"] for r in corrections.changes(late, account, [1, 2]).collect()] == ["c2"]
    assert corrections.changes(late, account, [1]).isEmpty()
    assert corrections.changes(late, account.limit(0), [1]).count() == 2
    taken = corrections.taken_back(late.unionByName(late), account, [2])
    assert [(r["comment_id"], r["model_id"]) for r in taken.collect()] == [("c1", 2)]


def test_lateness_is_at_or_below_the_mark(spark):
    rows = spark.createDataFrame(
        [("v", "a", START), ("v", "b", START + timedelta(seconds=1)), ("w", "c", START)],
        "video_id string, comment_id string, published_at timestamp",
    )
    marks = spark.createDataFrame([("v", START)], "video_id string, last_sync_date timestamp")
    for bound in (None, 1):
        out = corrections.with_lateness(rows, marks, bound).collect()
        assert {r["comment_id"]: r["late"] for r in out} == {"a": True, "b": False, "c": False}
