import random

import pytest
from pyspark.sql import functions as F

from opinara.functions import lexicon
from opinara.operators import scoring
from opinara.plans.queries import python_models


def failing_factory():
    """Local, so that it travels to the workers by value."""

    class Failing:
        """Fails on batches that hold a certain text; answers 5 stars otherwise."""

        def predict(self, texts):
            if "bad" in texts:
                raise ValueError("bad text")
            return ["5 stars"] * len(texts)

    return lambda: Failing()


def broken_factory():
    def broken():
        raise OSError("no weights")

    return broken


def texts(spark, n=300):
    rng = random.Random(3)
    words = [*lexicon.UP, *lexicon.DOWN, "x", "THE", "long-word", ""]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(900)))) for i in range(n)]
    return spark.createDataFrame([*rows, (n, None), (n + 1, "")], "id int, comment_text string")


@pytest.mark.parametrize("window", [None, 512, 7])
def test_native_and_python_scorers_agree(spark, window):
    """In windows of any size, as the whole text counts."""
    df = scoring.score(texts(spark), [*scoring.BUILT_IN, *python_models(window)])
    for r in df.collect():
        a, b, c, d = (s.sentiment_label for s in r.scores)
        assert (a, b) == (c, d)
        assert not any(s.score_failed for s in r.scores)


def test_a_failed_batch_is_neutral_and_marked(spark):
    rows = [(i, "bad" if i == 11 else "fine") for i in range(40)]
    df = spark.createDataFrame(rows, "id int, comment_text string").coalesce(1)
    model = scoring.Model("failing-test", factory=failing_factory(), batch_size=8)
    out = scoring.by_model(scoring.score(df, [model]), {"failing-test": 3}).collect()
    hit = {r.id for r in out if r.score_failed}
    assert hit == set(range(8, 16))
    assert {r.sentiment_label for r in out if r.score_failed} == {"neutral"}
    assert {r.sentiment_label for r in out if not r.score_failed} == {"positive"}
    assert {r.model_id for r in out} == {3}


def miscounting_factory():
    class Miscounting:
        """One answer too many, then one too few."""

        def predict(self, texts):
            return ["5 stars"] * (len(texts) + (1 if "more" in texts else -1 if "less" in texts else 0))

    return lambda: Miscounting()


def test_a_wrong_number_of_answers_is_a_failure(spark):
    rows = [(i, {3: "more", 12: "less"}.get(i, "fine")) for i in range(24)]
    df = spark.createDataFrame(rows, "id int, comment_text string").coalesce(1)
    model = scoring.Model("miscounting", factory=miscounting_factory(), batch_size=8)
    out = scoring.by_model(scoring.score(df, [model])).collect()
    assert {r.id for r in out if r.score_failed} == set(range(16))
    assert {r.sentiment_label for r in out if r.id >= 16} == {"positive"}


def test_models_of_one_name_do_not_share_a_scorer():
    one, other = (scoring.Model("same", factory=f) for f in (lexicon.three_class_scorer, lexicon.five_star_scorer))
    assert scoring.scorer_of(one).vocabulary != scoring.scorer_of(other).vocabulary
    made = [lambda n=n: lexicon.WordListScorer(n) for n in ("three_class", "five_star")]
    assert [scoring.scorer_of(scoring.Model("x", factory=f)).vocabulary for f in made] == ["three_class", "five_star"]


def test_models_that_do_not_load_are_left_out(spark):
    bad = scoring.Model("broken-test", factory=broken_factory())
    assert scoring.loadable(spark, [bad, scoring.FIVE_STAR]) == [scoring.FIVE_STAR]
    with pytest.raises(RuntimeError):
        scoring.loadable(spark, [bad])


def test_copies_are_scored_once(spark):
    df = texts(spark, 20)
    copies = df.union(df.withColumn("id", F.col("id") + 100)).repartition(4)
    models = python_models()
    once = scoring.score_copies_once(copies, models, "id").select("id", "scores").collect()
    each = scoring.score(copies, models).select("id", "scores").collect()
    assert {r.id: r.scores for r in once} == {r.id: r.scores for r in each}


def test_backfill_native_and_python_agree(spark):
    rows = [("a", "the and"), ("b", ""), ("c", None), ("d", "of to"), ("e", "of to")]
    df = spark.createDataFrame(rows, "video_id string, video_title string").withColumn(
        "video_title_sentiment", F.when(F.col("video_id") == "e", "positive")
    )
    expected = {"a": "positive", "b": "neutral", "c": "neutral", "d": "negative", "e": "positive"}
    for model in (scoring.THREE_CLASS, python_models()[0]):
        out = scoring.backfill_titles(df, model).collect()
        assert {r.video_id: r.video_title_sentiment for r in out} == expected


def test_texts_are_scored_in_one_place(spark, plan):
    df = scoring.by_model(scoring.score(texts(spark), scoring.BUILT_IN))
    text = plan(df)
    assert text.count("aggregate(split(") == 1
    assert "Python" not in text


def test_python_models_get_small_batches_of_texts(spark):
    """Of a batch from Arrow only the texts of one call are Python objects, and a batch holds few bytes."""
    import pyarrow as pa

    sizes = []

    class Scorer:
        def predict(self, texts):
            sizes.append((type(texts), len(texts)))
            return ["positive"] * len(texts)

    model = scoring.Model("counting", factory=Scorer, batch_size=4)
    assert scoring.predict_batches(model, pa.array(["x"] * 10)) == (["positive"] * 10, [False] * 10)
    assert sizes == [(list, 4), (list, 4), (list, 2)]
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "8m"
