import random

import pytest

from opinara.operators import evaluation

GOLD = (
    "comment_id string, sentiment_model_1 string, sentiment_model_2 string, human_sentiment string"
)


def gold(spark, n=400):
    rng = random.Random(4)
    first = ["positive", "negative", "neutral", "mixed"]
    rows = [
        (f"c{i}", rng.choice(first), rng.choice(first[:3]), rng.choice(first[:2] + [None]))
        for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, GOLD).repartition(3)


def test_label_columns():
    names = ["comment_id", "sentiment_model_1", "sentiment_model_2", "is_top", "human_sentiment",
             "is_sarcasm"]
    assert evaluation.label_columns(names) == (
        ["sentiment_model_1", "sentiment_model_2"],
        "human_sentiment",
    )


def test_matrices(spark):
    rows, df = gold(spark)
    full = evaluation.complete_rows(df)
    kept = [r for r in rows if r[3] is not None]
    assert full.count() == len(kept)
    for kind, axis in (
        ("all", {"positive", "negative", "neutral", "mixed"}),
        ("human", {"positive", "negative"}),
    ):
        out = evaluation.confusion_matrix(full, kind).where("model = 'sentiment_model_1'").collect()
        cells = {(r.human, r.predicted): r.n for r in out}
        assert set(cells) == {(a, b) for a in axis for b in axis}
        for (human, predicted), n in cells.items():
            assert n == sum(r[3] == human and r[1] == predicted for r in kept)
    total = evaluation.confusion_matrix(full).groupBy("model").sum("n").collect()
    assert {r["sum(n)"] for r in total} == {len(kept)}


def test_report(spark):
    rows, df = gold(spark)
    kept = [r for r in rows if r[3] is not None]
    out = evaluation.classification_report(evaluation.complete_rows(df)).collect()
    mine = {r.label: r for r in out if r.model == "sentiment_model_1"}
    scores = {}
    for label in ("positive", "negative", "neutral", "mixed"):
        hits = sum(r[1] == r[3] == label for r in kept)
        predicted, support = sum(r[1] == label for r in kept), sum(r[3] == label for r in kept)
        p, r_ = hits / predicted if predicted else 0, hits / support if support else 0
        f1 = 2 * p * r_ / (p + r_) if p + r_ else 0
        scores[label] = (p, r_, f1, support)
        assert mine[label][2:6] == pytest.approx(scores[label])
    accuracy = sum(r[1] == r[3] for r in kept) / len(kept)
    assert mine["accuracy"].f1_score == pytest.approx(accuracy)
    assert mine["macro avg"].f1_score == pytest.approx(sum(s[2] for s in scores.values()) / 4)
    assert mine["weighted avg"].precision == pytest.approx(
        sum(s[0] * s[3] for s in scores.values()) / len(kept)
    )


def test_contradictions(spark):
    rows, df = gold(spark)
    fp = {r[0] for r in rows if r[1] == r[2] == "positive" and r[3] == "negative"}
    fn = {r[0] for r in rows if r[1] == r[2] == "negative" and r[3] == "positive"}
    assert {r.comment_id for r in evaluation.false_positives(df).collect()} == fp
    assert {r.comment_id for r in evaluation.false_negatives(df).collect()} == fn
    assert tuple(evaluation.contradiction_counts(df).first()) == (len(fp), len(fn))
