"""Models against human labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions.labels import recode_letter


def label_columns(columns: Sequence[str]) -> tuple[list[str], str]:
    """Columns whose name contains "sen", in order: the models, and last the human one."""
    found = [c for c in columns if "sen" in c]
    return found[:-1], found[-1]


def recode(gold: DataFrame, column: str = "human_sentiment") -> DataFrame:
    return gold.withColumn(column, recode_letter(F.col(column)))


def complete_rows(gold: DataFrame) -> DataFrame:
    """Rows without a NULL in any column; saved index columns have a dot in their name."""
    return gold.where(reduce(and_, [F.col(f"`{c}`").isNotNull() for c in gold.columns]))


def pair_counts(gold: DataFrame) -> DataFrame:
    """(model, human, predicted, n) for all models in one pass; every report starts from it."""
    models, human = label_columns(gold.columns)
    pairs = F.array(
        *[F.struct(F.lit(m).alias("model"), F.col(m).alias("predicted")) for m in models]
    )
    return (
        gold.select(F.col(human).alias("human"), F.explode_outer(pairs).alias("p"))
        .select("p.model", "human", "p.predicted")
        .groupBy("model", "human", "predicted")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def confusion_matrix(gold: DataFrame, labels: str = "all") -> DataFrame:
    """Dense matrix per model as (model, human, predicted, n).

    ``labels="all"``: axes hold every label of either column; ``"human"``: only human labels, rows
    with other predictions fall out. The axes come from the counted pairs, one row per label pair.
    """
    counts = pair_counts(gold)
    if labels == "all":
        seen = F.explode(F.array("human", "predicted"))
    else:
        seen = F.col("human")
    axis = counts.select("model", seen.alias("label")).distinct()
    axes = axis.groupBy("model").agg(F.collect_list("label").alias("labels"))
    cells = axes.select("model", F.explode("labels").alias("human"), "labels").select(
        "model", "human", F.explode("labels").alias("predicted")
    )
    return cells.join(counts, ["model", "human", "predicted"], "left").select(
        "model", "human", "predicted", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def wide_matrix(matrix: DataFrame) -> DataFrame:
    """A row per model and human label, a column per predicted label, both axes sorted.

    ``matrix`` is one of the long ones; its predicted labels, a handful, are read for the columns.
    """
    labels = sorted(r["predicted"] for r in matrix.select("predicted").distinct().collect())
    cells = [F.sum(F.when(F.col("predicted") == x, F.col("n"))).alias(x) for x in labels]
    return matrix.groupBy("model", "human").agg(*cells).orderBy("model", "human")


def classification_report(gold: DataFrame) -> DataFrame:
    """Per model: precision, recall, F1 and support of each class, accuracy, macro and weighted
    averages. A ratio over nothing is 0. Accuracy stands in the F1 column, as printed reports
    have it.
    """
    hit = F.when(F.col("human") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(
            F.col("human").alias("label"),
            F.col("n").alias("support"),
            F.lit(0).cast("bigint").alias("predicted"),
            hit.alias("hits"),
        ),
        F.struct(
            F.col("predicted").alias("label"),
            F.lit(0).cast("bigint").alias("support"),
            F.col("n").alias("predicted"),
            F.lit(0).cast("bigint").alias("hits"),
        ),
    )
    classes = (
        pair_counts(gold)
        .select("model", F.explode(sides).alias("s"))
        .select("model", "s.*")
        .groupBy("model", "label")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
        .select(
            "model",
            "label",
            _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
            _ratio(F.col("hits"), F.col("support")).alias("recall"),
            _ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1_score"),
            "support",
            "hits",
        )
    )
    totals = classes.groupBy("model").agg(
        _ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        F.sum("support").alias("support"),
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1_score")],
        *[
            _ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"weighted_{c}")
            for c in ("precision", "recall", "f1_score")
        ],
    )
    nothing = F.lit(None).cast("double")
    summary = F.array(
        F.struct(
            F.lit("accuracy").alias("label"),
            nothing.alias("precision"),
            nothing.alias("recall"),
            F.col("accuracy").alias("f1_score"),
        ),
        *[
            F.struct(
                F.lit(f"{kind} avg").alias("label"),
                F.col(f"{kind}_precision").alias("precision"),
                F.col(f"{kind}_recall").alias("recall"),
                F.col(f"{kind}_f1_score").alias("f1_score"),
            )
            for kind in ("macro", "weighted")
        ],
    )
    rows = totals.select("model", F.explode(summary).alias("s"), "support").select(
        "model", "s.*", "support"
    )
    return classes.drop("hits").unionByName(rows)


def _ratio(part, whole):
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def contradictions(gold: DataFrame) -> DataFrame:
    """Comments where both models agree and the human says the opposite, with their kind."""
    agree = F.col("sentiment_model_1") == F.col("sentiment_model_2")
    machine, human = F.col("sentiment_model_1"), F.col("human_sentiment")
    kind = F.when((machine == "positive") & (human == "negative"), "false_positive").when(
        (machine == "negative") & (human == "positive"), "false_negative"
    )
    return gold.where(agree).withColumn("kind", kind).where(F.col("kind").isNotNull())


def false_positives(gold: DataFrame) -> DataFrame:
    return contradictions(gold).where(F.col("kind") == "false_positive").drop("kind")


def false_negatives(gold: DataFrame) -> DataFrame:
    return contradictions(gold).where(F.col("kind") == "false_negative").drop("kind")


def contradiction_counts(gold: DataFrame) -> DataFrame:
    """One row with both counts."""
    return contradictions(gold).agg(
        F.count_if(F.col("kind") == "false_positive").alias("false_positives"),
        F.count_if(F.col("kind") == "false_negative").alias("false_negatives"),
    )
