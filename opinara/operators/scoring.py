"""Sentiment labels for a text column by any number of models in one pass."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.functions import lexicon
from opinara.functions.labels import normalize_label
from opinara.operators import keyed
from opinara.runtime import cut_lineage


class Scorer(Protocol):
    """A loaded model: texts in, raw labels out, one for each text.

    A model with a limited input also has ``weigh``, a number for each text that adds up over the
    parts of a text, and ``label_of``, the label of such a sum.
    """

    def predict(self, texts: Sequence[str]) -> list[str]: ...


@dataclass(frozen=True)
class Model:
    """Either native (``feature`` and ``label`` expressions) or Python (``factory``).

    ``window`` is the input limit of a Python model in blank-separated tokens: a longer text is
    weighed in consecutive windows of that size, and their sum gives its label. No text is cut short.

    ``version`` tells kept scores of other weights apart.
    """

    name: str
    feature: Callable[[Column], Column] | None = None
    label: Callable[[Column], Column] | None = None
    factory: Callable[[], Scorer] | None = None
    window: int | None = None
    batch_size: int = 8
    version: str = "1"


THREE_CLASS = Model("three-class", feature=lexicon.balance, label=lexicon.three_class)
FIVE_STAR = Model("five-star", feature=lexicon.balance, label=lexicon.five_star)
BUILT_IN = (THREE_CLASS, FIVE_STAR)

_LOADED: dict[tuple, Scorer] = {}


def scorer_of(model: Model) -> Scorer:
    """The model object of this Python worker, built on first use. Models of one name and different
    origin do not share it."""
    made = model.factory
    key = (model.name, getattr(made, "__module__", ""), getattr(made, "__qualname__", repr(made)))
    if "<" in key[2]:
        key = (model.name, cloudpickle.dumps(made))
    if key not in _LOADED:
        _LOADED[key] = made()
    return _LOADED[key]


def windows(text: str, size: int) -> list[str]:
    """Consecutive parts of at most ``size`` blank-separated tokens; an empty text is one part."""
    tokens = text.split(" ")
    return [" ".join(tokens[i : i + size]) for i in range(0, len(tokens), size)]


def answers(model: Model, scorer: Scorer, texts: list[str]) -> list[str]:
    """One raw label per text; another number of answers is an error."""
    if model.window is None:
        labels = list(scorer.predict(texts))
    else:
        parts = [windows(t, model.window) for t in texts]
        weights = list(scorer.weigh([w for p in parts for w in p]))
        if len(weights) != sum(map(len, parts)):
            raise ValueError(f"{len(weights)} weights for {sum(map(len, parts))} windows")
        each = iter(weights)
        labels = [scorer.label_of(sum(next(each) for _ in p)) for p in parts]
    if len(labels) != len(texts):
        raise ValueError(f"{len(labels)} labels for {len(texts)} texts")
    return labels


def predict_batches(model: Model, texts: list[str] | pa.Array) -> tuple[list[str], list[bool]]:
    """Raw labels in batches; a batch that fails is neutral and marked as failed.

    Of an Arrow array, only the texts of one batch are Python objects at a time.
    """
    labels: list[str] = []
    failed: list[bool] = []
    scorer = scorer_of(model)
    for start in range(0, len(texts), model.batch_size):
        batch = texts[start : start + model.batch_size]
        batch = batch.to_pylist() if isinstance(batch, pa.Array) else batch
        try:
            labels += answers(model, scorer, batch)
            failed += [False] * len(batch)
        except Exception:
            labels += ["neutral"] * len(batch)
            failed += [True] * len(batch)
    return labels, failed


def score(df: DataFrame, models: Sequence[Model], text: str = "comment_text") -> DataFrame:
    """Add ``scores``: array of (model_name, sentiment_label, score_failed), in model order.

    Native models that share a feature compute it once. Python models get only the text column,
    in one Arrow pass for all of them.
    """
    df = df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    features = list(dict.fromkeys(m.feature for m in models if m.feature))
    df = df.select("*", *[f(F.col("_text")).alias(f"_f{i}") for i, f in enumerate(features)])
    python = [m for m in models if m.factory]
    if python:
        ship_package(df.sparkSession)
        df = df.withColumn("_python", _python_udf(python)(F.col("_text")))
    scores = []
    for m in models:
        if m.factory:
            i = python.index(m)
            raw, failed = F.col(f"_python.label{i}"), F.col(f"_python.failed{i}")
        else:
            raw = m.label(F.col(f"_f{features.index(m.feature)}"))
            failed = F.lit(False)
        scores.append(
            F.struct(
                F.lit(m.name).alias("model_name"),
                normalize_label(raw).alias("sentiment_label"),
                failed.alias("score_failed"),
            )
        )
    helpers = ["_text", "_python", *[f"_f{i}" for i in range(len(features))]]
    return df.withColumn("scores", F.array(*scores)).drop(*helpers)


def _python_udf(models: Sequence[Model]):
    fields = ", ".join(f"label{i} string, failed{i} boolean" for i in range(len(models)))

    @F.arrow_udf(fields)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            columns = {}
            for i, model in enumerate(models):
                labels, failed = predict_batches(model, texts)
                columns[f"label{i}"] = pa.array(labels, pa.string())
                columns[f"failed{i}"] = pa.array(failed, pa.bool_())
            yield pa.StructArray.from_arrays([*columns.values()], names=[*columns])

    return run


def score_copies_once(
    df: DataFrame, models: Sequence[Model], key: str, text: str = "comment_text"
) -> DataFrame:
    """Like ``score``, for expensive models over many equal texts: every distinct text is scored
    once and its scores are joined back. The join is salted, as one text may be most of the rows.
    """
    hashed = cut_lineage(df.withColumn("_hash", F.sha2(F.coalesce(F.col(text), F.lit("")), 256)))
    distinct = hashed.groupBy("_hash").agg(F.any_value(text).alias(text))
    scored = cut_lineage(score(distinct, models, text).select("_hash", "scores"))
    return keyed.lookup(hashed, scored, "_hash", key).drop("_hash")


def by_model(scored: DataFrame, model_ids: dict[str, int] | None = None) -> DataFrame:
    """One row per text and model; with ``model_ids`` the surrogate id is attached.

    The array is never empty. A plain explode would make Spark filter empty ones first, pushed below
    the scoring, and so score every text a second time for that filter.
    """
    rows = scored.withColumn("score", F.explode_outer("scores")).drop("scores")
    rows = rows.drop("sentiment_label").select("*", "score.*").drop("score")
    if model_ids is None:
        return rows
    known = F.create_map(*[F.lit(x) for pair in model_ids.items() for x in pair])
    return rows.withColumn("model_id", F.element_at(known, F.col("model_name")).cast("int"))


def title_label(title: Column, model: Model) -> Column:
    """Label of a title by a native model; an empty title is neutral."""
    raw = model.label(model.feature(title))
    return F.when(F.coalesce(title, F.lit("")) == "", "neutral").otherwise(normalize_label(raw))


def backfill_titles(video_info: DataFrame, model: Model) -> DataFrame:
    """Fill missing title labels; labels that exist stay."""
    missing = F.col("video_title_sentiment").isNull()
    if model.factory is None:
        label = title_label(F.col("video_title"), model)
        return video_info.withColumn(
            "video_title_sentiment", F.when(missing, label).otherwise(F.col("video_title_sentiment"))
        )
    filled = score(video_info.where(missing), [model], "video_title")
    label = F.when(F.coalesce("video_title", F.lit("")) == "", "neutral").otherwise(
        F.col("scores")[0]["sentiment_label"]
    )
    filled = filled.withColumn("video_title_sentiment", label).drop("scores")
    return video_info.where(~missing).unionByName(filled)


def loadable(spark: SparkSession, models: Sequence[Model]) -> list[Model]:
    """Models that can be built where they will run; the rest is left out, none left is an error."""
    python = [m for m in models if m.factory]
    good = {m.name for m in models if not m.factory}
    if python:
        ship_package(spark)

        def attempt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for _ in batches:
                names = []
                for model in python:
                    try:
                        scorer_of(model)
                        names.append(model.name)
                    except Exception:
                        pass
                yield pd.DataFrame({"name": names}, dtype="object")

        probe = spark.range(1).repartition(1).mapInPandas(attempt, "name string")
        good |= {row["name"] for row in probe.collect()}
    usable = [m for m in models if m.name in good]
    if not usable:
        raise RuntimeError("no sentiment model could be loaded")
    return usable


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application.

    The archive is made where the driver runs and handed to Spark, which serves it to the executors.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="opinara-ship-")) / package.name
        archive = shutil.make_archive(str(target), "zip", package.parent, package.name)
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)
