"""Per-video, per-model counters and what is derived from them."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.operators import keyed
from opinara.operators.comments import NEVER

COUNTERS = ["pos_count", "neg_count", "neu_count", "total_likes"]
TOTALS = {
    "total_positive": "pos_count",
    "total_negative": "neg_count",
    "total_neutral": "neu_count",
    "total_likes": "total_likes",
    "total_comments": "total_comments",
}


def video_mood(scored: DataFrame) -> DataFrame:
    """Counters of one batch per (video, model), with the time of the newest comment."""
    label = F.col("sentiment_label")
    return scored.groupBy("video_id", "model_id").agg(
        F.count_if(label == "positive").alias("pos_count"),
        F.count_if(label == "negative").alias("neg_count"),
        F.count_if(label == "neutral").alias("neu_count"),
        F.sum(F.col("likes").cast("bigint")).alias("total_likes"),
        F.coalesce(F.max("published_at"), F.lit(NEVER).cast("timestamp")).alias("last_sync_date"),
    )


def corrected_mood(added: DataFrame, removed: DataFrame) -> DataFrame:
    """Counters of one batch as differences: ``added`` rows count for their label, ``removed`` ones against it."""
    columns = ["video_id", "model_id", "sentiment_label", "likes", "published_at", "sign"]
    plus = added.withColumn("sign", F.lit(1)).select(*columns)
    minus = removed.withColumns({"sign": F.lit(-1), "published_at": F.lit(None).cast("timestamp")}).select(*columns)

    def balance(label: str):
        return F.sum(F.when(F.col("sentiment_label") == label, F.col("sign")).otherwise(0))

    return plus.unionByName(minus).groupBy("video_id", "model_id").agg(
        balance("positive").alias("pos_count"),
        balance("negative").alias("neg_count"),
        balance("neutral").alias("neu_count"),
        F.sum(F.col("likes").cast("bigint") * F.col("sign")).alias("total_likes"),
        F.coalesce(F.max("published_at"), F.lit(NEVER).cast("timestamp")).alias("last_sync_date"),
    )


def batch_delta(
    processed: DataFrame,
    mood: DataFrame,
    model_ids: list[int],
    batch_id: int,
    as_of: datetime,
) -> DataFrame:
    """Delta rows for every processed video and model; nothing new adds zeros and keeps the mark, which
    never goes back.

    ``processed`` holds video_id, yt_count and the previous last_sync_date.
    """
    every = processed.select(
        "video_id",
        "yt_count",
        F.col("last_sync_date").alias("previous_sync"),
        F.explode(F.array(*[F.lit(m).cast("int") for m in model_ids])).alias("model_id"),
    )
    joined = every.join(mood, ["video_id", "model_id"], "left")
    return joined.select(
        "video_id",
        "model_id",
        F.lit(None).cast("string").alias("video_title_sentiment"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTERS],
        F.col("yt_count").cast("bigint").alias("total_comments"),
        F.greatest("last_sync_date", "previous_sync").alias("last_sync_date"),
        F.lit(as_of).cast("timestamp").alias("checked_at"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    )


def merge(deltas: DataFrame) -> DataFrame:
    """Current counters from all deltas: counts add, total and mark are those of the last batch."""
    return deltas.groupBy("video_id", "model_id").agg(
        keyed.last_filled("video_title_sentiment", "batch_id"),
        *[F.sum(c).alias(c) for c in COUNTERS],
        keyed.last("total_comments", "batch_id"),
        keyed.last("last_sync_date", "batch_id"),
        F.min("checked_at").alias("checked_at"),
    )


def latest(video_stats: DataFrame) -> DataFrame:
    """The newest statistics row per (model, video).

    A window of rank one would do the same after sorting every group; the aggregate combines on
    the map side. Equal times are settled by the remaining columns.
    """
    rest = [c for c in video_stats.columns if c not in ("model_id", "video_id", "checked_at")]
    return (
        video_stats.groupBy("model_id", "video_id")
        .agg(F.max(F.struct("checked_at", *rest)).alias("row"))
        .select("model_id", "video_id", "row.*")
    )


def global_totals(video_stats: DataFrame, models: DataFrame) -> DataFrame:
    """One row of totals per model in ``models``; a model without rows has zeros."""
    sums = (
        latest(video_stats)
        .groupBy("model_id")
        .agg(
            F.count("video_id").alias("total_videos"),
            *[F.sum(src).alias(name) for name, src in TOTALS.items()],
        )
    )
    names = ["total_videos", *TOTALS]
    return (
        models.select("model_id")
        .join(sums, "model_id", "left")
        .select(
            "model_id", *[F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n) for n in names]
        )
    )


def totals_after(previous: DataFrame, delta: DataFrame, before: DataFrame, models: DataFrame) -> DataFrame:
    """Totals per model from those of the batch before and one batch's delta.

    ``before`` holds the counters of the delta's videos ahead of it: a row that had none is a video not counted yet,
    and the platform's total replaces the one it had. Every model must stand in ``previous``.
    """
    old = before.select("video_id", "model_id", F.col("total_comments").alias("old_total"), F.lit(True).alias("seen"))
    change = (
        delta.join(old, ["video_id", "model_id"], "left")
        .groupBy("model_id")
        .agg(
            F.count_if(F.col("seen").isNull()).alias("total_videos"),
            *[F.sum(c).alias(name) for name, c in TOTALS.items() if name != "total_comments"],
            F.sum(F.coalesce("total_comments", F.lit(0)) - F.coalesce("old_total", F.lit(0))).alias("total_comments"),
        )
    )
    names = ["total_videos", *TOTALS]
    changes = change.select("model_id", *[F.col(n).alias(f"_{n}") for n in names])
    return (
        models.select("model_id")
        .join(previous, "model_id")
        .join(changes, "model_id", "left")
        .select("model_id", *[(F.col(n) + F.coalesce(f"_{n}", F.lit(0))).cast("bigint").alias(n) for n in names])
    )


def for_model(video_stats: DataFrame, model_id: int) -> DataFrame:
    return video_stats.where(F.col("model_id") == model_id)


def top_rows(video_stats: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` statistics rows with most likes, then most comments.

    A video counted by two models takes two of the rows, which is the meaning of the report.
    """
    return video_stats.orderBy(
        F.desc("total_likes"), F.desc("total_comments"), F.asc("video_id"), F.asc("model_id")
    ).limit(n)


def comments_of_top(raw_comments: DataFrame, video_stats: DataFrame, n: int = 50) -> DataFrame:
    """Comments of the videos among the top rows; the list has at most ``n`` entries."""
    top = top_rows(video_stats, n).select("video_id").distinct()
    if n <= keyed.BROADCAST_ROWS:
        top = F.broadcast(top)
    return raw_comments.join(top, "video_id", "left_semi")


# Longer lists reach a Parquet scan only as their lowest and highest value.
PUSHED_VALUES = 10


def comments_of_listed(raw_comments: DataFrame, video_ids: list[str]) -> DataFrame:
    """Comments of a short list of videos, as a filter that reaches the scan: files and row groups
    without any of them are skipped where the table is laid out by video.
    """
    parts = [video_ids[i : i + PUSHED_VALUES] for i in range(0, len(video_ids), PUSHED_VALUES)]
    listed = [F.col("video_id").isin(part) for part in parts]
    return raw_comments.where(reduce(or_, listed, F.lit(False)))
