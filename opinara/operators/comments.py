"""Comments: preparation, incremental cut, newest per video, scoring by model, merge by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import clean
from opinara.operators import keyed
from opinara.runtime import cut_lineage

NEVER = "1900-01-01 00:00:00"


def prepare(comments: DataFrame, *keep: str) -> DataFrame:
    """Typed comments from rows of any accepted layout; rows without id or readable time go."""
    label = clean.first_filled(comments, "mood", "sentiment_label")
    return (
        comments.select(
            "video_id",
            clean.first_filled(comments, "comment_id", "id").alias("comment_id"),
            clean.first_filled(comments, "text", "textDisplay", default="").alias("comment_text"),
            clean.like_count(F.col("likes")).alias("likes"),
            clean.time_column(comments, "published_at").alias("published_at"),
            clean.edited(comments).alias("is_edited"),
            label.alias("sentiment_label"),
            *keep,
        )
        .where(F.col("comment_id").isNotNull())
        .where(F.col("published_at").isNotNull())
    )


def newest(comments: DataFrame, n: int, order: list[Column] | None = None) -> DataFrame:
    """A report: the ``n`` newest comments of every video, with their rank ``rn``."""
    if order is None:
        order = [F.desc_nulls_last("published_at"), F.asc("comment_id")]
    return keyed.top_per_key(comments, ["video_id"], order, n, "comment_id")


def newer_than_sync(
    comments: DataFrame, marks: DataFrame, how: str = "left", marks_rows: int | None = None
) -> DataFrame:
    """Comments strictly newer than their video's ``last_sync_date`` in ``marks``.

    With ``how="inner"`` only videos listed in ``marks`` count.
    """
    marked = keyed.lookup(comments, marks, "video_id", "comment_id", how, marks_rows)
    mark = F.coalesce("last_sync_date", F.lit(NEVER).cast("timestamp"))
    return marked.where(F.col("published_at") > mark).drop("last_sync_date")


def last_sync(video_stats: DataFrame) -> DataFrame:
    """High-water mark per video, over all models."""
    return video_stats.groupBy("video_id").agg(F.max("last_sync_date").alias("last_sync_date"))


def drop_redelivered(comments: DataFrame, order: list[str]) -> DataFrame:
    """One row per comment id within a batch: the last one by ``order``, equal ones settled by all
    columns."""
    rest = [c for c in comments.columns if c not in ("comment_id", *order)]
    last = F.max(F.struct(*order, *rest)).alias("row")
    rows = comments.groupBy("comment_id").agg(last).select("comment_id", "row.*")
    return rows.select("comment_id", *[c for c in comments.columns if c != "comment_id"])


def merge(versions: DataFrame, order: str = "batch_id") -> DataFrame:
    """Current comments from all stored versions, key (comment_id, model_id).

    Text, likes and label are those of the last version; the time is the last known one; the video
    is that of the first. Rows without a model id never meet another row. Rows are dealt by comment before they are
    grouped: the rows of a comment's models stay beside each other, so the shuffle packs their equal texts, and no
    task sorts texts ahead of it.
    """
    latest = _latest(versions)
    alone = F.when(F.col("model_id").isNull(), F.monotonically_increasing_id())
    return (
        versions.withColumn("_alone", alone)
        .repartition("comment_id")
        .groupBy("comment_id", "model_id", "_alone")
        .agg(
            F.max(F.struct(order, *latest)).alias("row"),
            keyed.last_filled("published_at", order),
            F.min_by("video_id", F.struct(order, "video_id")).alias("video_id"),
        )
        .select("comment_id", "model_id", "video_id", "published_at", *[f"row.{c}" for c in latest])
    )


def _latest(versions: DataFrame) -> list[str]:
    """Columns of which the last version holds."""
    failed = ["score_failed"] if "score_failed" in versions.columns else []
    return ["comment_text", "likes", "sentiment_label", *failed]


def merge_stored(versions: DataFrame, order: str = "batch_id") -> DataFrame:
    """Like ``merge``, for stored versions of which few are of one key: only those are shuffled with their texts.

    Keys of several versions are counted over narrow rows; where they are too many to be broadcast, all rows are merged.
    """
    key = ["comment_id", "model_id"]
    parts = keyed.by_repetition(versions, key, versions.where(F.col("model_id").isNotNull()))
    if parts is None:
        return merge(versions, order)
    once, several = parts[0], merge(parts[1], order)
    return once.select(*several.columns).unionByName(several)


def each_once(comments: DataFrame, order: list[str], folder: str | None = None, reread: bool = False) -> DataFrame:
    """Like ``drop_redelivered``, for comments that can be read again at little cost and of which few come several
    times: only those are shuffled with their texts. What is written for it lies in ``folder``. An outcome that is
    ``reread`` is written where all texts were shuffled for it."""
    parts = keyed.by_repetition(comments, ["comment_id"], folder=folder)
    if parts is None:
        last = drop_redelivered(comments, order)
        return cut_lineage(last, folder and f"{folder}_last") if reread else last
    return parts[0].unionByName(drop_redelivered(parts[1], order))


def label_pivot(raw_comments: DataFrame, models: tuple[int, int] = (1, 2)) -> DataFrame:
    """One row per comment with the labels of two models side by side.

    Rows are dealt by comment before they are grouped, as in ``merge``.
    """
    picked = [
        F.max(F.when(F.col("model_id") == m, F.col("sentiment_label"))).alias(f"sentiment_model_{i}")
        for i, m in enumerate(models, start=1)
    ]
    return raw_comments.repartition("comment_id").groupBy("comment_id", "comment_text", "likes").agg(
        F.any_value("video_id").alias("video_id"), *picked
    )
