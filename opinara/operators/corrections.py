"""Late comments: those at or below the mark of their video, and what they change in counters already stored.

What has been counted is kept as narrow rows, one per comment and model: label, likes and a digest of the text. A late
comment that was never counted adds to the counters; one that comes again with another text or other likes takes its
old row back and adds the new one; one that comes again as it was changes nothing and is not scored. So counters stay
those of the stored comments as they were delivered last, in whatever order they land. A comment's video and time
are taken as fixed. Its text may be NULL, which is an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.operators import comments, keyed

KEY = ["video_id", "comment_id"]


def text_digest(text: str = "comment_text"):
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def counted(scored: DataFrame) -> DataFrame:
    """What is remembered of scored comments; rows without a model were never counted."""
    return scored.where(F.col("model_id").isNotNull()).select(
        *KEY,
        "model_id",
        "sentiment_label",
        F.coalesce("likes", F.lit(0)).cast("bigint").alias("likes"),
        text_digest().alias("text_digest"),
    )


def merge(versions: DataFrame, order: str = "batch_id") -> DataFrame:
    """What is counted now: the last row per comment and model."""
    row = ["sentiment_label", "likes", "text_digest"]
    return (
        versions.groupBy(*KEY, "model_id")
        .agg(F.max_by(F.struct(*row), F.struct(order, *row)).alias("row"))
        .select(*KEY, "model_id", "row.*")
    )


def with_lateness(ready: DataFrame, marks: DataFrame, marks_rows: int | None = None) -> DataFrame:
    """Prepared comments with ``late``, whether they are at or below their video's mark."""
    marked = keyed.lookup(ready, marks, "video_id", "comment_id", "left", marks_rows)
    mark = F.coalesce("last_sync_date", F.lit(comments.NEVER).cast("timestamp"))
    return marked.withColumn("late", F.col("published_at") <= mark).drop("last_sync_date")


def changes(late: DataFrame, known: DataFrame, model_ids: Sequence[int]) -> DataFrame:
    """Late comments of which some model has not counted this very text with these likes.

    The join is by comment, so a video with most of the comments is spread like any other.
    """
    settled = (
        known.where(F.col("model_id").isin(*model_ids))
        .groupBy(*KEY, F.col("likes").alias("_likes"), F.col("text_digest").alias("_digest"))
        .agg(F.count(F.lit(1)).alias("_models"))
        .where(F.col("_models") == len(set(model_ids)))
        .drop("_models")
    )
    compared = late.withColumn("_likes", F.coalesce("likes", F.lit(0)).cast("bigint"))
    compared = compared.withColumn("_digest", text_digest())
    return compared.join(settled, [*KEY, "_likes", "_digest"], "left_anti").select(*late.columns)


def taken_back(changed: DataFrame, known: DataFrame, model_ids: Sequence[int]) -> DataFrame:
    """Counted rows that the changed comments replace."""
    of_models = known.where(F.col("model_id").isin(*model_ids))
    return of_models.join(changed.select(*KEY).distinct(), KEY, "left_semi")
