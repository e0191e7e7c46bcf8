"""Videos and channels: who is watched, who is dropped, who is added."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import clean
from opinara.operators import keyed, selection

# Days a video is followed in full, and days until it is given up.
FULL_DAYS = 3
LAST_DAYS = 14


def active(video_info: DataFrame) -> DataFrame:
    return video_info.where(F.col("is_active") == 1)


def active_with_total(
    video_info: DataFrame, video_stats: DataFrame, fanout: bool = False
) -> DataFrame:
    """Active videos with their stored comment total, 0 when never synced.

    ``fanout`` gives one row per statistics row instead of one per video.
    """
    totals = video_stats.select("video_id", "total_comments")
    if not fanout:
        totals = totals.groupBy("video_id").agg(F.max("total_comments").alias("total_comments"))
    return (
        active(video_info)
        .join(totals, "video_id", "left")
        .select(
            "video_id",
            "date_publication",
            F.coalesce("total_comments", F.lit(0)).cast("bigint").alias("total_comments"),
        )
    )


def with_platform_count(videos: DataFrame, counts: DataFrame) -> DataFrame:
    return videos.join(counts, "video_id", "left")


def decide(active_videos: DataFrame, counts: DataFrame, as_of: datetime) -> DataFrame:
    """What to do with each active video, given the platform's comment counts."""
    return with_action(with_platform_count(active_videos, counts), as_of)


def with_action(videos: DataFrame, as_of: datetime) -> DataFrame:
    """``age_days`` and ``action`` from publication date, stored total and platform count; the first
    matching rule wins."""
    age = clean.age_days(F.lit(as_of).cast("timestamp"), F.col("date_publication"))
    grown = F.col("yt_count") > F.col("total_comments")
    action = (
        F.when(F.col("date_publication").isNull(), "skip_no_date")
        .when(F.col("age_days") > LAST_DAYS, "deactivate_old")
        .when(F.col("yt_count").isNull(), "skip_no_count")
        .when((F.col("age_days") > FULL_DAYS) & ~grown, "deactivate_quiet")
        .otherwise("fetch")
    )
    return videos.withColumn("age_days", age).withColumn("action", action)


def deactivate(video_info: DataFrame, video_ids: DataFrame) -> DataFrame:
    """``is_active`` = 0 for the listed videos."""
    return _where_listed(video_info, video_ids, "is_active", F.lit(0))


def stamp_checked(video_info: DataFrame, video_ids: DataFrame, as_of: datetime) -> DataFrame:
    """``last_checked_at`` = ``as_of`` for the listed videos."""
    return _where_listed(video_info, video_ids, "last_checked_at", F.lit(as_of).cast("timestamp"))


def _where_listed(
    video_info: DataFrame, video_ids: DataFrame, column: str, value: Column
) -> DataFrame:
    listed = video_ids.select("video_id").distinct().withColumn("_listed", F.lit(True))
    return (
        video_info.join(listed, "video_id", "left")
        .withColumn(column, F.when(F.col("_listed"), value).otherwise(F.col(column)))
        .drop("_listed")
    )


def disabled(pages: DataFrame) -> DataFrame:
    """Videos whose landed page says that comments are switched off."""
    return pages.where(F.col("comments_disabled")).select("video_id").distinct()


def free_slots(active_videos: DataFrame, limit: int) -> int:
    """How many videos may be added; one counted number comes back, no rows."""
    counted = active_videos.agg(F.count_distinct("video_id").alias("n")).first()["n"]
    return max(0, limit - counted)


def newest_found(found: DataFrame, slots: int, one_task: int = selection.ONE_TASK) -> DataFrame:
    """The newest discovered videos, as many as there are slots; each takes one, however often found. With more
    slots than ``one_task`` they are selected by ranges.

    They are selected by id and time; only rows that are among them go on with their titles. Up to ``one_task`` they
    come in order.
    """
    order = [F.desc_nulls_last("published_at"), F.asc("video_id")]
    latest = found.groupBy("video_id").agg(F.max("published_at").alias("published_at"))
    chosen = selection.first_rows(latest, order, slots, one_task).toDF("_video", "_at")
    if slots <= keyed.BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    same = [F.col("video_id").eqNullSafe(F.col("_video")), F.col("published_at").eqNullSafe(F.col("_at"))]
    rest = [c for c in found.columns if c not in ("video_id", "published_at")]
    newest = F.max(F.struct("published_at", *rest)).alias("row")
    once = found.join(chosen, same, "left_semi").groupBy("video_id").agg(newest)
    once = once.select("video_id", "row.*").select(*found.columns)
    return once.orderBy(*order) if slots <= one_task else once


def register(video_info: DataFrame, found: DataFrame, as_of: datetime) -> DataFrame:
    """Add discovered videos or refresh known ones; both come back as active."""
    old = video_info.withColumn("step", F.lit(0))
    new = found.select(
        "video_id",
        "channel_id",
        F.col("title").alias("video_title"),
        F.col("published_at").alias("date_publication"),
        F.lit(1).alias("is_active"),
        F.lit(as_of).cast("timestamp").alias("last_checked_at"),
        F.lit(None).cast("string").alias("video_title_sentiment"),
        F.lit(1).alias("step"),
    )
    return merge(old.unionByName(new), "step")


def merge(versions: DataFrame, order: str = "batch_id") -> DataFrame:
    """Current videos from versions: times and title label keep the last known value, the rest
    is replaced, all of it from one row. Of rows of one batch the later published one is the last."""
    replaced = ["channel_id", "video_title", "is_active"]
    columns = [c for c in versions.columns if c != order]
    return (
        versions.groupBy("video_id")
        .agg(
            F.max(F.struct(order, F.col("date_publication").alias("_published"), *replaced)).alias("row"),
            keyed.last_filled("date_publication", order),
            keyed.last_filled("last_checked_at", order),
            keyed.last_filled("video_title_sentiment", order),
        )
        .select("*", *[f"row.{c}" for c in replaced])
        .select(*columns)
    )


def merge_channels(versions: DataFrame, order: str = "batch_id") -> DataFrame:
    return versions.groupBy("channel_id").agg(keyed.last("channel_name", order))


def untitled(video_info: DataFrame) -> DataFrame:
    """Videos whose title has no sentiment yet."""
    return video_info.where(F.col("video_title_sentiment").isNull()).select(
        "video_id", "video_title"
    )
