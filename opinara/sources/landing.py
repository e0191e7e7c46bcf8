"""Landed platform responses, one JSON page per line, as batch or as stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara import schemas
from opinara.functions import clean

# Fixed value: the search item kind that is a video.
VIDEO_KIND = "youtube#video"

FOLDERS = {
    "comments": schemas.COMMENT_PAGE,
    "search": schemas.SEARCH_PAGE,
    "statistics": schemas.COUNT_PAGE,
}


def read_pages(
    spark: SparkSession, folder: str, kind: str, stream: bool = False, options: dict | None = None
) -> DataFrame:
    """Pages of a kind (comments, search, statistics) below ``folder``, with the time they landed.

    As a stream, ``options`` go to the file source: ``maxFilesPerTrigger`` bounds a batch,
    ``cleanSource`` and ``sourceArchiveDir`` take files that were read out of the folder, so that it
    does not grow.
    """
    reader = spark.readStream.options(**(options or {})) if stream else spark.read
    pages = reader.schema(schemas.struct(FOLDERS[kind])).json(f"{folder}/{kind}")
    return pages.select("*", F.col("_metadata.file_modification_time").alias("landed_at"))


def flatten_pages(pages: DataFrame) -> DataFrame:
    """One row per comment, unfiltered, and one with ``blocked`` per page of a video whose comments
    are switched off: all a comment page holds, from one reading of it.

    ``page_newest`` and ``position`` give the order in which the platform lists a video's comments,
    including those whose own time is unreadable. Where the platform sends no updated time the
    published one stands in, so the comment counts as unedited.
    """
    times = F.transform(
        "items", lambda item: clean.to_time(item.snippet.topLevelComment.snippet.publishedAt)
    )
    blocked = F.coalesce("comments_disabled", F.lit(False))
    landed = "landed_at" if "landed_at" in pages.columns else F.lit(None).cast("timestamp").alias("landed_at")
    snippet = "item.snippet.topLevelComment.snippet"
    return (
        pages.select(
            "video_id",
            blocked.alias("blocked"),
            landed,
            F.array_max(times).alias("page_newest"),
            F.posexplode_outer(F.when(~blocked, F.col("items"))).alias("position", "item"),
        )
        .where(F.col("blocked") | F.col("item").isNotNull())
        .select(
            "blocked",
            "video_id",
            F.col("item.id").alias("comment_id"),
            F.coalesce(f"{snippet}.textDisplay", F.lit("")).alias("text"),
            clean.like_count(F.col(f"{snippet}.likeCount")).alias("likes"),
            F.col(f"{snippet}.publishedAt").alias("published_at"),
            F.coalesce(f"{snippet}.updatedAt", f"{snippet}.publishedAt").alias("updated_at"),
            "landed_at",
            "page_newest",
            "position",
        )
    )


def flatten_comments(pages: DataFrame) -> DataFrame:
    """The comments of the pages alone."""
    return flatten_pages(pages).where(~F.col("blocked")).drop("blocked")


def page_order() -> list:
    """Sort order of flattened comments as the platform lists them: newest page first."""
    return [F.desc_nulls_last("page_newest"), F.asc("position"), F.asc("comment_id")]


def flatten_search(pages: DataFrame) -> DataFrame:
    """One row per found video; other kinds of items are left out."""
    return (
        pages.select(F.explode("items").alias("item"))
        .where(F.col("item.id.kind") == VIDEO_KIND)
        .select(
            F.col("item.id.videoId").alias("video_id"),
            F.col("item.snippet.title").alias("title"),
            F.col("item.snippet.channelId").alias("channel_id"),
            F.col("item.snippet.channelTitle").alias("channel_name"),
            clean.to_time(F.col("item.snippet.publishedAt")).alias("published_at"),
        )
    )


def flatten_counts(pages: DataFrame) -> DataFrame:
    """Platform comment count per listed video; a missing count is 0."""
    return pages.select(F.explode("items").alias("item")).select(
        F.col("item.id").alias("video_id"),
        F.coalesce(
            F.col("item.statistics.commentCount").try_cast("bigint"), F.lit(0)
        ).alias("yt_count"),
    )
