"""Platform pages made from the driver's tables, and two intake waves over them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara import schemas
from opinara.operators import scoring
from opinara.plans import fixtures as fx
from opinara.runtime import clear, let_go, scratch_dir, shuffles_go
from opinara.sources import landing
from opinara.sources.state import StateTables
from opinara.streaming.intake import landed_rows, run_stream, take_in

# A page holds the comments of one video with ids from one such range, so it is never larger.
PAGE_RANGE = 1000
# Fixed value of the platform: videos per statistics call.
COUNT_PAGE = 50


def comment_pages(
    spark: SparkSession,
    sf_dir: str,
    when: Column | None = None,
    flaws: bool = True,
    edit: Callable[[DataFrame], DataFrame] | None = None,
    part: tuple[int, int] = (0, 1),
) -> DataFrame:
    """Comment pages, newest comment first; videos whose last event is an error have theirs
    switched off. With ``flaws``, texts, likes and times are missing or unreadable here and there.
    ``edit`` changes the comments ahead of that. ``part`` (number, of how many) gives some of the pages, whole ones.
    """
    e, (number, parts) = F.col("event_id"), part
    page_of = {"video_id": F.col("video_id"), "page": F.floor(e / PAGE_RANGE)}
    when = F.lit(True) if when is None else when
    if parts > 1:
        when = when & (F.pmod(F.xxhash64(*page_of.values()), F.lit(parts)) == number)
    rows = fx.comments_dealt(spark, sf_dir, when, page_of)
    if edit is not None:
        rows = edit(rows)
    written = F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    updated = F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    body = F.col("text")
    if flaws:
        written = F.when(e % 19 == 0, "soon").when(e % 23 != 0, written)
        body = F.when(e % 4 != 0, body)
    item = F.struct(
        F.col("comment_id").alias("id"),
        F.struct(
            F.struct(
                F.struct(
                    written.alias("publishedAt"),
                    F.when(e % 2 == 0, updated).alias("updatedAt"),
                    body.alias("textDisplay"),
                    F.col("likes").cast("bigint").alias("likeCount"),
                ).alias("snippet")
            ).alias("topLevelComment")
        ).alias("snippet"),
    )
    page = rows.groupBy("video_id", "page").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("published_at", item.alias("item"))), asc=False),
            lambda x: x["item"],
        ).alias("items")
    )
    filled = page.select(
        "video_id",
        F.lit(False).alias("comments_disabled"),
        "items",
        F.lit(None).cast("string").alias("nextPageToken"),
    )
    blocked = (
        fx.events(spark, sf_dir)
        .groupBy("user_id")
        .agg(F.max_by("event_type", "event_id").alias("last_type"))
        .where(F.col("last_type") == "error")
        .select(fx.text_id("v", "user_id").alias("video_id"), F.lit(True).alias("comments_disabled"))
    )
    return filled if number else filled.unionByName(blocked, allowMissingColumns=True)


def page_parts(spark: SparkSession, sf_dir: str, *how, filled: bool = False, **more) -> list[DataFrame]:
    """Comment pages in as many frames as bound what is shuffled for one; only ``filled`` ones if asked."""
    n = fx.dealt_parts(spark, sf_dir)
    pages = [comment_pages(spark, sf_dir, *how, **more, part=(i, n)) for i in range(n)]
    return [p.where(~F.col("comments_disabled")) for p in pages] if filled else pages


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document is a found item; German ones are channels."""
    documents = fx.table(spark, sf_dir, "documents")
    doc = F.col("doc_id")
    item = F.struct(
        F.struct(
            F.when(F.col("lang") == "de", "youtube#channel")
            .otherwise("youtube#video")
            .alias("kind"),
            fx.text_id("v", "doc_id").alias("videoId"),
        ).alias("id"),
        F.struct(
            F.col("text").alias("title"),
            fx.text_id("ch", (doc % 40).cast("string")).alias("channelId"),
            fx.text_id("channel ", (doc % 40).cast("string")).alias("channelTitle"),
            F.date_format(
                F.lit(fx.AS_OF).cast("timestamp") - F.make_dt_interval(F.lit(0), (doc % 97).cast("int")),
                "yyyy-MM-dd'T'HH:mm:ss'Z'",
            ).alias("publishedAt"),
        ).alias("snippet"),
    )
    return documents.groupBy(F.floor(doc / COUNT_PAGE).alias("page")).agg(
        F.collect_list(item).alias("items")
    ).select("items")


def count_pages(spark: SparkSession, sf_dir: str, counts: DataFrame | None = None) -> DataFrame:
    """Statistics pages; counts that end in 0 are missing."""
    if counts is None:
        counts = fx.platform_counts(spark, sf_dir).withColumn(
            "yt_count", F.when(F.col("yt_count") % 10 != 0, F.col("yt_count"))
        )
    user = F.substring("video_id", 2, 20).cast("bigint")
    item = F.struct(
        F.col("video_id").alias("id"),
        F.struct(F.col("yt_count").cast("string").alias("commentCount")).alias("statistics"),
    )
    return counts.groupBy(F.floor(user / COUNT_PAGE).alias("page")).agg(
        F.collect_list(item).alias("items")
    ).select("items")


def write(spark: SparkSession, pages: dict[str, DataFrame | list[DataFrame]], folder: str | None = None) -> str:
    """Land pages by kind; of several frames of a kind one at a time, each without the shuffle files of those before."""
    folder = folder or scratch_dir(spark, "landing")
    for kind, frames in pages.items():
        for df in frames if isinstance(frames, list) else [frames]:
            with shuffles_go(spark):
                df.write.mode("append").option("compression", "gzip").json(f"{folder}/{kind}")
    return folder


def new_store(spark: SparkSession, sf_dir: str) -> StateTables:
    store = StateTables(spark, scratch_dir(spark, "state")).create()
    store.write("video_info", fx.videos_raw(spark, sf_dir), 0)
    return store


def users(spark: SparkSession, sf_dir: str) -> int:
    return fx.events(spark, sf_dir).select("user_id").distinct().count()


def wave_pages(spark: SparkSession, sf_dir: str) -> list[dict[str, DataFrame | list[DataFrame]]]:
    """Pages of the comments before the cut, and of the rest with new counts and found videos."""
    early = F.col("published_at") < fx.cut()
    listed = (
        fx.events(spark, sf_dir)
        .where(F.col("ts") < fx.cut())
        .groupBy(fx.text_id("v", "user_id").alias("video_id"))
        .agg(F.count(F.lit(1)).alias("yt_count"))
    )
    return [
        {
            "comments": page_parts(spark, sf_dir, early, flaws=False, filled=True),
            "statistics": count_pages(spark, sf_dir, listed),
        },
        {
            "comments": page_parts(spark, sf_dir, ~early, flaws=False),
            "statistics": count_pages(spark, sf_dir, fx.platform_counts(spark, sf_dir)),
            "search": search_pages(spark, sf_dir),
        },
    ]


def taken_in(
    spark: SparkSession,
    sf_dir: str,
    waves: list[dict[str, DataFrame | list[DataFrame]]],
    times: list[datetime],
    keyed: bool = False,
    keep_late: bool = False,
) -> StateTables:
    """The state after the waves have landed and been streamed one by one; pages go once they are staged, and after
    each wave what only older batches name and shuffle files, which hold a wave's texts once more."""
    store = new_store(spark, sf_dir)
    folder, checkpoint = scratch_dir(spark, "landing"), scratch_dir(spark, "checkpoint")
    slots = users(spark, sf_dir)
    for wave in waves:
        write(spark, wave, folder)
        let_go(spark)

        def pages_go() -> None:
            for kind in landing.FOLDERS:
                clear(spark, f"{folder}/{kind}")

        run_stream(
            spark,
            folder,
            store,
            checkpoint,
            scoring.BUILT_IN,
            lambda n: times[n - 1],
            slots,
            keyed=keyed,
            keep_late=keep_late,
            on_staged=pages_go,
        ).awaitTermination()
        store.expire(keep=1)
        let_go(spark)
    clear(spark, folder)
    clear(spark, checkpoint)
    return store


_TWO_WAVES: dict[tuple[str, str], StateTables] = {}


def two_waves(spark: SparkSession, sf_dir: str, fresh: bool = False) -> StateTables:
    """Two complete waves. Queries that read different tables of the state share one run of an application;
    ``fresh`` streams them anew."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if fresh or key not in _TWO_WAVES:
        _TWO_WAVES[key] = taken_in(spark, sf_dir, wave_pages(spark, sf_dir), [fx.CUT, fx.AS_OF])
    return _TWO_WAVES[key]


def split_waves(spark: SparkSession, sf_dir: str) -> StateTables:
    """The same pages, but comments and the other kinds land apart: first after, then before them."""
    first, second = wave_pages(spark, sf_dir)

    def only(wave, *kinds):
        return {k: v for k, v in wave.items() if k in kinds}

    waves = [
        only(first, "statistics"),
        only(first, "comments"),
        only(second, "comments"),
        only(second, "statistics", "search"),
    ]
    return taken_in(spark, sf_dir, waves, [fx.CUT, fx.CUT, fx.AS_OF, fx.AS_OF])


def found_again(spark: SparkSession, sf_dir: str, keyed: bool = False) -> StateTables:
    """Videos that are not watched at first are found again by the second wave's search page; their comments
    land before, with and after it."""
    second = fx.CUT + timedelta(days=7)
    bounds = [None, fx.CUT, second, None]

    def landed_between(low: datetime | None, high: datetime | None) -> list[DataFrame]:
        time, when = F.col("published_at"), F.lit(True)
        if low is not None:
            when = when & (time >= F.lit(low).cast("timestamp"))
        if high is not None:
            when = when & (time < F.lit(high).cast("timestamp"))
        return page_parts(spark, sf_dir, when, flaws=False, filled=True)

    waves = [{"comments": landed_between(a, b)} for a, b in pairwise(bounds)]
    waves[0]["statistics"] = waves[2]["statistics"] = count_pages(spark, sf_dir, fx.platform_counts(spark, sf_dir))
    waves[1]["search"] = search_again(spark, sf_dir)
    return taken_in(spark, sf_dir, waves, [fx.CUT + timedelta(days=n) for n in range(3)], keyed)


def search_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search pages that find the videos that are not watched at first."""
    user = F.col("user_id")
    item = F.struct(
        F.struct(F.lit(landing.VIDEO_KIND).alias("kind"), fx.text_id("v", "user_id").alias("videoId")).alias("id"),
        F.struct(
            F.lit("again").alias("title"),
            F.lit("ch").alias("channelId"),
            F.lit("channel").alias("channelTitle"),
            F.date_format(
                F.lit(fx.AS_OF).cast("timestamp") - F.make_dt_interval((user % 20).cast("int")),
                "yyyy-MM-dd'T'HH:mm:ss'Z'",
            ).alias("publishedAt"),
        ).alias("snippet"),
    )
    unwatched = fx.events(spark, sf_dir).where(user % 7 == 6).select("user_id").distinct()
    search = unwatched.groupBy(F.floor(user / COUNT_PAGE).alias("page")).agg(F.collect_list(item).alias("items"))
    return search.select("items")


# Likes that a comment has gained, and its text, where it lands again changed.
GAINED, REWORDED = 100, "the"


def late_waves(spark: SparkSession, sf_dir: str) -> StateTables:
    """The later comments land first; then the earlier ones, and of the later ones every fifth again with more likes
    and another text, and every fifth again as it was."""
    later = F.col("published_at") >= fx.cut()
    fifth = F.col("event_id") % 5

    def edit(rows: DataFrame) -> DataFrame:
        changed = later & (fifth == 0)
        likes = F.coalesce("likes", F.lit(0))
        return rows.withColumn("text", F.when(changed, F.lit(REWORDED)).otherwise(F.col("text"))).withColumn(
            "likes", F.when(changed, likes + GAINED).otherwise(F.col("likes"))
        )

    first = page_parts(spark, sf_dir, later, flaws=False, filled=True)
    second = page_parts(spark, sf_dir, ~later | (fifth <= 1), flaws=False, edit=edit, filled=True)
    waves = [{"comments": pages} for pages in (first, second)]
    waves[0]["statistics"] = count_pages(spark, sf_dir, fx.platform_counts(spark, sf_dir))
    waves[0]["search"] = search_again(spark, sf_dir)
    return taken_in(spark, sf_dir, waves, [fx.CUT, fx.CUT + timedelta(days=1)], keep_late=True)


def repeated_batch(spark: SparkSession, sf_dir: str) -> StateTables:
    """The first wave taken in twice under one batch id, the second time with a later clock."""
    store, slots = new_store(spark, sf_dir), users(spark, sf_dir)
    folder = write(spark, wave_pages(spark, sf_dir)[0])
    spark.createDataFrame([], schemas.struct(schemas.SEARCH_PAGE)).write.json(f"{folder}/search")
    for time in (fx.CUT, fx.AS_OF):
        take_in(store, 1, landed_rows(spark, folder, stream=False), scoring.BUILT_IN, time, slots)
    return store
