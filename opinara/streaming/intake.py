"""Landed pages as a stream; every micro-batch is one monitoring cycle.

The mark up to which a video has been read is kept in its counters and compared per video. Spark's
own watermark runs over the whole stream and would drop the comments of videos that lag behind.
A comment at or below its video's mark is late: it is dropped, or with ``keep_late`` corrects what is stored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from opinara.operators import scoring
from opinara.plans.cycle import STAGED, run_cycle
from opinara.runtime import packed, shuffles_go, write_once
from opinara.sources import landing
from opinara.sources.state import StateTables
from opinara.streaming import marks

# Keyed state with timers needs this store. Timers by the clock would ask for batches without rows for ever; they
# are looked at with the next batch that has some.
KEYED_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}

# One filled column per kind of landed row.
COLUMNS = {
    "comments": (
        "comment",
        "struct<video_id: string, comment_id: string, text: string, likes: bigint, "
        "published_at: string, updated_at: string, landed_at: timestamp, page_newest: timestamp, "
        "position: int>",
    ),
    "disabled": ("blocked", "struct<video_id: string>"),
    "statistics": ("count", "struct<video_id: string, yt_count: bigint>"),
    "search": (
        "found",
        "struct<video_id: string, title: string, channel_id: string, channel_name: string, "
        "published_at: timestamp>",
    ),
}


def landed_rows(
    spark: SparkSession,
    folder: str,
    stream: bool = True,
    options: dict | None = None,
    through: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """All landed rows in one frame: ``kind`` and the struct column of that kind.

    ``through`` takes flattened comment pages and gives back those rows, with a ``kind``, that go on.
    """
    pages = {k: landing.read_pages(spark, folder, k, stream, options) for k in landing.FOLDERS}
    flat = landing.flatten_pages(pages["comments"])
    fields = [c for c in flat.columns if c != "blocked"]
    if through is None:
        flat = flat.withColumn("kind", F.when(F.col("blocked"), "disabled").otherwise("comments"))
    else:
        flat = through(flat)
    blocked = F.col("kind") == "disabled"
    from_comments = flat.select(
        "kind",
        F.when(~blocked, F.struct(*fields)).alias("comment"),
        F.when(blocked, F.struct("video_id")).alias("blocked"),
    )
    counts = landing.flatten_counts(pages["statistics"])
    found = landing.flatten_search(pages["search"])
    return (
        _in_columns(from_comments)
        .unionByName(_in_columns(_of_kind("statistics", counts)))
        .unionByName(_in_columns(_of_kind("search", found)))
    )


def _of_kind(kind: str, df: DataFrame) -> DataFrame:
    return df.select(F.lit(kind).alias("kind"), F.struct(*df.columns).alias(COLUMNS[kind][0]))


def _in_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "kind",
        *[
            (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
            for c, t in COLUMNS.values()
        ],
    )


def stage(batch: DataFrame, folder: str) -> DataFrame:
    """A micro-batch as a table with a folder per kind.

    A micro-batch is a finished plan: no filter reaches its source, and each use would parse all
    its pages again. Read from the table, a use touches the rows and columns of its kind.
    """
    with shuffles_go(batch.sparkSession):
        packed(batch).partitionBy("kind").parquet(folder)
    return batch.sparkSession.read.schema(batch.schema).parquet(folder)


def split(rows: DataFrame) -> dict[str, DataFrame]:
    """Frames by kind out of landed rows."""
    return {
        kind: rows.where(F.col("kind") == kind).select(f"{column}.*")
        for kind, (column, _) in COLUMNS.items()
    }


def take_in(
    store: StateTables,
    batch_id: int,
    rows: DataFrame,
    models: Sequence[scoring.Model],
    as_of: datetime,
    max_active: int,
    give_back: Callable[[DataFrame], None] | None = None,
    keep_late: bool = False,
    scores: str | None = None,
    on_staged: Callable[[], None] | None = None,
) -> datetime:
    """One monitoring cycle over landed rows, from a stream or from a plain read.

    The time of a batch's first attempt is stored and holds for its repeats; it is returned. ``on_staged`` is called
    once all rows are staged: this attempt reads no page after that.
    """
    staged = stage(rows, store.work(batch_id, STAGED))
    if on_staged is not None:
        on_staged()
    as_of = store.batch_time(batch_id, as_of)
    run_cycle(store, batch_id, split(staged), models, as_of, max_active, give_back, keep_late, scores)
    return as_of


def run_stream(
    spark: SparkSession,
    folder: str,
    store: StateTables,
    checkpoint: str,
    models: Sequence[scoring.Model],
    as_of: Callable[[int], datetime],
    max_active: int,
    trigger: dict | None = None,
    first_batch: int = 1,
    options: dict | None = None,
    keyed: bool = False,
    keep_late: bool = False,
    scores: str | None = None,
    on_staged: Callable[[], None] | None = None,
) -> StreamingQuery:
    """Start the intake. By default it takes what has landed and ends, as a scheduled run would.

    ``options`` go to the file source, as ``maxFilesPerTrigger`` to bound a batch or ``cleanSource`` to
    archive what was read. ``as_of`` gives the time of a batch by its id. Ids start at ``first_batch``, 1 for new tables;
    a new checkpoint over existing tables has to start beyond their last batch.

    ``keyed`` keeps marks and waiting comments as state of the stream (``marks``) instead of pending rows. What a cycle
    decides about videos lands below ``_cycle`` beside the pages and is read with the next batch. A new
    keyed stream takes over the stored videos and marks. Its state is in RocksDB.

    With ``keep_late`` pages may land in any time order: late comments are taken in, and counters are corrected where
    a comment comes again changed. The first such batch over an older store reads its stored comments once.
    ``scores`` names a folder that keeps scores of Python models: a text that comes again is not scored again.
    ``on_staged`` is called in every batch once its pages have been read; only a repeat of a batch that failed reads
    them again, so what removes them there gives up such repeats.
    """

    def one_cycle(batch: DataFrame, epoch: int) -> None:
        batch_id = epoch + first_batch
        state = StateTables(batch.sparkSession, store.root)
        if not keyed:
            take_in(
                state, batch_id, batch, models, as_of(batch_id), max_active, None, keep_late, scores, on_staged
            )
            return
        said = f"batch-{batch_id:09}"

        def give_back(unread: DataFrame) -> None:
            write_once(marks.as_waiting(unread), f"{folder}/_cycle/returned/{said}")

        time = take_in(
            state, batch_id, batch, models, as_of(batch_id), max_active, give_back, keep_late, scores, on_staged
        )
        write_once(marks.word(state, batch_id, time), f"{folder}/_cycle/watch/{said}")

    def through_state(flat: DataFrame) -> DataFrame:
        told = {}
        for kind, ddl in (("watch", marks.WATCH), ("returned", marks.RETURNED)):
            schema = T.StructType.fromDDL(ddl)
            write_once(spark.createDataFrame([], schema), f"{folder}/_cycle/{kind}/start")
            told[kind] = spark.readStream.schema(schema).json(f"{folder}/_cycle/{kind}/*")
        known = marks.known_videos(store, first_batch)
        passed = marks.hold_back(marks.events(flat, **told), known)
        return passed.replace("late", "comments", "kind") if keep_late else passed

    for kind in landing.FOLDERS:
        empty = spark.createDataFrame([], T.StructType.fromDDL(landing.FOLDERS[kind]))
        empty.limit(0).write.mode("ignore").json(f"{folder}/{kind}")
    rows = landed_rows(spark, folder, options=options, through=through_state if keyed else None)
    writer = rows.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
    if not keyed:
        return writer.foreachBatch(one_cycle).start()
    # the query keeps the settings it was started with
    before = {name: spark.conf.get(name) for name in KEYED_SETTINGS}
    try:
        for name, value in KEYED_SETTINGS.items():
            spark.conf.set(name, value)
        return writer.foreachBatch(one_cycle).start()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
