"""The driver's tables seen as videos, comments and models.

A user is a video, an event is a comment, its value the likes; comment texts are the documents in
turn, so every event and every document takes part. The same views stand in SQL in ``oracle``.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.functions.labels import normalize_label, recode_letter
from opinara.operators import sampling, scoring, stats
from opinara.runtime import configure

# Parameters: the time of the second batch, and the cut between the two.
AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)
CUT = datetime(2024, 1, 15, tzinfo=timezone.utc)


# Bytes of all texts up to which they are broadcast to comments that are dealt by page; beyond, both are shuffled.
BROADCAST_BYTES = 64 << 20
# Bytes of comments' texts that are shuffled for pages at a time.
LANDED_BYTES = 8 << 30
# Bytes of comments' texts in one part of them.
PART_BYTES = 32 << 20

_READ: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its files are listed and its schema is read once per application."""
    configure(spark)
    key = (spark.sparkContext.applicationId, f"{sf_dir}/{name}.parquet")
    if key not in _READ:
        _READ[key] = spark.read.parquet(key[1])
    return _READ[key]


_ROWS: dict[tuple[str, str], int] = {}


def documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """Texts, and how many there are; counted once per application."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ROWS:
        _ROWS[key] = rows.count()
    return rows, _ROWS[key]


_BYTES: dict[tuple[str, str], int] = {}


def text_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Bytes of all texts; summed once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BYTES:
        size = F.coalesce(F.sum(F.octet_length("text")), F.lit(0))
        _BYTES[key] = table(spark, sf_dir, "documents").agg(size).first()[0]
    return _BYTES[key]


def text_id(prefix: str, number: str | Column) -> Column:
    return F.concat(F.lit(prefix), F.col(number).cast("string") if isinstance(number, str) else number)


def cut() -> Column:
    return F.lit(CUT).cast("timestamp")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def comments_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments without their text, for what does not read it."""
    event_type, event_id = F.col("event_type"), F.col("event_id")
    stars = F.pmod(event_id * 7 + F.col("user_id"), F.lit(5)) + 1
    return events(spark, sf_dir).select(
        "event_id",
        text_id("c", "event_id").alias("comment_id"),
        text_id("v", "user_id").alias("video_id"),
        F.when(event_id % 17 != 0, F.floor("value").cast("int")).alias("likes"),
        F.col("ts").alias("published_at"),
        F.when(event_id % 5 == 0, F.col("ts") + F.expr("interval 1 hour"))
        .otherwise(F.col("ts"))
        .alias("updated_at"),
        F.when(event_type == "error", "LABEL_0")
        .when(event_type == "view", "LABEL_1")
        .when(event_type == "purchase", "LABEL_2")
        .when(event_type == "click", "positive")
        .otherwise("signup")
        .alias("raw_label_1"),
        F.when(stars == 1, "1 star")
        .otherwise(F.concat(stars.cast("string"), F.lit(" stars")))
        .alias("raw_label_2"),
        F.when(event_id % 10 == 9, None)
        .when(event_id % 3 == 0, "n")
        .when(event_id % 3 == 1, "ne")
        .otherwise("p")
        .alias("human_code"),
    )


def comments_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments with their text.

    Both sides are shuffled by document: each table is one file here, and a scan of one file is one
    task, which would then score all texts alone.
    """
    texts, number = documents(spark, sf_dir)
    turn = comments_plain(spark, sf_dir).withColumn("doc_id", F.col("event_id") % number)
    return turn.join(texts.hint("merge"), "doc_id").drop("doc_id")


def comments_dealt(spark: SparkSession, sf_dir: str, when: Column, by: dict[str, Column]) -> DataFrame:
    """Comments with their text, of which ``when`` holds, dealt by ``by``, columns that are added.

    Texts that may be broadcast join the dealt rows and are not shuffled; a part holds a bounded share of them.
    """
    number, size = documents(spark, sf_dir)[1], text_bytes(spark, sf_dir)
    if size > BROADCAST_BYTES:
        # no task sorts texts ahead of the shuffle
        return comments_raw(spark, sf_dir).where(when).withColumns(by).repartition(*by)
    rows = events(spark, sf_dir).count()
    parts = rows * size // max(number, 1) // PART_BYTES + spark.sparkContext.defaultParallelism
    turn = comments_plain(spark, sf_dir).where(when).withColumns(by)
    turn = turn.withColumn("doc_id", F.col("event_id") % number).repartition(parts, *by)
    return turn.join(F.broadcast(documents(spark, sf_dir)[0]), "doc_id").drop("doc_id")


def dealt_parts(spark: SparkSession, sf_dir: str) -> int:
    """In how many parts all comments are dealt so that the shuffles of one, if texts are shuffled, are bounded."""
    number, size = documents(spark, sf_dir)[1], text_bytes(spark, sf_dir)
    if size <= BROADCAST_BYTES:
        return 1
    return events(spark, sf_dir).count() * size // max(number, 1) // LANDED_BYTES + 1


def videos_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos; one in four has its title label already."""
    texts, number = documents(spark, sf_dir)
    users = events(spark, sf_dir).select("user_id").distinct()
    user = F.col("user_id")
    published = F.lit(AS_OF).cast("timestamp") - F.make_dt_interval((user % 20).cast("int"))
    return users.join(texts, F.col("doc_id") == user % number).select(
        text_id("v", "user_id").alias("video_id"),
        text_id("ch", (user % 25).cast("string")).alias("channel_id"),
        F.when(user % 13 == 0, "").otherwise(F.col("text")).alias("video_title"),
        F.when(user % 23 != 22, published).alias("date_publication"),
        F.when(user % 7 == 6, 0).otherwise(1).alias("is_active"),
        F.lit(None).cast("timestamp").alias("last_checked_at"),
        F.when(user % 4 == 0, "positive").alias("video_title_sentiment"),
    )


def platform_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment counts of the platform: a third of the videos has not grown since the cut, and those
    whose last event is a signup are not listed."""
    before = F.count_if(F.col("ts") < cut())
    return (
        events(spark, sf_dir)
        .groupBy("user_id")
        .agg(
            F.when(F.col("user_id") % 3 == 0, before)
            .otherwise(F.count(F.lit(1)))
            .alias("yt_count"),
            F.max_by("event_type", "event_id").alias("last_type"),
        )
        .where(F.col("last_type") != "signup")
        .select(text_id("v", "user_id").alias("video_id"), "yt_count")
    )


def by_label(comments: DataFrame) -> DataFrame:
    """One row per comment and model, from the two raw labels."""
    pairs = F.array(
        F.struct(
            F.lit(1).alias("model_id"), normalize_label(F.col("raw_label_1")).alias("sentiment_label")
        ),
        F.struct(
            F.lit(2).alias("model_id"), normalize_label(F.col("raw_label_2")).alias("sentiment_label")
        ),
    )
    keep = [c for c in comments.columns if not c.startswith("raw_label")]
    return (
        comments.select(*keep, F.explode_outer(pairs).alias("p"))
        .select(*keep, "p.*")
        .withColumn("likes", F.coalesce("likes", F.lit(0)))
    )


def deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the comments before and after the cut, as two batches."""
    scored = by_label(comments_plain(spark, sf_dir))
    first = scored.where(F.col("published_at") < cut())
    second = scored.where(F.col("published_at") >= cut())
    parts = []
    for batch_id, rows, time in ((1, first, CUT), (2, second, AS_OF)):
        mood = stats.video_mood(rows)
        parts.append(
            mood.select(
                "video_id",
                "model_id",
                F.when(F.lit(batch_id) == 1, "positive").alias("video_title_sentiment"),
                *stats.COUNTERS,
                (F.col("pos_count") + F.col("neg_count") + F.col("neu_count")).alias(
                    "total_comments"
                ),
                "last_sync_date",
                F.lit(time).cast("timestamp").alias("checked_at"),
                F.lit(batch_id).cast("bigint").alias("batch_id"),
            )
        )
    return parts[0].unionByName(parts[1])


def stats_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters as they stood at the cut."""
    return deltas(spark, sf_dir).where(F.col("batch_id") == 1).drop("batch_id")


def stats_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters over all comments."""
    return stats.merge(deltas(spark, sf_dir))


def raw_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored comments: texts with the labels of both models."""
    return by_label(comments_raw(spark, sf_dir).withColumnRenamed("text", "comment_text"))


def annotated_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every comment of the top videos, as the annotation file holds it."""
    frame = sampling.annotation_frame(raw_comments(spark, sf_dir), stats_now(spark, sf_dir))
    letters = comments_plain(spark, sf_dir).select(
        "comment_id", recode_letter(F.col("human_code")).alias("human_sentiment")
    )
    return frame.join(letters, "comment_id").withColumn("is_sarcasm", F.lit(False))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All comments with both labels and the human one, as classes."""
    both = comments_plain(spark, sf_dir)
    return both.select(
        "comment_id",
        "video_id",
        normalize_label(F.col("raw_label_1")).alias("sentiment_model_1"),
        normalize_label(F.col("raw_label_2")).alias("sentiment_model_2"),
        recode_letter(F.col("human_code")).alias("human_sentiment"),
    )


def unloadable() -> scoring.Scorer:
    """Factory of a model whose files are missing."""
    raise OSError("no weights")
