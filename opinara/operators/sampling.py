"""Exact stratified sample of the comments of the most liked videos, for human annotation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.operators import comments, keyed, stats
from opinara.runtime import cut_lineage

# Fixed values of the annotation job.
TOP_ROWS = 50
SAMPLE_SIZE = 300
SEED = 42


def video_medians(frame: DataFrame) -> DataFrame:
    """Median likes per video.

    Equal like counts are counted first, so a video with most of the rows is spread over its
    distinct like counts, and the second step sees one row for each of those.
    """
    counted = frame.groupBy("video_id", "likes").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("video_id").agg(F.percentile("likes", 0.5, F.col("n")).alias("median_likes"))


def with_median(
    frame: DataFrame, videos: int | None = None, medians: DataFrame | None = None
) -> DataFrame:
    """Each row with the median of its video. ``videos`` is a proven bound on their number."""
    medians = video_medians(frame) if medians is None else medians
    return keyed.lookup(frame, medians, "video_id", "comment_id", small_rows=videos)


def with_strata(
    frame: DataFrame, videos: int | None = None, medians: DataFrame | None = None
) -> DataFrame:
    """Popularity flag and stratum; the stratum is NULL where a label is."""
    is_top = F.col("likes") >= F.col("median_likes")
    return (
        with_median(frame, videos, medians)
        .withColumn("is_top", F.coalesce(is_top, F.lit(False)))
        .withColumn("pop_str", F.when(F.col("is_top"), "Top").otherwise("Bottom"))
        .withColumn(
            "strata",
            F.concat(
                "sentiment_model_1", F.lit("_"), "sentiment_model_2", F.lit("_"), F.col("pop_str")
            ),
        )
        .drop("median_likes")
    )


def annotation_frame(
    raw_comments: DataFrame, video_stats: DataFrame, top: int = TOP_ROWS
) -> DataFrame:
    """Comments of the top videos with two labels, popularity and stratum."""
    picked = stats.comments_of_top(raw_comments, video_stats, top)
    return _stratified_once(comments.label_pivot(picked), top)


def annotation_frame_of_versions(
    versions: DataFrame, video_stats: DataFrame, top: int = TOP_ROWS
) -> DataFrame:
    """The same from stored versions: only comments that a top video has ever held are merged.

    A merged comment belongs to the video of its first version, so its id is among those; whether it is
    that video is asked again after the merge.
    """
    held = cut_lineage(stats.comments_of_top(versions, video_stats, top).select("comment_id").distinct())
    versions = keyed.lookup(versions, held, "comment_id", "comment_id", "left_semi", held.count())
    merged = comments.merge(versions)
    return annotation_frame(merged, video_stats, top)


def _stratified_once(pivot: DataFrame, top: int) -> DataFrame:
    """Strata over a pivot that is written first, as the medians, the strata and the sample all
    start from it: Spark prunes each use differently and would otherwise scan and shuffle the
    comments for every one.
    """
    pivot = cut_lineage(pivot)
    return with_strata(pivot, top, cut_lineage(video_medians(pivot)))


def strata_counts(frame: DataFrame) -> DataFrame:
    return (
        frame.where(F.col("strata").isNotNull())
        .groupBy("strata")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quotas(counts: DataFrame, size: int) -> DataFrame:
    """Adds ``quota``, the rows to take per stratum: whole shares, then one more for the largest
    remainders. The ranking runs over the strata table, a row for each pair of labels."""
    total, n = F.sum("n").over(Window.partitionBy()), F.col("n")
    shares = counts.withColumn("_all", total).select(
        "strata",
        "n",
        F.floor(n * size / F.col("_all")).alias("_base"),
        F.pmod(n * size, F.col("_all")).alias("_rest"),
    )
    missing = F.lit(size) - F.sum("_base").over(Window.partitionBy())
    place = F.row_number().over(Window.orderBy(F.desc("_rest"), F.asc("strata")))
    extra = F.when(place <= missing, 1).otherwise(0)
    return shares.select("strata", "n", (F.col("_base") + extra).cast("bigint").alias("quota"))


def can_stratify(counts: DataFrame, size: int) -> bool:
    """A split needs two rows in every stratum and room for every stratum on both sides."""
    seen = counts.agg(
        F.sum("n").alias("total"), F.min("n").alias("least"), F.count("*").alias("strata")
    ).first()
    total, strata = seen["total"] or 0, seen["strata"]
    return total > size and seen["least"] >= 2 and strata <= min(size, total - size)


def stratified_sample(frame: DataFrame, size: int = SAMPLE_SIZE, seed: int = SEED) -> DataFrame:
    """Exactly ``size`` rows in proportion to the strata, or the whole frame where that is
    impossible.

    Rows are chosen by hash order, so the same input gives the same sample. Sizes and quotas of the
    strata stay a table. The frame is read twice, for the strata and for the rows, so it should come
    from a table.
    """
    counts = cut_lineage(strata_counts(frame))
    if not can_stratify(counts, size):
        return frame
    take = cut_lineage(quotas(counts, size))
    known = frame.where(F.col("strata").isNotNull()).withColumn(
        "_hash", F.md5(F.concat(F.lit(f"{seed}-"), F.col("comment_id")))
    )
    strata = take.count()
    likely = cut_lineage(_lowest_hashes(known, take, strata))
    found = strata_counts(likely).select("strata", F.col("n").alias("found"))
    short = take.join(found, "strata", "left").where(F.coalesce("found", F.lit(0)) < F.col("quota"))
    return _first_by_hash(likely if short.isEmpty() else known, take, strata).select(*frame.columns)


def _lowest_hashes(known: DataFrame, take: DataFrame, strata: int) -> DataFrame:
    """Rows whose hash is low enough to be in the sample, and some more.

    Hashes are even, so the share of a stratum below a bound is known up to chance. The margin of
    six deviations makes it all but certain that the quota is met; the caller checks that it is,
    and ranks everything where it is not. What is left to rank is a few times the sample, however
    large the strata.
    """
    share = (F.col("quota") + 6 * F.sqrt("quota") + 20) / F.col("n")
    # Digits of a hash sort as text; "g" lies above all of them.
    digits = F.lower(F.lpad(F.hex(F.floor(share * 16**8)), 8, "0"))
    limits = take.select("strata", F.when(share < 1, digits).otherwise("g").alias("_bound"))
    marked = keyed.lookup(known, limits, "strata", "comment_id", "inner", strata)
    return marked.where(F.col("_hash") < F.col("_bound")).drop("_bound")


def _first_by_hash(rows: DataFrame, take: DataFrame, strata: int) -> DataFrame:
    order = [F.col(c) for c in ("_hash", "comment_id", "comment_text", "likes")]
    most = take.agg(F.max("quota").alias("n")).first()["n"]
    first = keyed.top_per_key(rows, ["strata"], order, most, "comment_id")
    quota = take.select("strata", "quota")
    return keyed.lookup(first, quota, "strata", "comment_id", "inner", strata).where(F.col("rn") <= F.col("quota"))


def preview(sample: DataFrame, n: int = 5) -> DataFrame:
    """The first rows of a sample, by stratum and comment."""
    return sample.orderBy("strata", "comment_id", "likes").limit(n)


def annotation_sheet(sample: DataFrame) -> DataFrame:
    """The sample with blank columns for the annotators."""
    return sample.withColumn("human_sentiment", F.lit("")).withColumn("is_sarcasm", F.lit(False))
