"""Registered queries: every operator over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara import schemas
from opinara.functions import clean, lexicon
from opinara.functions.labels import normalize_label, recode_letter
from opinara.operators import (
    comments,
    evaluation,
    migrate,
    registry,
    sampling,
    scoring,
    stats,
    videos,
)
from opinara.plans import fixtures as fx
from opinara.plans import jobs, landed
from opinara.runtime import scratch_dir
from opinara.sources import export, gold as gold_file, landing
from opinara.sources.scores import ScoreStore
from opinara.sources.state import StateTables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name; times are shown as text."""

    def shown(spark: SparkSession, sf_dir: str) -> DataFrame:
        fx.configure(spark)
        return show_times(function(spark, sf_dir))

    QUERIES[function.__name__] = shown
    return function


def show_times(df: DataFrame) -> DataFrame:
    times = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in times})


def iso(ts: str | Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


# --- comments: clean, cut, merge -----------------------------------------------------------------


@query
def prepare_comments(spark, sf_dir):
    e = F.col("event_id")
    mixed = fx.comments_raw(spark, sf_dir).select(
        "video_id",
        F.when(e % 7 != 0, F.col("comment_id")).alias("comment_id"),
        F.when(e % 7 == 0, F.when(e % 49 != 0, F.col("comment_id"))).alias("id"),
        F.when(e % 4 == 0, "").otherwise(F.col("text")).alias("text"),
        F.when(e % 8 == 0, F.col("text")).alias("textDisplay"),
        F.when(e % 29 == 0, "many").otherwise(F.col("likes").cast("string")).alias("likes"),
        F.when(e % 19 == 0, "yesterday").otherwise(iso("published_at")).alias("published_at"),
        F.when(e % 11 != 0, iso("updated_at")).alias("updated_at"),
        F.when(e % 3 == 0, F.col("raw_label_1")).alias("mood"),
        F.col("raw_label_2").alias("sentiment_label"),
    )
    ready = comments.prepare(mixed)
    return ready.withColumn("comment_text", F.md5("comment_text"))


@query
def parse_times(spark, sf_dir):
    ts, kind = F.col("ts"), F.col("event_id") % 9
    written = (
        F.when(kind == 0, iso(ts))
        .when(kind == 1, F.date_format(ts + F.expr("interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
        .when(kind == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 3, F.date_format(ts, "yyyy-MM-dd"))
        .when(kind == 4, F.date_format(ts - F.expr("interval 5 hours"), "yyyy-MM-dd'T'HH:mm:ss'-0500'"))
        .when(kind == 5, F.date_format(ts, "HH:mm"))
        .when(kind == 6, F.date_format(ts, "yyyy"))
        .when(kind == 7, F.concat(F.lit("on "), F.date_format(ts, "yyyy-MM-dd")))
    )
    frame = fx.events(spark, sf_dir).select("event_id", written.alias("written"))
    return frame.withColumn("parsed", clean.to_time(F.col("written")))


@query
def normalize_labels(spark, sf_dir):
    return fx.comments_plain(spark, sf_dir).select(
        "comment_id",
        normalize_label(F.col("raw_label_1")).alias("label_1"),
        normalize_label(F.col("raw_label_2")).alias("label_2"),
    )


@query
def new_comments(spark, sf_dir):
    rows = fx.comments_plain(spark, sf_dir).select("video_id", "comment_id", "likes", "published_at")
    marks = comments.last_sync(fx.stats_first(spark, sf_dir))
    return comments.newer_than_sync(rows, marks)


@query
def newest_per_video(spark, sf_dir):
    """The report of the 20 newest comments of every video."""
    rows = fx.comments_plain(spark, sf_dir).select("video_id", "comment_id", "likes", "published_at")
    return comments.newest(rows, 20)


@query
def upsert_comments(spark, sf_dir):
    first = fx.raw_comments(spark, sf_dir).select(
        "comment_id",
        "model_id",
        "video_id",
        "comment_text",
        "likes",
        "published_at",
        "sentiment_label",
        F.lit(1).cast("bigint").alias("batch_id"),
        (F.col("event_id") % 2).alias("odd"),
    )
    again = (
        first.where(F.col("sentiment_label") != "neutral")
        .withColumn("comment_text", F.concat("comment_text", F.lit(" edited")))
        .withColumn("likes", F.col("likes") + 1)
        .withColumn("video_id", F.lit("elsewhere"))
        .withColumn("published_at", F.when(F.col("odd") == 1, F.col("published_at")))
        .withColumn(
            "sentiment_label",
            F.when(F.col("odd") == 1, "neutral")
            .when(F.col("sentiment_label") == "positive", "negative")
            .otherwise("positive"),
        )
        .withColumn("batch_id", F.lit(2).cast("bigint"))
    )
    merged = comments.merge(first.unionByName(again).drop("odd"))
    return merged.withColumn("comment_text", F.md5("comment_text"))


@query
def drop_redelivered(spark, sf_dir):
    once = fx.comments_plain(spark, sf_dir).select(
        "comment_id",
        "video_id",
        F.coalesce("likes", F.lit(0)).alias("likes"),
        (F.col("event_id") % 3).alias("page"),
        (F.col("event_id") % 5).alias("position"),
    )
    again = once.withColumn("likes", F.col("likes") + 5).withColumn("page", F.lit(1).cast("bigint"))
    last = once.withColumn("position", F.lit(2).cast("bigint")).withColumn("likes", F.col("likes") + 9)
    return comments.drop_redelivered(once.unionByName(again).unionByName(last), ["page", "position"])


# --- counters ------------------------------------------------------------------------------------


@query
def video_mood(spark, sf_dir):
    return stats.video_mood(fx.by_label(fx.comments_plain(spark, sf_dir)))


@query
def upsert_video_stats(spark, sf_dir):
    return fx.stats_now(spark, sf_dir)


@query
def zero_delta(spark, sf_dir):
    scored = fx.by_label(fx.comments_plain(spark, sf_dir))
    mood = stats.video_mood(scored.where(F.col("published_at") >= fx.cut()))
    processed = fx.platform_counts(spark, sf_dir).join(
        comments.last_sync(fx.stats_first(spark, sf_dir)), "video_id", "left"
    )
    return stats.batch_delta(processed, mood, [1, 2, 3], 2, fx.AS_OF)


@query
def latest_stats(spark, sf_dir):
    return stats.latest(fx.deltas(spark, sf_dir))


@query
def global_snapshot(spark, sf_dir):
    models = spark.range(1, 4).select(F.col("id").cast("int").alias("model_id"))
    totals = stats.global_totals(fx.stats_now(spark, sf_dir), models)
    return totals.withColumn("snapshot_date", F.lit(fx.AS_OF).cast("timestamp"))


@query
def stats_of_model(spark, sf_dir):
    return stats.for_model(fx.stats_now(spark, sf_dir), 2)


@query
def top_videos(spark, sf_dir):
    return stats.top_rows(fx.stats_now(spark, sf_dir)).select(
        "video_id", "model_id", "total_likes", "total_comments"
    )


@query
def top_video_comments(spark, sf_dir):
    rows = fx.by_label(fx.comments_plain(spark, sf_dir))
    picked = stats.comments_of_top(rows, fx.stats_now(spark, sf_dir))
    return picked.select("comment_id", "video_id", "model_id", "sentiment_label", "likes")


# --- videos --------------------------------------------------------------------------------------


@query
def active_videos(spark, sf_dir):
    return videos.active_with_total(fx.videos_raw(spark, sf_dir), fx.stats_first(spark, sf_dir))


@query
def active_videos_fanout(spark, sf_dir):
    return videos.active_with_total(
        fx.videos_raw(spark, sf_dir), fx.stats_first(spark, sf_dir), fanout=True
    )


@query
def platform_counts(spark, sf_dir):
    active = videos.active(fx.videos_raw(spark, sf_dir)).select("video_id", "channel_id")
    return videos.with_platform_count(active, fx.platform_counts(spark, sf_dir))


@query
def video_lifecycle(spark, sf_dir):
    first = fx.stats_first(spark, sf_dir)
    active = videos.active_with_total(fx.videos_raw(spark, sf_dir), first)
    decided = videos.decide(active, fx.platform_counts(spark, sf_dir), fx.AS_OF)
    return decided.join(comments.last_sync(first), "video_id", "left")


def _video_core(df):
    return df.withColumn("video_title", F.md5("video_title"))


@query
def disabled_videos(spark, sf_dir):
    pages = landed.comment_pages(spark, sf_dir)
    return _video_core(
        videos.deactivate(fx.videos_raw(spark, sf_dir), videos.disabled(pages))
    )


@query
def stamp_videos(spark, sf_dir):
    listed = fx.platform_counts(spark, sf_dir)
    return _video_core(videos.stamp_checked(fx.videos_raw(spark, sf_dir), listed, fx.AS_OF))


def _slots(spark, sf_dir, **how):
    info = fx.videos_raw(spark, sf_dir)
    limit = fx.events(spark, sf_dir).select("user_id").distinct().count()
    found = landing.flatten_search(landed.search_pages(spark, sf_dir))
    # every video is listed again on an older page
    older = F.col("published_at") - F.expr("interval 9 hours")
    found = found.union(found.withColumn("published_at", older).withColumn("title", F.lit("old")))
    slots = videos.free_slots(videos.active(info), limit)
    return info, videos.newest_found(found, slots, **how)


@query
def free_slots(spark, sf_dir):
    return _slots(spark, sf_dir)[1].withColumn("title", F.md5("title"))


@query
def free_slots_by_ranges(spark, sf_dir):
    """The same where more slots are free than one task should fill."""
    return _slots(spark, sf_dir, one_task=0)[1].withColumn("title", F.md5("title"))


@query
def register_videos(spark, sf_dir):
    info, added = _slots(spark, sf_dir)
    return _video_core(videos.register(info, added, fx.AS_OF))


@query
def upsert_videos(spark, sf_dir):
    old = fx.videos_raw(spark, sf_dir).withColumn("batch_id", F.lit(1))
    digits = F.substring("video_id", 2, 20).cast("bigint")
    new = (
        old.withColumn("channel_id", F.lit("ch7"))
        .withColumn("video_title", F.concat(F.lit("New "), F.col("video_title")))
        .withColumn("date_publication", F.when(digits % 2 == 0, fx.cut()))
        .withColumn("is_active", 1 - F.col("is_active"))
        .withColumn("last_checked_at", F.when(digits % 3 == 0, fx.cut()))
        .withColumn("video_title_sentiment", F.lit(None).cast("string"))
        .withColumn("batch_id", F.lit(2))
    )
    return _video_core(videos.merge(old.unionByName(new)))


@query
def upsert_channels(spark, sf_dir):
    nation = fx.table(spark, sf_dir, "nation")
    found = landing.flatten_search(landed.search_pages(spark, sf_dir))
    versions = nation.select(
        fx.text_id("ch", "n_nationkey").alias("channel_id"),
        F.col("n_name").alias("channel_name"),
        F.lit(1).alias("batch_id"),
    ).unionByName(found.select("channel_id", "channel_name", F.lit(2).alias("batch_id")))
    renamed = found.select(
        "channel_id", F.concat("channel_name", F.lit(" b")).alias("channel_name"), F.lit(2).alias("batch_id")
    )
    return videos.merge_channels(versions.unionByName(renamed))


@query
def titles_to_score(spark, sf_dir):
    return _video_core(videos.untitled(fx.videos_raw(spark, sf_dir)))


@query
def backfill_titles(spark, sf_dir):
    filled = scoring.backfill_titles(fx.videos_raw(spark, sf_dir), scoring.THREE_CLASS)
    return _video_core(filled)


# --- models --------------------------------------------------------------------------------------


def _registry(spark, sf_dir):
    """Two event types are registered; the others, and numbers, turn up in the events."""
    kinds = fx.events(spark, sf_dir).groupBy("event_type").count()
    known = kinds.where(F.col("event_type").isin("view", "click"))
    return known.select(
        F.when(F.col("event_type") == "view", 1).otherwise(5).alias("model_id"),
        F.col("event_type").alias("model_name"),
        fx.cut().alias("date_from"),
    )


def _identifier():
    number = (F.col("event_id") % 3 + 1).cast("string")
    return F.when(F.col("event_id") % 4 == 0, number).otherwise(F.col("event_type"))


@query
def model_registry(spark, sf_dir):
    known = _registry(spark, sf_dir)
    names = fx.events(spark, sf_dir).select(
        _identifier().alias("model_identifier"), F.col("event_id").alias("position")
    )
    return known.unionByName(registry.register(names, known, fx.AS_OF))


def _text_stats(spark, sf_dir):
    """Counters with text model identifiers, as older tables hold them."""
    return (
        fx.events(spark, sf_dir)
        .groupBy(fx.text_id("v", "user_id").alias("video_id"), _identifier().alias("model_id"))
        .agg(
            F.count(F.lit(1)).alias("pos_count"),
            F.count_if(F.col("value") > 10).alias("neg_count"),
            F.count_if(F.col("value") > 20).alias("neu_count"),
            F.sum(F.floor("value")).alias("total_likes"),
            F.count(F.lit(1)).alias("total_comments"),
            F.max("ts").alias("last_sync_date"),
            F.min("ts").alias("checked_at"),
            F.max("event_id").alias("row_order"),
        )
    )


@query
def migrate_model_ids(spark, sf_dir):
    return migrate.video_stats(
        _text_stats(spark, sf_dir), _registry(spark, sf_dir), "row_order", fx.AS_OF
    )[0]


@query
def migrate_snapshots(spark, sf_dir):
    old = (
        fx.events(spark, sf_dir)
        .groupBy(_identifier().alias("model_id"), F.to_date("ts").cast("timestamp").alias("snapshot_date"))
        .agg(
            *[F.count(F.lit(1)).alias(c) for c in ("total_positive", "total_comments")],
            F.count_if(F.col("value") > 10).alias("total_negative"),
            F.count_if(F.col("value") > 20).alias("total_neutral"),
            F.sum(F.floor("value")).alias("total_likes"),
            F.count_distinct("user_id").alias("total_videos"),
            F.max("event_id").alias("id"),
        )
    )
    return migrate.global_stats(old, _registry(spark, sf_dir), "id", fx.AS_OF)[0]


@query
def migrate_store(spark, sf_dir):
    """The migration job over counters with text ids and text times, some of them unreadable."""
    folder = scratch_dir(spark, "old")
    digits = F.substring("video_id", 2, 20).cast("bigint")
    checked = F.when(digits % 5 == 0, "unknown").otherwise(iso("checked_at"))
    old = _text_stats(spark, sf_dir).drop("row_order").withColumn("checked_at", checked)
    old.write.parquet(f"{folder}/video_stats")
    _registry(spark, sf_dir).write.parquet(f"{folder}/model_info")
    store = StateTables(spark, scratch_dir(spark, "state"))
    paths = {t: f"{folder}/{t}" for t in ("video_stats", "model_info")}
    jobs.migrate_job(spark, paths, store, fx.AS_OF)
    return store.current("video_stats")


@query
def align_schema(spark, sf_dir):
    old = fx.raw_comments(spark, sf_dir).select(
        "comment_id", "video_id", "comment_text", "likes", "published_at", "sentiment_label"
    )
    aligned = schemas.align(old, "raw_comments")
    return aligned.withColumn("comment_text", F.md5("comment_text"))


# --- scoring -------------------------------------------------------------------------------------


@query
def comments_by_model(spark, sf_dir):
    rows = fx.comments_raw(spark, sf_dir).select(
        "comment_id", "video_id", F.col("text").alias("comment_text")
    )
    scored = scoring.by_model(
        scoring.score(rows, scoring.BUILT_IN), {"three-class": 1, "five-star": 2}
    )
    return scored.drop("comment_text")


def _documents(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents").select("doc_id", "text")


@query
def lexicon_three_class(spark, sf_dir):
    rows = _documents(spark, sf_dir).withColumn("score", lexicon.balance(F.col("text")))
    raw = lexicon.three_class(F.col("score"))
    return rows.select("doc_id", raw.alias("raw_label"), normalize_label(raw).alias("mood"))


@query
def lexicon_five_star(spark, sf_dir):
    rows = _documents(spark, sf_dir).withColumn("score", lexicon.balance(F.col("text")))
    raw = lexicon.five_star(F.col("score"))
    return rows.select("doc_id", raw.alias("raw_label"), normalize_label(raw).alias("mood"))


def python_models(window: int | None = None) -> list[scoring.Model]:
    return [
        scoring.Model("py-three-class", factory=lexicon.three_class_scorer, window=window),
        scoring.Model("py-five-star", factory=lexicon.five_star_scorer, window=window),
    ]


def _scored(spark, sf_dir, models):
    scored = scoring.score(_documents(spark, sf_dir), models, "text").drop("text")
    return scoring.by_model(scored)


@query
def score_with_model(spark, sf_dir):
    return _scored(spark, sf_dir, python_models())


@query
def score_in_windows(spark, sf_dir):
    """Models that read 512 tokens at once, the input limit of the pretrained ones, over whole texts."""
    return _scored(spark, sf_dir, python_models(512))


@query
def score_with_failures(spark, sf_dir):
    """A model that raises on some texts and miscounts its answers for others."""
    model = scoring.Model("unsteady", factory=lexicon.unsteady_scorer, batch_size=1)
    return _scored(spark, sf_dir, [model])


@query
def score_copies_once(spark, sf_dir):
    rows = fx.comments_raw(spark, sf_dir).select("comment_id", "text")
    scored = scoring.score_copies_once(rows, python_models(), "comment_id", "text")
    return scoring.by_model(scored.drop("text"))


@query
def score_store(spark, sf_dir):
    """Every other comment is scored first; then all of them, of whose texts the store knows many by then. With
    ``scored`` how many texts each batch has scored by each model."""
    rows = fx.comments_raw(spark, sf_dir).select("comment_id", "event_id", "text")
    store = ScoreStore(spark, scratch_dir(spark, "scores"))
    models = python_models()
    store.score(rows.where(F.col("event_id") % 2 == 0), models, 1, "comment_id", "text")
    scored = scoring.by_model(store.score(rows, models, 2, "comment_id", "text").drop("text", "event_id"))
    runs = store.run_sizes()
    sizes = F.create_map(*[F.lit(x) for pair in sorted(runs.items()) for x in pair])
    first, second = (F.element_at(sizes, F.concat_ws("/", F.lit(n), "model_name")) for n in ("1", "2"))
    return scored.withColumns({"scored_first": first, "scored_second": second})


# --- annotation sample ---------------------------------------------------------------------------


def _frame(spark, sf_dir):
    return sampling.annotation_frame(fx.raw_comments(spark, sf_dir), fx.stats_now(spark, sf_dir))


def _hashed_text(df):
    return df.withColumn("comment_text", F.md5("comment_text"))


@query
def label_pivot(spark, sf_dir):
    return _hashed_text(comments.label_pivot(fx.raw_comments(spark, sf_dir)))


@query
def video_median_likes(spark, sf_dir):
    rows = fx.comments_plain(spark, sf_dir).select("comment_id", "video_id", "likes")
    return sampling.with_median(rows)


@query
def annotation_frame(spark, sf_dir):
    return _hashed_text(_frame(spark, sf_dir))


@query
def strata_counts(spark, sf_dir):
    return sampling.strata_counts(_frame(spark, sf_dir))


@query
def stratified_sample(spark, sf_dir):
    sample = sampling.stratified_sample(_frame(spark, sf_dir))
    return _hashed_text(sampling.annotation_sheet(sample))


@query
def sample_preview(spark, sf_dir):
    sample = sampling.annotation_sheet(sampling.stratified_sample(_frame(spark, sf_dir)))
    return _hashed_text(sampling.preview(sample))


@query
def annotation_sheet_job(spark, sf_dir):
    """The annotation job over stored versions; every fourth comment comes again under another video."""
    store = StateTables(spark, scratch_dir(spark, "state")).create()
    first = fx.raw_comments(spark, sf_dir)
    top = stats.top_rows(fx.stats_now(spark, sf_dir)).select("video_id").distinct()
    elsewhere = F.concat(F.lit("v"), (F.substring("video_id", 2, 20).cast("bigint") + 1).cast("string"))
    moved = first.where(F.col("event_id") % 4 == 0).withColumn("video_id", elsewhere)
    store.write("raw_comments", first, 1)
    store.write("raw_comments", moved.union(moved.join(top, "video_id", "left_semi").select(moved.columns)), 2)
    store.write("video_stats", fx.stats_now(spark, sf_dir), 1)
    target = scratch_dir(spark, "sheet")
    jobs.annotation_job(store, target)
    return _hashed_text(gold_file.read_gold(spark, target))


@query
def sample_fallback(spark, sf_dir):
    """More rows are asked for than there are, so the whole frame comes back."""
    asked = fx.events(spark, sf_dir).count() + 1
    return _hashed_text(sampling.stratified_sample(_frame(spark, sf_dir), size=asked))


# --- evaluation ----------------------------------------------------------------------------------


@query
def recode_annotations(spark, sf_dir):
    return fx.comments_plain(spark, sf_dir).select(
        "comment_id", recode_letter(F.col("human_code")).alias("human_sentiment")
    )


@query
def gold_complete(spark, sf_dir):
    return evaluation.complete_rows(fx.gold(spark, sf_dir))


@query
def label_columns(spark, sf_dir):
    models, human = evaluation.label_columns(fx.gold(spark, sf_dir).columns)
    used = fx.gold(spark, sf_dir)
    counted = [F.count(c).alias(c) for c in [*models, human]]
    return used.agg(*counted)


@query
def confusion_all_labels(spark, sf_dir):
    return evaluation.confusion_matrix(evaluation.complete_rows(fx.gold(spark, sf_dir)))


@query
def confusion_wide(spark, sf_dir):
    matrix = evaluation.confusion_matrix(evaluation.complete_rows(fx.gold(spark, sf_dir)))
    return evaluation.wide_matrix(matrix)


@query
def confusion_human_labels(spark, sf_dir):
    """Annotators who know two classes: predictions of the third one fall out."""
    human = F.col("human_sentiment")
    two = evaluation.complete_rows(fx.gold(spark, sf_dir)).withColumn(
        "human_sentiment", F.when(human == "neutral", "negative").otherwise(human)
    )
    return evaluation.confusion_matrix(two, labels="human")


@query
def classification_report(spark, sf_dir):
    report = evaluation.classification_report(evaluation.complete_rows(fx.gold(spark, sf_dir)))
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1_score")})


@query
def false_positives(spark, sf_dir):
    return evaluation.false_positives(fx.gold(spark, sf_dir))


@query
def false_negatives(spark, sf_dir):
    return evaluation.false_negatives(fx.gold(spark, sf_dir))


@query
def disagreement_counts(spark, sf_dir):
    return evaluation.contradiction_counts(fx.gold(spark, sf_dir))


@query
def disagreement_counts_file(spark, sf_dir):
    """The counts as the report's file holds them."""
    target = scratch_dir(spark, "report")
    export.write_contradictions(fx.gold(spark, sf_dir).withColumn("comment_text", F.lit("")), target)
    return spark.read.schema("false_positives long, false_negatives long").json(f"{target}/counts")


@query
def disagreement_report(spark, sf_dir):
    target = scratch_dir(spark, "report")
    export.write_contradictions(fx.annotated_gold(spark, sf_dir), target)
    schema = schemas.struct("comment_text STRING")
    parts = [
        gold_file.read_csv(spark, f"{target}/{kind}", schema).withColumn("kind", F.lit(kind))
        for kind in ("false_positives", "false_negatives")
    ]
    return _hashed_text(parts[0].unionByName(parts[1]))


# --- files ---------------------------------------------------------------------------------------


@query
def read_comment_pages(spark, sf_dir):
    folder = landed.write(spark, {"comments": landed.page_parts(spark, sf_dir)})
    flat = landing.flatten_comments(landing.read_pages(spark, folder, "comments"))
    ready = comments.prepare(flat).drop("sentiment_label")
    return _hashed_text(ready)


@query
def read_search_pages(spark, sf_dir):
    folder = landed.write(spark, {"search": landed.search_pages(spark, sf_dir)})
    found = landing.flatten_search(landing.read_pages(spark, folder, "search"))
    return found.withColumn("title", F.md5("title"))


@query
def read_count_pages(spark, sf_dir):
    folder = landed.write(spark, {"statistics": landed.count_pages(spark, sf_dir)})
    return landing.flatten_counts(landing.read_pages(spark, folder, "statistics"))


def _exported(spark, sf_dir, name, table, **rows):
    """One table of a snapshot that the export job has written from a store."""
    store = StateTables(spark, scratch_dir(spark, "state")).create()
    store.write("video_info", fx.videos_raw(spark, sf_dir), 1)
    for stored, df in rows.items():
        store.write(stored, df, 1)
    target = scratch_dir(spark, "export")
    jobs.export_job(store, target)
    return gold_file.read_csv(spark, f"{target}/{name}", schemas.struct(schemas.STATE[table]))


@query
def export_roundtrip(spark, sf_dir):
    rows = fx.raw_comments(spark, sf_dir)
    return _hashed_text(_exported(spark, sf_dir, "comments", "raw_comments", raw_comments=rows))


@query
def export_videos(spark, sf_dir):
    return _video_core(_exported(spark, sf_dir, "videos", "video_info"))


@query
def export_model_info(spark, sf_dir):
    names = fx.events(spark, sf_dir).select(
        _identifier().alias("model_identifier"), F.col("event_id").alias("position")
    )
    known = _registry(spark, sf_dir)
    models = known.unionByName(registry.register(names, known, fx.AS_OF))
    return _exported(spark, sf_dir, "model_info", "model_info", model_info=models)


@query
def export_global_sum(spark, sf_dir):
    models = spark.range(1, 4).select(F.col("id").cast("int").alias("model_id"))
    totals = stats.global_totals(fx.stats_now(spark, sf_dir), models)
    totals = totals.withColumn("snapshot_date", F.lit(fx.AS_OF).cast("timestamp"))
    return _exported(spark, sf_dir, "global_sum", "global_stats", global_stats=totals)


@query
def gold_roundtrip(spark, sf_dir):
    target = scratch_dir(spark, "gold")
    gold_file.write_sheet(fx.annotated_gold(spark, sf_dir), target)
    return _hashed_text(gold_file.read_gold(spark, target))


@query
def stream_cycle(spark, sf_dir):
    return landed.two_waves(spark, sf_dir, fresh=True).current("video_stats")


@query
def stream_videos(spark, sf_dir):
    return _video_core(landed.two_waves(spark, sf_dir).current("video_info"))


@query
def stream_snapshots(spark, sf_dir):
    return landed.two_waves(spark, sf_dir).current("global_stats")


@query
def stream_comments(spark, sf_dir):
    return _hashed_text(landed.two_waves(spark, sf_dir).current("raw_comments"))


@query
def stream_channels(spark, sf_dir):
    return landed.two_waves(spark, sf_dir).current("channel_info")


@query
def stream_models(spark, sf_dir):
    store = landed.two_waves(spark, sf_dir)
    models = store.current("model_info")
    used = store.current("raw_comments").groupBy("model_id").count()
    return models.join(used, "model_id").select("model_id", "model_name", "date_from", "count")


@query
def stream_split_waves(spark, sf_dir):
    """Stored comments where these and the other kinds of pages land in different batches."""
    return _hashed_text(landed.split_waves(spark, sf_dir).current("raw_comments"))


@query
def loadable_models(spark, sf_dir):
    """Labels by model over all comments, where one of the asked models does not load and is left out."""
    asked = [scoring.THREE_CLASS, scoring.Model("missing", factory=fx.unloadable), scoring.FIVE_STAR]
    usable = scoring.loadable(spark, asked)
    scored = scoring.by_model(scoring.score(fx.comments_raw(spark, sf_dir), usable, "text"))
    return scored.groupBy("model_name", "sentiment_label").agg(F.count("*").alias("n"))


@query
def snapshot_from_delta(spark, sf_dir):
    """Totals from the earlier ones and the second batch's delta alone."""
    first = fx.stats_first(spark, sf_dir)
    models = first.select("model_id").distinct()
    previous = stats.global_totals(first, models)
    delta = fx.deltas(spark, sf_dir).where(F.col("batch_id") == 2)
    return stats.totals_after(previous, delta, first, models)


def _marks(store: StateTables) -> DataFrame:
    rows = store.current("video_stats")
    return rows.select("video_id", "model_id", *stats.COUNTERS, "last_sync_date")


@query
def stream_found_again(spark, sf_dir):
    """Counters and marks where videos are found again between the landings of their comments."""
    return _marks(landed.found_again(spark, sf_dir))


@query
def stream_state_marks(spark, sf_dir):
    """The same from marks and waiting comments in the keyed state of the stream."""
    return _marks(landed.found_again(spark, sf_dir, keyed=True))


@query
def stream_late_comments(spark, sf_dir):
    """Counters and marks where earlier comments land after later ones, and some land again, changed or not."""
    return _marks(landed.late_waves(spark, sf_dir))


@query
def replayed_batch(spark, sf_dir):
    """A batch taken in twice leaves the counters of once, and the time of its first attempt."""
    return landed.repeated_batch(spark, sf_dir).current("video_stats")
