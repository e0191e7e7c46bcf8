"""Offline jobs over the state tables and the annotated file."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from opinara import schemas
from opinara.operators import evaluation, migrate, sampling
from opinara.sources import export
from opinara.sources import gold as gold_file
from opinara.sources.state import StateTables


def annotation_job(
    store: StateTables,
    target: str,
    top: int = sampling.TOP_ROWS,
    size: int = sampling.SAMPLE_SIZE,
    seed: int = sampling.SEED,
) -> DataFrame:
    """Write the annotation sheet; returns its first rows as a preview."""
    frame = sampling.annotation_frame_of_versions(
        store.versions("raw_comments"), store.current("video_stats"), top
    )
    sample = sampling.stratified_sample(frame, size, seed)
    gold_file.write_sheet(sampling.annotation_sheet(sample), target)
    return sampling.preview(gold_file.read_gold(store.spark, target))


def migrate_job(
    spark: SparkSession,
    old: dict[str, str],
    store: StateTables,
    as_of: datetime,
    order: dict[str, str] | None = None,
) -> None:
    """Bring Parquet tables of an older layout, by name and path, into a new store as batch 0.

    Missing columns are added, text model ids become numbers. ``order`` names the column that tells
    the row order of a table whose ids are text.
    """
    order = {"global_stats": "id", "video_stats": "checked_at"} | (order or {})
    tables = {t: spark.read.parquet(path) for t, path in old.items()}
    empty = spark.createDataFrame([], schemas.struct(schemas.STATE["model_info"]))
    models = schemas.align(tables.get("model_info", empty), "model_info")
    repair = {"global_stats": migrate.global_stats, "video_stats": migrate.video_stats}
    for table, fix in repair.items():
        if table in tables and _has_text_ids(tables[table]):
            tables[table], models = fix(tables[table], models, order[table], as_of)
    for table, df in (tables | {"model_info": models}).items():
        store.write(table, df, 0)
    store.create()


def _has_text_ids(df: DataFrame) -> bool:
    return "model_id" in df.columns and isinstance(df.schema["model_id"].dataType, T.StringType)


def evaluation_job(spark: SparkSession, gold_path: str) -> dict[str, DataFrame]:
    """Classification report and both confusion matrices for every model column of the file."""
    complete = evaluation.complete_rows(gold_file.read_gold(spark, gold_path))
    return {
        "report": evaluation.classification_report(complete),
        "confusion_all_labels": evaluation.confusion_matrix(complete),
        "confusion_human_labels": evaluation.confusion_matrix(complete, labels="human"),
    }


def contradictions_job(
    spark: SparkSession, gold_path: str, target: str, letters: bool = False
) -> None:
    """Write the comments where both models contradict the human; ``letters`` recodes first."""
    gold = gold_file.read_gold(spark, gold_path)
    if letters:
        gold = evaluation.recode(gold)
    export.write_contradictions(gold, target)


def export_job(store: StateTables, target: str, gold_path: str | None = None) -> list[str]:
    """Write the publishable snapshot of the store, with the annotated file if there is one."""
    current = {t: store.current(t) for t in schemas.STATE if t in export.TABLES and store.has(t)}
    gold = gold_file.read_gold(store.spark, gold_path) if gold_path else None
    sources = [store.root, *([gold_path] if gold_path else [])]
    return export.export_snapshot(current, target, gold, sources)
