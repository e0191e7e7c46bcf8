"""Publishable snapshot of the tables and the report of contradictions."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame

from opinara.operators import evaluation
from opinara.runtime import clear, overlap
from opinara.sources import gold as gold_file

# Codec of the published files (`*.csv.gz`): a comment's text stands in the row of each model, and no file could be
# read in parts without it either.
PACKED = "gzip"

log = logging.getLogger(__name__)

# Published names of the tables.
REQUIRED = {"videos": "video_info", "comments": "raw_comments"}
OPTIONAL = {"global_sum": "global_stats", "model_info": "model_info"}
TABLES = {*REQUIRED.values(), *OPTIONAL.values()}


def export_snapshot(
    tables: dict[str, DataFrame],
    target: str,
    gold: DataFrame | None = None,
    sources: Sequence[str] = (),
) -> list[str]:
    """One folder of packed CSV files per table below ``target``; folders of these names are replaced or, if their
    table is gone, removed, and nothing else is touched.

    ``tables`` maps state table names to frames, ``sources`` are the folders they are read from: a
    target that overlaps one is refused. Missing optional tables are skipped with a warning; a missing
    required one is an error. Returns the names written.
    """
    absent = [t for t in REQUIRED.values() if t not in tables]
    if absent:
        raise ValueError(f"required tables missing: {', '.join(absent)}")
    for source in sources:
        if overlap(target, source):
            raise ValueError(f"target {target} overlaps {source}")
    written = []
    for name, table in {**REQUIRED, **OPTIONAL}.items():
        if table not in tables:
            log.warning("skipped %s: no table %s", name, table)
            continue
        gold_file.write_csv(tables[table], f"{target}/{name}", PACKED)
        written.append(name)
    if gold is not None:
        gold_file.write_csv(gold, f"{target}/manual_annotation")
        written.append("manual_annotation")
    spark = next(iter(tables.values())).sparkSession
    for name in {*REQUIRED, *OPTIONAL, "manual_annotation"} - set(written):
        clear(spark, f"{target}/{name}")
    return written


def write_contradictions(gold: DataFrame, target: str) -> None:
    """Counts and texts of false positives and false negatives below ``target``."""
    evaluation.contradiction_counts(gold).write.mode("overwrite").json(f"{target}/counts")
    for kind in ("false_positives", "false_negatives"):
        rows = getattr(evaluation, kind)(gold).select("comment_text")
        gold_file.write_csv(rows, f"{target}/{kind}")
