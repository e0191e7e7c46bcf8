"""Repair of state tables written with an older layout."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara import schemas
from opinara.functions import clean
from opinara.operators import registry
from opinara.runtime import cut_lineage


def names_in(table: DataFrame, order: str) -> DataFrame:
    """Model identifiers in a table with their first position."""
    return table.where(F.col("model_id").isNotNull()).groupBy(
        F.col("model_id").alias("model_identifier")
    ).agg(F.min(order).alias("position"))


def global_stats(
    table: DataFrame, model_info: DataFrame, order: str, as_of: datetime
) -> tuple[DataFrame, DataFrame]:
    """Text model ids to numbers; returns the table and the extended ``model_info``."""
    known = _extended(table, model_info, order, as_of)
    fixed = registry.resolve(table, "model_id", known)
    return schemas.align(fixed, "global_stats"), known


def video_stats(
    table: DataFrame, model_info: DataFrame, order: str, as_of: datetime
) -> tuple[DataFrame, DataFrame]:
    """The same for per-video counters; rows that now share a key collapse to the last one. An order
    that is a time kept as text is read as time."""
    if order in ("checked_at", "last_sync_date"):
        table = table.withColumn(order, clean.time_column(table, order))
    known = _extended(table, model_info, order, as_of)
    fixed = registry.resolve(table, "model_id", known)
    return schemas.align(_last_row(fixed, order), "video_stats"), known


def _extended(
    table: DataFrame, model_info: DataFrame, order: str, as_of: datetime
) -> DataFrame:
    """The registry with the table's new names: few rows, written so that later steps read them."""
    new = registry.register(names_in(table, order), model_info, as_of)
    return cut_lineage(model_info.unionByName(new))


def _last_row(table: DataFrame, order: str) -> DataFrame:
    """One row per key: the last by ``order``, equal or missing ones settled by the other columns.
    Rows without a model id never meet another row."""
    rest = [c for c in table.columns if c not in ("video_id", "model_id", order)]
    alone = F.when(F.col("model_id").isNull(), F.monotonically_increasing_id())
    return (
        table.withColumn("_alone", alone)
        .groupBy("video_id", "model_id", "_alone")
        .agg(F.max(F.struct(order, *rest)).alias("row"))
        .select("video_id", "model_id", "row.*")
    )
