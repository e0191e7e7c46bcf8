"""Model names and their surrogate ids."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.operators import keyed

DIGITS = "^[0-9]+$"


def unseen(names: DataFrame, model_info: DataFrame) -> DataFrame:
    """Names that are neither numbers nor registered, each with its first position.

    ``names`` holds model_identifier and position. They are reduced to distinct names before
    anything else, so what follows handles one row per model.
    """
    return (
        names.where(~F.col("model_identifier").rlike(DIGITS))
        .groupBy(F.col("model_identifier").alias("model_name"))
        .agg(F.min("position").alias("position"))
        .join(model_info.select("model_name"), "model_name", "left_anti")
    )


def register(names: DataFrame, model_info: DataFrame, as_of: datetime) -> DataFrame:
    """New rows of ``model_info``: the next ids, in order of first appearance.

    The ranking runs over new model names only, a handful by nature.
    """
    used = model_info.agg(F.coalesce(F.max("model_id"), F.lit(0)).alias("used")).scalar()
    order = Window.orderBy("position", "model_name")
    return unseen(names, model_info).select(
        (F.row_number().over(order) + used).cast("int").alias("model_id"),
        "model_name",
        F.lit(as_of).cast("timestamp").alias("date_from"),
    )


def resolve(df: DataFrame, column: str, model_info: DataFrame) -> DataFrame:
    """Replace a text model identifier by its id; a digit string is that number, unchecked.

    Every row of a table names one of few models, so the registry is counted and broadcast.
    """
    names = model_info.select(F.col("model_name").alias(column), F.col("model_id").alias("_named"))
    spread = [c for c in df.columns if c != column]
    return (
        keyed.lookup(df, names, column, spread, small_rows=model_info.count())
        .withColumn(column, F.coalesce(_as_number(F.col(column)), F.col("_named")))
        .drop("_named")
    )


def _as_number(value: Column) -> Column:
    return F.when(value.rlike(DIGITS), value.try_cast("int"))
