"""Joins and rankings by a key of which one value may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.runtime import cut_lineage

# A hot key is spread over this many parts. Copies of the small side stay narrow, and AQE can split
# what is still uneven, since no later step relies on the salted partitioning.
SALTS = 16

# Rows of a side that may be broadcast: about 10 MB of narrow rows.
BROADCAST_ROWS = 100_000


def salt(spread: str | Sequence[str]) -> Column:
    names = [spread] if isinstance(spread, str) else list(spread)
    return F.pmod(F.xxhash64(*names), F.lit(SALTS)).cast("int")


def lookup(
    big: DataFrame,
    small: DataFrame,
    on: str,
    spread: str | Sequence[str],
    how: str = "left",
    small_rows: int | None = None,
) -> DataFrame:
    """Join rows to a frame with one row per key.

    ``small_rows`` is a proven upper bound on ``small``; within the limit it is broadcast. Without
    one, both sides are salted, so that the rows of a hot key land in many tasks.
    """
    if small_rows is not None and small_rows <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), on, how)
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return big.withColumn("_salt", salt(spread)).join(copies, [on, "_salt"], how).drop("_salt")


def by_repetition(
    df: DataFrame, keys: Sequence[str], counted: DataFrame | None = None, folder: str | None = None
) -> tuple[DataFrame, DataFrame] | None:
    """Rows whose key comes once, and rows of keys that come again; None where the latter are too many to be broadcast.

    Keys are counted over narrow rows, of ``counted`` if not all rows matter, and those that come again are written
    (to ``folder``) at once: ``df`` is evaluated here with the columns of its keys alone.
    """
    named = [F.col(k).alias(f"_{k}") for k in keys]
    rows = (df if counted is None else counted).groupBy(*named).agg(F.count(F.lit(1)).alias("_n"))
    again = cut_lineage(rows.where(F.col("_n") > 1).drop("_n"), folder)
    if again.count() > BROADCAST_ROWS:
        return None
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return df.join(F.broadcast(again), same, "left_anti"), df.join(F.broadcast(again), same, "left_semi")


def top_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    spread: str | Sequence[str],
    rank: str = "rn",
) -> DataFrame:
    """The first ``n`` rows per key, ranked.

    Ranked within salted parts first, so at most ``n`` rows per part of a hot key meet in one task;
    the literal bound lets Spark cut each map partition before its shuffle (WindowGroupLimit).
    """
    parts = Window.partitionBy(*keys, "_salt").orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_salt", salt(spread))
        .withColumn("_part_rank", F.row_number().over(parts))
        .where(F.col("_part_rank") <= n)
        .drop("_salt", "_part_rank")
        .withColumn(rank, F.row_number().over(whole))
        .where(F.col(rank) <= n)
    )


def last_filled(value: str, order: str) -> Column:
    """Aggregate: the last non-NULL value by ``order``, the largest of equally late ones."""
    return F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(order, value))).alias(value)


def last(value: str, order: str) -> Column:
    """Aggregate: the value of the last row by ``order``, NULL or not, the largest of equally late ones."""
    return F.max_by(value, F.struct(order, value)).alias(value)
