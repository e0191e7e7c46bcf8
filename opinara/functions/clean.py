"""Normalisation of raw comment fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what counts as a readable time. Without it Spark would take '2024' for 1 January
# and '12:00' for today.
TIME_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)


def to_time(value: Column) -> Column:
    """Text time to TIMESTAMP: ISO, extended or basic, with ``Z``, offset or none (= UTC), with ``T`` or
    a blank; else NULL."""
    dashed = F.regexp_replace(value, r"^(\d{4})(\d{2})(\d{2})(?=[T ]|$)", r"$1-$2-$3")
    timed = F.regexp_replace(dashed, r"([T ]\d{2})(\d{2})(\d{2})(?=[.Z+-]|$)", r"$1:$2:$3")
    timed = F.regexp_replace(timed, r"([T ]\d{2})(\d{2})(?=[Z+-]|$)", r"$1:$2")
    full = F.regexp_replace(timed, r"([T ]\d{2})(?=Z|[+-]|$)", r"$1:00")
    full = F.regexp_replace(full, r"([T ]\d{2}:\d{2})(?=Z|[+-])", r"$1:00")
    zoned = F.regexp_replace(full, r"([T ].*[+-]\d{2})(\d{2})$", r"$1:$2")
    zoned = F.regexp_replace(zoned, r"([T ].*[+-]\d{2})$", r"$1:00")
    return F.when(timed.rlike(TIME_PATTERN), F.try_to_timestamp(zoned))


def time_column(df: DataFrame, name: str) -> Column:
    """A time column as TIMESTAMP, whether it comes as text or already typed."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return to_time(F.col(name))
    return F.col(name).cast("timestamp")


def like_count(value: Column) -> Column:
    """Likes as BIGINT, decimals cut off; missing and unreadable ones are 0."""
    return F.coalesce(value.try_cast("decimal(38,6)").try_cast("bigint"), F.lit(0).cast("bigint"))


def first_filled(df: DataFrame, *names: str, default: str | None = None) -> Column:
    """First of the columns that exist and hold a non-empty text, else the default."""
    present = [F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in df.columns]
    return F.coalesce(*present, F.lit(default).cast("string"))


def edited(df: DataFrame) -> Column:
    """Published and updated times differ; a missing time on either side counts as different."""
    if "updated_at" not in df.columns:
        return F.lit(False)
    differ = time_column(df, "published_at") != time_column(df, "updated_at")
    return F.coalesce(differ, F.lit(True))


def age_days(as_of: Column, published: Column) -> Column:
    """Whole days passed, rounded down; calendar midnights do not matter."""
    seconds = F.unix_micros(as_of) - F.unix_micros(published)
    return F.floor(seconds / F.lit(86_400_000_000)).cast("int")
