"""Types of the state tables, the landed pages and the annotation file, and schema alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions import clean

# Table and column names are part of the data contract.
STATE = {
    "model_info": "model_id INT, model_name STRING, date_from TIMESTAMP",
    "channel_info": "channel_id STRING, channel_name STRING",
    "video_info": (
        "video_id STRING, channel_id STRING, video_title STRING, date_publication TIMESTAMP, "
        "is_active INT, last_checked_at TIMESTAMP, video_title_sentiment STRING"
    ),
    "raw_comments": (
        "comment_id STRING, model_id INT, video_id STRING, comment_text STRING, likes BIGINT, "
        "published_at TIMESTAMP, sentiment_label STRING, score_failed BOOLEAN"
    ),
    "video_stats": (
        "video_id STRING, model_id INT, video_title_sentiment STRING, pos_count BIGINT, "
        "neg_count BIGINT, neu_count BIGINT, total_likes BIGINT, total_comments BIGINT, "
        "last_sync_date TIMESTAMP, checked_at TIMESTAMP"
    ),
    "pending_comments": (
        "video_id STRING, comment_id STRING, text STRING, likes BIGINT, published_at STRING, "
        "updated_at STRING, landed_at TIMESTAMP, page_newest TIMESTAMP, position INT, "
        "pending_since TIMESTAMP"
    ),
    "watched_videos": "video_id STRING",
    "counted_comments": (
        "video_id STRING, comment_id STRING, model_id INT, sentiment_label STRING, likes BIGINT, text_digest STRING"
    ),
    "global_stats": (
        "model_id INT, snapshot_date TIMESTAMP, total_positive BIGINT, total_negative BIGINT, "
        "total_neutral BIGINT, total_likes BIGINT, total_videos BIGINT, total_comments BIGINT"
    ),
}

COMMENT_PAGE = (
    "video_id STRING, comments_disabled BOOLEAN, "
    "items ARRAY<STRUCT<id: STRING, snippet: STRUCT<topLevelComment: STRUCT<snippet: STRUCT<"
    "publishedAt: STRING, updatedAt: STRING, textDisplay: STRING, likeCount: BIGINT>>>>>, "
    "nextPageToken STRING"
)
SEARCH_PAGE = (
    "items ARRAY<STRUCT<id: STRUCT<kind: STRING, videoId: STRING>, snippet: STRUCT<"
    "title: STRING, channelId: STRING, channelTitle: STRING, publishedAt: STRING>>>"
)
COUNT_PAGE = "items ARRAY<STRUCT<id: STRING, statistics: STRUCT<commentCount: STRING>>>"

GOLD = (
    "`Unnamed: 0.1` INT, `Unnamed: 0` INT, video_id STRING, comment_id STRING, "
    "comment_text STRING, likes BIGINT, sentiment_model_1 STRING, sentiment_model_2 STRING, "
    "is_top BOOLEAN, pop_str STRING, strata STRING, human_sentiment STRING, is_sarcasm BOOLEAN"
)


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def align(df: DataFrame, table: str) -> DataFrame:
    """Bring an older layout of a state table to today's columns; what is missing or cannot be read
    becomes NULL."""
    types = {f.name: f.dataType for f in df.schema}

    def column(field: T.StructField):
        if field.name not in types:
            return F.lit(None).cast(field.dataType)
        if isinstance(types[field.name], T.StringType) and isinstance(field.dataType, T.TimestampType):
            return clean.to_time(F.col(field.name))
        return F.col(field.name).try_cast(field.dataType)

    return df.select(*[column(f).alias(f.name) for f in struct(STATE[table])])
