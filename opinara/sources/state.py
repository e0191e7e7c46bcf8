"""The state tables, kept as runs per batch and read through commit records.

A batch writes its rows to folders of its own and, when all of them are written, one commit record: a small file, put
in place in one step, that names the batch and the runs the tables consist of. Readers go by the newest record,
so they see finished batches only, whole or not at all, also while a batch runs or after one has died. Jobs of
batch N go by the newest record before N, so a repeated batch sees the same state and leaves the same tables.

Videos, counters and what was counted, which cycles read again, lie in buckets by the hash of their video. A run has a folder
per bucket it touches, and a bucket that has gathered more than a few runs is folded into one when a batch that
touches it is committed. So a batch reads the buckets of its own videos, a bounded number of runs each, and what
it costs depends on the size of these buckets and not on how many batches there have been. The other tables are
only added to: ``<table>/batch_id=N``. Nothing is rewritten in place; what no kept record names can be removed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara import schemas
from opinara.operators import comments, corrections, stats, videos
from opinara.runtime import clear, list_folder, packed, read_small, replace_small, shuffles_go

# Tables in buckets, by the column that decides. The number of buckets is fixed when a store is made.
BUCKETED = {"video_info": "video_id", "video_stats": "video_id", "counted_comments": "video_id"}
BUCKETS = 8
# A bucket with more runs is folded.
RUNS = 4
# Tables of which each batch writes all that holds after it.
LATEST = ("pending_comments", "watched_videos")

CURRENT = {
    "model_info": lambda versions: versions.drop("batch_id"),
    "channel_info": videos.merge_channels,
    "video_info": videos.merge,
    "raw_comments": comments.merge_stored,
    "video_stats": stats.merge,
    "global_stats": lambda versions: versions.drop("batch_id"),
    "pending_comments": lambda versions: versions.drop("batch_id"),
    "watched_videos": lambda versions: versions.drop("batch_id"),
    "counted_comments": corrections.merge,
}


class StateTables:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        """``buckets`` counts for a new store only; an older one keeps its number."""
        self.spark = spark
        self.root = root.rstrip("/")
        self._asked = buckets

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def create(self) -> StateTables:
        """Make the tables that are missing, empty; those that exist are left alone."""
        for table, ddl in schemas.STATE.items():
            if table not in BUCKETED:
                empty = self.spark.createDataFrame([], schemas.struct(ddl))
                empty.write.mode("ignore").parquet(f"{self.path(table)}/batch_id=0")
        if self.record() is None:
            self._put({"batch": 0, "buckets": self._asked, "runs": {t: {} for t in BUCKETED}})
        return self

    def has(self, table: str) -> bool:
        """Whether the table was ever made; it may be empty."""
        if table in BUCKETED:
            return self.record() is not None
        return any(name.startswith("batch_id=") for name in list_folder(self.spark, self.path(table)))

    # --- commit records ---------------------------------------------------------------------------

    def record(self, before: int | None = None) -> dict | None:
        """The newest commit record, or the newest one ahead of a batch."""
        numbers = [int(name.removesuffix(".json")) for name in list_folder(self.spark, f"{self.root}/_commits")]
        numbers = [n for n in numbers if before is None or n < before]
        return json.loads(read_small(self.spark, self._record_path(max(numbers)))) if numbers else None

    def _record_path(self, batch_id: int) -> str:
        return f"{self.root}/_commits/{batch_id:012}.json"

    def _put(self, record: dict) -> None:
        replace_small(self.spark, self._record_path(record["batch"]), json.dumps(record))

    def _known(self, before: int | None = None) -> dict:
        return self.record(before) or {"batch": -1, "buckets": self._asked, "runs": {t: {} for t in BUCKETED}}

    def commit(self, batch_id: int, counted: bool = False) -> None:
        """Make all that a batch has written visible at once; buckets with many runs are folded first.

        ``counted`` says that the batch wrote down what it counted. Where the batch before did not, it wrote all
        that was ever counted, and older runs are done with.
        """
        record = self._known(batch_id)
        if not (counted and self.follows_counted(batch_id)):
            record["runs"]["counted_comments"] = {}
        for table in BUCKETED:
            self._add_run(record, table, batch_id)
            self._fold(record, table, batch_id)
        self._put({**record, "batch": batch_id, "cycle": batch_id, "counted": batch_id if counted else None})

    def follows_cycle(self, batch_id: int) -> bool:
        """Whether what is stored ahead of a batch was committed whole by the batch before it, and not added to
        since: its list of watched videos and its totals then hold."""
        record = self._known(batch_id)
        return record["batch"] > 0 and record.get("cycle") == record["batch"]

    def follows_counted(self, batch_id: int) -> bool:
        """Whether the rows of what was counted are complete ahead of a batch."""
        return self.follows_cycle(batch_id) and self._known(batch_id).get("counted") == self._known(batch_id)["batch"]

    def _add_run(self, record: dict, table: str, batch_id: int) -> None:
        """Name the batch's run in every bucket that it touches."""
        run, runs = f"{batch_id:012}", record["runs"].setdefault(table, {})
        for folder in list_folder(self.spark, f"{self.path(table)}/{run}"):
            if folder.startswith("bucket="):
                named = runs.setdefault(folder.removeprefix("bucket="), [])
                if run not in named:
                    named.append(run)

    def _fold(self, record: dict, table: str, batch_id: int) -> None:
        """Merge the runs of buckets that have too many into one run for each, in one job for all."""
        run, runs = f"{batch_id:012}-folded", record["runs"][table]
        full = [bucket for bucket, named in runs.items() if len(named) > RUNS]
        if not full:
            return
        merged = CURRENT[table](self._read(table, [f"{r}/bucket={b}" for b in full for r in runs[b]]))
        self._write_buckets(table, merged, batch_id, run, record["buckets"])
        for bucket in full:
            runs[bucket] = [run]

    def expire(self, keep: int = 2) -> None:
        """Remove records older than the newest ``keep``, and runs and pending rows that no kept one names. Readers
        that began with a removed record lose their files."""
        numbers = sorted(int(n.removesuffix(".json")) for n in list_folder(self.spark, f"{self.root}/_commits"))
        kept = [json.loads(read_small(self.spark, self._record_path(n))) for n in numbers[-keep:]]
        for n in numbers[:-keep]:
            clear(self.spark, self._record_path(n))
        for table in BUCKETED:
            named = {r for record in kept for runs in record["runs"].get(table, {}).values() for r in runs}
            for run in list_folder(self.spark, self.path(table)):
                # a run beyond the newest record belongs to a batch that has not finished
                if run not in named and int(run.split("-")[0]) <= numbers[-1]:
                    clear(self.spark, f"{self.path(table)}/{run}")
        for table in LATEST:
            for folder in list_folder(self.spark, self.path(table)):
                if folder.startswith("batch_id=") and int(folder.removeprefix("batch_id=")) < kept[0]["batch"]:
                    clear(self.spark, f"{self.path(table)}/{folder}")

    # --- reading ----------------------------------------------------------------------------------

    def versions(self, table: str, before: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """Committed rows with their ``batch_id``; of a table in buckets those of some buckets alone."""
        record = self._known(before)
        if table in BUCKETED:
            runs = record["runs"].get(table, {})
            wanted = runs if buckets is None else [str(b) for b in buckets if str(b) in runs]
            return self._read(table, [f"{run}/bucket={b}" for b in wanted for run in runs[b]])
        schema = schemas.struct(schemas.STATE[table] + ", batch_id BIGINT")
        rows, batch = self.spark.read.schema(schema).parquet(self.path(table)), F.col("batch_id")
        return rows.where(batch == record["batch"]) if table in LATEST else rows.where(batch <= record["batch"])

    def _read(self, table: str, runs: list[str]) -> DataFrame:
        schema = schemas.struct(schemas.STATE[table] + ", batch_id BIGINT")
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path(table)}/{run}" for run in runs])

    def current(self, table: str, before: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table as it stands, or as it stood ahead of a batch."""
        merged = CURRENT[table](self.versions(table, before, buckets))
        return schemas.align(merged, table)

    def batch(self, table: str, batch_id: int) -> DataFrame:
        """Rows of one batch, committed or not; the folders of the others are not even listed."""
        schema = schemas.struct(schemas.STATE[table] + ", batch_id BIGINT")
        if table in BUCKETED:
            return self.spark.read.schema(schema).parquet(f"{self.path(table)}/{batch_id:012}").drop("bucket")
        reader = self.spark.read.schema(schema).option("basePath", self.path(table))
        return reader.parquet(f"{self.path(table)}/batch_id={batch_id}")

    def buckets_of(self, video_ids: DataFrame) -> list[int]:
        """The buckets that hold some videos; no more numbers than there are buckets come back."""
        n = self._known()["buckets"]
        return sorted(r[0] for r in video_ids.select(_bucket("video_id", n).alias("b")).distinct().collect())

    # --- writing ----------------------------------------------------------------------------------

    def write(self, table: str, rows: DataFrame, batch_id: int, commit: bool = True) -> None:
        """Store a batch's rows; a second write of the same batch replaces the first. Without ``commit`` they are
        seen once the batch is committed."""
        rows, record = schemas.align(rows, table), self._known()
        if table in BUCKETED:
            self._write_buckets(table, rows, batch_id, f"{batch_id:012}", record["buckets"])
        else:
            with shuffles_go(self.spark):
                packed(rows).parquet(f"{self.path(table)}/batch_id={batch_id}")
        if commit:
            if table in BUCKETED:
                self._add_run(record, table, batch_id)
            self._put({**record, "batch": max(record["batch"], batch_id), "cycle": None})

    def _write_buckets(self, table: str, rows: DataFrame, batch_id: int, run: str, n: int) -> None:
        placed = schemas.align(rows, table).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        placed = placed.withColumn("bucket", _bucket(BUCKETED[table], n))
        # a row per comment: one video may hold most of a bucket, which adaptive execution then splits
        placed = placed.hint("rebalance", "bucket") if table == "counted_comments" else placed.repartition("bucket")
        with shuffles_go(self.spark):
            packed(placed).partitionBy("bucket").parquet(f"{self.path(table)}/{run}")

    def pending(self, batch_id: int) -> DataFrame:
        """Comments that the batch before this one left for later; each batch hands on what is still
        open, so older ones are done with."""
        return self.versions("pending_comments", batch_id).drop("batch_id")

    def batch_time(self, batch_id: int, asked: datetime) -> datetime:
        """The time of a batch: as asked at its first attempt, then the same for every repeat."""
        path, start = f"{self.root}/_times/{batch_id:012}.json", datetime.fromtimestamp(0, timezone.utc)
        kept = read_small(self.spark, path)
        if kept is None:
            aware = asked.astimezone(timezone.utc) if asked.tzinfo else asked.replace(tzinfo=timezone.utc)
            replace_small(self.spark, path, json.dumps((aware - start) // timedelta(microseconds=1)))
            return asked
        return start + timedelta(microseconds=json.loads(kept))

    def last_batch(self) -> int:
        """The newest batch whose cycle came to its end."""
        return max(self._known()["batch"], 0)

    def work(self, batch_id: int, name: str = "") -> str:
        """Folder for what a batch writes for itself; it is cleared when the batch is done."""
        return f"{self.root}/_work/batch-{batch_id}/{name}".rstrip("/")

    def compact(self, target: str, upto: int) -> StateTables:
        """Fold all versions up to a batch into one below a new root, for jobs to go on from."""
        folded = StateTables(self.spark, target)
        for table in schemas.STATE:
            rows = self.current(table, upto + 1)
            if table == "raw_comments":
                # Near together by video, so that files without a wanted video can be skipped; the
                # comment id splits a video that is too large for one file.
                rows = rows.repartitionByRange("video_id", "comment_id").sortWithinPartitions(
                    "video_id", "comment_id"
                )
            folded.write(table, rows, upto)
        return folded


def _bucket(key: str, n: int):
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
