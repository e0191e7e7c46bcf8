"""Session settings, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession


# Codec of the tables that are written here: most of their bytes are texts, which it packs
# closer than the default one, above all where rows of several models repeat a text.
PACKED = "zstd"
# A stronger level and pages in which it sees more texts at once than in the default 1 MB.
PACKED_OPTIONS = {"compression": PACKED, "parquet.compression.codec.zstd.level": "6", "parquet.page.size": str(4 << 20)}


# Bytes of an Arrow batch that goes to Python, which holds one at a time: its default counts 10 000 rows or 64 MB.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


# Whether Spark removes the shuffle files of a statement at its end.
FILES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Tables written meanwhile leave no shuffle files behind. Without it they stay until the driver's JVM finds that
    nothing refers to them; a write is a statement of its own, of which nothing is read again."""
    before = spark.conf.get(FILES_GO, None)
    spark.conf.set(FILES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FILES_GO)
        else:
            spark.conf.set(FILES_GO, before)


def configure(spark: SparkSession) -> SparkSession:
    """All times are UTC, and batches of texts that go to Python are small unless the cluster says otherwise;
    everything else is left as the cluster set it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, "8m")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    A local run without that setting gets a temporary folder. On a cluster the setting is
    required, because a machine-local folder is lost with its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="opinara-")
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder below the shared root."""
    return f"{shared_root(spark)}/opinara-scratch/{name}-{uuid.uuid4().hex}"


def packed(df: DataFrame) -> DataFrameWriter:
    """Writer of a Parquet table that packs texts closely and replaces what is there."""
    return df.write.mode("overwrite").options(**PACKED_OPTIONS)


def cut_lineage(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a frame that is used several times to the shared folder and read it from there.

    A written table outlives its executors, is computed once, and each later use reads only the
    columns it needs. Without ``folder`` a new one below the scratch folder is taken.
    """
    spark = df.sparkSession
    folder = folder or scratch_dir(spark, "table")
    with shuffles_go(spark):
        packed(df).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def clear(spark: SparkSession, folder: str) -> None:
    """Remove a folder and all that lies below it, on whatever storage it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def let_go(spark: SparkSession) -> None:
    """Have shuffle files of ended jobs removed now. Spark does so once the driver's JVM has found that nothing refers
    to them, which may take until its periodic collection (``spark.cleaner.periodicGC.interval``, 30 minutes)."""
    gc.collect()
    spark._jvm.System.gc()


def _on_storage(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def list_folder(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, but for hidden ones; none where there is no folder."""
    target, system = _on_storage(spark, folder)
    if not system.exists(target):
        return []
    names = [entry.getPath().getName() for entry in system.listStatus(target)]
    return [name for name in names if not name.startswith(("_", "."))]


def read_small(spark: SparkSession, path: str) -> str | None:
    """Text of a small file, None where there is none."""
    target, system = _on_storage(spark, path)
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_small(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place in one step: written beside its place, then renamed."""
    folder, name = path.rsplit("/", 1)
    target, system = _on_storage(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = system.create(beside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    system.delete(target, False)
    if not system.rename(beside, target):
        raise OSError(f"{path} could not be put in place")


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether a folder was written to the end."""
    done, system = _on_storage(spark, f"{folder}/_SUCCESS")
    return system.exists(done)


def write_once(df: DataFrame, folder: str) -> None:
    """Write JSON rows to a folder unless that has been done to the end before."""
    if not is_complete(df.sparkSession, folder):
        with shuffles_go(df.sparkSession):
            df.write.mode("overwrite").json(folder)


def overlap(one: str, other: str) -> bool:
    """Whether one of two folders is the other or lies within it."""
    a, b = (f"{p.removeprefix('file:').rstrip('/')}/".replace("///", "/") for p in (one, other))
    return a.startswith(b) or b.startswith(a)
