"""What the text operators share: reading tables, row keys, splits of labelled rows, byte batches."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key() -> Column:
    """Key of a document row: equal for rows that repeat both id and text, else different.

    64 bits: among 3e10 rows some 25 pairs are expected to share a key.
    """
    return F.xxhash64("doc_id", F.lit("|"), F.col("text").isNull(), "text")


def remainder(parts: int) -> Column:
    """crc32 of the id as text, modulo parts; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % parts


def text_bytes() -> Column:
    """The text as UTF-8 bytes, empty when missing."""
    return F.coalesce(F.col("text"), F.lit("")).cast("binary")


def byte_chunks(values: pa.Array | list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Cut a column of bytes into runs of rows that hold about limit bytes (one row at least).

    Yields the first row's number and the values. Whatever the batch size, arrays made from a run
    stay small; a single long text is a run of its own.
    """
    run: list[bytes] = []
    first = size = 0
    for i, value in enumerate(values):
        data = (value if isinstance(value, bytes) else value.as_py()) or b""
        if run and size + len(data) > limit:
            yield first, run
            run, first, size = [], i, 0
        run.append(data)
        size += len(data)
    if run:
        yield first, run


def trimmed(read: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A reader for mapInArrow that gives freed memory back to the machine once its rows are out: workers are kept
    for later tasks, and wait beside those at work."""

    @functools.wraps(read)
    def run(*given):
        yield from read(*given)
        for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
            pool.release_unused()

    return run


def collect_arrays(df: DataFrame) -> dict[str, np.ndarray]:
    """A bounded table of numbers on the driver: each batch comes as the bytes of its columns, not as
    rows of objects."""
    kinds = {"int": np.int32, "bigint": np.int64, "double": np.float64}
    types = {name: kinds[kind] for name, kind in df.dtypes}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [c.to_numpy(False).astype(t).tobytes() for c, t in zip(batch.columns, types.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.binary()) for d in data], names=list(types))

    rows = df.mapInArrow(pack, ", ".join(f"`{c}` binary" for c in types)).collect()
    return {c: np.frombuffer(b"".join(r[c] for r in rows), t) for c, t in types.items()}


def as_list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(offsets.astype(np.int32)), pa.array(values).cast(kind)
    )
