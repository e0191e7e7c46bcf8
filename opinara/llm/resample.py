"""Importance resampling: draw the documents whose hashed features look most like a target's texts.

Features are runs of consecutive words, hashed with CRC-32 into buckets. A bucket's gain is the log ratio of
its share in the target and in the documents, a document's weight is the sum of the gains of its features, and
the highest weights with Gumbel noise are a draw without replacement.

All spans of a run of texts are hashed at once. CRC-32 without its initial state is linear over XOR, so a byte
contributes a value that depends on the byte and on its distance from the end of its span alone. These values
stand in a table by position; the checksum of a span is the XOR of its bytes' values and of a constant of its
length. Spans beyond the table are folded in blocks, each block's value moved over the bytes behind it.

Missing and empty texts have no features: weight 0 and, with a positive `min_words`, never drawn. Repeated rows
each count and may each be drawn. An empty table gives an empty result; a target without words gives gains by
the documents alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import byte_chunks, collect_arrays, text_bytes
from opinara.runtime import cut_lineage

SPAN = 64  # bytes that the table by position covers
SLICE = 1 << 20  # bytes that are looked up at a time
# Fixed value: the reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
ONES = np.uint32(0xFFFFFFFF)

_byte = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _byte = np.where(_byte & 1, (_byte >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), _byte >> np.uint32(1))


def one_byte_on(state: np.ndarray) -> np.ndarray:
    """Checksum states moved over one zero byte."""
    return (state >> np.uint32(8)) ^ _byte[state & np.uint32(255)]


def position_table() -> np.ndarray:
    """[distance from the end, byte]: what the byte adds to a checksum."""
    rows = [_byte]
    for _ in range(SPAN - 1):
        rows.append(one_byte_on(rows[-1]))
    return np.stack(rows)


class Shift:
    """Moving states over a fixed number of zero bytes: a linear map, kept as four tables by byte."""

    def __init__(self, bits: np.ndarray):
        """`bits`: the images of the 32 single bits."""
        self.bits = bits
        set_bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
        self.tables = [
            np.bitwise_xor.reduce(np.where(set_bits == 1, bits[8 * k : 8 * k + 8], np.uint32(0)), axis=1) for k in range(4)
        ]

    def __call__(self, state: np.ndarray) -> np.ndarray:
        out = self.tables[0][state & np.uint32(255)]
        for k in range(1, 4):
            out = out ^ self.tables[k][(state >> np.uint32(8 * k)) & np.uint32(255)]
        return out

    def twice(self) -> Shift:
        return Shift(self(self.bits))


BY_POSITION = position_table().ravel()
SHIFTS = [Shift(one_byte_on(np.uint32(1) << np.arange(32, dtype=np.uint32)))]  # over 1, 2, 4, ... bytes


def moved(state: np.ndarray, count: np.ndarray, first: int) -> np.ndarray:
    """States moved over count * 2**first zero bytes each."""
    state, level = state.copy(), first
    while count.any():
        while len(SHIFTS) <= level:
            SHIFTS.append(SHIFTS[-1].twice())
        odd = (count & 1).astype(bool)
        state[odd] = SHIFTS[level](state[odd])
        count, level = count >> 1, level + 1
    return state


# what the length alone adds, for the lengths of the table
BY_LENGTH = moved(np.full(SPAN + 1, ONES), np.arange(SPAN + 1), 0) ^ ONES


def crc32_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of data[start:end] for every span; spans may overlap, none is empty."""
    lengths = ends - starts
    blocks = -(-lengths // SPAN)
    span = np.repeat(np.arange(len(starts)), blocks)
    first_block = np.cumsum(blocks) - blocks
    behind = np.arange(len(span)) - first_block[span]  # whole blocks between this one and the span's end
    block_ends = ends[span] - behind * SPAN
    block_sizes = np.minimum(SPAN, block_ends - starts[span])
    reach = np.cumsum(block_sizes)
    values = np.empty(len(span), np.uint32)
    at = 0
    while at < len(span):
        done = reach[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(reach, done + SLICE, "right")))
        sizes = block_sizes[at:stop]
        begins = np.cumsum(sizes) - sizes
        distance = np.repeat(begins + sizes, sizes) - 1 - np.arange(int(sizes.sum()))
        byte = data[np.repeat(block_ends[at:stop], sizes) - 1 - distance]
        values[at:stop] = np.bitwise_xor.reduceat(BY_POSITION[distance * 256 + byte], begins)
        at = stop
    long = lengths > SPAN
    constant = BY_LENGTH[np.minimum(lengths, SPAN)]
    if long.any():
        values = moved(values, behind, SPAN.bit_length() - 1)
        values = np.bitwise_xor.reduceat(values, first_block)
        constant[long] = moved(np.full(int(long.sum()), ONES), lengths[long], 0) ^ ONES
    return values ^ constant


# Word bytes: digits, letters after lowering, and every byte of a character beyond ASCII.
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_word_byte = np.zeros(256, bool)
_word_byte[48:58] = _word_byte[97:123] = _word_byte[128:] = True


def features(texts: list[bytes], max_run: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, CRC-32) of every run of 1 to max_run words, in slices; the words of a run are
    joined by one space."""
    data = _lower[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    change = np.flatnonzero(np.diff(_word_byte[data], prepend=False, append=False))
    starts, ends = change[::2], change[1::2]
    if not len(starts):
        return
    borders = np.cumsum([len(t) + 1 for t in texts])
    owner = np.searchsorted(borders, starts, "right")
    if max_run > 1:
        sizes = ends - starts
        offset = np.cumsum(sizes + 1) - sizes - 1
        place = np.arange(int(sizes.sum() + len(sizes))) - np.repeat(offset, sizes + 1)
        last = place == np.repeat(sizes, sizes + 1)
        data = np.where(last, np.uint8(32), data[np.repeat(starts, sizes + 1) + place])
        starts, ends = offset, offset + sizes
    step = SLICE // 8
    for n in range(1, max_run + 1):
        for at in range(0, len(starts) - n + 1, step):
            to = min(at + step, len(starts) - n + 1)
            one = owner[at:to] == owner[at + n - 1 : to + n - 1]
            begins, stops = starts[at:to][one], ends[at + n - 1 : to + n - 1][one]
            if len(begins):
                yield owner[at:to][one], crc32_spans(data, begins, stops)


def bucket_counts(texts: DataFrame, name: str, max_run: int, buckets: int) -> DataFrame:
    """(bucket, name): how often the features of all texts fall into each bucket; counted within each task
    first, so at most `buckets` rows a task are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, run in byte_chunks(batch.column(0)):
                for _, crc in features(run, max_run):
                    total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int32()), "n": pa.array(total[some], pa.int64())})

    counted = texts.select(text_bytes().alias("t")).mapInArrow(count, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias(name))


def bucket_gains(docs: DataFrame, target: DataFrame, max_run: int, buckets: int) -> np.ndarray:
    """Per bucket floor(1000 * ln of its smoothed share in the target over that in the documents).

    The driver sees one row a bucket, whatever the size of the tables.
    """
    s, t = bucket_counts(docs, "s", max_run, buckets), bucket_counts(target, "t", max_run, buckets)
    both = s.join(t, "bucket", "full").select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t"))
    rows = collect_arrays(both)
    counts = {c: np.zeros(buckets, np.int64) for c in "st"}
    for c in "st":
        counts[c][rows["bucket"]] = rows[c]
    all_s, all_t = (float(counts[c].sum()) + buckets for c in "st")
    ratio = [(t + 1.0) * all_s / ((s + 1.0) * all_t) for s, t in zip(counts["s"].tolist(), counts["t"].tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, max_run: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document."""
    buckets = np.uint32(len(gains))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            found, weight, words = (np.zeros(n, np.int64) for _ in range(3))
            for first, texts in byte_chunks(batch.column(1)):
                for number, crc in features(texts, max_run):
                    np.add.at(weight, first + number, gains[crc % buckets])
                    np.add.at(found, first + number, 1)
                if max_run > 1:
                    for number, _ in features(texts, 1):
                        np.add.at(words, first + number, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, (words if max_run > 1 else found, found, weight))],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("t"))
    return narrow.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noisy(seed: str):
    """weight plus Gumbel noise in thousandths, drawn from a digest of seed and id; an id that is missing
    counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, order: list) -> DataFrame:
    """Rows with `rank` 1, 2, 3... in the given order, and no task that sees them all.

    Ranges are sorted apart and written; a row's rank is its place in its range after the rows of the ranges
    before. One count a range reaches the driver.
    """
    spark = rows.sparkSession
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(sorted_rows.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).orderBy("_part").collect()
    before = accumulate([0] + [r["n"] for r in sizes])
    offsets = spark.createDataFrame(
        [(r["_part"], b) for r, b in zip(sizes, before, strict=False)], "_part long, _before long"
    )
    place = F.col("_place").bitwiseAND((1 << 33) - 1)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn("rank", F.col("_before") + place + 1)
        .drop("_part", "_place", "_before")
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    max_run: int = 1,
    buckets: int = 10_000,
    seed: str = "2024",
    min_words: int = 20,
    percent: int = 10,
) -> DataFrame:
    """Every document with n_words, n_features, weight, score and rank.

    Of the documents with `min_words` words or more the `percent` % (rounded down) of highest score are drawn and
    ranked, ties to the smaller id, a missing id last; of all others the rank is null.
    """
    gains = bucket_gains(docs, target, max_run, buckets)
    scored = cut_lineage(weigh(docs, gains, max_run).withColumn("score", noisy(seed)))
    eligible = scored.where(F.col("n_words") >= min_words)
    drawn = eligible.count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")]
    kept = ranked(eligible, order).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return kept.unionByName(rest)
