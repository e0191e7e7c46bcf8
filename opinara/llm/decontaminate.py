"""Benchmark passages in documents, found by spaced seeds.

A mask covers `SPAN` consecutive words and ignores some of them, so a window whose ignored words were
substituted hashes to the same value. Windows of all benchmark items and of all documents are hashed
under every mask and joined on (mask, hash). Around each hit the texts are compared word by word on
the hit's diagonal, to both sides as long as the balance (+1 for an equal word, -2 for another) stays
within `DROP` of its best. The overlap counts if it has at least `min_words` equal words and these are
at least `min_share` of its length; if not, its stretch with most equal words that does so counts. Every
hit of a diagonal that lies in no overlap before it is followed.

The `LIGHT` masks are chosen so that each stretch with `MIN_WORDS` equal words or more that make up
`MIN_SHARE` of it holds a window under one of them, wherever the other words are: those of up to 23 words
were counted out, and longer ones consist of parts of 12 to 23 words, of which one has that share.

A document's windows first pass a Bloom filter of fixed size, so that only a small part of them is
shuffled, however large the benchmark.

Defined results: words are as in `tokens`; items with fewer than `min_words` but at least `MIN_ITEM` words
are found where they occur whole and unchanged; shorter, empty and missing items match nothing, nor do
missing or empty documents; an item id or a document id that repeats with another text is a case of
its own; rows that repeat both are one document; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm import bloom
from opinara.llm.common import as_list_array, byte_chunks, row_key, text_bytes
from opinara.llm.tokens import mix, powers, words
from opinara.runtime import cut_lineage

MASKS = ("111011010011", "110100110111", "101110011101")
LIGHT = ("1111011", "1110100011", "10011111", "111101001")
SPAN = 12
MIN_ITEM = 5
CONTEXT = 256  # words kept on either side of a hit, the furthest that an overlap can reach
DROP = 6
MIN_WORDS = 10
MIN_SHARE = 0.8
_SALT = powers(np.uint64(0xD6E8FEB86659FD93), SPAN + 1)


def masked(hashes: np.ndarray, kept: list[int], name: int) -> np.ndarray:
    """Hash of the kept places of every window; places count from the window's start."""
    size = max(0, len(hashes) - (kept[-1] if kept else 0))
    total = np.full(size, name, np.uint64)
    for j in kept:
        total += hashes[j : j + size] * _SALT[j + 1]
    return mix(total)


def patterns(lengths: list[int]) -> list[tuple[int, int, list[int]]]:
    """(name, span, kept places) of the spaced masks and of the whole-item masks of short items."""
    spaced = [(i, len(m), [j for j, c in enumerate(m) if c == "1"]) for i, m in enumerate(MASKS + LIGHT)]
    return spaced + [(100 + n, n, list(range(n))) for n in lengths]


def all_windows(run, masks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, mask, hash) of every window that lies within one text."""
    text = run.text_of_word()
    out = []
    for name, span, kept in masks:
        size = len(run.hashes) - span + 1
        if size <= 0:
            continue
        h = masked(run.hashes, kept, name)[:size]
        inside = np.flatnonzero(text[:size] == text[span - 1 :])
        out.append((inside, np.full(len(inside), name, np.int32), h[inside]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def benchmark_words(benchmark: DataFrame) -> DataFrame:
    """(ikey, item_id, words): word hashes of each item."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in byte_chunks(batch.column(2)):
                run = words(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(first, len(texts)) for i in (0, 1)),
                        as_list_array(run.hashes.view(np.int64), run.offsets, pa.int64()),
                    ],
                    names=["ikey", "item_id", "words"],
                )

    key = F.xxhash64("item_id", F.lit("|"), F.col("text").isNull(), "text")
    rows = benchmark.select(key.alias("ikey"), F.col("item_id").cast("long"), text_bytes().alias("t"))
    return rows.dropDuplicates(["ikey"]).mapInArrow(read, "ikey long, item_id long, words array<long>")


def benchmark_windows(items: DataFrame, masks, min_words: int = MIN_WORDS) -> DataFrame:
    """(mask, hash, ikey, at): windows of items; one with fewer than min_words has only its whole."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                h = np.array(row["words"], np.int64).view(np.uint64)
                for name, span, kept in masks:
                    if len(h) != span if name >= 100 else len(h) < max(span, min_words):
                        continue
                    found = masked(h, kept, name)[: len(h) - span + 1]
                    n = len(found)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, name, np.int32)),
                            pa.array(found.view(np.int64)),
                            pa.array(np.full(n, row["ikey"], np.int64)),
                            pa.array(np.arange(n, dtype=np.int32)),
                        ],
                        names=["mask", "hash", "ikey", "at"],
                    )

    return items.select("ikey", "words").mapInArrow(read, "mask int, hash long, ikey long, at int")


def candidate_segments(docs: DataFrame, masks, allowed) -> DataFrame:
    """Per stretch of a document with possible hits: its word hashes with context, and the hits."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_words = allowed.value
        for batch in batches:
            keys = batch.column(0).to_numpy(False)
            ids = batch.column(1)
            for first, texts in byte_chunks(batch.column(2)):
                run = words(texts)
                at, mask, h = all_windows(run, masks)
                found = bloom.possible(filter_words, h)
                if not len(found):
                    continue
                found = found[np.argsort(at[found], kind="stable")]
                at, mask, h = at[found], mask[found], h[found]
                text = run.text_of_word()[at]
                new = np.append(True, (np.diff(at) > CONTEXT) | (np.diff(text) > 0))
                begin = np.flatnonzero(new)
                stop = np.append(begin[1:], len(at))
                owner = text[begin]
                low = np.maximum(run.offsets[owner], at[begin] - CONTEXT)
                high = np.minimum(run.offsets[owner + 1], at[stop - 1] + SPAN + CONTEXT)
                seg = np.cumsum(new) - 1
                bounds = np.append(begin, len(at))
                flat = np.concatenate([run.hashes[a:b] for a, b in zip(low, high, strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[first + owner].astype(np.int64)),
                        ids.take(pa.array(first + owner)),
                        pa.array(low - run.offsets[owner], pa.int64()),
                        as_list_array(
                            flat.view(np.int64), np.append(0, np.cumsum(high - low)), pa.int64()
                        ),
                        as_list_array(at - low[seg], bounds, pa.int32()),
                        as_list_array(mask, bounds, pa.int32()),
                        as_list_array(h.view(np.int64), bounds, pa.int64()),
                    ],
                    names=["key", "doc_id", "low", "seg", "at", "mask", "hash"],
                )

    return docs.select(
        row_key().alias("key"), F.col("doc_id").cast("long"), text_bytes().alias("t")
    ).mapInArrow(
        search,
        "key long, doc_id long, low long, seg array<long>, at array<int>, mask array<int>, "
        "hash array<long>",
    )


def reach(equal: np.ndarray) -> int:
    """How far an overlap goes over these comparisons before its balance falls by DROP."""
    if not len(equal):
        return 0
    balance = np.cumsum(np.where(equal, 1, -2))
    best = np.maximum.accumulate(np.maximum(balance, 0))
    fallen = np.flatnonzero(best - balance >= DROP)
    end = fallen[0] if len(fallen) else len(equal)
    if not end or balance[:end].max() <= 0:
        return 0
    return int(np.argmax(balance[:end])) + 1


def best_stretch(equal: np.ndarray, min_share: float) -> tuple[int, int]:
    """The stretch with most equal words among those of which they are at least min_share."""
    total = np.append(0, np.cumsum(equal))
    balance = total - min_share * np.arange(len(total))
    # of each end, the first begin from which the share is reached
    begin = np.searchsorted(-np.minimum.accumulate(balance), -balance - 1e-9)
    end = int(np.argmax(total - total[begin]))
    places = np.flatnonzero(equal[begin[end] : end])
    if not len(places):
        return 0, 0
    return int(begin[end] + places[0]), int(begin[end] + places[-1] + 1)


def verify(seg: np.ndarray, item: np.ndarray, shift: int, seeds, min_words: int, min_share: float):
    """(first word, end, equal words) of the overlaps through the windows (at, span) of seg, where word i
    of seg lies over word i - shift of item. Windows are sorted."""
    low, high = max(0, shift), min(len(seg), len(item) + shift)
    equal = seg[low:high] == item[low - shift : high - shift]
    done = 0
    for at, span in seeds:
        begin, end = at - low, at - low + span
        whole = span == len(item) < SPAN and equal[begin:end].all()
        if end <= done:
            continue
        begin -= reach(equal[:begin][::-1])
        end += reach(equal[end:])
        done = end
        if not whole and equal[begin:end].sum() < min_share * (end - begin):
            a, b = best_stretch(equal[begin:end], min_share)
            begin, end = begin + a, begin + b
        n = int(equal[begin:end].sum())
        if whole or n >= min_words:
            yield low + begin, low + end, n


def find_overlaps(
    docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE
) -> DataFrame:
    """(key, doc_id, item_id, first_word, n_words, n_equal): the best overlap of each document with
    each benchmark item that it overlaps. `key` is the document row's key."""
    spark = docs.sparkSession
    items = cut_lineage(benchmark_words(benchmark))
    size = F.size("words")
    short = [
        r["n"]
        for r in items.select(size.alias("n")).where((size >= MIN_ITEM) & (size < SPAN)).distinct().collect()
    ]
    masks = patterns(sorted(short))
    spans = {name: span for name, span, _ in masks}
    seeds = cut_lineage(benchmark_windows(items, masks, min_words))
    allowed = spark.sparkContext.broadcast(bloom.build(seeds, "hash"))
    segments = cut_lineage(candidate_segments(docs, masks, allowed))

    hit = F.explode(F.arrays_zip("at", "mask", "hash"))
    hits = segments.select("key", "low", hit.alias("hit")).select(
        "key", "low", F.col("hit.at").alias("d_at"), "hit.mask", "hit.hash"
    )
    paired = (
        hits.join(seeds, ["mask", "hash"])
        .groupBy("key", "low", "ikey", (F.col("d_at") - F.col("at")).alias("shift"))
        .agg(F.array_sort(F.collect_set(F.struct("d_at", "mask"))).alias("seeds"))
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                windows = [(x["d_at"], spans[x["mask"]]) for x in r["seeds"]]
                seg, item = np.array(r["seg"], np.int64), np.array(r["words"], np.int64)
                for a, b, n in verify(seg, item, r["shift"], windows, min_words, min_share):
                    out.append((r["key"], r["doc_id"], r["item_id"], r["low"] + a, b - a, n))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["key", "doc_id", "item_id", "first_word", "n_words", "n_equal"],
            )

    rows = (
        paired.join(segments.select("key", "doc_id", "low", "seg").dropDuplicates(["key", "low"]), ["key", "low"])
        .join(items, "ikey")
        .select("key", "doc_id", "item_id", "low", "shift", "seeds", "seg", "words")
    )
    overlaps = rows.mapInArrow(
        check, "key long, doc_id long, item_id long, first_word long, n_words long, n_equal long"
    )
    best = F.max(F.struct("n_equal", -F.col("n_words"), -F.col("first_word"))).alias("b")
    return (
        overlaps.groupBy("key", "doc_id", "item_id")
        .agg(best)
        .select(
            "key",
            "doc_id",
            "item_id",
            (-F.col("b.col3")).alias("first_word"),
            (-F.col("b.col2")).alias("n_words"),
            F.col("b.n_equal").alias("n_equal"),
        )
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap no benchmark item; same columns."""
    columns = [F.col(f"d.`{c}`") for c in docs.columns]
    leaks = find_overlaps(docs, benchmark).select("key").distinct()
    keyed = docs.select(row_key().alias("__key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"))
    return keyed.join(leaks, keyed["__key"] == leaks["key"], "left_anti").select(*columns)
