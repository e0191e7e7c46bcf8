"""Removal of passages that repeat, by hashes of normalised units and of windows of words.

A text is cut into units: lines, and within a line sentences, which end at a word ending in `.`, `!`
or `?`. A unit is normalised to its words (A-Z lowered, white space between them ignored) and hashed
to 128 bits. Digests are grouped over all texts; of each digest the occurrence with the smallest
(doc_id, row key, place) stays. Since a passage need not begin or end with a unit, windows of `min_words`
consecutive words are grouped the same way. Stretches of neighbouring later units and windows with at
least `min_words` words are taken out: a repeated paragraph goes, wherever it begins, a greeting or a
licence line stays.

Windows are counted only where they may repeat: the smallest hash among a window's runs of half as many
words is the same in each copy of the window, and these minima are counted first.

Long copies do not cost a row per window. Windows are dealt to blocks, which begin where a hash of the words says
so; a block that is not the first of its digest is one later stretch, and neither its windows nor the units within
it are looked at, as the first block of the digest holds them all. The digest takes in where units end.

Defined results: a missing or empty text has no units and stays as it is; a missing id ranks first;
rows that repeat both id and text are the same document and lose the same spans; other columns pass
through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm import bloom
from opinara.llm.common import as_list_array, byte_chunks, row_key, text_bytes
from opinara.llm.tokens import Words, mix, powers, segment_hash, words
from opinara.runtime import clear, cut_lineage, scratch_dir

MIN_WORDS = 30
SECOND = np.uint64(0xA0761D6478BD642F)
WINDOW, RUN = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x8EBC6AF09C88C6E3)
BLOCK, END = np.uint64(0xE7037ED1A0B428DB), np.uint64(0x589965CC75374CC3)
BLOCK_WINDOWS = np.uint64(16)  # in a block, on average
FILTER_BITS = (25, 26)
PART = 1 << 19  # bytes of texts read at once; arrays of eight bytes to each stand beside them
DEALT = 1 << 19  # half digests of a task that are dealt at once
BUCKET_BITS = 12
DIGESTS = "bucket int, packed binary"
ENDINGS = np.zeros(256, bool)
ENDINGS[[ord(c) for c in ".!?"]] = True


def unit_sizes(run: Words) -> tuple[np.ndarray, np.ndarray]:
    """Words in each unit, and the first unit of each text (one more entry than texts)."""
    n = len(run.starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(run.offsets), np.int64)
    lines = np.cumsum(run.data == 10)
    last = ENDINGS[run.data[run.ends - 1]]
    last[:-1] |= lines[run.starts[1:]] > lines[run.ends[:-1] - 1]
    last[-1] = True
    stops = np.flatnonzero(last) + 1
    return np.diff(stops, prepend=0), np.searchsorted(stops, run.offsets, side="right")


def rolled(values: np.ndarray, n: int, step: np.uint64) -> np.ndarray:
    """Hash of every n consecutive values, from sums weighted by powers of an odd number."""
    size = len(values) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    sums = np.append(np.uint64(0), np.cumsum(values * powers(step, len(values))))
    return mix((sums[n:] - sums[:-n]) * powers(np.uint64(pow(int(step), -1, 1 << 64)), size))


def sliding(best: np.ufunc, values: np.ndarray, n: int) -> np.ndarray:
    """The smallest (np.minimum) or largest of every n consecutive values."""
    width = 1
    while 2 * width <= n:
        values, width = best(values[:-width], values[width:]), 2 * width
    rest = n - width
    return best(values[: len(values) - rest], values[rest:])


@dataclass
class Blocks:
    """Blocks of windows: words begin to end, of which `windows` windows begin within the block."""

    begin: np.ndarray
    end: np.ndarray
    windows: np.ndarray
    text: np.ndarray
    values: np.ndarray  # of all words, changed where a unit ends

    def digest(self, step: np.uint64) -> np.ndarray:
        """Hash of each block's words and of where units end in it."""
        sums = np.append(np.uint64(0), np.cumsum(self.values * powers(step, len(self.values))))
        back = powers(np.uint64(pow(int(step), -1, 1 << 64)), len(sums))[self.begin]
        return mix((sums[self.end] - sums[self.begin]) * back + (self.end - self.begin).astype(np.uint64))

    def known(self, allowed: np.ndarray, firsts: np.ndarray, h1: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Whether each block is surely not in the first text of its digest. keys: of the texts."""
        out = np.zeros(len(h1), bool)
        out[bloom.possible(allowed, h1)] = True
        out[bloom.possible(firsts, h1 ^ keys[self.text])] = False
        return out

    def of_windows(self, known: np.ndarray) -> np.ndarray:
        """First words of the windows in blocks that are not known."""
        size = np.where(known, 0, self.windows)
        return np.repeat(self.begin - np.cumsum(size) + size, size) + np.arange(int(size.sum()))

    def hold(self, known: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether each unit of the given sizes lies in a known block behind another unit's end."""
        if not len(self.begin):
            return np.zeros(len(sizes), bool)
        end = np.cumsum(sizes)
        at = np.searchsorted(self.begin, end - sizes - 1, side="right") - 1
        return (at >= 0) & known[at] & (end <= self.end[at])


def blocks_of(run: Words, sizes: np.ndarray, min_words: int) -> Blocks:
    """The blocks of all texts; sizes: of their units. Each window lies in one block."""
    text = run.text_of_word()
    values = run.hashes.copy()
    values[np.cumsum(sizes) - 1] ^= END
    size = max(0, len(text) - min_words + 1)
    first = np.flatnonzero(text[:size] == text[len(text) - size :])
    runs = rolled(run.hashes, (min_words + 1) // 2, RUN)[first]
    opens = (runs % BLOCK_WINDOWS == 0) | (np.diff(text[first], prepend=-1) != 0)
    begin = first[opens]
    windows = np.diff(np.flatnonzero(np.append(opens, True)))
    return Blocks(begin, begin + windows + min_words - 1, windows, text[begin], values)


def window_minima(run: Words, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of the windows within one text, the smallest hash among each one's runs, and the hashes
    of all runs that are the smallest of a window."""
    none = np.zeros(0, np.uint64)
    size = len(run.hashes) - min_words + 1
    if size <= 0:
        return np.zeros(0, np.int64), none, none
    text = run.text_of_word()
    inside = text[:size] == text[min_words - 1 :]
    length = (min_words + 1) // 2
    width = min_words - length + 1
    runs = rolled(run.hashes, length, RUN)
    least = sliding(np.minimum, runs, width)
    edge = np.zeros(width - 1, np.uint64)
    chosen = sliding(np.maximum, np.concatenate([edge, np.where(inside, least, np.uint64(0)), edge]), width)
    first = np.flatnonzero(inside)
    return first, least[first], runs[chosen == runs]


def dealt(found: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(bucket, packed): half digests by their last bits, the bytes of one bucket in a row, at most two of each digest
    among those dealt at once. The bits stand in front, so that a bucket is a run of sorted numbers."""
    shift, rest = np.uint64(64 - BUCKET_BITS), np.uint64(BUCKET_BITS)

    def rows(run: list[np.ndarray]) -> pa.RecordBatch:
        values = np.concatenate(run)
        values = np.sort(values << shift | values >> rest)
        values = values[np.append(np.ones(min(2, len(values)), bool), values[2:] != values[:-2])]
        bucket = (values >> shift).astype(np.int32)
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        places = (8 * np.append(first, len(values))).astype(np.int32)
        packed = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(places), pa.py_buffer(values)])
        return pa.RecordBatch.from_arrays([pa.array(bucket[first]), packed], names=["bucket", "packed"])

    run, size = [], 0
    for part in found:
        run.append(part)
        size += len(part)
        if size >= DEALT:
            yield rows(run)
            run, size = [], 0
    if size:
        yield rows(run)


def met_again(bucket: pa.Table) -> pa.Table:
    """For applyInArrow on a bucket: the half digests that stand in it twice or more."""
    values = np.sort(np.frombuffer(b"".join(bucket.column("packed").to_pylist()), np.uint64))
    values = np.unique(values[1:][values[1:] == values[:-1]])
    values = values << np.uint64(BUCKET_BITS) | values >> np.uint64(64 - BUCKET_BITS)
    return pa.table({"h1": values.view(np.int64)})


def digests(min_words: int) -> object:
    """For mapInArrow on texts: half digests of units, of blocks, and of windows' smallest runs."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for _, texts in byte_chunks(batch.column(0), PART):
                run = words(texts)
                sizes = unit_sizes(run)[0]
                yield segment_hash(run.hashes, sizes)
                yield window_minima(run, min_words)[2]
                yield blocks_of(run, sizes, min_words).digest(BLOCK)

    return lambda batches: dealt(read(batches))


def window_digests(allowed, firsts, min_words: int) -> object:
    """For mapInArrow on keys and texts: half digests of the windows whose smallest runs repeat, of known blocks none."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            keys = batch.column(0).to_numpy(False).view(np.uint64)
            for row, texts in byte_chunks(batch.column(1), PART):
                run = words(texts)
                block = blocks_of(run, unit_sizes(run)[0], min_words)
                known = block.known(allowed.value, firsts.value, block.digest(BLOCK), keys[row : row + len(texts)])
                first, least, _ = window_minima(run, min_words)
                begin = block.of_windows(known)
                begin = begin[bloom.possible(allowed.value, least[np.searchsorted(first, begin)])]
                yield rolled(run.hashes, min_words, WINDOW)[begin]

    return lambda batches: dealt(read(batches))


def repeating(spark, found: DataFrame) -> object:
    """Broadcast filter of the half digests that occur twice or more among dealt ones.

    They are shuffled as bytes, eight for each. A bucket is one group: 4 MB of 30 GB of texts.
    """
    folder = scratch_dir(spark, "twice")
    twice = cut_lineage(found.groupBy("bucket").applyInArrow(met_again, "h1 long"), folder)
    filled = filter_of(twice, "h1")
    clear(spark, folder)
    return filled


def filter_of(table: DataFrame, column: str) -> object:
    """Broadcast Bloom filter of a written table's hashes, sized by their number within bounds."""
    low, high = FILTER_BITS
    filled = bloom.build(table, column, min(high, max(low, (16 * table.count()).bit_length())))
    return table.sparkSession.sparkContext.broadcast(filled)


def grouped(
    row: np.ndarray, h1: np.ndarray, h2: np.ndarray, places: np.ndarray, keys: np.ndarray, ids: pa.Array
) -> pa.RecordBatch:
    """One row for each text and digest, with its places in order."""
    order = np.lexsort((h2, h1, row))
    places, row, h1, h2 = (x[order] for x in (places, row, h1, h2))
    new = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (h1 != np.roll(h1, 1)) | (h2 != np.roll(h2, 1)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(h1[new].view(np.int64)),
            pa.array(h2[new].view(np.int64)),
            pa.array(keys[row[new]].view(np.int64)),
            ids.take(pa.array(row[new])),
            as_list_array(places, np.append(new, len(places)), pa.int64()),
        ],
        names=["h1", "h2", "key", "doc_id", "places"],
    )


def located(docs: DataFrame, find) -> DataFrame:
    """(h1, h2, key, doc_id, places): per text and digest its places, as ``find(words, keys)`` gives them with
    their texts and digests."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = batch.column(0).to_numpy(False).astype(np.int64).view(np.uint64), batch.column(1)
            for first, texts in byte_chunks(batch.column(2), PART):
                own = keys[first : first + len(texts)]
                yield grouped(*find(words(texts), own), own, ids.slice(first, len(texts)))

    columns = [row_key().alias("key"), F.col("doc_id").cast("long"), text_bytes().alias("t")]
    return docs.select(*columns).mapInArrow(
        read, "h1 long, h2 long, key long, doc_id long, places array<bigint>"
    )


def shared_blocks(docs: DataFrame, allowed, min_words: int) -> DataFrame:
    """The blocks that may occur elsewhere too. A place is that of the first window, and the number of windows that
    follow it in the upper half."""

    def find(run: Words, keys: np.ndarray):
        block = blocks_of(run, unit_sizes(run)[0], min_words)
        h1 = block.digest(BLOCK)
        found = bloom.possible(allowed.value, h1)
        row = block.text[found]
        places = 2 * (block.begin[found] - run.offsets[row]) + 1 + (block.windows[found] - 1 << 32)
        return row, h1[found], block.digest(SECOND)[found], places

    return located(docs, find)


def shared_units(docs: DataFrame, allowed, firsts, wide, min_words: int) -> DataFrame:
    """The units and windows outside known blocks that may occur elsewhere too. A place is twice the number of a unit,
    or twice the number of a window's first word and one."""

    def find(run: Words, keys: np.ndarray):
        sizes, units = unit_sizes(run)
        block = blocks_of(run, sizes, min_words)
        known = block.known(allowed.value, firsts.value, block.digest(BLOCK), keys)
        h1, h2 = segment_hash(run.hashes, sizes), segment_hash(run.hashes, sizes, SECOND)
        found = bloom.possible(allowed.value, h1)
        found = found[~block.hold(known, sizes)[found]]
        begin = block.of_windows(known)
        w1 = rolled(run.hashes, min_words, WINDOW)[begin]
        likely = bloom.possible(wide.value, w1)
        begin, w1 = begin[likely], w1[likely]
        row = np.repeat(np.arange(len(keys)), np.diff(units))[found]
        at = run.text_of_word()[begin]
        places = np.append(2 * (found - units[row]), 2 * (begin - run.offsets[at]) + 1)
        w2 = rolled(run.hashes, min_words, SECOND)[begin]
        return np.append(row, at), np.append(h1[found], w1), np.append(h2[found], w2), places

    return located(docs, find)


def first_places(found: DataFrame) -> DataFrame:
    """(h1, h2, first, n): of each digest its first text's key, and how often it occurs."""
    first = found.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "key")).alias("f"), F.sum(F.size("places")).alias("n"))
    # written, so that a digest of very many texts can be split when it is joined
    return cut_lineage(first.select("h1", "h2", F.col("f.key").alias("first"), "n"))


def not_first(found: DataFrame, first: DataFrame) -> DataFrame:
    """(key, places): what is not the first of its digest."""
    # a key stands for its id too, which need not be shuffled again
    rest = F.when(F.col("key") == F.col("first"), F.slice("places", 2, F.size("places"))).otherwise(F.col("places"))
    first = first.where("n > 1").drop("n")
    later = found.drop("doc_id").join(first.hint("merge"), ["h1", "h2"]).select("key", rest.alias("places"))
    return later.where(F.size("places") > 0)


def later_units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(key, later): the blocks, units and windows of each text that are not the first of their digest.

    Half digests alone are counted first. What occurs twice goes into Bloom filters of bounded size, so that
    the last passes shuffle little more than what repeats; so do the blocks that are first of their digest, so that
    of the others nothing within is shuffled. What a filter lets through wrongly is a row more, not another result.
    """
    spark, texts = docs.sparkSession, docs.select(text_bytes().alias("t"))
    keyed = docs.select(row_key().alias("key"), text_bytes().alias("t"))
    allowed = repeating(spark, texts.mapInArrow(digests(min_words), DIGESTS))
    blocks = cut_lineage(shared_blocks(docs, allowed, min_words))
    first_blocks = first_places(blocks)
    firsts = filter_of(first_blocks.select(F.col("h1").bitwiseXOR(F.col("first")).alias("h")), "h")
    wide = repeating(spark, keyed.mapInArrow(window_digests(allowed, firsts, min_words), DIGESTS))
    units = cut_lineage(shared_units(docs, allowed, firsts, wide, min_words))
    later = not_first(units, first_places(units)).unionByName(not_first(blocks, first_blocks))
    return later.groupBy("key").agg(F.flatten(F.collect_list("places")).alias("later"))


def cut(texts: list[bytes], later: list[np.ndarray], min_words: int):
    """For each text: what stays, and the removed spans as (start, end) in code points."""
    run = words(texts, hashed=False)
    sizes, units = unit_sizes(run)
    word_end = np.cumsum(sizes)
    for i, text in enumerate(texts):
        here = later[i]
        if here is None or not len(here):
            yield text, []
            continue
        place, more = here & 0xFFFFFFFF, here >> 32
        windows = place % 2 == 1
        unit, window = place[~windows] // 2 + units[i], place[windows] // 2 + run.offsets[i]
        # words begun and ended, by stretches of units and windows
        begun = np.append(word_end[unit] - sizes[unit], window)
        order = np.argsort(begun, kind="stable")
        begun, ended = begun[order], np.maximum.accumulate(np.append(word_end[unit], window + more[windows] + min_words)[order])
        breaks = np.flatnonzero(begun[1:] > ended[:-1])
        runs = zip(begun[np.append(0, breaks + 1)], ended[np.append(breaks, len(ended) - 1)], strict=True)
        kept, spans, at, chars = [], [], 0, 0
        for w0, w1 in runs:
            if w1 - w0 < min_words:
                continue
            start, end = run.starts[w0] - run.begins[i], run.ends[w1 - 1] - run.begins[i]
            kept.append(text[at:start])
            chars += len(text[at:start].decode())
            width = len(text[start:end].decode())
            spans.append((chars, chars + width))
            chars, at = chars + width, end
        kept.append(text[at:])
        yield b"".join(kept), spans


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without repeated passages.

    Adds `text_kept` and `removed`, an array of (start, end) offsets in the original text; input
    columns of these two names are replaced.
    """

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            later = batch.column(1)
            for first, texts in byte_chunks(batch.column(2), PART):
                mine = [
                    np.array(later[first + i].as_py() or [], np.int64) for i in range(len(texts))
                ]
                result = list(cut(texts, mine, min_words))
                sizes = np.cumsum([0, *(len(s) for _, s in result)])
                flat = [x for _, s in result for x in s]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array([t.decode() for t, _ in result], pa.string()),
                        as_list_array(np.array([x[0] for x in flat], np.int64), sizes, pa.int64()),
                        as_list_array(np.array([x[1] for x in flat], np.int64), sizes, pa.int64()),
                    ],
                    names=["row", "kept", "starts", "ends"],
                )

    lists = cut_lineage(later_units(docs, min_words))
    # texts that are surely not listed stay as they are and are not shuffled
    allowed = filter_of(lists, "key")

    @F.pandas_udf("boolean")
    def listed(keys: pd.Series) -> pd.Series:
        out = np.zeros(len(keys), bool)
        out[bloom.possible(allowed.value, keys.to_numpy(np.int64).view(np.uint64))] = True
        return pd.Series(out)

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("text_kept", "removed")])
    keyed = docs.select(row_key().alias("key"), row.alias("row")).withColumn("listed", listed("key"))
    joined = (
        keyed.where("listed")
        .join(lists.hint("merge"), "key", "left")
        .select("row", "later", F.coalesce("row.text", F.lit("")).cast("binary").alias("t"))
    )
    kind = joined.schema["row"].dataType.simpleString()
    out = joined.mapInArrow(
        strip, f"row {kind}, kept string, starts array<bigint>, ends array<bigint>"
    )
    removed = F.transform(
        F.arrays_zip("starts", "ends"), lambda x: F.struct(x["starts"].alias("start"), x["ends"].alias("end"))
    )
    stripped = out.select(
        "row.*",
        F.when(F.col("row.text").isNotNull(), F.col("kept")).alias("text_kept"),
        removed.alias("removed"),
    )
    whole = keyed.where(~F.col("listed")).select(
        "row.*",
        F.col("row.text").alias("text_kept"),
        F.array().cast("array<struct<start: bigint, end: bigint>>").alias("removed"),
    )
    return stripped.unionByName(whole)


def substring_stage(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Pipeline form: same columns, texts without repeats; documents left without a word go."""
    cleaned = remove_repeats(docs, min_words)
    emptied = (F.size("removed") > 0) & ~F.col("text_kept").rlike(r"[^\x20\x09-\x0D]")
    new = {"text": F.col("text_kept"), "n_chars": F.length("text_kept").cast("long")}
    return cleaned.where(~F.coalesce(emptied, F.lit(False))).select(
        *[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns]
    )
