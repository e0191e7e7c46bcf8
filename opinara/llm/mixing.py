"""Mixing sources to target weights, block by block.

1. Each source's documents are laid out one after another in an order given by a hash of their ids,
   and this stream of words is cut into blocks of `block` words; the last one may be shorter.
2. The sources' targets are whole numbers of words. They fix how many output slots each source gets;
   a slot takes one block, the last slot of a source only what is still lacking.
3. Slots are dealt to output shards by multinomial draws under the condition that these totals come
   out (the unconditioned draw would miss its targets by chance, and could take a block more often than
   the cap allows). Shards are halved again and again: each half draws its sources by a multivariate
   hypergeometric seeded with the range of shards, so every task finds its shards' counts by itself.
4. Slot q of a source takes the block at place q of a pseudorandom permutation of the source's blocks
   (a Feistel network that walks until the value is in range), one permutation for each time round.
   So no block is taken more than once a round, and slots need no shared state.
5. Slots and blocks are joined on (source, round's block number).

Defined results: words are `[^\\x20\\x09-\\x0D]+`; a missing text has none; documents without words
are never taken; missing sources are a source of their own, after all others; rows that repeat an id
are documents of their own; an empty table gives an empty mix. The table of sources (name, size) is
read on the driver: a mix names its sources.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.tokens import mix as mix_bits
from opinara.runtime import cut_lineage

BLOCK = 256
SHARD_SLOTS = 4096
SEED = 17
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_ROUNDS = 2
ROWS_PER_BUCKET = 200
BUCKETS = 1000
WORD = r"[^\x20\x09-\x0D]+"
WORD_AND_SPACE = r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"


@dataclass(frozen=True)
class Source:
    """number: its place among the sources; target: exact; words: the target in whole words."""

    number: int
    name: str | None
    size: int
    target: float
    words: int


def fill_targets(
    sizes: list[int], weights: list[float], share: float = SHARE, rounds: float = MAX_ROUNDS
) -> list[float]:
    """share * all sizes dealt by weight; what exceeds rounds * size is dealt again to the others."""
    targets = [0.0] * len(sizes)
    open_ = [i for i, n in enumerate(sizes) if n > 0]
    left = share * sum(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        above = [i for i in open_ if left * weights[i] / total >= rounds * sizes[i]]
        if not above:
            for i in open_:
                targets[i] = left * weights[i] / total
            break
        for i in above:
            targets[i] = float(rounds * sizes[i])
            left -= targets[i]
        open_ = [i for i in open_ if i not in set(above)]
    return targets


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_table(sized: DataFrame) -> list[Source]:
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8")))
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(rows))]
    targets = fill_targets([r["size"] for r in rows], weights)
    return [
        Source(i, r["source"], r["size"], t, int(t))
        for i, (r, t) in enumerate(zip(rows, targets, strict=True))
    ]


def permute(place: np.ndarray, size: int, key: int) -> np.ndarray:
    """Image of places in a pseudorandom permutation of range(size)."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = place.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for step in range(6):
            salt = mix_bits(np.array([key * 8 + step], np.uint64))
            left, right = right, left ^ (mix_bits(right + salt) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def unpermute_last(size: int, key: int) -> int:
    """The place whose image is size - 1: walk the cycle of the inverse network."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask, value = (1 << half) - 1, size - 1
    while True:
        left, right = value >> half, value & mask
        for step in reversed(range(6)):
            salt = mix_bits(np.array([key * 8 + step], np.uint64))
            f = int(mix_bits(np.array([left], np.uint64) + salt)[0]) & mask
            left, right = right ^ f, left
        value = (left << half) | right
        if value < size:
            return value


def round_key(seed: int, source: int, turn: int) -> int:
    return int(mix_bits(np.array([(seed << 40) ^ (source << 8) ^ turn], np.uint64))[0] >> np.uint64(8))


def slots_needed(source: Source, block: int, seed: int) -> tuple[int, int]:
    """Slots that give the target, and the words the last of them takes."""
    if not source.words:
        return 0, 0
    blocks = -(-source.size // block)
    short = source.size - (blocks - 1) * block
    turns, rest = divmod(source.words, source.size)
    if not rest:
        # the last slot of a whole round takes its whole block
        last = unpermute_last(blocks, round_key(seed, source.number, turns - 1)) == blocks - 1
        return turns * blocks, short if last else block
    where = unpermute_last(blocks, round_key(seed, source.number, turns))
    n = -(-rest // block)
    words = n * block if where >= n else (n - 1) * block + short
    if words < rest:
        n, words = n + 1, words + block
    size = short if where == n - 1 else block
    return turns * blocks + n, rest - (words - size)


def draw(random: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good ones among n drawn without return; beyond the generator's range by the normal limit."""
    if good + bad < 10**9:
        return int(random.hypergeometric(good, bad, n))
    share = good / (good + bad)
    width = (n * share * (1 - share) * (good + bad - n) / (good + bad - 1)) ** 0.5
    return int(np.clip(round(random.normal(n * share, width)), max(0, n - bad), min(good, n)))


def multinomial_part(random: np.random.Generator, totals: np.ndarray, n: int) -> np.ndarray:
    """Counts of each source among n slots, given the totals of all slots."""
    out, rest = np.zeros_like(totals), int(totals.sum())
    for i, good in enumerate(totals.tolist()):
        rest -= good
        out[i] = draw(random, good, rest, n) if n and good else 0
        n -= int(out[i])
    return out


def shard_counts(totals: np.ndarray, shard: int, shards: int, slots: int, seed: int):
    """(slots of each source before this shard, slots in it), by halving the range of shards."""
    before, here = np.zeros_like(totals), totals.copy()
    low, high = 0, shards
    while high - low > 1:
        middle = (low + high) // 2
        random = np.random.default_rng([seed, low, high])
        left = multinomial_part(random, here, (middle - low) * slots)
        if shard < middle:
            here, high = left, middle
        else:
            before, here, low = before + left, here - left, middle
    return before, here


def running_sum(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Adds `before`, the sum of `size` over the rows of the same keys that come first in order."""
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("before", F.coalesce(F.sum("size").over(window), F.lit(0)))


def numbered(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with their source's number, size and target instead of its name alone."""
    # one row a source, already read on the driver
    known = F.broadcast(sources.withColumnRenamed("source", "name"))
    return rows.join(known, F.col("source").eqNullSafe(F.col("name"))).drop("name")


def laid_out(rows: DataFrame, sizes: DataFrame, total: int) -> DataFrame:
    """Rows (number, place, doc_id, size, ...) with `offset`, where each document begins in its source's
    stream. sizes: the same rows, of which number, place and size are enough.

    A source is no group of its own: rows are summed in buckets of about `ROWS_PER_BUCKET` rows, these
    in groups of `BUCKETS` buckets, and these in the source.
    """
    bucket = F.pmod("place", F.lit(max(1, -(-total // ROWS_PER_BUCKET)))).alias("bucket")
    low = cut_lineage(sizes.groupBy("number", bucket).agg(F.sum("size").alias("size")))
    low = low.withColumn("group", F.floor(F.col("bucket") / BUCKETS))
    high = running_sum(
        low.groupBy("number", "group").agg(F.sum("size").alias("size")), ["number"], ["group"]
    ).select("number", "group", F.col("before").alias("group_start"))
    low = running_sum(low, ["number", "group"], ["bucket"]).join(high, ["number", "group"])
    starts = low.select("number", "bucket", (F.col("group_start") + F.col("before")).alias("start"))
    local = running_sum(rows.select("*", bucket), ["number", "bucket"], ["place", "doc_id"])
    offset = F.col("start") + F.col("before")
    return local.join(starts, ["number", "bucket"]).withColumn("offset", offset).drop("start", "before", "bucket")


def mix(
    docs: DataFrame, block: int = BLOCK, seed: int = SEED, with_text: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces).

    documents: doc_id, number and name of the source, size, source_size, target and offset, the
    document's first word in its source's stream; (number, offset) names a document that has words.
    pieces: shard, slot (its place in the shard), part (order within the slot), number, source, offset,
    doc_id, first_word, n_words, and with `with_text` the words with the white space after them. The
    pieces of a slot in the order of their parts are one block of the mix.
    """
    spark = docs.sparkSession
    columns = ["source", "doc_id", count_words(F.col("text")).alias("size"), F.xxhash64("doc_id", "text").alias("place")]
    sizes = cut_lineage(docs.select(*columns))
    sources = source_table(sizes)
    schema = "number long, source string, source_size long, target double"
    known = spark.createDataFrame([(s.number, s.name, s.size, s.target) for s in sources], schema)
    sizes = numbered(sizes, known)
    rows = numbered(docs.select(*columns, "text"), known) if with_text else sizes
    documents = laid_out(rows, sizes, sizes.count())
    if not with_text:
        documents = cut_lineage(documents)

    needed = [slots_needed(s, block, seed) for s in sources]
    totals = np.array([n for n, _ in needed] or [0], np.int64)
    lasts = [w for _, w in needed]
    shards = max(1, -(-int(totals.sum()) // SHARD_SLOTS))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                before, here = shard_counts(totals, shard, shards, SHARD_SLOTS, seed)
                order = np.random.default_rng([seed, shards, shard]).permutation(int(here.sum()))
                at = 0
                for s in sources:
                    n = int(here[s.number])
                    if not n:
                        continue
                    q = np.arange(before[s.number], before[s.number] + n)
                    blocks = -(-s.size // block)
                    index = np.empty(n, np.int64)
                    for turn in np.unique(q // blocks):
                        own = q // blocks == turn
                        key = round_key(seed, s.number, int(turn))
                        index[own] = permute(q[own] % blocks, blocks, key)
                    limit = np.where(q == totals[s.number] - 1, lasts[s.number], block)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, shard), pa.int64()),
                            pa.array(order[at : at + n], pa.int64()),
                            pa.array(np.full(n, s.number), pa.int64()),
                            pa.array(index),
                            pa.array(limit, pa.int64()),
                        ],
                        names=["shard", "slot", "number", "block", "limit"],
                    )
                    at += n

    tasks = min(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    slots = spark.range(0, shards, 1, tasks).mapInArrow(
        deal, "shard long, slot long, number long, block long, limit long"
    )
    first, size = F.col("offset"), F.col("size")
    pieces = documents.where("size > 0")
    if with_text:
        pieces = pieces.withColumn("words", F.regexp_extract_all("text", F.lit(WORD_AND_SPACE), F.lit(0)))
    numbers = F.sequence(F.floor(first / block), F.floor((first + size - 1) / block))

    def piece(b: Column) -> Column:
        low = F.greatest(first, b * block)
        n = F.least(first + size, (b + 1) * block) - low
        fields = [b.alias("block"), (low - first).alias("first_word"), n.alias("n_words")]
        if with_text:
            own = F.slice("words", (low - first + 1).cast("int"), n.cast("int"))
            fields.append(F.array_join(own, "").alias("text"))
        return F.struct(*fields)

    pieces = pieces.select(
        "number", "source", "offset", "doc_id", F.explode(F.transform(numbers, piece)).alias("p")
    ).select("number", "source", "offset", "doc_id", "p.*")
    # words of the block that the slot takes, when it is the last of its source
    part = F.col("offset") + F.col("first_word") - F.col("block") * block
    taken = F.least(F.col("n_words"), F.col("limit") - part)
    # shuffled by block, whatever the optimizer thinks of the pieces' size
    mixed = slots.join(pieces.hint("merge"), ["number", "block"]).withColumns({"part": part, "taken": taken}).where("taken > 0")
    kept = [
        F.col(c)
        for c in ("shard", "slot", "part", "number", "source", "offset", "doc_id", "first_word")
    ]
    if with_text:
        whole = F.regexp_extract_all("text", F.lit(WORD_AND_SPACE), F.lit(0))
        short = F.array_join(F.slice(whole, 1, F.col("taken").cast("int")), "")
        kept.append(F.when(F.col("taken") < F.col("n_words"), short).otherwise(F.col("text")).alias("text"))
    documents = documents.select(
        "doc_id", "number", "source", "size", "source_size", "target", "offset"
    )
    return documents, mixed.select(*kept, F.col("taken").alias("n_words"))
