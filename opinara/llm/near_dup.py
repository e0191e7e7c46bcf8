"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set holds its distinct word shingles; its sketch is the `K` smallest hashes of the set. Rows
with equal sets form a class, and all that follows is done on classes, so copies cost one row each.

* Inverted lists of retained values. Two sets at the wanted similarity share at least a share `tau` of
  their sketches (the similarity less 4.5 standard deviations, so one pair in some 300 000 is missed),
  hence a value among the first m - ceil(tau * m) + 1 of each, in any order common to all. Values are
  ordered by how many sketches retain them, rare ones first: a value of a common line heads no sketch.
* A list is not expanded into pairs. Every member is paired with its hub: the member whose values are
  commonest in all, that is the text nearest to the origin of a group of copies. Lists with the same
  members count once.
* Pairs pass the estimate from the union sketch, then exact Jaccard similarity on full sets. Links
  found so far are contracted; within a component no further pair matters.
* What lists still hold of different components is compared in blocks of bounded size, first by sketches,
  then by full sets, inside the task: it gives back only links that join components, fewer than members.

So the result lacks no link but by the sketches' chance. Sets are hashed to 64 bits; two different sets
taken for equal are expected once in 6e8 rows at most (n is compared too).

Defined results: words are lower-cased `[^\\x20\\x09-\\x0D]+`; fewer words than a shingle make one shingle
of them all; a missing or empty text has an empty set and is linked with nothing; rows that repeat are
a class; a group of missing ids has no id; extra columns pass through where rows are returned.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm import bloom
from opinara.llm.common import as_list_array, byte_chunks, row_key, text_bytes
from opinara.llm.components import connected
from opinara.llm.tokens import windows, words
from opinara.runtime import cut_lineage

K = 64
BLOCK = 512
SIGN = np.uint64(1 << 63)


def least_share(percent: int) -> float:
    s = percent / 100
    return s - 4.5 * math.sqrt(s * (1 - s) / K)


def shingle_sets(texts: list[bytes], n: int) -> Iterator[np.ndarray]:
    """The sorted hashes of each text's shingles."""
    run = words(texts)
    for a, b in zip(run.offsets[:-1], run.offsets[1:], strict=True):
        own = run.hashes[a:b]
        found = windows(own, n) if len(own) >= n else windows(own, len(own)) if len(own) else own
        yield np.unique(found)


def ordered(values: np.ndarray) -> np.ndarray:
    """As longs that sort like the unsigned hashes."""
    return (values ^ SIGN).view(np.int64)


def class_id(values: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True)


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """(key, doc_id, n, cid, sketch) of every row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in byte_chunks(batch.column(2)):
                sets = list(shingle_sets(texts, shingle))
                sketches = [ordered(s[:K]) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(first, len(texts)) for i in (0, 1)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([class_id(s) for s in sets], pa.int64()),
                        as_list_array(
                            np.concatenate(sketches), np.cumsum([0, *map(len, sketches)]), pa.int64()
                        ),
                    ],
                    names=["key", "doc_id", "n", "cid", "sketch"],
                )

    columns = [row_key().alias("key"), F.col("doc_id").cast("long"), text_bytes().alias("t")]
    return docs.select(*columns).mapInArrow(
        read, "key long, doc_id long, n long, cid long, sketch array<long>"
    )


def full_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(cid, shingles) of the rows whose key is wanted. A Bloom filter of fixed size keeps the rest out
    of the shuffle."""
    allowed = docs.sparkSession.sparkContext.broadcast(bloom.build(wanted, "key"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(False).astype(np.int64)
            found = bloom.possible(allowed.value, keys.view(np.uint64))
            for first, texts in byte_chunks(batch.column(1).take(pa.array(found))):
                sets = list(shingle_sets(texts, shingle))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[found[first : first + len(texts)]]),
                        pa.array([class_id(s) for s in sets], pa.int64()),
                        as_list_array(
                            ordered(np.concatenate(sets)), np.cumsum([0, *map(len, sets)]), pa.int64()
                        ),
                    ],
                    names=["key", "cid", "shingles"],
                )

    rows = docs.select(row_key().alias("key"), text_bytes().alias("t"))
    found = rows.mapInArrow(read, "key long, cid long, shingles array<long>")
    return found.join(wanted, "key", "left_semi").dropDuplicates(["key"]).select("cid", "shingles")


def inverted_lists(classes: DataFrame, tau: float) -> DataFrame:
    """(value, cid, central): the members of each list. `central` is the mean number of sketches that
    retain the member's values."""
    posts = classes.select("cid", F.size("sketch").alias("m"), F.explode("sketch").alias("value"))
    common = posts.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    own = Window.partitionBy("cid")
    ranked = (
        posts.join(common, "value")
        .withColumns(
            {
                "rank": F.row_number().over(own.orderBy("df", "value")),
                "shared": F.count("*").over(own),
                "central": F.sum("df").over(own) / F.col("m"),
            }
        )
    )
    m = F.col("m")
    prefix = m - F.ceil(F.lit(tau) * m) + 1
    return ranked.where(F.col("rank") + m - F.col("shared") <= prefix).select("value", "cid", "central")


def shared_lists(lists: DataFrame) -> DataFrame:
    """The lists with two members or more, one of each kind of membership."""
    kinds = (
        lists.groupBy("value")
        .agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("cid")).alias("members"))
        .where("size > 1")
    )
    chosen = kinds.groupBy("size", "members").agg(F.min("value").alias("value"))
    return lists.join(chosen.select("value", "size"), "value")


def hub_pairs(lists: DataFrame) -> DataFrame:
    """(a, b): each member with the most central member of its list."""
    hubs = lists.groupBy("value").agg(F.max(F.struct("central", "cid"))["cid"].alias("hub"))
    met = lists.join(hubs, "value").where("cid <> hub")
    return pair(met, F.col("cid"), F.col("hub"))


def pair(df: DataFrame, one: Column, other: Column) -> DataFrame:
    return df.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).distinct()


def both_sides(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    left = table.select(F.col("cid").alias("a"), F.col(column).alias("x"))
    right = table.select(F.col("cid").alias("b"), F.col(column).alias("y"))
    return pairs.join(left, "a").join(right, "b")


def linked(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, tau: float) -> DataFrame:
    """The pairs whose similarity is at least `percent` hundredths; estimated first, then exact."""
    union = F.slice(F.array_sort(F.array_union("x", "y")), 1, K)
    sizes = classes.select("cid", F.struct("n", "sketch").alias("s"))
    near = both_sides(pairs, sizes, "s").where(
        100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")
    )
    near = near.select("a", "b", F.col("x.sketch").alias("x"), F.col("y.sketch").alias("y"))
    both = F.size(F.array_intersect(union, F.array_intersect("x", "y")))
    near = near.where(both >= F.lit(tau) * F.size(union)).select("a", "b")
    common = F.size(F.array_intersect("x", "y"))
    exact = both_sides(near, sets, "shingles").withColumn("common", common)
    return exact.where(
        100 * F.col("common") >= percent * (F.size("x") + F.size("y") - F.col("common"))
    ).select("a", "b")


def settled(lists: DataFrame, sets: DataFrame, components: DataFrame, percent: int, tau: float) -> DataFrame:
    """(a, b): links between different components that share a list."""
    comp = F.coalesce("component", "cid")
    members = lists.join(components.withColumnRenamed("node", "cid"), "cid", "left").select(
        "value", "size", "cid", comp.alias("component")
    )
    # a list of two has been settled by its hub
    open_ = members.where("size > 2").groupBy("value").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    open_ = cut_lineage(open_.where("low <> high").select("value"))
    rows = members.join(open_, "value").join(sets, "cid")
    blocks = F.ceil(F.col("size") / BLOCK)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("cid"), blocks)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    )
    groups = rows.groupBy(
        "value", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")
    ).agg(F.collect_list(F.struct("cid", "component", "shingles")).alias("members"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = [(np.zeros(0, np.int64),) * 2]
            for i in range(batch.num_rows):
                m = batch.column(0).slice(i, 1).flatten()
                shingles = m.field("shingles")
                links.append(
                    joining_links(
                        m.field("cid").to_numpy(False),
                        m.field("component").to_numpy(False),
                        pc.list_value_length(shingles).to_numpy(False).astype(np.int64),
                        shingles.flatten().to_numpy(False),
                        percent,
                        tau,
                    )
                )
            a, b = (np.concatenate(x) for x in zip(*links, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return groups.select("members").mapInArrow(compare, "a long, b long").distinct()


def joining_links(cid, component, size, values, percent: int, tau: float):
    """(a, b): links between members of different components, as many as join them and no more.

    values: the members' sets one after another, each sorted.
    """
    order = np.argsort(cid)
    names, comp = np.unique(component, return_inverse=True)
    first = np.cumsum(size) - size
    found, column = np.unique(values, return_inverse=True)
    close = sketches_close(size, first, column, tau)
    root = np.arange(len(names))
    a, b = [], []
    # the largest component's members need no comparison among each other
    for i in order[comp[order] != np.bincount(comp).argmax()]:
        others = np.flatnonzero(close[i] & (root[comp] != root[comp[i]]))
        if not len(others):
            continue
        mine = np.zeros(len(found), bool)
        mine[column[first[i] : first[i] + size[i]]] = True
        common = np.add.reduceat(mine[column], first, dtype=np.int64)[others]
        linked = others[100 * common >= percent * (size[i] + size[others] - common)]
        for j in linked:
            if root[comp[i]] != root[comp[j]]:
                root[root == root[comp[j]]] = root[comp[i]]
                a.append(min(cid[i], cid[j]))
                b.append(max(cid[i], cid[j]))
    return np.array(a, np.int64), np.array(b, np.int64)


def sketches_close(size, first, column, tau: float) -> np.ndarray:
    """Which pairs share at least tau of their sketches."""
    short = np.minimum(size, K)
    row = np.repeat(np.arange(len(size)), short)
    kept = column[np.repeat(first - (np.cumsum(short) - short), short) + np.arange(int(short.sum()))]
    _, place, count = np.unique(kept, return_inverse=True, return_counts=True)
    shared = count[place] > 1
    number = np.cumsum(count > 1) - 1
    has = np.zeros((len(size), int((count > 1).sum())), np.float32)
    has[row[shared], number[place[shared]]] = 1
    return has @ has.T >= np.ceil(tau * np.minimum(short[:, None], short[None, :])) - 0.5


def components_of(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(key, doc_id, n, component) of every row; component is null for an empty set."""
    tau = least_share(percent)
    rows = cut_lineage(signatures(docs, shingle))
    classes = cut_lineage(
        rows.where("n > 0")
        .groupBy("cid", "n")
        .agg(F.first("sketch").alias("sketch"), F.min("key").alias("key"))
    )
    lists = cut_lineage(inverted_lists(classes, tau))
    lists = cut_lineage(shared_lists(lists))
    wanted = classes.join(lists.select("cid").distinct(), "cid", "left_semi").select("key")
    sets = cut_lineage(full_sets(docs, cut_lineage(wanted), shingle))

    links = cut_lineage(linked(hub_pairs(lists), classes, sets, percent, tau))
    found = cut_lineage(connected(links))
    more = settled(lists, sets, found, percent, tau)
    stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    found = connected(stars.union(more))
    own = F.when(F.col("n") > 0, F.coalesce("component", "cid"))
    return rows.select("key", "doc_id", "n", "cid").join(
        found.withColumnRenamed("node", "cid"), "cid", "left"
    ).select("key", "doc_id", "n", own.alias("component"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """(key, doc_id, n_shingles, component_id, kept) of every row: component_id is the smallest doc_id
    that links lead to; kept tells the rows with that id."""
    rows = cut_lineage(components_of(docs, shingle, percent))
    smallest = rows.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("smallest"))
    component_id = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    return rows.join(smallest, "component", "left").select(
        "key",
        "doc_id",
        F.col("n").alias("n_shingles"),
        component_id.alias("component_id"),
        F.col("doc_id").eqNullSafe(component_id).alias("kept"),
    )


def one_of_each(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near duplicates: of each group the row with the smallest (id, key)
    stays, and all rows with an empty set. Same columns."""
    rows = components_of(docs, shingle, percent)
    lead = rows.where("component is not null").groupBy("component").agg(
        F.min(F.struct("doc_id", "key"))["key"].alias("key")
    )
    empty = rows.where("component is null").select("key").distinct()
    stay = lead.select("key", F.lit(True).alias("single")).union(empty.select("key", F.lit(False)))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    kept = docs.select(row_key().alias("key"), row.alias("d")).join(stay, "key")
    return kept.where("single").dropDuplicates(["key"]).union(kept.where("not single")).select("d.*")
