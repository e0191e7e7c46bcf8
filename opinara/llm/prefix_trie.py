"""A trie of conversations: every distinct sequence of first turns is a node with counts of what lies below it.

Burst tries: a container holds the suffixes of all conversations below one head. A container with too many turns
is burst: its head becomes a node of the trie of heads, and its suffixes move on by their next turn into the
containers of that node's children. What remains is small, is sorted and swept once, and gives its nodes with all
that lies below them; the heads are then summed up from the deepest to the root.

Conversations are compared by the digests of their turns, 16 bytes each, so texts are shuffled no further than
the first step. Equal conversations are one suffix with a count, so a group of copies is one row however large
it is; their ids are joined in blocks by many tasks before one digest goes over the blocks.

A conversation's turns are its rows by `turn`, a missing one first, equal ones by the digest of role and text; a
missing role or text is empty. Repeated rows are repeated turns. Rows without a conversation id belong to no
conversation and are left out. A conversation is one row of digests. An empty table has no conversations, and so no
nodes, not even the root.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.runtime import cut_lineage

WIDTH = 16  # bytes of a turn's digest
# A container beyond both is burst: turns of its suffixes, and suffixes, of which more than one is needed.
BURST_TURNS = 100_000
BURST_SUFFIXES = 64
ID_BLOCK = 50_000  # ids that are joined to one text
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
NO_ENDS = sha256(b"").hexdigest()


def turn_digest() -> Column:
    """Digest of role and text; the role's length keeps the two apart."""
    return F.unhex(F.md5(F.concat_ws(":", F.length("role").cast("string"), F.concat("role", "text")).cast("binary")))


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, seq): a conversation's turns in order, each its digest and the length of its text."""
    filled = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # NULL sorts first in a struct
    row = F.struct("turn", turn_digest().alias("id"), F.length("text").cast("int").alias("chars"))
    rows = filled.select("conv_id", row.alias("row")).groupBy("conv_id").agg(F.collect_list("row").alias("rows"))
    in_order = F.transform(F.array_sort("rows"), lambda r: F.struct(r["id"].alias("id"), r["chars"].alias("chars")))
    return rows.select("conv_id", in_order.alias("seq"))


def rebuilt(seqs: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """Conversations that begin with the first h turns of the first one of their block of ids, h being the
    checksum of their id modulo `most`, followed by their own turns after the first h."""
    conv = F.col("conv_id")
    h = (F.crc32(conv.cast("string").cast("binary")) % most).cast("int")
    first = seqs.where(conv % block == 0).select(conv.alias("base"), F.slice("seq", 1, most - 1).alias("lent"))
    joined = seqs.withColumn("base", conv - conv % block).join(first, "base", "left")
    lent = F.coalesce(F.slice("lent", F.lit(1), h), F.slice("seq", F.lit(1), F.lit(0)))
    own = F.slice("seq", h + 1, F.greatest(F.size("seq") - h, F.lit(0)))
    return joined.select("conv_id", F.concat(lent, own).alias("seq"))


def joined_ids(members: DataFrame) -> DataFrame:
    """(key, n_convs, conv_id, ends_sha256) of (key, conv_id): how many, the smallest, and the digest of all ids
    in ascending order.

    Ids are sorted in ranges, where hot keys are cut, and joined to texts of bounded length; a key's texts are
    digested one after the other, none of them kept.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def done() -> dict:
            return {"key": key, "first": ids[0], "n": len(ids), "ids": ",".join(map(str, ids))}

        for batch in batches:
            rows = []
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (k != key or len(ids) >= ID_BLOCK):
                    rows.append(done())
                    ids = []
                key = k
                ids.append(c)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, RUN_SCHEMA)
        if ids:
            yield pa.RecordBatch.from_pylist([done()], RUN_SCHEMA)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, n, state = None, None, 0, None
        for batch in batches:
            rows = []
            for k, least, count, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is not None and k == key:
                    state.update(b",")
                else:
                    if state is not None:
                        rows.append({"key": key, "n_convs": n, "conv_id": first, "ends_sha256": state.hexdigest()})
                    key, first, n, state = k, least, 0, sha256()
                state.update(ids.encode())
                n += count
            if rows:
                yield pa.RecordBatch.from_pylist(rows, DIGEST_SCHEMA)
        if state is not None:
            row = {"key": key, "n_convs": n, "conv_id": first, "ends_sha256": state.hexdigest()}
            yield pa.RecordBatch.from_pylist([row], DIGEST_SCHEMA)

    order = ["key", "conv_id"]
    in_ranges = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = cut_lineage(in_ranges.mapInArrow(runs, "key binary, first long, n long, ids string"))
    return blocks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(
        digests, "key binary, n_convs long, conv_id long, ends_sha256 string"
    )


RUN_SCHEMA = pa.schema([("key", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])
DIGEST_SCHEMA = pa.schema(
    [("key", pa.binary()), ("n_convs", pa.int64()), ("conv_id", pa.int64()), ("ends_sha256", pa.string())]
)


def distinct_suffixes(convs: DataFrame) -> DataFrame:
    """Distinct sequences as suffixes below the root: head, depth (of the head), turns (digests one behind the
    other), chars, n_convs, conv_id and ends_sha256."""
    digests = F.concat(F.lit(b""), *[F.unhex(F.array_join(F.transform("seq", lambda t: F.hex(t["id"])), ""))])
    keyed = cut_lineage(
        convs.select("conv_id", digests.alias("turns"), F.transform("seq", lambda t: t["chars"]).alias("chars")).withColumn(
            "key", F.unhex(F.md5("turns"))
        )
    )
    # the smallest member stands for its copies: ids are unique, so no key of this join is hot
    ends = joined_ids(keyed)
    return ends.join(keyed.select("conv_id", "turns", "chars"), "conv_id").select(
        F.lit(b"").alias("head"), F.lit(0).alias("depth"), "turns", "chars", "n_convs", "conv_id", "ends_sha256",
        F.lit(None).cast("binary").alias("parent"), F.lit(0).alias("last_chars"),
    )


def burst(suffixes: DataFrame, turns: int, least: int) -> tuple[DataFrame, list[DataFrame]]:
    """Suffixes in containers that are small enough, and the burst heads by depth.

    One round a depth, as long as a container is too large. The head of a burst container gets the members that
    end there; all others move on by one turn.
    """
    small, heads = [], []
    rows = cut_lineage(suffixes)
    while True:
        n_turns = F.sum(F.octet_length("turns") / WIDTH)
        large = cut_lineage(
            rows.groupBy("head")
            .agg(
                n_turns.alias("n_turns"),
                F.count("*").alias("n_rows"),
                F.sum("n_convs").alias("n_convs"),
                F.min("conv_id").alias("conv_id"),
                F.max(F.when(F.octet_length("turns") == 0, F.col("ends_sha256"))).alias("ends_sha256"),
                F.any_value("depth").alias("depth"),
                F.any_value("parent").alias("parent"),
                F.any_value("last_chars").alias("last_chars"),
            )
            .where((F.col("n_turns") > turns) & (F.col("n_rows") > least))
            .drop("n_turns", "n_rows")
        )
        if large.isEmpty():
            return _union([*small, rows]), heads
        heads.append(large)
        marked = cut_lineage(rows.join(large.select("head", F.lit(True).alias("burst")), "head", "left"))
        small.append(marked.where("burst is null").drop("burst"))
        turn = F.expr(f"substring(turns, 1, {WIDTH})")
        moved = marked.where("burst and octet_length(turns) > 0").select(
            F.unhex(F.md5(F.concat("head", turn))).alias("head"),
            (F.col("depth") + 1).alias("depth"),
            F.expr(f"substring(turns, {WIDTH + 1})").alias("turns"),
            F.expr("slice(chars, 2, size(chars))").alias("chars"),
            "n_convs",
            "conv_id",
            "ends_sha256",
            F.col("head").alias("parent"),
            F.col("chars")[0].alias("last_chars"),
        )
        rows = cut_lineage(moved)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


class Node:
    __slots__ = ("below", "chars", "conv_id", "ends", "n_children", "n_convs", "n_leaves", "saved")

    def __init__(self, chars: int):
        self.chars = chars
        self.conv_id = self.ends = None
        self.n_convs = self.n_children = self.n_leaves = self.saved = 0
        self.below: list[int] = []  # places of its children's rows


class Sweep:
    """Nodes of one container, from its suffixes in sorted order."""

    def __init__(self, depth: int, last_chars: int, top: bytes | None):
        self.depth, self.parent = depth, top
        self.path = [Node(last_chars)]
        self.before = b""
        self.rows: list[list] = []

    def add(self, turns: bytes, chars: list[int], n_convs: int, conv_id: int, ends: str) -> None:
        shared, limit = 0, min(len(self.path) - 1, len(chars))
        while shared < limit and turns[shared * WIDTH : (shared + 1) * WIDTH] == self.before[shared * WIDTH : (shared + 1) * WIDTH]:
            shared += 1
        self._close(shared + 1)
        self.path += [Node(c) for c in chars[shared:]]
        self.before = turns
        end = self.path[-1]
        end.ends, end.n_convs = ends, n_convs
        end.conv_id = conv_id if end.conv_id is None else min(end.conv_id, conv_id)

    def _close(self, keep: int) -> None:
        """Finish all nodes deeper than the first `keep` of the path."""
        while len(self.path) > keep:
            node = self.path.pop()
            place, up = self._row(node), self.path[-1]
            up.below.append(place)
            up.n_children += 1
            up.n_convs += node.n_convs
            up.n_leaves += node.n_leaves
            up.saved += node.saved
            up.conv_id = node.conv_id if up.conv_id is None else min(up.conv_id, node.conv_id)

    def _row(self, node: Node) -> int:
        node.n_leaves = node.n_leaves or 1
        node.saved += (node.n_convs - 1) * node.chars
        for child in node.below:
            self.rows[child][2] = node.conv_id
        self.rows.append([
            node.conv_id, self.depth + len(self.path), None, node.n_convs, node.n_children, node.n_leaves,
            node.saved, node.ends or NO_ENDS, None, False,
        ])
        return len(self.rows) - 1

    def finish(self) -> list[list]:
        self._close(1)
        top = self._row(self.path.pop())
        self.rows[top][8], self.rows[top][9] = self.parent, True
        return self.rows


SWEPT = pa.schema(
    [("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
     ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
     ("parent", pa.binary()), ("top", pa.bool_())]
)


def sweep(containers: DataFrame) -> DataFrame:
    """Nodes of all containers; those that are a container's head are marked `top` and name their parent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, current = None, None
        for batch in batches:
            done = []
            for k, depth, parent, last_chars, *suffix in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if current is None or k != head:
                    if current is not None:
                        done += current.finish()
                    head, current = k, Sweep(depth, last_chars, parent)
                current.add(*suffix)
            yield from packed(done)
        if current is not None:
            yield from packed(current.finish())

    def packed(rows: list[list]) -> Iterator[pa.RecordBatch]:
        if rows:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), SWEPT.types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=SWEPT)

    columns = ["head", "depth", "parent", "last_chars", "turns", "chars", "n_convs", "conv_id", "ends_sha256"]
    dealt = containers.select(*columns).repartition("head").sortWithinPartitions("head", "turns")
    return dealt.mapInArrow(run, f"{NODE}, parent binary, top boolean")


def trie(convs: DataFrame, burst_turns: int = BURST_TURNS, burst_suffixes: int = BURST_SUFFIXES) -> DataFrame:
    """Per node of the trie of (conv_id, seq) its smallest member and its counts."""
    containers, heads = burst(distinct_suffixes(convs), burst_turns, burst_suffixes)
    swept = cut_lineage(sweep(containers))
    names = [c for c in swept.columns if c not in ("parent", "top")]
    if not heads:
        return swept.select(*names)
    out, tops = [swept.where("not top").select(*names)], swept.where("top")
    for level in reversed(heads):
        below = tops.where("parent is not null").groupBy(F.col("parent").alias("head")).agg(
            F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved")
        )
        nodes = level.join(below, "head")
        summed = cut_lineage(
            nodes.select(
                "head", "conv_id", F.col("depth").cast("long").alias("depth"), "n_convs", "n_children", "n_leaves",
                (F.col("saved") + (F.col("n_convs") - 1) * F.col("last_chars")).alias("saved_tokens"),
                F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"), "parent",
            )
        )
        # the heads' children are done: they learn their parent's smallest member
        named = summed.select(F.col("head").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
        out.append(tops.drop("parent_conv_id").join(named, "parent").select(*names))
        waiting = tops.join(named.select("parent"), "parent", "left_anti")
        here = summed.withColumn("parent_conv_id", F.lit(None).cast("long")).withColumn("top", F.lit(True))
        tops = cut_lineage(waiting.unionByName(here.select(*waiting.columns)))
    return _union([*out, tops.select(*names)])
