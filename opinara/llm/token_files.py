"""Documents as token ids in Huffman-coded files, in the order of their ids, and the way back.

Texts are tokenised once. The counts of all ids give one canonical code of bounded length, the same in every
file. Documents are sorted by id in ranges; each range is written as one file or several, so that the files, by
(part, number), hold all documents in ascending order.

A file: `HUFIDS01`; the codes of all its ids, packed; a footer of the code lengths of ids 0, 1, 2... (one byte
each), the bit at which each block of 256 ids begins (8 bytes each), and of every document its id (8 bytes),
whether it has one (1 byte) and its number of ids (8 bytes); the numbers of ids, blocks, documents and code
lengths and the place of the footer (8 bytes each). All numbers are little-endian. A reader looks up the blocks
it needs by their bits and decodes them side by side, so one file is read by many tasks.

A missing text is empty and has the end id alone. A document without an id comes first and keeps none. Repeated
rows are documents of their own; documents of one id are ordered by a digest of their ids. An empty table has no files
and gives no rows. Texts and files of any length are worked through in slices.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinara.llm.common import byte_chunks, collect_arrays, text_bytes
from opinara.llm.huffman import BLOCK, Decoder, Encoder, code_lengths
from opinara.llm.warc import opened
from opinara.runtime import cut_lineage, scratch_dir

MAGIC = b"HUFIDS01"
TAIL = struct.Struct("<5q")
RUN = BLOCK * 4096  # ids that are packed or decoded at a time
FILE_IDS = 64 << 20  # a file is closed at the end of the document that reaches this
READ_IDS = 4 << 20  # ids that one reading task is meant to have
CACHE_WORDS = 600_000  # words of a generation of the cache
TEXT_SLICE = 1 << 20

_BREAK = re.compile(rb"[ \t\n\r\x0b\x0c]")
# A word of letters that the tokenizer keeps together, and signs that it never joins to a letter before them.
_SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!-&(-/:-@\\[-`{-~]*)")
# The tokenizer's model sees the bytes of a text as characters: printable ones as themselves, the others as those
# from 256 on, in order.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_AS_CHARACTER = {b: b for b in _PRINTED} | {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTED)))}

_TOKENIZERS: dict[tuple[int, type], WordIds] = {}


class WordIds:
    """Ids of texts by a tokenizer that drops white space, so that its words can be encoded apart.

    Words keep their ids in a cache of two generations: when the younger is full it becomes the older, and words
    of the older that are met again move back. A plain word, which normalising and splitting only lower and part
    from its signs, goes to the tokenizer's model as it is; every other one to the tokenizer.
    """

    def __init__(self, definition: str, code: str = "I"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.code = code
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _letters(self, part: str) -> bytes:
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(_AS_CHARACTER)
        return array(self.code, [t.id for t in self.model.tokenize(part)]).tobytes()

    def _whole(self, part: str) -> bytes:
        return array(self.code, self.tokenizer.encode_batch_fast([part], add_special_tokens=False)[0].ids).tobytes()

    def _learned(self, word: bytes) -> bytes:
        """Ids of a word that the younger generation lacks."""
        ids = self.older.get(word)
        if ids is None:
            text = word.decode()
            split = _SIMPLE.fullmatch(text)
            if split is None:
                ids = self._whole(text)
            else:
                head, tail = split.groups()
                head = head.lower()
                ids = self.parts.get(head)
                if ids is None:
                    ids = self.parts[head] = self._letters(head)
                if tail:
                    more = self.parts.get(tail)
                    if more is None:
                        more = self.parts[tail] = self._whole(tail)
                    ids += more
        self.words[word] = ids
        return ids

    def __call__(self, text: bytes) -> bytes:
        out, at = [], 0
        while at < len(text):
            end = len(text)
            if end - at > TEXT_SLICE:
                space = _BREAK.search(text, at + TEXT_SLICE)
                end = space.start() if space else end
            if len(self.words) >= CACHE_WORDS:
                self.words, self.older, self.parts = {}, self.words, {}
            words = text[at:end].split()
            ids = list(map(self.words.get, words))
            if None in ids:
                known = self.words
                for i, found in enumerate(ids):
                    if found is None:
                        ids[i] = known.get(words[i]) or self._learned(words[i])
            out.append(b"".join(ids))
            at = end
        return b"".join(out)


def id_kind(size: int) -> type[np.unsignedinteger]:
    return np.uint16 if size <= 1 << 16 else np.uint32


def tokenize(docs: DataFrame, path: str, end_id: int) -> tuple[DataFrame, type]:
    """(doc_id, n, ids) of every document, its ids with the end id behind them as bytes, and the kind of
    number that they are. The tokenizer's definition is handed to the tasks from the driver."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        text = file.read()
    kind = id_kind(max(Tokenizer.from_str(text).get_vocab_size(), end_id + 1))
    definition = docs.sparkSession.sparkContext.broadcast(text)
    code = np.dtype(kind).char
    end, key = np.array([end_id], kind).tobytes(), (zlib.crc32(text.encode()), kind)
    width = len(end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _TOKENIZERS:
            _TOKENIZERS[key] = WordIds(definition.value, code)
        ids_of = _TOKENIZERS[key]
        for batch in batches:
            ids = [ids_of(t.as_py()) + end for t in batch.column(1)]
            sizes = pa.array([len(i) // width for i in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(ids, pa.binary())], names=["doc_id", "n", "ids"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("t"))
    return narrow.mapInArrow(run, "doc_id long, n long, ids binary"), kind


def count_ids(tokens: DataFrame, kind: type) -> np.ndarray:
    """How often each id is used in all documents; one row an id reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for _, values in byte_chunks(batch.column(0)):
                n = np.bincount(np.frombuffer(b"".join(values), kind))
                if len(n) > len(total):
                    total = np.pad(total, (0, len(n) - len(total)))
                total[: len(n)] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(used, pa.int64()), "n": pa.array(total[used], pa.int64())})

    rows = collect_arrays(tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")))
    counts = np.zeros(int(rows["id"].max()) + 1 if len(rows["id"]) else 0, np.int64)
    counts[rows["id"]] = rows["n"]
    return counts


class Writer:
    """One file; packs ids as soon as a run of blocks is full."""

    def __init__(self, out, encoder: Encoder, kind: type):
        self.out, self.encoder, self.kind = out, encoder, kind
        self.bits: list[np.ndarray] = []
        self.docs: list[int | None] = []
        self.sizes: list[int] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        self.at = len(MAGIC)
        out.write(MAGIC)

    def _pack(self, ids: np.ndarray) -> None:
        data, begins = self.encoder.pack(ids)
        self.bits.append(begins + 8 * self.at)
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.sizes.append(len(ids))
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= RUN:
            joined = np.concatenate(self.waiting)
            full = len(joined) // RUN * RUN
            for i in range(0, full, RUN):
                self._pack(joined[i : i + RUN])
            self.waiting, self.n_waiting = [joined[full:].copy()], len(joined) - full

    def close(self) -> None:
        if self.n_waiting:
            self._pack(np.concatenate(self.waiting))
        bits = np.concatenate(self.bits) if self.bits else np.zeros(0, np.int64)
        for part in (
            self.encoder.lengths.astype(np.uint8),
            bits.astype("<i8"),
            np.array([d or 0 for d in self.docs], "<i8"),
            np.array([d is not None for d in self.docs], np.uint8),
            np.array(self.sizes, "<i8"),
        ):
            self.out.write(part.tobytes())
        self.out.write(TAIL.pack(self.n_ids, len(bits), len(self.docs), len(self.encoder.lengths), self.at))
        self.out.close()


class Reader:
    """One file's footer, and its ids from any place on."""

    def __init__(self, file):
        size = file.size()
        self.file = file
        file.seek(size - TAIL.size)
        self.n_ids, n_blocks, n_docs, n_lengths, self.end = TAIL.unpack(file.read(TAIL.size))
        file.seek(self.end)
        footer = file.read(size - TAIL.size - self.end)
        places = list(accumulate([0, n_lengths, 8 * n_blocks, 8 * n_docs, n_docs, 8 * n_docs]))
        kinds = [np.uint8, "<i8", "<i8", np.uint8, "<i8"]
        parts = [np.frombuffer(footer[a:b], k) for (a, b), k in zip(pairwise(places), kinds, strict=True)]
        lengths, self.bits, self.docs, self.named, self.sizes = parts
        self.decoder = Decoder(lengths)

    def runs(self, start: int, stop: int) -> Iterator[tuple[int, np.ndarray]]:
        """(place of its first id, ids) of consecutive runs that together are ids start to stop."""
        block, last = start // BLOCK, -(-stop // BLOCK)
        while block < last:
            to = min(last, block + RUN // BLOCK)
            first = int(self.bits[block]) >> 3
            end = (int(self.bits[to]) + 7 >> 3) if to < len(self.bits) else self.end
            self.file.seek(first)
            n = min(to * BLOCK, self.n_ids) - block * BLOCK
            ids = self.decoder.unpack(self.file.read(end - first), self.bits[block:to] - 8 * first, n)
            a, b = max(start, block * BLOCK), min(stop, to * BLOCK, self.n_ids)
            yield a, ids[a - block * BLOCK : b - block * BLOCK]
            block = to


def write_files(tokens: DataFrame, kind: type, folder: str, file_ids: int = FILE_IDS) -> DataFrame:
    """Write (doc_id, ids) below folder; (path, part, number, n_ids) of the files that count, in whose order
    by part and number the documents ascend."""
    lengths = code_lengths(count_ids(tokens, kind))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(folder)
        system.create_dir(root, recursive=True)
        encoder, part = Encoder(lengths), TaskContext.get().partitionId()
        writer, name, number = None, "", 0

        def done() -> pa.RecordBatch:
            writer.close()
            row = {"path": f"{folder}/{name}", "part": part, "number": number, "n_ids": writer.n_ids}
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            for i in range(batch.num_rows):
                if writer is None:
                    name = f"ids-{uuid.uuid4().hex}.huf"
                    writer = Writer(system.open_output_stream(f"{root}/{name}", compression=None), encoder, kind)
                writer.add(batch.column(0)[i].as_py(), np.frombuffer(batch.column(1)[i].as_buffer(), kind))
                if writer.n_ids >= file_ids:
                    yield done()
                    writer, number = None, number + 1
        if writer is not None:
            yield done()

    order = [F.asc_nulls_first("doc_id"), F.asc("tie")]
    rows = tokens.select("doc_id", "ids", F.xxhash64("ids").alias("tie"))
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    return cut_lineage(ranges.mapInArrow(write, "path string, part long, number long, n_ids long"))


def read_files(files: DataFrame, read_ids: int = READ_IDS, with_ids: bool = False) -> DataFrame:
    """Per document of the files (path, part, number, n_ids): doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32 and, if wanted, its ids.

    A file is read by as many tasks as it has slices of `read_ids` ids; a document belongs to the slice in which it
    begins. The driver sees one sum a part.
    """
    spark = files.sparkSession
    sums = files.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    before = accumulate([0] + [r["n"] for r in sums])
    offsets = spark.createDataFrame([(r["part"], b) for r, b in zip(sums, before, strict=False)], "part long, offset long")
    earlier = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    slices = F.greatest(F.ceil(F.col("n_ids") / read_ids), F.lit(1))
    items = (
        files.withColumn("earlier", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))
        .join(F.broadcast(offsets), "part")
        .select("path", (F.col("offset") + F.col("earlier")).alias("base"), F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"))
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, inner = opened(path)
                with system.open_input_file(inner) as file:
                    yield from rows_of(Reader(file), base, part * read_ids, (part + 1) * read_ids)

    def rows_of(reader: Reader, base: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
        starts = np.cumsum(reader.sizes) - reader.sizes
        first, last = np.searchsorted(starts, [low, high])
        if first == last:
            return
        doc, crc, rows, parts = first, 0, [], []
        for at, ids in reader.runs(int(starts[first]), int(starts[last - 1] + reader.sizes[last - 1])):
            ids, end = ids.astype("<u4"), at + len(ids)
            while doc < last and starts[doc] < end:
                stop = starts[doc] + reader.sizes[doc]
                data = ids[max(starts[doc] - at, 0) : stop - at].tobytes()
                crc = zlib.crc32(data, crc)
                if with_ids:
                    parts.append(data)
                if stop > end:
                    break
                named = int(reader.docs[doc]) if reader.named[doc] else None
                row = (named, base + int(starts[doc]), int(reader.sizes[doc]), crc, b"".join(parts) if with_ids else None)
                rows.append(row)
                doc, crc, parts = doc + 1, 0, []
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=NAMES)
                rows = []

    spread = items.repartition(spark.sparkContext.defaultParallelism * 4, "path", "slice")
    found = spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
    return found if with_ids else found.drop("ids")


NAMES = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def token_round_trip(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """Tokenise, write the files and read every document back from them."""
    spark: SparkSession = docs.sparkSession
    tokens, kind = tokenize(docs, path, end_id)
    tokens = cut_lineage(tokens)
    return read_files(write_files(tokens, kind, scratch_dir(spark, "token-files")))
