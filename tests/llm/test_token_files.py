import heapq
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from opinara.llm import huffman, token_files

from .conftest import ODD_ROWS, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def word_ids():
    with open(PATH, encoding="utf-8") as file:
        return token_files.WordIds(file.read())


def plain_cost(counts):
    """Cost of an unbounded Huffman code."""
    heap, cost = [c for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


@given(st.lists(st.integers(0, 10_000), min_size=2, max_size=60))
@settings(max_examples=200, deadline=None)
def test_lengths_are_optimal(counts):
    counts = np.array(counts)
    lengths = huffman.code_lengths(counts, 40).astype(int)
    used = counts > 0
    assert (lengths[~used] == 0).all() and (lengths[used] > 0).all()
    if used.sum() > 1:
        assert (2.0 ** -lengths[used]).sum() == 1
        assert (lengths * counts).sum() == plain_cost(counts.tolist())


def test_lengths_keep_the_bound():
    counts = np.array([2**i for i in range(40)])
    lengths = huffman.code_lengths(counts, 8)
    assert lengths.max() == 8 and (2.0 ** -lengths.astype(float)).sum() == 1
    assert huffman.code_lengths(np.ones(300, int), 8).max() == 9
    assert huffman.code_lengths(np.array([0, 0, 7])).tolist() == [0, 0, 1]
    # the best of all codes of at most 3 bits for five ids
    assert (huffman.code_lengths(np.array([1, 1, 1, 10, 100]), 3) * np.array([1, 1, 1, 10, 100])).sum() == 100 + 3 * 13


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
@pytest.mark.parametrize("ids", [1, 2, 300, 40_000])
def test_blocks(n, ids):
    rng = np.random.default_rng(n + ids)
    values = (rng.pareto(0.7, n) * 3).astype(np.int64) % ids
    lengths = huffman.code_lengths(np.bincount(np.concatenate([values, [0, ids - 1]]), minlength=ids))
    data, starts = huffman.Encoder(lengths).pack(values)
    decoder = huffman.Decoder(lengths)
    assert (decoder.unpack(data, starts, n) == values).all()
    for k in range(len(starts)):
        size = min(huffman.BLOCK, n - k * huffman.BLOCK)
        one = decoder.unpack(data, starts[k : k + 1], size)
        assert (one == values[k * huffman.BLOCK :][:size]).all()


LETTERS = "aZéÉÑñßİıſŉǅΣςаЖ中あ가👍🏽0٣½²_-'.,!?<|>́̇  　\x1c\x85\x0b\x0c\t\n \x00‍"
PIECES = st.one_of(st.text(LETTERS, max_size=8), st.sampled_from(["<|endoftext|>", "'s", "it's", "'LL", "é", " ", "Straße!!", "A.B", "x'"]))


@given(st.lists(PIECES, max_size=10).map("".join))
@settings(max_examples=1500, deadline=None)
def test_words_apart_are_the_whole_text(library, word_ids, text):
    expected = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(word_ids(text.encode()), "<u4").tolist() == expected


@given(st.text(max_size=12))
@settings(max_examples=1500, deadline=None)
def test_any_text(library, word_ids, text):
    expected = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(word_ids(text.encode()), "<u4").tolist() == expected


def test_slices_and_full_cache(library, word_ids, monkeypatch):
    monkeypatch.setattr(token_files, "TEXT_SLICE", 40)
    monkeypatch.setattr(token_files, "CACHE_WORDS", 3)
    text = prose(1, 300) + " " + "x" * 200 + "! " + prose(1, 50)
    assert np.frombuffer(word_ids(text.encode()), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def expected_rows(library, rows):
    out = []
    for r in rows:
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 1]
        data = np.array(ids, "<u4").tobytes()
        out.append((r[0], len(ids), zlib.crc32(data), data))
    return out


@pytest.mark.parametrize("file_ids,read_ids", [(1 << 26, 1 << 22), (3000, 700), (1, 2000)])
def test_round_trip(spark, frame, library, tmp_path, file_ids, read_ids):
    rows = ODD_ROWS + [(1000 - i, prose(i % 50, 1 + i)) for i in range(200)] + [(-5, "<|endoftext|> a"), (2**60, prose(3, 9))]
    tokens, kind = token_files.tokenize(frame(rows), PATH, 1)
    files = token_files.write_files(tokens, kind, f"{tmp_path}/files", file_ids)
    found = sorted(token_files.read_files(files, read_ids, with_ids=True).collect(), key=lambda r: r["start"])
    expected = expected_rows(library, rows)
    assert sorted(map(repr, ((r["doc_id"], r["n_tokens"], r["ids_crc32"], bytes(r["ids"])) for r in found))) == sorted(map(repr, expected))
    ids = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in found]
    assert ids == sorted(ids)
    at = 0
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]
    if file_ids == 1:
        assert files.count() == len(rows)


def test_query_columns_and_empty(spark, frame):
    assert token_files.token_round_trip(frame([]), PATH).count() == 0
    one = token_files.token_round_trip(frame([(4, None)]), PATH).select(F.struct("*").alias("r")).first()["r"]
    assert (one["doc_id"], one["start"], one["n_tokens"]) == (4, 0, 1)
    assert one["ids_crc32"] == zlib.crc32(b"\1\0\0\0")
