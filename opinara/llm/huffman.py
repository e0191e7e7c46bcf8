"""Canonical Huffman codes of bounded length for token ids: lengths, packing and decoding in blocks.

A code is given by its lengths alone: codes of one length count upwards in the order of the ids. With no code
longer than L bits a table of 2**L entries, indexed by the next L bits, gives an id and its length. Blocks of a
fixed number of ids begin at known bits, so all blocks of a run are decoded side by side, one id of each at a
time, and any block can be read without the ones before.
"""

from __future__ import annotations

import numpy as np

MAX_BITS = 16
# ids a block; the bit at which a block begins is kept
BLOCK = 256


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths for the counts of ids 0, 1, 2... under a bound; ids without a count get 0.

    Package-merge: of L lists, each made of the single ids and of the pairs of the list before, the cheapest
    2n - 2 entries of the last are taken apart; an id's length is how often it turns up. The bound is raised
    where the ids need more bits even with codes of one length.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n < 2:
        lengths[used] = 1
        return lengths
    bits = max(max_bits, int(n - 1).bit_length())
    order = np.argsort(counts[used], kind="stable")
    weights = counts[used][order].astype(np.float64)
    merged, kept = weights, [np.ones(n, bool)]
    for _ in range(bits - 1):
        half = len(merged) // 2
        pairs = merged[: 2 * half : 2] + merged[1 : 2 * half : 2]
        both = np.concatenate([weights, pairs])
        single = np.arange(len(both)) < n
        by_weight = np.argsort(both, kind="stable")
        merged = both[by_weight]
        kept.append(single[by_weight])
    taken = np.zeros(n, np.int64)
    wanted = 2 * n - 2
    for single in reversed(kept):
        singles = int(single[:wanted].sum())
        taken[:singles] += 1  # singles of every list stand in the order of their weight
        wanted = 2 * (wanted - singles)
    lengths[used[order]] = taken
    return lengths


def codes(lengths: np.ndarray) -> np.ndarray:
    """The canonical code of every id, as a number of as many bits as its length."""
    out = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        sizes = lengths[order].astype(np.uint64)
        top = sizes[-1]
        # each code is the sum of the shares of the codes before, in units of the longest code
        share = np.uint64(1) << (top - sizes)
        out[order] = (np.cumsum(share) - share) >> (top - sizes)
    return out


class Encoder:
    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.codes = codes(lengths)

    def pack(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The ids' codes one behind the other, filled up to whole bytes, and the bit of every block's start."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        begins = ends - sizes
        words = np.zeros((int(ends[-1]) + 63 >> 6) + 1 if len(ids) else 1, np.uint64)
        if len(ids):
            code = self.codes[ids]
            word, free = begins >> 6, 64 - (begins & 63) - sizes
            inside = np.where(free >= 0, code << np.maximum(free, 0).astype(np.uint64), code >> np.maximum(-free, 0).astype(np.uint64))
            first = np.flatnonzero(np.diff(word, prepend=-1))
            words[word[first]] = np.bitwise_or.reduceat(inside, first)
            over = np.flatnonzero(free < 0)  # at most one code a word reaches into the next
            words[word[over] + 1] |= code[over] << (64 + free[over]).astype(np.uint64)
        data = words.astype(">u8").tobytes()[: int(ends[-1]) + 7 >> 3 if len(ids) else 0]
        return data, begins[::BLOCK]


class Decoder:
    def __init__(self, lengths: np.ndarray):
        used = np.flatnonzero(lengths)
        self.bits = int(lengths.max()) if len(used) else 1
        share = np.int64(1) << (self.bits - lengths[used].astype(np.int64))
        order = np.argsort(codes(lengths)[used] * share.astype(np.uint64), kind="stable")
        self.ids = np.repeat(used[order], share[order]).astype(np.uint32)
        self.sizes = np.repeat(lengths[used[order]], share[order]).astype(np.int64)

    def unpack(self, data: bytes, starts: np.ndarray, n: int) -> np.ndarray:
        """The n ids of consecutive blocks that begin at the given bits of data; the last may be shorter."""
        padded = np.frombuffer(data + bytes(8), np.uint8)
        at = starts.astype(np.int64)
        out = np.empty((BLOCK, len(at)), np.uint32)
        mask, last = (1 << self.bits) - 1, len(data) * 8
        for i in range(min(BLOCK, n)):
            byte = np.minimum(at, last) >> 3
            window = np.zeros(len(at), np.int64)
            for k in range((self.bits + 14) // 8):
                window = (window << 8) | padded[byte + k]
            peek = (window >> ((self.bits + 14) // 8 * 8 - self.bits - (at & 7))) & mask
            out[i] = self.ids[peek]
            at = at + self.sizes[peek]
        return out.T.reshape(-1)[:n]
