import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from opinara.llm import resample

from .conftest import ODD_ROWS, prose

LENGTHS = [1, 2, 63, 64, 65, 127, 128, 129, 4096, 70_000]


def test_spans_of_all_lengths():
    data = np.random.default_rng(3).integers(0, 256, 200_000, dtype=np.uint8)
    starts = np.arange(0, 3000, 7)
    ends = starts + np.resize(LENGTHS, len(starts))
    expected = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
    assert resample.crc32_spans(data, starts, ends).tolist() == expected


def runs_of(text, max_run):
    lowered = (text or "").translate({k: k + 32 for k in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return [" ".join(words[i : i + n]) for n in range(1, max_run + 1) for i in range(len(words) - n + 1)]


@given(st.lists(st.text("aZ9 é-\n\x00😀", max_size=20), max_size=5), st.integers(1, 3))
@settings(max_examples=150, deadline=None)
def test_features(texts, max_run):
    found = [(int(i), int(c)) for t, crc in resample.features([t.encode() for t in texts], max_run) for i, c in zip(t, crc, strict=True)]
    expected = [(i, zlib.crc32(f.encode())) for i, t in enumerate(texts) for f in runs_of(t, max_run)]
    assert sorted(found) == sorted(expected)


def expected_rows(rows, target, max_run, buckets, min_words, percent):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s = Counter(bucket(f) for r in rows for f in runs_of(r[1], max_run))
    t = Counter(bucket(f) for text in target for f in runs_of(text, max_run))
    all_s, all_t = s.total() + buckets, t.total() + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(buckets)]
    out = []
    for r in rows:
        found = runs_of(r[1], max_run)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(sha256(f"2024:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([r[0], len(runs_of(r[1], 1)), len(found), weight, weight + noise, None])
    eligible = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for place, r in enumerate(eligible[: len(eligible) * percent // 100], 1):
        r[5] = place
    return sorted(map(repr, map(tuple, out)))


@pytest.mark.parametrize("max_run,percent", [(1, 10), (2, 60), (1, 100), (1, 0)])
def test_against_brute_force(spark, frame, max_run, percent):
    rows = ODD_ROWS + [(100 + i, prose(i % 40, 5 + i % 60)) for i in range(300)] + [(400, "x" * 300_000 + " y")]
    target = [prose(1, 50), None, "", prose(77, 500)]
    texts = spark.createDataFrame([(t,) for t in target], "text string")
    drawn = resample.resample(frame(rows), texts, max_run, 500, min_words=8, percent=percent)
    assert drawn.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    expected = expected_rows(rows, target, max_run, 500, 8, percent)
    assert sorted(repr(tuple(r)) for r in drawn.collect()) == expected


def test_empty_tables(spark, frame):
    none = spark.createDataFrame([], "text string")
    assert resample.resample(frame([]), none).count() == 0
    found = resample.resample(frame([(1, "a b")]), none, buckets=50).collect()
    assert [repr(tuple(r)) for r in found] == expected_rows([(1, "a b")], [], 1, 50, 20, 10)
