import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from opinara.llm import prefix_trie as pt

COLUMNS = "conv_id long, turn long, role string, text string, key string, head string, depth int"


def rebuilt_conversations(rows):
    own = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            own[r[0]].append(r[1:4])
    for conv in own:
        # rows of one turn differ only where the tests do not look at their order
        own[conv].sort(key=lambda t: (t[0] is not None, t[0] or 0))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = [(r or "", t or "") for _, r, t in own.get(base, [])[:h] + turns[h:]]
    return out


def expected_nodes(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    rows = []
    for path, ids in members.items():
        below = [p for p in members if p[: len(path)] == path]
        parents = {p[:-1] for p in below if p}
        rows.append((
            min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids),
            sum(len(p) == len(path) + 1 for p in below),
            sum(p not in parents for p in below),
            sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
            sha256(",".join(map(str, sorted(c for c in ids if len(convs[c]) == len(path)))).encode()).hexdigest(),
        ))
    return sorted(map(repr, rows))


def found_nodes(frame):
    return sorted(repr(tuple(r)) for r in frame.collect())


def made(n, seed=5, most=7):
    rows = []
    for c in range(n):
        for t in range((c * 7 + seed) % most + 1):
            rows.append((c * 3, t, "user" if t % 2 == 0 else "assistant", f"t{(c * c + t * seed) % 4}"))
    return rows


ODD = [
    (None, 0, "user", "nobody"),
    (None, None, None, None),
    (500, None, None, None),
    (500, 4, "user", ""),
    (500, 4, "user", ""),
    (501, 0, "user", "x" * 200_000),
    (502, 9, "a:", "b"),
    (503, 9, "a", ":b"),
    (-150, 1, "user", "minus"),
    (-100, 1, "user", "hundred"),
    (-7, 1, "user", "seven"),
    (0, -1, "user", "\U0001f600é"),
    (2**40, 0, None, "far"),
]


@pytest.mark.parametrize("turns,suffixes", [(100_000, 64), (40, 3), (0, 1)])
def test_against_brute_force(spark, turns, suffixes):
    rows = made(120) + ODD
    frame = spark.createDataFrame([(*r, "k", "h", 1) for r in rows], COLUMNS).repartition(5)
    convs = pt.rebuilt(pt.sequences(frame))
    found = pt.trie(convs, turns, suffixes)
    assert found.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    ]
    assert found_nodes(found) == expected_nodes(rebuilt_conversations(rows))


def test_large_groups_of_copies(spark, monkeypatch):
    monkeypatch.setattr(pt, "ID_BLOCK", 7)
    rows = [(c, t, "user", f"same {t}") for c in range(1000, 1400) for t in range(8)]
    rows += [(c, t, "user", f"same {min(t, c % 9)}") for c in range(2000, 2100) for t in range(9)]
    rows += [(c, 0, "user", "hello") for c in range(3000, 3090)]
    frame = spark.createDataFrame([(*r, "k", "h", 1) for r in rows], COLUMNS)
    convs = pt.rebuilt(pt.sequences(frame))
    expected = expected_nodes(rebuilt_conversations(rows))
    assert found_nodes(pt.trie(convs)) == expected
    assert found_nodes(pt.trie(convs, 5, 1)) == expected


def test_a_long_conversation(spark):
    rows = [(1, t, "user", f"{t}") for t in range(3000)] + [(2, t, "user", f"{t}") for t in range(1500)]
    frame = spark.createDataFrame([(*r, "k", "h", 1) for r in rows], COLUMNS)
    found = {(r["conv_id"], r["depth"]): r for r in pt.trie(pt.sequences(frame)).collect()}
    assert len(found) == 3001 and found[1, 0]["n_convs"] == found[1, 1500]["n_convs"] == 2
    assert found[1, 0]["saved_tokens"] == sum(len(str(t)) for t in range(1500))
    assert found[1, 1500]["ends_sha256"] == sha256(b"2").hexdigest() and found[1, 3000]["n_leaves"] == 1


def test_empty(spark):
    frame = spark.createDataFrame([], COLUMNS)
    assert pt.trie(pt.rebuilt(pt.sequences(frame))).count() == 0


@given(st.lists(st.lists(st.integers(0, 2), max_size=5), min_size=1, max_size=9))
@settings(max_examples=200, deadline=None)
def test_sweep(sequences):
    copies = defaultdict(list)
    for c, turns in enumerate(sequences):
        copies[tuple(turns)].append(c)
    current = pt.Sweep(0, 0, None)
    for turns, ids in sorted(copies.items()):
        digests = b"".join(bytes([t]) * pt.WIDTH for t in turns)
        current.add(digests, list(turns), len(ids), ids[0], sha256(",".join(map(str, ids)).encode()).hexdigest())
    expected = expected_nodes({c: [("", chr(65 + t) * t) for t in turns] for c, turns in enumerate(sequences)})
    assert sorted(repr(tuple(r[:8])) for r in current.finish()) == expected
