import random

from opinara.llm import near_dup

from .conftest import ODD_ROWS, prose


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(rows, n, percent):
    """component by doc_id, from all pairs."""
    sets = [(i, shingles(t, n)) for i, t, *_ in rows]
    group = {i: i for i, _ in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, s in sets:
        for b, t in sets:
            if a < b and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    return {i: root(i) for i in group}


def edited(text, share, seed):
    r = random.Random(seed)
    return " ".join(f"e{r.random()}" if r.random() < share else w for w in text.split(" "))


def corpus():
    rows, i = [], 100
    for g in range(6):
        base = prose(g, 120)
        for k in range(25):
            rows.append((i, edited(base, [0, 0.005, 0.01, 0.02, 0.04][k % 5], i)))
            i += 1
    # a chain whose ends are not alike, short texts, copies in other letters' case
    chain = prose("c", 100).split(" ")
    for k in range(8):
        rows.append((i + k, " ".join(chain[2 * k : 2 * k + 84])))
    rows += [(400 + k, " ".join(["a", "b", "c", "d"][: k % 5])) for k in range(10)]
    return [*rows, (500, rows[0][1].upper()), (501, " " + rows[0][1].replace(" ", "\n"))]


def test_equals_brute_force(frame):
    rows = corpus()
    for n, percent in ((3, 85), (5, 80)):
        found = near_dup.near_duplicates(frame(rows), n, percent).collect()
        assert {r["doc_id"]: r["component_id"] for r in found} == brute(rows, n, percent)
        assert {r["doc_id"]: r["n_shingles"] for r in found} == {i: len(shingles(t, n)) for i, t in rows}
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_blocks_lose_nothing(frame, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    rows = corpus()
    found = near_dup.near_duplicates(frame(rows), 3, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == brute(rows, 3, 85)


def test_odd_rows(frame):
    rows = near_dup.near_duplicates(frame(ODD_ROWS), 3, 85).collect()
    assert len(rows) == len(ODD_ROWS)
    for r in rows:
        assert r["doc_id"] == r["component_id"] and r["kept"]
    docs = frame([*ODD_ROWS, (0, ODD_ROWS[7][1])])
    kept = near_dup.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(0) == 1 and 7 not in ids and {1, 2, 3} <= set(ids)
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0
    assert near_dup.one_of_each(docs.limit(0)).count() == 0
