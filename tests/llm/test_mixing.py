import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from opinara.llm import mixing

from .conftest import ODD_ROWS, prose


def resharing(sizes, weights):
    """Targets as the rule tells it: deal, stop at twice the size, deal the excess again."""
    targets = [0.0] * len(sizes)
    excess, open_ = 1.5 * sum(sizes), list(range(len(sizes)))
    while excess > 1e-9 and open_:
        total = sum(weights[i] for i in open_)
        for i in open_:
            targets[i] += excess * weights[i] / total
        excess = sum(max(0, targets[i] - 2 * sizes[i]) for i in open_)
        stopped = [i for i in open_ if targets[i] >= 2 * sizes[i]]
        for i in stopped:
            targets[i] = 2 * sizes[i]
        open_ = [i for i in open_ if i not in stopped]
    return targets


@given(st.lists(st.integers(0, 1000), max_size=12))
@settings(max_examples=200, deadline=None)
def test_targets(sizes):
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    assert mixing.fill_targets(sizes, weights) == pytest.approx(resharing(sizes, weights), abs=1e-6)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1000])
def test_permutation(size):
    image = mixing.permute(np.arange(size), size, 12345)
    assert sorted(image) == list(range(size))
    assert image[mixing.unpermute_last(size, 12345)] == size - 1


def test_shards_share_out_the_totals():
    totals = np.array([100, 0, 37, 900])
    parts = [mixing.shard_counts(totals, i, 11, 100, 3) for i in range(11)]
    assert (sum(here for _, here in parts) == totals).all()
    assert [int(here.sum()) for _, here in parts] == [100] * 10 + [37]
    for i, (before, _) in enumerate(parts):
        assert (before == sum((here for _, here in parts[:i]), np.zeros(4, int))).all()


def test_large_populations_are_drawn_in_range():
    r = np.random.default_rng(1)
    n = mixing.draw(r, 3 * 10**12, 10**12, 10**9)
    assert abs(n - 75 * 10**7) < 10**6


def test_mix(frame):
    rows = [(100 + i, prose(i, 5 + 37 * (i % 9)), "en", ["b", "a", None, "é", "Z"][min(i % 7, 4)]) for i in range(60)]
    rows += ODD_ROWS
    docs = frame(rows)
    for with_text in (True, False):
        documents, pieces = mixing.mix(docs, block=16, with_text=with_text)
        d, p = documents.toPandas(), pieces.toPandas()
        assert len(d) == len(rows)
        own = p.groupby(["number", "offset"])["n_words"].sum()
        sizes = d[d["size"] > 0].set_index(["number", "offset"])["size"]
        assert sizes.index.is_unique
        assert (own <= 2 * sizes.reindex(own.index)).all()
        for number, target in d.groupby("number")["target"].first().items():
            assert p[p["number"] == number]["n_words"].sum() == int(target)
        names = d.groupby("number")["source"].first()
        assert list(names.dropna()) == sorted(names.dropna(), key=lambda s: s.encode())
        slots = p.groupby(["shard", "slot"])["n_words"].sum()
        assert slots.max() <= 16
        if with_text:
            texts = {r[0]: (r[1] or "").encode().split() for r in rows}
            for r in p.itertuples():
                if r.doc_id == r.doc_id and r.doc_id != 7:
                    words = texts[int(r.doc_id)][r.first_word : r.first_word + r.n_words]
                    assert r.text.encode().split() == words


def test_same_again_and_empty(frame):
    docs = frame([(i, prose(i, 50), "en", "ab"[i % 2]) for i in range(20)])
    one, two = (sorted(map(tuple, mixing.mix(docs, block=8)[1].collect())) for _ in range(2))
    assert one == two
    documents, pieces = mixing.mix(docs.limit(0))
    assert documents.count() == pieces.count() == 0
    documents, pieces = mixing.mix(frame([(1, None), (2, "")]))
    assert documents.count() == 2 and pieces.count() == 0
