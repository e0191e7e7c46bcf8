import random

import numpy as np
import pytest

from opinara.llm import toxicity

from .conftest import ODD_ROWS, prose

INSULTS = ["blockhead", "numbskull", "dimwit", "halfwit", "scoundrel"]


def text_of(seed, insults=0):
    r = random.Random(seed)
    words = prose(seed, 40).split()
    for _ in range(insults):
        words.insert(r.randrange(1, len(words)), r.choice(INSULTS))
    return " ".join(words)


@pytest.fixture(scope="module")
def model():
    texts = [text_of(i, 2 * (i % 2)) for i in range(240)]
    return toxicity.train(texts, [i % 2 for i in range(240)])


def test_kernel_is_the_sum_over_subsequences():
    def plain(s):
        out = {}
        s = "\x02" + s + "\x03"
        for i in range(len(s)):
            for a in range(1, toxicity.SPAN):
                for b in range(a + 1, toxicity.SPAN):
                    for c in range(b + 1, toxicity.SPAN):
                        if i + c < len(s):
                            u = s[i] + s[i + a] + s[i + b] + s[i + c]
                            out[u] = out.get(u, 0) + toxicity.DECAY ** (c + 1)
        return out

    words = ["dimwit", "dimmwit", "aaaaaa", "é\U0001f600xyz", "ab", "halfwit"]
    found = toxicity.kernel(words, words)
    for i, x in enumerate(map(plain, words)):
        for j, y in enumerate(map(plain, words)):
            dot = sum(v * y.get(u, 0) for u, v in x.items())
            norm = (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
            assert found[i, j] == pytest.approx(dot / norm)


def test_held_out_texts(model):
    texts = [toxicity.all_units(text_of(1000 + i, 2 * (i % 2))) for i in range(100)]
    predicted = model.probability(toxicity.worst_of(model, texts)) >= 0.7
    truth = np.arange(100) % 2 == 1
    assert (predicted == truth).mean() >= 0.97


def test_gaps_and_inserted_characters(model):
    for word in ["block-head", "b l o c k h e a d", "numbxskull", "n.u.m.b.s.k.u.l.l", "DIMWIT!!", "dim*wit"]:
        units = toxicity.all_units(f"{prose(1, 30)} {word} {prose(2, 30)}")
        assert model.word_scores(sorted(units)).max() > 0, word
    parts = toxicity.worst_of(model, [{"head", "river", "wonder", "stone", "the"}])
    assert model.probability(parts)[0] < 0.7


def test_odd_rows(frame, model):
    docs = frame(ODD_ROWS)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == len(ODD_ROWS)
    assert all(0 <= r["score"] < 0.7 for r in rows)
    assert len({r["score"] for r in rows if not (r["text"] or "").strip()}) == 1
    assert set(rows[0].asDict()) == {*docs.columns, "worst_word"}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_long_text_is_read_to_its_end(frame, model):
    rows = frame([(1, prose(5, 20_000) + " dimwit scoundrel blockhead")])
    assert toxicity.score(rows, model).first()["score"] >= 0.7


def test_nothing_to_learn_from(frame, spark):
    docs = frame([(1, "a dimwit"), (2, "fine")])
    labels = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, toxic int")
    assert not toxicity.fit(docs.join(labels, "doc_id")).known
    assert toxicity.score(docs, toxicity.fit(docs.join(labels.limit(0), "doc_id"))).first()["score"] == 0
