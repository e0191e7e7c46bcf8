import random
from collections import Counter

import numpy as np
import pytest

from opinara.llm import toxicity

from .conftest import prose

TEXTS = ["", " ", "a b c", "a b", "a  b c", "x\ta b\tc d", "a b c.", "i d i o t\nyou", "é_ b c d", "a\xa0b\xa0c", "A B C D E"]


def by_rule(text):
    low = text.lower()
    return set(low.split()) | {"".join(m.group().split()) for m in toxicity._SPELLED.finditer(low)}


def test_spelled_words_are_those_of_the_rule():
    rng = random.Random(5)
    made = ["".join(rng.choice("ab. \t\n_é\xa0\x1c") for _ in range(rng.randrange(30))) for _ in range(5000)]
    for text in TEXTS + made:
        assert toxicity.words_of(text) == by_rule(text)


def test_units_of_plain_words_need_no_pattern(monkeypatch):
    for word in ("word", "été", "a1", "_x", "x_y", "²", "½a", "中文", "don't", "--", ""):
        plain = toxicity._EDGE.sub("", word)
        bare = toxicity._INNER.sub("", plain)
        assert toxicity.units(word) == ([plain] if bare == plain else [plain, bare] if plain else [])
    monkeypatch.setattr(toxicity, "_EDGE", None)
    assert toxicity.units("word") == ["word"]


@pytest.mark.parametrize("words, scores, worst", [
    ([], [], None), (["a"], [-1.0], None), (["a", "c", "b"], [0.5, 0.5, 0.1], "c"), (["a", "b"], [-1.0, -0.2], "b"),
])
def test_worst_word(words, scores, worst):
    assert toxicity.worst_word(words, scores) == worst


def test_a_text_has_the_scores_of_its_words(spark):
    model = toxicity.train(["you idiot fool stupid"] * 40 + [f"fine day word{i % 9} here" for i in range(200)], [1] * 40 + [0] * 200)
    texts = ["idiot, idiot. (idiot) other", "fine day", "i d i o t", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    for i, text in enumerate(texts):
        units = {w: toxicity.units(w) for w in by_rule(text or "")}
        own = {w: max(model.word_scores(u).tolist(), default=-1.0) for w, u in units.items()}
        value = model.probability(toxicity.np.array([toxicity.features(own.values())]))[0]
        top = max(own.values(), default=-1.0)
        assert rows[i]["score"] == pytest.approx(value, abs=1e-12)
        assert rows[i]["worst_word"] == (max(w for w in own if own[w] == top) if top > -1 else None)


def test_norms_and_places_equal_plain_sums():
    random = np.random.default_rng(9)
    words = ["mississippi", "aa", "a", "", "\x02\x02ab", "\U0001f600\U0001f600é" * 4, "banana-banana"]
    words += ["".join(chr(97 + i) for i in random.integers(0, 4, n)) for n in random.integers(0, 30, 300)]
    found = toxicity.sequences(words)
    sums = [Counter() for _ in words]
    for code, weight, word in zip(found.code.tolist(), found.weight.tolist(), found.word.tolist(), strict=True):
        sums[word][code] += weight
    assert np.allclose(found.norms(), [sum(v * v for v in s.values()) ** 0.5 for s in sums], atol=1e-12)
    codes = np.unique(found.code)[::2]
    here, there = toxicity.Table(codes).find(found.code)
    assert (here == np.flatnonzero(np.isin(found.code, codes))).all() and (codes[there] == found.code[here]).all()


def test_common_words_are_scored_once_over_tasks(monkeypatch):
    """A second run of texts scored all its words again, and so did a run after more than CACHE words."""
    monkeypatch.setattr(toxicity, "CACHE", 20)
    model = toxicity.train([prose(i, 40) for i in range(40)], [i % 2 for i in range(40)])
    asked = []
    score = model.word_scores
    model.word_scores = lambda words: asked.extend(words) or score(words)
    common = ["the", "of", "and", "(and)"]
    for k in range(20):
        texts = [[*common, *(f"w{k}x{j}." for j in range(4))]]
        values = model.scorer().values(texts)
        assert values == [[max(score([u])[0] for u in toxicity.units(w)) for w in texts[0]]]
    assert len(asked) == len(set(asked)) == 3 + 80
