import numpy as np
import pytest

from opinara.llm import language

from .conftest import ODD_ROWS


def text_of(words, n, seed):
    r = np.random.default_rng(seed)
    return " ".join(r.choice(words, n))


LATIN = ["the", "and", "with", "house", "river", "thing"]
OTHER = ["der", "und", "nicht", "strasse", "schön", "zwei"]
CYRILLIC = ["дом", "река", "это", "быть", "город"]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, text_of(w, 60, 10 * i + j), lang) for i in range(20)
            for j, (w, lang) in enumerate([(LATIN, "en"), (OTHER, "de"), (CYRILLIC, "ru")])]
    rows += [(99, None, "en"), (98, "nothing", None)]
    return language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_held_out_and_mixed(model):
    texts = [text_of(w, 40, s) for s, w in enumerate([LATIN, OTHER, CYRILLIC], 900)]
    mixed = texts[0] + "\n" + texts[2] + " " + texts[1]
    lang, score, start, end, of, bounds = language.label([t.encode() for t in [*texts, mixed]], model, 12.0)
    assert [model.langs[i] for i in lang[:3]] == ["en", "de", "ru"]
    assert (score[:3] == 1).all()
    spans = [(model.langs[l], mixed[a:b]) for a, b, l in zip(start, end, of, strict=True)][bounds[3] :]
    assert spans == [("en", texts[0]), ("ru", texts[2]), ("de", texts[1])]


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(5)
    first = np.array([0, 6, 6, 11, 12])
    scores = r.normal(0, 2, (12, 3)).astype(np.float32)
    path = language.viterbi(scores, first, 1.5)
    import itertools

    for a, b in zip(first[:-1], first[1:], strict=True):
        def value(p):
            return sum(scores[a + i, s] for i, s in enumerate(p)) - 1.5 * sum(x != y for x, y in zip(p, p[1:]))
        best = max((value(p) for p in itertools.product(range(3), repeat=b - a)), default=0)
        assert value(path[a:b]) == pytest.approx(best, abs=1e-4)


def test_viterbi_with_many_languages():
    scores = np.zeros((4, 300), np.float32)
    scores[:, 290] = 1
    scores[2, 299] = 9
    first = np.array([0, 2, 4])
    assert language.viterbi(scores, first, 2.0).tolist() == [290, 290, 299, 299]


def test_a_foreign_script_gets_some_language(frame, model):
    rows = language.identify(frame([(1, "สวัสดี ชาวโลก"), (2, "12 34"), (3, "สวัสดี " + text_of(LATIN, 9, 1))]), model).collect()
    found = {r["doc_id"]: r for r in rows}
    assert found[1]["lang_pred"] in model.langs and (found[1]["score"], found[1]["spans"]) == (0, [])
    assert (found[2]["lang_pred"], found[2]["score"]) == ("und", 0)
    assert found[3]["lang_pred"] == "en" and 0 < found[3]["score"] < 1


def test_odd_rows(frame, model):
    docs = frame(ODD_ROWS)
    rows = language.identify(docs, model).collect()
    assert len(rows) == len(ODD_ROWS)
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert 0 <= r["score"] <= 1
        assert letters or (r["lang_pred"], r["score"], r["spans"]) == ("und", 0, [])
    assert {r["lang_pred"] for r in rows if r["doc_id"] == 6} <= {"en", "de", "ru"}
    assert set(docs.columns) | {"lang_pred"} == set(rows[0].asDict())


def test_empty_and_unlabelled(frame):
    assert language.identify(frame([(1, "a")]).limit(0), language.fit(frame([(1, "a")]))).count() == 0
    unlabelled = frame([(1, "some words", None)])
    assert language.identify(unlabelled, language.fit(unlabelled)).first()["lang_pred"] == "und"


def test_stage_drops_what_has_no_language(frame):
    rows = [(i, text_of(LATIN, 30, i)) for i in range(8)] + [(20, "1 2 3"), (21, None), (22, text_of(LATIN, 9, 3), None)]
    docs = frame(rows)
    out = language.language_stage(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [*range(8), 22]
