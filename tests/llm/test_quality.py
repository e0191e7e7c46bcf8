import random
import re
from collections import Counter

from opinara.llm import quality

from .conftest import ODD_ROWS, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = list(zip(words, words[1:], words[2:]))
    n = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if n[w] > 1 for j in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))


def test_base_statistics(frame):
    rows = [*ODD_ROWS, (20, "a b c a b c a b c d"), (21, "x x x x x\n\nx\nx"), (22, "#<b> 1\n#<b> 1\r\n#<b> 1"), (23, "a b c x a b c y b c x")]
    found = quality.base_statistics(frame(rows)).collect()
    got = sorted(tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in found)
    assert got == sorted(brute(r[1]) for r in rows)


def clean(seed):
    return "\n".join(prose(f"{seed}-{k}", 12) for k in range(6))


def test_outliers_of_each_source(frame):
    r = random.Random(3)
    rows = [(i, clean(i), "en", "a") for i in range(150)]
    rows += [(1000 + i, clean(i).replace(" ", "## "), "en", "b") for i in range(100)]
    bad = [(2000 + i, " ".join("###%%%" if r.random() < 0.5 else w for w in clean(i).split()), "en", "a") for i in range(30)]
    bad += [(2100 + i, "\n".join([prose(i, 12)] * 3 + [prose(k, 12) for k in range(9)]), "en", "a") for i in range(15)]
    found = {x["doc_id"]: x for x in quality.judge(frame(rows + bad)).collect()}
    assert all(found[i]["kept"] for i, *_ in rows)
    assert not any(found[i]["kept"] for i, *_ in bad)
    # what is usual in one source is an outlier in another
    assert found[1000]["n_symbols"] > 100


def test_small_cells_are_pooled(frame):
    rows = [(i, clean(i), "en", f"s{i}") for i in range(60)] + [(100 + i, clean(i), "de", None) for i in range(30)]
    rows += [(200 + i, clean(i), None, "x") for i in range(30)]
    cells = Counter(r["cell"] for r in quality.judge(frame(rows)).collect())
    assert cells == {'language {"lang":"en"}': 60, "rest": 60}


def test_odd_rows_and_empty(frame):
    docs = frame(ODD_ROWS)
    rows = quality.judge(docs).collect()
    assert len(rows) == len(ODD_ROWS)
    for r in rows:
        assert r["kept"] == (not r["base_failed"]) and r["base_failed"] == (r["n_words"] < 50 or r["doc_id"] == 10)
    assert quality.judge(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(frame, plan):
    text = plan(quality.judge(frame([(i, clean(i)) for i in range(60)])))
    assert not re.search("Python|Pandas|Arrow", text)


def test_two_fifths_of_equal_junk(frame):
    rows = [(i, clean(i), "en", "a") for i in range(120)]
    junk = "\n".join(" ".join(f"{w[:4]}###" for w in line.split()) for line in clean("junk").split("\n"))
    found = {x["doc_id"]: x for x in quality.judge(frame(rows + [(1000 + i, junk, "en", "a") for i in range(80)])).collect()}
    assert all(found[i]["kept"] for i, *_ in rows)
    assert not any(found[1000 + i]["kept"] or found[1000 + i]["base_failed"] for i in range(80))
