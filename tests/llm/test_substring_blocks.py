import random

from pyspark.sql import functions as F

from opinara.llm import substring

from .conftest import prose
from .test_substring import units


def brute(rows, min_words):
    """Words that stay: units and windows that occur in an earlier text, or earlier in the same, are later ones."""
    seen_units, seen_windows, kept = set(), set(), {}
    for i, text in rows:
        words, covered, at, marks = text.split(), [], 0, set()
        for unit, n, *_ in units(text):
            if unit in seen_units:
                covered.append((at, at + n))
            marks.add(unit)
            seen_units.add(unit)
            at += n
        low = [w.lower() for w in words]
        for a in range(len(words) - min_words + 1):
            window = tuple(low[a : a + min_words])
            if window in seen_windows:
                covered.append((a, a + min_words))
            seen_windows.add(window)
        gone, run = set(), None
        for a, b in [*sorted(covered), (len(words) + 1, 0)]:
            if run and a <= run[1]:
                run = (run[0], max(run[1], b))
                continue
            if run and run[1] - run[0] >= min_words:
                gone.update(range(*run))
            run = (a, b)
        kept[i] = [w for k, w in enumerate(words) if k not in gone]
    return kept


def edited(text, r):
    """A copy with other line ends, another case, a word changed, or a piece of it."""
    words = text.split(" ")
    for _ in range(r.randrange(4)):
        at = r.randrange(len(words))
        words[at] = r.choice([words[at] + "\n", words[at] + ".", words[at].upper(), "changed"])
    a, b = r.randrange(len(words) // 2), len(words) - r.randrange(len(words) // 2)
    return " ".join(words if r.random() < 0.5 else words[a:b])


def test_copies_and_pieces_equal_brute_force(frame):
    r = random.Random(11)
    first = [". ".join(prose(f"{k}{j}", r.randrange(3, 60)) for j in range(8)) for k in range(6)]
    texts = list(first)
    for _ in range(60):
        texts.append(r.choice([" ", "\n", ". "]).join(edited(r.choice(first), r) for _ in range(r.randrange(1, 3))))
    r.shuffle(texts)
    rows = list(enumerate(texts))
    want = brute(rows, 30)
    assert sum(len(want[i]) < len(t.split()) for i, t in rows) > 40
    found = {x["doc_id"]: x["text_kept"].split() for x in substring.remove_repeats(frame(rows)).collect()}
    assert found == want


def test_filters_that_let_all_through_change_nothing(frame, monkeypatch):
    r = random.Random(12)
    first = [". ".join(prose(f"{k}{j}", r.randrange(3, 60)) for j in range(5)) for k in range(3)]
    rows = [(i, edited(r.choice(first), r)) for i in range(30)]
    full = substring.np.full(2, (1 << 32) - 1, substring.np.uint32)
    monkeypatch.setattr(substring.bloom, "build", lambda table, column, bits: full)
    found = {x["doc_id"]: x["text_kept"].split() for x in substring.remove_repeats(frame(rows)).collect()}
    assert found == brute(rows, 30)


def test_a_copied_text_is_listed_by_blocks(frame):
    """A copy of 400 words had a place for each of its 371 windows, and so had its first text."""
    text = prose("long", 400)
    listed = substring.later_units(frame([(i, text) for i in range(20)])).select(F.size("later").alias("n")).collect()
    assert len(listed) == 19 and max(x["n"] for x in listed) < 100
