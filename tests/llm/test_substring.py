import random
import re

from opinara.llm import substring

from .conftest import ODD_ROWS, prose


def units(text):
    """(normalised, words, start, end) by a plain reading of the rules."""
    out, open_ = [], []
    words = [(m.start(), m.end(), m.group()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    for k, (a, b, w) in enumerate(words):
        open_.append((a, b, w))
        last = k + 1 == len(words)
        if last or w[-1] in ".!?" or "\n" in text[b : words[k + 1][0]]:
            out.append((" ".join(w.lower() for _, _, w in open_), len(open_), open_[0][0], open_[-1][1]))
            open_ = []
    return out


def brute(rows, min_words):
    seen, result = set(), {}
    for i, text, *_ in sorted(rows, key=lambda r: r[0]):
        spans, run = [], []
        for u in [*units(text or ""), None]:
            if u is not None and u[0] in seen:
                run.append(u)
                continue
            if sum(x[1] for x in run) >= min_words:
                spans.append((run[0][2], run[-1][3]))
            run = []
            if u is not None:
                seen.add(u[0])
        result[i] = spans
    return result


def test_equals_brute_force(frame):
    passage = ". ".join(prose(k, 9) for k in range(7)) + "."
    rows = [
        (1, prose(1, 40) + ".\n" + passage + "\nthe end"),
        (2, "Início é. " + passage.upper() + " " + prose(2, 20)),
        (3, "short line\n" * 3 + prose(3, 20)),
        (4, "short line\n" * 40),
        (5, passage),
        (6, passage[:40]),
        (7, "é! " * 3 + passage.replace(" ", "  ") + "\n\n" + prose(1, 40) + "."),
    ]
    found = {r["doc_id"]: r for r in substring.remove_repeats(frame(rows)).collect()}
    want = brute(rows, 30)
    assert want[2] and want[5] and want[7] and not want[1] and not want[6]
    for i, text in rows:
        assert [tuple(x) for x in found[i]["removed"]] == want[i], i
        rest, at = "", 0
        for a, b in want[i]:
            rest, at = rest + text[at:a], b
        assert found[i]["text_kept"] == rest + text[at:]


def test_odd_rows(frame):
    docs = frame(ODD_ROWS)
    rows = substring.remove_repeats(docs).collect()
    assert len(rows) == len(ODD_ROWS)
    for r in rows:
        if r["doc_id"] == 10:
            assert r["text_kept"].strip() == "Same line here." and r["text"] == "Same line here.\n" * 50
        else:
            assert (r["text_kept"], r["removed"]) == (r["text"], [])
    assert substring.remove_repeats(docs.limit(0)).count() == 0


def test_stage(frame):
    long = prose(1, 60)
    docs = frame([(1, long), (2, long), (3, "a " + long + "\n" + prose(2, 5)), (4, None), (5, "")])
    out = substring.substring_stage(docs)
    assert out.columns == docs.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert set(rows) == {1, 3, 4, 5}
    assert rows[1]["n_chars"] == len(long) and rows[4]["text"] is None


def test_passages_without_unit_ends(frame):
    """Every stretch of 30 words that occurs in an earlier text goes, no other word does."""
    r = random.Random(5)
    rows = []
    for i in range(60):
        words = prose(f"own{i}", 60).split()
        for k in range(i % 3):
            passage, a = prose(f"shared{r.randrange(2)}", 90).split(), r.randrange(30)
            at = r.randrange(len(words))
            words[at:at] = passage[a : a + r.choice([25, 29, 30, 31, 51, 60])]
        rows.append((i, " ".join(words)))
    rows.append((70, "same " * 70))
    seen, want = set(), {}
    for i, text in rows:
        words = text.split()
        gone = set()
        for a in range(len(words) - 29):
            window = tuple(words[a : a + 30])
            if window in seen:
                gone.update(range(a, a + 30))
            seen.add(window)
        want[i] = [w for k, w in enumerate(words) if k not in gone]
    assert sum(len(want[i]) < len(t.split()) for i, t in rows) > 10
    found = {x["doc_id"]: x["text_kept"].split() for x in substring.remove_repeats(frame(rows)).collect()}
    assert found == want


def test_sentences_with_their_surroundings(frame):
    two = f"{prose('s1', 27)}. {prose('s2', 27)}"
    rows = [(1, f"{prose(1, 9)} {two} {prose(2, 9)}."), (2, f"{prose(3, 9)}\n{prose(4, 3)} {two} {prose(5, 9)}.")]
    found = {x["doc_id"]: x for x in substring.remove_repeats(frame(rows)).collect()}
    assert found[1]["removed"] == [] and two not in found[2]["text_kept"]
    assert found[2]["text_kept"].split() == rows[1][1].replace(two, "").split()
