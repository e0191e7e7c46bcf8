import itertools
import random

from opinara.llm import decontaminate

from .conftest import ODD_ROWS, prose


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, key string")


def substituted(text, every):
    return " ".join(f"sub{i}" if i % every == every - 1 else w for i, w in enumerate(text.split()))


def test_finds_exact_and_substituted_passages(spark, frame):
    bench = {i: prose(f"item{i}", 30 + i) for i in range(12)}
    docs, want = [], set()
    for i in range(60):
        words = prose(i, 80).split()
        if i % 3 == 0:
            item = i % 12
            part = [bench[item], substituted(bench[item], 7), bench[item].upper(), " \n".join(bench[item].split())][i % 4]
            at = random.Random(i).randrange(len(words))
            words[at:at] = part.split(" ")
            want.add((i, item))
        docs.append((i, " ".join(words)))
    found = decontaminate.find_overlaps(frame(docs), items(spark, [(i, t, "x") for i, t in bench.items()])).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want
    texts = dict(docs)
    for r in found:
        length = len(bench[r["item_id"]].split())
        assert r["n_words"] >= length - 6 and r["n_equal"] >= 0.8 * r["n_words"]
        own = texts[r["doc_id"]].lower().split()[r["first_word"] : r["first_word"] + r["n_words"]]
        assert sum(w in bench[r["item_id"]].split() for w in own) == r["n_equal"]
    kept = decontaminate.decontaminate(frame(docs), items(spark, [(i, t, "x") for i, t in bench.items()]))
    assert {r["doc_id"] for r in kept.collect()} == set(range(60)) - {i for i, _ in want}


def test_masks():
    assert all(len(m) == decontaminate.SPAN and m[0] == m[-1] == "1" and m.count("1") == 8 for m in decontaminate.MASKS)
    assert len(set(decontaminate.MASKS)) == len(decontaminate.MASKS)


def test_short_items(spark, frame):
    docs = frame([(1, "x one two three four five six y"), (2, "one two three four five"), (3, "a b c d")])
    bench = items(spark, [(1, "One two three four five six", "k"), (2, "a b c d", "k"), (3, None, "k"), (4, "", "k"), (None, "two three four five six", "k")])
    found = decontaminate.find_overlaps(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"], r["first_word"]) for r in found} == {(1, 1, 1), (1, None, 2)}


def test_odd_rows(spark, frame):
    docs = frame(ODD_ROWS)
    bench = items(spark, [(1, prose(9, 30_000)[-400:], "x"), (1, prose(9, 30_000)[-400:], "x"), (2, prose(8, 60), "y")])
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_overlaps(docs, bench).collect()}
    assert found == {(9, 1), (None, 2)}
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(ODD_ROWS) - 2
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == len(ODD_ROWS)
    assert decontaminate.find_overlaps(docs.limit(0), bench).count() == 0


def test_common_passage_in_very_many_documents(spark, frame):
    passage = prose("p", 25)
    docs = frame([(i, f"{prose(i, 6)} {passage} {prose(-i, 6)}") for i in range(1, 200)])
    found = decontaminate.find_overlaps(docs, items(spark, [(5, passage, "x")])).collect()
    assert [r["n_equal"] for r in found] == [25] * 199


def test_exact_passage_after_an_edited_one(spark, frame):
    bench, docs = {}, []
    for i in range(60):
        r, words = random.Random(i), prose(f"long{i}", 140).split()
        bench[i] = " ".join(words)
        edited = [f"sub{k}" if k < 100 and r.random() < 0.3 else w for k, w in enumerate(words)]
        docs.append((i, " ".join([prose(i, 30), *edited])))
    found = decontaminate.find_overlaps(frame(docs), items(spark, [(i, t, "x") for i, t in bench.items()])).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(i, i) for i in range(60)}
    assert all(r["n_equal"] >= 40 and r["n_equal"] >= 0.8 * r["n_words"] for r in found)


def test_any_word_of_a_short_item_replaced(spark, frame):
    bench = {n: prose(f"short{n}", n) for n in (11, 12, 15, 20)}
    docs, want = [], set()
    for n, text in bench.items():
        for i in range(n):
            for k in {i, (i * 7 + 3) % n} if n == 12 else {i}:
                words = text.split()
                words[i], words[k] = "sub", "sub"
                docs.append((len(docs), f"{prose(len(docs), 5)} {' '.join(words)} {prose(-len(docs), 5)}"))
                want.add((len(docs) - 1, n))
    found = decontaminate.find_overlaps(frame(docs), items(spark, [(n, t, "x") for n, t in bench.items()])).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want


def test_light_masks_leave_no_stretch_out():
    masks = [(len(m), int(m[::-1], 2)) for m in decontaminate.LIGHT]
    for n in range(10, 24):
        for k in range(min(n // 5, n - decontaminate.MIN_WORDS) + 1):
            for other in itertools.combinations(range(n), k):
                equal = (1 << n) - 1 - sum(1 << x for x in other)
                assert any(equal >> s & m == m for size, m in masks for s in range(n - size + 1)), (n, other)
