import corpus_pipeline as pipeline
from opinara.llm.queries import QUERIES

from .conftest import ODD_ROWS, prose


def test_pipeline(spark, frame, tmp_path):
    # A text that is part of another counts as repeated and is removed where it comes later, so all seeds differ.
    rows = [(100 + i, prose(f"d{i}", 80), "en" if i % 2 else "de", "abc"[i % 3]) for i in range(60)]
    passage = prose("passage", 60)
    rows += [
        (300, rows[0][1]),
        (301, rows[0][1] + " tail"),
        (302, prose(302, 30) + ". " + prose("item", 40)),
        (303, prose(303, 30) + ".\n" + passage + "."),
        (304, prose(304, 30) + ".\n" + passage + "."),
        (305, "1 2 3"),
        (306, prose("long", 200)),
        (307, "\n".join([prose(307, 30), " ".join(prose("long", 200).split()[100:160])])),
        *ODD_ROWS,
    ]
    docs = frame(rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench = spark.createDataFrame([(1, prose("item", 40))], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    ids = []
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        ids.append({r["doc_id"] for r in docs.collect()})
    assert 305 not in ids[0] and 1 not in ids[0] and {300, 301, 4} <= ids[0]
    assert ids[0] - ids[1] == {300, 301}
    assert ids[1] == ids[2] and ids[2] - ids[3] == {302}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    # the part of an earlier text is gone, its own words stay
    assert texts[306] == prose("long", 200) and texts[307].strip() == prose(307, 30)
    assert passage in texts[303] and passage not in texts[304] and prose(304, 30) in texts[304]
    mixed = QUERIES["pipeline"](spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in mixed} <= ids[3]
    assert all(len(r["text"].encode().split()) == r["n_words"] for r in mixed)
    total = sum(len((t or "").encode().split()) for t in texts.values())
    assert abs(sum(r["n_words"] for r in mixed) - 1.5 * total) <= 5
    assert [name for name, _ in pipeline.STAGES] == [
        "language_id", "near_dedup", "substring_dedup", "benchmark_decontamination", "source_mixing",
    ]
