import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

from opinara.llm import substring


def test_dealt_digests_that_meet_again_are_found(spark, monkeypatch):
    monkeypatch.setattr(substring, "DEALT", 500)
    random = np.random.default_rng(3)
    runs = [random.integers(0, 2**64, 300, dtype=np.uint64) for _ in range(9)]
    runs[1][:3], runs[7][:40], runs[8][:2] = runs[1][0], runs[2][:40], [0, 2**64 - 1]
    runs[4][:2] = [0, 2**64 - 1]
    batches = list(substring.dealt(iter([*runs, runs[0][:0]])))
    rows = pa.Table.from_batches(batches)
    found = []
    for bucket in np.unique(rows.column("bucket").to_numpy()):
        part = rows.filter(pa.compute.equal(rows.column("bucket"), int(bucket)))
        found.append(substring.met_again(part).column("h1").to_numpy().view(np.uint64))
    found = np.concatenate(found)
    values, times = np.unique(np.concatenate(runs), return_counts=True)
    assert len(found) == len(set(found.tolist())) and set(found.tolist()) == set(values[times > 1].tolist())
    assert not list(substring.dealt(iter([runs[0][:0]])))


def test_digests_are_shuffled_as_bytes(spark):
    texts = spark.createDataFrame([(" ".join(f"w{i % 50}" for i in range(200)),)], "text string")
    rows = texts.selectExpr("cast(text as binary) t").mapInArrow(substring.digests(30), substring.DIGESTS).collect()
    assert len({r["bucket"] for r in rows}) == len(rows) and sum(len(r["packed"]) for r in rows) % 8 == 0
