import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opinara import schemas
from opinara.operators import scoring, stats, videos
from opinara.plans import cycle
from opinara.runtime import list_folder
from opinara.sources.state import RUNS, StateTables
from opinara.streaming.intake import landed_rows, take_in

from test_cycle import AS_OF, land, made, start_store, tables

TIME = datetime(2024, 1, 1)


def counters(spark, rows):
    """Counter rows from (video, number)."""
    full = [(v, 1, None, n, 0, 0, n, n, TIME, TIME) for v, n in rows]
    return spark.createDataFrame(full, schemas.struct(schemas.STATE["video_stats"]))


def sums(store, before=None):
    return {r["video_id"]: r["pos_count"] for r in store.current("video_stats", before).collect()}


def test_buckets_are_folded_and_results_stay(spark, tmp_path):
    store = StateTables(spark, str(tmp_path / "s"), buckets=4).create()
    rng, expected, largest = random.Random(1), {}, 0
    for batch in range(1, 9):
        rows = [(f"v{i}", rng.randrange(9)) for i in range(12) if rng.random() < 0.6]
        store.write("video_stats", counters(spark, rows), batch, commit=False)
        for v, n in rows:
            expected[v] = expected.get(v, 0) + n
        seen = sums(store)
        store.commit(batch)
        assert sums(store) == expected and sums(store, batch) == seen
        runs = store.record()["runs"]["video_stats"]
        largest = max(largest, *(len(r) for r in runs.values()))
        files = store.versions("video_stats").inputFiles()
        assert len(files) <= 4 * RUNS
    assert largest == RUNS and any(r[0].endswith("folded") for r in runs.values())
    before = sums(store)
    n = len(list_folder(spark, store.path("video_stats")))
    store.expire()
    assert sums(store) == before and len(list_folder(spark, store.path("video_stats"))) < n


def test_only_touched_buckets_are_read(spark, tmp_path):
    store = StateTables(spark, str(tmp_path / "s"), buckets=16).create()
    store.write("video_stats", counters(spark, [(f"v{i}", i) for i in range(200)]), 1)
    wanted = store.buckets_of(spark.createDataFrame([("v7",), ("v7",)], "video_id string"))
    part = store.current("video_stats", buckets=wanted)
    assert len(wanted) == 1 and len(part.inputFiles()) == 1 < len(store.current("video_stats").inputFiles())
    assert part.where("video_id = 'v7'").first()["pos_count"] == 7
    # a store that exists keeps its number of buckets
    assert StateTables(spark, str(tmp_path / "s"), buckets=3).create().buckets_of(part.select("video_id")) == wanted


def test_a_repeated_fold_gives_the_same(spark, tmp_path):
    store = StateTables(spark, str(tmp_path / "s"), buckets=1).create()
    for batch in range(1, RUNS + 2):
        store.write("video_stats", counters(spark, [("a", batch)]), batch, commit=False)
        store.commit(batch)
    last = RUNS + 1
    assert store.record()["runs"]["video_stats"] == {"0": [f"{last:012}-folded"]}
    store.write("video_stats", counters(spark, [("a", last)]), last, commit=False)
    store.commit(last)
    assert sums(store) == {"a": sum(range(last + 1))}


def test_folding_keeps_the_latest_of_a_video(spark, tmp_path):
    columns = schemas.struct(schemas.STATE["video_info"])
    rows = [
        (1, ("a", "c", "one", TIME, 1, None, None)),
        (2, ("a", "c", "two", None, 0, TIME, "positive")),
        (3, ("b", "c", "", None, 1, None, None)),
        (4, ("a", "d", "four", None, 1, None, None)),
        (5, ("b", "c", "last", TIME, 1, None, "neutral")),
        (6, ("a", "d", "six", None, 0, None, None)),
    ]
    store = StateTables(spark, str(tmp_path / "s"), buckets=1).create()
    every = []
    for batch, row in rows:
        one = spark.createDataFrame([row], columns)
        every.append(one.withColumn("batch_id", F.lit(batch)))
        store.write("video_info", one, batch, commit=False)
        store.commit(batch)
    versions = every[0]
    for frame in every[1:]:
        versions = versions.unionByName(frame)
    assert sorted(map(repr, store.current("video_info").collect())) == sorted(
        map(repr, schemas.align(videos.merge(versions), "video_info").collect())
    )


@pytest.mark.parametrize("step", ["video_stats", "global_stats"])
def test_readers_see_finished_batches_only(spark, tmp_path, monkeypatch, step):
    """A cycle that dies between two writes leaves the state before it; its repeat finishes the batch."""
    comments = made(60)
    store = start_store(spark, tmp_path / "state")
    land(tmp_path / "a", 1, comments[:30])
    land(tmp_path / "b", 2, comments[30:])

    def run(number, folder):
        rows = landed_rows(spark, str(tmp_path / folder), stream=False)
        take_in(store, number, rows, scoring.BUILT_IN, AS_OF, 7)

    run(1, "a")
    old = tables(store, *schemas.STATE)
    write = StateTables.write

    def dying(self, table, *args, **named):
        if table == step:
            raise RuntimeError("the cluster is gone")
        write(self, table, *args, **named)

    monkeypatch.setattr(StateTables, "write", dying)
    with pytest.raises(RuntimeError, match="gone"):
        run(2, "b")
    assert tables(store, *schemas.STATE) == old and store.last_batch() == 1
    monkeypatch.setattr(StateTables, "write", write)
    run(2, "b")
    assert store.current("raw_comments").count() == 120 and store.last_batch() == 2


def test_totals_after_a_batch_are_those_over_all(spark, tmp_path, monkeypatch):
    store = StateTables(spark, str(tmp_path / "s"), buckets=4).create()
    models = spark.createDataFrame([(1,)], "model_id int")
    store.write("video_stats", counters(spark, [("a", 1), ("b", 2), ("c", 3)]), 1)
    before = store.current("video_stats")
    delta = counters(spark, [("b", 5), ("d", 7)])
    previous = stats.global_totals(before, models)
    store.write("video_stats", delta, 2)
    found = stats.totals_after(previous, delta, before, models).collect()
    assert found == stats.global_totals(store.current("video_stats"), models).collect()
    assert found[0]["total_videos"] == 4
    # rows written by hand after a cycle: no list of watched videos, no totals to go on from
    assert not store.follows_cycle(3) and cycle._touched_buckets(store, 3, before) is None
