import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opinara import schemas
from opinara.operators import scoring
from opinara.plans import jobs
from opinara.sources.state import StateTables
from opinara.streaming.intake import landed_rows, run_stream, take_in

START = datetime(2024, 1, 10)
WORDS = ["the", "and", "of", "to", "x"]


def iso(t):
    return t.strftime("%Y-%m-%dT%H:%M:%SZ")


def made(n=240, seed=2):
    """Comments in time order: one video holds half of them."""
    rng = random.Random(seed)
    return [
        {
            "video": "hot" if rng.random() < 0.5 else f"v{rng.randrange(6)}",
            "id": f"c{i}",
            "text": " ".join(rng.choices(WORDS, k=5)),
            "likes": rng.randrange(9),
            "time": START + timedelta(minutes=i),
        }
        for i in range(n)
    ]


def land(folder, number, comments, counts=None, search=(), disabled=()):
    pages = []
    for video in sorted({c["video"] for c in comments}):
        newest = sorted((c for c in comments if c["video"] == video), key=lambda c: c["time"])[::-1]
        items = [
            {"id": c["id"], "snippet": {"topLevelComment": {"snippet": {
                "publishedAt": iso(c["time"]), "textDisplay": c["text"], "likeCount": c["likes"]}}}}
            for c in newest
        ]
        pages += [{"video_id": video, "items": items[i : i + 20]} for i in range(0, len(items), 20)]
    pages += [{"video_id": v, "comments_disabled": True} for v in disabled]
    if counts is None:
        counts = {v: 10_000 + number for v in ["hot", *[f"v{i}" for i in range(6)]]}
    statistics = [
        {"id": v, "statistics": {"commentCount": str(n)}} for v, n in sorted(counts.items())
    ]
    found = [
        {"id": {"kind": "youtube#video", "videoId": v}, "snippet": {
            "title": "the", "channelId": "ch", "channelTitle": "n", "publishedAt": iso(t)}}
        for v, t in search
    ]
    for kind, lines in (
        ("comments", pages),
        ("statistics", [{"items": statistics}]),
        ("search", [{"items": found}] if found else []),
    ):
        (folder / kind).mkdir(parents=True, exist_ok=True)
        text = "\n".join(json.dumps(p) for p in lines)
        (folder / kind / f"{number:03}.json").write_text(text)


def start_store(spark, root):
    store = StateTables(spark, str(root)).create()
    rows = [
        (v, "ch", "of to" if v == "hot" else "", START, 1, None, None)
        for v in ["hot", *[f"v{i}" for i in range(6)]]
    ]
    videos = spark.createDataFrame(rows, schemas.struct(schemas.STATE["video_info"]))
    store.write("video_info", videos, 0)
    return store


def tables(store, *names):
    return {n: sorted(map(repr, store.current(n).collect())) for n in names}


def expected_counts(comments):
    out = {}
    for c in comments:
        words = c["text"].split(" ")
        score = sum(w in ("the", "and") for w in words) - sum(w in ("of", "to") for w in words)
        label = "pos" if score > 0 else "neg" if score < 0 else "neu"
        row = out.setdefault(c["video"], {"pos": 0, "neg": 0, "neu": 0, "likes": 0})
        row[label] += 1
        row["likes"] += c["likes"]
    return out


def batch(spark, folder):
    return landed_rows(spark, str(folder), stream=False)


AS_OF = START + timedelta(days=1)


@pytest.fixture(scope="module")
def one_batch(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("one")
    comments = made()
    land(root / "landing", 1, comments)
    store = start_store(spark, root / "state")
    take_in(store, 1, batch(spark, root / "landing"), scoring.BUILT_IN, AS_OF, 20)
    return root, store, comments


def test_one_cycle(spark, one_batch):
    _, store, comments = one_batch
    stats = {r.video_id: r for r in store.current("video_stats").where("model_id = 1").collect()}
    expected = expected_counts(comments)
    assert set(stats) == set(expected)
    for video, e in expected.items():
        r = stats[video]
        assert (r.pos_count, r.neg_count, r.neu_count, r.total_likes) == tuple(e.values())
        assert r.total_comments == 10_001
        assert r.last_sync_date == max(c["time"] for c in comments if c["video"] == video)
    assert store.current("raw_comments").count() == 2 * len(comments)
    info = {r.video_id: r for r in store.current("video_info").collect()}
    assert info["hot"].video_title_sentiment == "negative"
    assert info["v1"].video_title_sentiment == "neutral"
    assert info["v1"].last_checked_at == AS_OF
    models = {(r.model_id, r.model_name) for r in store.current("model_info").collect()}
    assert models == {(1, "three-class"), (2, "five-star")}
    snapshot = {r.model_id: r for r in store.current("global_stats").collect()}
    assert snapshot[1].total_videos == len(expected)
    assert snapshot[1].total_likes == sum(c["likes"] for c in comments)


def test_repeating_a_batch_changes_nothing(spark, one_batch):
    root, store, _ = one_batch
    before = tables(store, *schemas.STATE)
    take_in(store, 1, batch(spark, root / "landing"), scoring.BUILT_IN, AS_OF, 20)
    assert tables(store, *schemas.STATE) == before


def test_streamed_waves_end_like_one_batch(spark, one_batch, tmp_path):
    _, single, comments = one_batch
    store = start_store(spark, tmp_path / "state")
    for number, part in enumerate((comments[:90], comments[90:150], comments[150:]), start=1):
        land(tmp_path / "landing", number, part)
        run_stream(
            spark, str(tmp_path / "landing"), store, str(tmp_path / "check"), scoring.BUILT_IN,
            lambda n: AS_OF, 20,
        ).awaitTermination()
    key = ["video_id", "model_id", "pos_count", "neg_count", "neu_count", "total_likes"]
    for table, columns in (("raw_comments", ["*"]), ("video_stats", [*key, "last_sync_date"])):
        a, b = (s.current(table).select(*columns) for s in (single, store))
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert store.current("global_stats").count() == 6

    folded = store.compact(str(tmp_path / "folded"), 3)
    assert tables(folded, *schemas.STATE) == tables(store, *schemas.STATE)
    sheet = jobs.annotation_job(folded, str(tmp_path / "sheet"), size=40)
    assert sheet.count() == 5
    from opinara.sources.gold import read_gold

    assert read_gold(spark, str(tmp_path / "sheet")).count() == 40


def test_late_redelivered_disabled_and_found(spark, tmp_path):
    comments = made(60)
    store = start_store(spark, tmp_path / "state")
    land(tmp_path / "a", 1, comments[20:40])
    take_in(store, 1, batch(spark, tmp_path / "a"), scoring.BUILT_IN, AS_OF, 7)
    counted = store.current("video_stats").agg(F.sum("pos_count")).first()[0]
    # Late and repeated comments are at or below the mark; v0 is switched off.
    land(
        tmp_path / "b", 2,
        [c for c in comments[:40] if c["video"] in {x["video"] for x in comments[20:40]}],
        disabled=["v0"], search=[("new1", START), ("new2", START - timedelta(hours=1))],
    )
    take_in(store, 2, batch(spark, tmp_path / "b"), scoring.BUILT_IN, AS_OF, 7)
    assert store.current("video_stats").agg(F.sum("pos_count")).first()[0] == counted
    info = {r.video_id: r for r in store.current("video_info").collect()}
    assert info["v0"].is_active == 0
    assert info["new1"].is_active == 1 and "new2" not in info
    assert info["new1"].video_title_sentiment is None
    assert [r.channel_id for r in store.current("channel_info").collect()] == ["ch"]


def test_an_older_batch_is_refused(spark, tmp_path):
    store = start_store(spark, tmp_path / "state")
    land(tmp_path / "none", 1, [])
    rows = spark.createDataFrame(
        [(1, AS_OF, 0, 0, 0, 0, 0, 0)], schemas.struct(schemas.STATE["global_stats"])
    )
    store.write("global_stats", rows, 5)
    with pytest.raises(ValueError, match="older than the stored batch 5"):
        take_in(store, 4, batch(spark, tmp_path / "none"), scoring.BUILT_IN, AS_OF, 20)


@pytest.mark.parametrize("comments_first", [True, False])
def test_kinds_in_different_batches_lose_nothing(spark, one_batch, tmp_path, comments_first):
    """Videos five days old, whose counts land before or after their comments."""
    _, single, comments = one_batch
    later = AS_OF + timedelta(days=4)
    store = start_store(spark, tmp_path / "state")
    counts = {v: sum(c["video"] == v for c in comments) for v in {c["video"] for c in comments}}
    parts = [(comments, {}), ([], counts)]
    for number, (part, counted) in enumerate(parts if comments_first else parts[::-1], start=1):
        land(tmp_path / f"l{number}", number, part, counts=counted)
        take_in(store, number, batch(spark, tmp_path / f"l{number}"), scoring.BUILT_IN, later, 20)
    assert tables(store, "raw_comments") == tables(single, "raw_comments")


def test_comments_of_a_video_found_later_wait_for_it(spark, tmp_path):
    comments = [{**c, "video": "late"} for c in made(30)]
    store = start_store(spark, tmp_path / "state")
    land(tmp_path / "a", 1, comments, counts={"late": 30})
    take_in(store, 1, batch(spark, tmp_path / "a"), scoring.BUILT_IN, AS_OF, 20)
    assert store.current("raw_comments").count() == 0
    land(tmp_path / "b", 2, [], counts={"late": 30}, search=[("late", START)])
    take_in(store, 2, batch(spark, tmp_path / "b"), scoring.BUILT_IN, AS_OF, 20)
    land(tmp_path / "c", 3, [], counts={"late": 30})
    take_in(store, 3, batch(spark, tmp_path / "c"), scoring.BUILT_IN, AS_OF, 20)
    assert store.current("raw_comments").count() == 60
    assert store.pending(4).count() == 0


def test_the_latest_fetch_of_a_comment_wins(spark, tmp_path):
    import os

    comments = made(5)
    store = start_store(spark, tmp_path / "state")
    land(tmp_path / "a", 1, comments)
    land(tmp_path / "a", 2, [{**c, "text": "of", "likes": 99} for c in comments])
    for number, seconds in ((1, 1_000), (2, 2_000)):
        os.utime(tmp_path / "a" / "comments" / f"{number:03}.json", (seconds, seconds))
    take_in(store, 1, batch(spark, tmp_path / "a"), scoring.BUILT_IN, AS_OF, 7)
    assert {(r.comment_text, r.likes) for r in store.current("raw_comments").collect()} == {("of", 99)}


def stream(spark, root, store, keyed, as_of=AS_OF, slots=20):
    run = run_stream(
        spark, str(root / "landing"), store, str(root / "check"), scoring.BUILT_IN, lambda n: as_of, slots, keyed=keyed
    )
    run.awaitTermination()
    return run


@pytest.mark.parametrize("keyed", [False, True])
def test_a_video_found_again_is_read_from_its_mark_on(spark, tmp_path, keyed):
    """Its comments land before, with and after the search page that finds it."""
    comments = [{**c, "video": "v1"} for c in made(50)]
    store = start_store(spark, tmp_path / "state")
    waves = [
        dict(comments=comments[:10]),
        dict(comments=comments[10:20], disabled=["v1"]),
        dict(comments=comments[20:30], search=[("v1", START)]),
        dict(comments=comments[30:]),
    ]
    stored = []
    for number, wave in enumerate(waves, start=1):
        land(tmp_path / "landing", number, **wave)
        stream(spark, tmp_path, store, keyed, AS_OF + timedelta(hours=number))
        stored.append(store.current("raw_comments").count() // 2)
    assert stored == [10, 10, 10, 50]
    assert store.pending(5).count() == 0
    row = store.current("video_stats").where("video_id = 'v1' and model_id = 1").first()
    assert row["last_sync_date"] == comments[-1]["time"]
    assert row["pos_count"] + row["neg_count"] + row["neu_count"] == 50


def test_keyed_state_ends_like_one_batch(spark, one_batch, tmp_path):
    """Comments, counts and the video itself in any order; what waits is put down once."""
    _, single, comments = one_batch
    extra = [{**c, "video": "found", "id": f"f{i}"} for i, c in enumerate(comments[:40])]
    store = start_store(spark, tmp_path / "state")
    land(tmp_path / "landing", 1, comments[:90] + extra[:20], counts={})
    first = stream(spark, tmp_path, store, True)
    land(tmp_path / "landing", 2, comments[90:200], search=[("found", START)])
    second = stream(spark, tmp_path, store, True)
    land(tmp_path / "landing", 3, comments[200:] + comments[:30] + extra[20:])
    stream(spark, tmp_path, store, True)
    mine = "video_id <> 'found'"
    columns = ["video_id", "model_id", "pos_count", "neg_count", "neu_count", "total_likes", "last_sync_date"]
    for table, names in (("raw_comments", ["*"]), ("video_stats", columns)):
        a, b = (s.current(table).where(mine).select(*names) for s in (single, store))
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert store.current("raw_comments").where("video_id = 'found' and model_id = 1").count() == 40
    assert store.versions("pending_comments").count() == 0
    updated = [sum(p["stateOperators"][0]["numRowsUpdated"] for p in q.recentProgress) for q in (first, second)]
    # a mark for each video that has rows; the first batch also puts down what waits, with a timer, as one list
    assert updated[1] < updated[0]
    assert len(store.current("video_info").where("video_id = 'found' and is_active = 1").collect()) == 1


def label_counts(store, model=1):
    rows = store.current("video_stats").where(f"model_id = {model}").collect()
    return {
        r["video_id"]: {"pos": r["pos_count"], "neg": r["neg_count"], "neu": r["neu_count"], "likes": r["total_likes"]}
        for r in rows
        if r["pos_count"] + r["neg_count"] + r["neu_count"]
    }


@pytest.mark.parametrize("keyed", [False, True])
def test_late_comments_correct_counters(spark, tmp_path, keyed):
    """Comments land in any order, some again: as they were, with more likes, or reworded."""
    comments = made(150)
    order = random.Random(4).sample(comments, len(comments))
    again = [{**c, "likes": c["likes"] + 50} for c in order[:20]]
    again += [{**c, "text": "of of of"} for c in order[20:40]]
    changed = {c["id"]: c for c in again}
    store = start_store(spark, tmp_path / "state")
    waves = [order[:60], order[60:110], order[110:] + again + order[40:55]]
    for number, wave in enumerate(waves, start=1):
        land(tmp_path / "landing", number, wave)
        run_stream(
            spark, str(tmp_path / "landing"), store, str(tmp_path / "check"), scoring.BUILT_IN, lambda n: AS_OF, 20,
            keyed=keyed, keep_late=True,
        ).awaitTermination()
    final = [changed.get(c["id"], c) for c in comments]
    assert label_counts(store) == expected_counts(final)
    stored = {r["comment_id"]: r for r in store.current("raw_comments").where("model_id = 1").collect()}
    assert {i: (r["comment_text"], r["likes"]) for i, r in stored.items()} == {
        c["id"]: (c["text"], c["likes"]) for c in final
    }
    # what came again as it was is neither scored nor stored again
    assert store.batch("raw_comments", 3).where("model_id = 1").count() == 40 + len(again)
    marks = store.current("video_stats").where("model_id = 1").collect()
    newest = {v: max(c["time"] for c in comments if c["video"] == v) for v in {c["video"] for c in comments}}
    assert {r["video_id"]: r["last_sync_date"] for r in marks if r["video_id"] in newest} == newest
    totals = store.versions("global_stats").where("model_id = 1 and batch_id = 3").first()
    assert totals["total_likes"] == sum(c["likes"] for c in final)


def test_late_comments_over_a_store_that_kept_no_account(spark, tmp_path):
    """The account begins with the stored comments, also after a batch without one; a repeat changes nothing."""
    comments = made(60)
    store = start_store(spark, tmp_path / "state")

    def cycle(number, rows, keep_late, counts=None):
        folder = tmp_path / f"landing{number}"
        land(folder, number, rows, counts)
        pages = batch(spark, folder)
        take_in(store, number, pages, scoring.BUILT_IN, AS_OF, 20, keep_late=keep_late)

    more = [{**c, "likes": c["likes"] + 7} for c in comments[:10]]
    cycle(1, comments[10:40], False)
    cycle(2, comments[:10] + comments[12:20], True)
    cycle(3, comments[40:], False)
    assert not store.follows_counted(4) and store.current("counted_comments").isEmpty()
    # no counts: only that a late comment changes something is a reason to fetch
    cycle(4, more + comments[45:50], True, counts={})
    before = tables(store, *schemas.STATE)
    cycle(4, more + comments[45:50], True, counts={})
    assert tables(store, *schemas.STATE) == before
    assert label_counts(store) == expected_counts(more + comments[10:])
    assert store.current("counted_comments").count() == 2 * len(comments)
