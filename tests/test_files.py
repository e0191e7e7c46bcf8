import json
import logging

import pytest

from opinara import schemas
from opinara.operators import comments
from opinara.plans import jobs
from opinara.sources import export, gold as gold_file, landing
from opinara.sources.state import StateTables


def write_lines(folder, pages):
    folder.mkdir(parents=True)
    (folder / "pages.json").write_text("\n".join(json.dumps(p) for p in pages))


def item(cid, published=None, **snippet):
    if published is not None:
        snippet["publishedAt"] = published
    return {"id": cid, "snippet": {"topLevelComment": {"snippet": snippet}}}


def test_comment_pages(spark, tmp_path):
    pages = [
        {"video_id": "v", "items": [
            item("c4", "2024-01-04T00:00:00Z", textDisplay="four", likeCount=4),
            item("bad", "soon", textDisplay="x"),
            item("none", textDisplay="y"),
            item("c3", "2024-01-03T00:00:00Z"),
        ], "nextPageToken": "2"},
        {"video_id": "v", "items": [
            item("c3", "2024-01-03T00:00:00Z", textDisplay="three", likeCount=3,
                 updatedAt="2024-01-05T00:00:00Z"),
            item("c2", "2024-01-02T00:00:00Z"),
        ]},
        {"video_id": "w", "items": []},
        {"video_id": "x", "comments_disabled": True},
    ]
    write_lines(tmp_path / "comments", pages)
    read = landing.read_pages(spark, str(tmp_path), "comments")
    flat = landing.flatten_comments(read)
    assert flat.count() == 6
    ready = comments.prepare(flat).orderBy("comment_id", "likes").collect()
    assert [(r.comment_id, r.comment_text, r.likes, r.is_edited) for r in ready] == [
        ("c2", "", 0, False), ("c3", "", 0, False), ("c3", "three", 3, True), ("c4", "four", 4, False),
    ]
    first = comments.newest(flat, 3, landing.page_order()).collect()
    assert {r.comment_id for r in first} == {"c4", "bad", "none"}


def test_search_and_count_pages(spark, tmp_path):
    found = {"id": {"kind": "youtube#video", "videoId": "v"}, "snippet": {
        "title": "t", "channelId": "c", "channelTitle": "n", "publishedAt": "2024-01-01T00:00:00Z"}}
    other = {"id": {"kind": "youtube#channel"}, "snippet": {"title": "t"}}
    write_lines(tmp_path / "search", [{"items": [found, other]}, {"items": []}])
    out = landing.flatten_search(landing.read_pages(spark, str(tmp_path), "search")).collect()
    assert [(r.video_id, r.channel_name) for r in out] == [("v", "n")]
    counts = [{"id": "v", "statistics": {"commentCount": "12"}}, {"id": "w", "statistics": {}}]
    write_lines(tmp_path / "statistics", [{"items": counts}])
    out = landing.flatten_counts(landing.read_pages(spark, str(tmp_path), "statistics")).collect()
    assert {r.video_id: r.yt_count for r in out} == {"v": 12, "w": 0}


GOLD_ROWS = [
    (0, 0, "v", "c1", 'He said "no",\nthen left ', 1, "positive", "positive", True, "Top", "s",
     "negative", False),
    (1, 1, "v", "c2", "  two\r\nlines", 2, "negative", "negative", False, "Bottom", "s",
     "positive", False),
    (2, 2, "v", "c3", "None", 2, "negative", "negative", False, "Bottom", "s", "n", False),
    (3, 3, "v", "c4", "blank", 2, "positive", "positive", False, "Bottom", "s", "", False),
]


def test_gold_file(spark, tmp_path):
    path = str(tmp_path / "gold")
    schema = schemas.struct(schemas.GOLD)
    gold_file.write_csv(spark.createDataFrame(GOLD_ROWS, schema).coalesce(1), path)
    gold = gold_file.read_gold(spark, path)
    assert gold.schema == schema
    out = {r.comment_id: r for r in gold.collect()}
    assert out["c1"].comment_text == GOLD_ROWS[0][4] and out["c2"].comment_text == GOLD_ROWS[1][4]
    assert out["c3"].comment_text is None and out["c4"].human_sentiment is None

    reports = jobs.evaluation_job(spark, path)
    labels = {r.label for r in reports["report"].collect()}
    assert labels == {"positive", "negative", "accuracy", "macro avg", "weighted avg"}

    target = str(tmp_path / "report")
    jobs.contradictions_job(spark, path, target)
    counts = spark.read.json(f"{target}/counts").first()
    assert (counts.false_positives, counts.false_negatives) == (1, 1)
    texts = gold_file.read_csv(
        spark, f"{target}/false_positives", schemas.struct("comment_text STRING")
    )
    assert [r[0] for r in texts.collect()] == [GOLD_ROWS[0][4]]


def test_export_replaces_its_own_names_only(spark, tmp_path, caplog):
    store = StateTables(spark, str(tmp_path / "state"))
    for table in ("video_info", "raw_comments", "global_stats"):
        empty = spark.createDataFrame([], schemas.struct(schemas.STATE[table]))
        store.write(table, empty, 0)
    target = tmp_path / "out"
    for name in ("foreign", "model_info"):
        (target / name).mkdir(parents=True)
        (target / name / "old.csv").write_text("x")
    with caplog.at_level(logging.WARNING):
        written = jobs.export_job(store, str(target))
    assert written == ["videos", "comments", "global_sum"]
    assert "model_info" in caplog.text
    assert not (target / "model_info").exists() and (target / "videos").exists()
    assert (target / "foreign" / "old.csv").read_text() == "x"
    with pytest.raises(ValueError):
        export.export_snapshot({}, str(target))


def test_export_refuses_a_target_that_overlaps_its_source(spark, tmp_path):
    store = StateTables(spark, str(tmp_path / "data" / "state")).create()
    (tmp_path / "data" / "other.txt").write_text("x")
    before = sorted(p for p in tmp_path.rglob("*"))
    for target in (tmp_path / "data", tmp_path / "data" / "state", tmp_path / "data" / "state" / "out"):
        for form in (str(target), f"file:{target}/", f"file://{target}"):
            with pytest.raises(ValueError, match="overlaps"):
                jobs.export_job(store, form)
    assert sorted(p for p in tmp_path.rglob("*")) == before
    jobs.export_job(store, str(tmp_path / "data" / "state2"))


def test_store_creation_leaves_tables_alone(spark, tmp_path):
    store = StateTables(spark, str(tmp_path)).create()
    rows = spark.createDataFrame([("c", "n")], "channel_id string, channel_name string")
    store.write("channel_info", rows, 1)
    store.create()
    assert store.current("channel_info").count() == 1
    assert store.current("channel_info", 1).count() == 0
    for table, ddl in schemas.STATE.items():
        assert store.current(table).schema.simpleString() == schemas.struct(ddl).simpleString()


def test_texts_are_packed_wherever_they_are_written(spark, tmp_path):
    from opinara.plans import landed
    from opinara.runtime import cut_lineage
    from opinara.sources.state import StateTables

    rows = spark.range(5).selectExpr("concat('c', id) comment_id", "'text' comment_text")
    cut_lineage(rows, str(tmp_path / "table"))
    StateTables(spark, str(tmp_path / "state")).create().write("raw_comments", rows, 1)
    for folder in ("table", "state/raw_comments/batch_id=1"):
        names = [p.name for p in (tmp_path / folder).glob("part-*")]
        assert names and all(n.endswith(".zstd.parquet") for n in names)
    landed.write(spark, {"comments": spark.range(3)}, str(tmp_path / "landing"))
    assert all(p.name.endswith(".json.gz") for p in (tmp_path / "landing/comments").glob("part-*"))
