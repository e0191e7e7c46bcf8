from datetime import datetime

from opinara import schemas
from opinara.operators import migrate, registry
from opinara.plans import jobs
from opinara.sources.state import StateTables

NOW = datetime(2024, 1, 1)


def known(spark, *rows):
    return spark.createDataFrame(
        [(i, n, NOW) for i, n in rows], schemas.struct(schemas.STATE["model_info"])
    )


def test_new_names_get_the_next_ids_in_order(spark):
    names = spark.createDataFrame(
        [("zeta", 1), ("7", 2), ("alpha", 3), ("zeta", 4), ("b", 5), (None, 6)],
        "model_identifier string, position int",
    )
    new = registry.register(names, known(spark, (1, "a"), (4, "b")), NOW).collect()
    assert {(r.model_id, r.model_name) for r in new} == {(5, "zeta"), (6, "alpha")}


def test_resolve(spark):
    df = spark.createDataFrame([("x", "b"), ("y", "42"), ("z", None)], "k string, model_id string")
    out = registry.resolve(df, "model_id", known(spark, (4, "b"))).collect()
    assert {r.k: r.model_id for r in out} == {"x": 4, "y": 42, "z": None}


def test_video_stats_with_text_ids_collapse_to_the_last_row(spark):
    rows = [("v", "b", 1, 1), ("v", "4", 2, 2), ("v", "new", 3, 3), ("v", None, 4, 4)]
    old = spark.createDataFrame(rows, "video_id string, model_id string, pos_count int, n int")
    fixed, models = migrate.video_stats(old, known(spark, (4, "b")), "n", NOW)
    assert fixed.columns == [f.name for f in schemas.struct(schemas.STATE["video_stats"])]
    assert {(r.model_id, r.pos_count) for r in fixed.collect()} == {(4, 2), (5, 3), (None, 4)}
    assert {(r.model_id, r.model_name) for r in models.collect()} == {(4, "b"), (5, "new")}


def test_align_adds_missing_columns(spark):
    old = spark.createDataFrame([("c", "v", "t")], "comment_id string, video_id string, extra string")
    new = schemas.align(old, "raw_comments")
    assert new.schema == schemas.struct(schemas.STATE["raw_comments"])
    assert new.first().model_id is None


def test_a_store_of_older_layout_is_taken_over(spark, tmp_path):
    old = {
        "model_info": known(spark, (4, "b")),
        "video_info": spark.createDataFrame([("v", "t")], "video_id string, video_title string"),
        "raw_comments": spark.createDataFrame([("c", "v")], "comment_id string, video_id string"),
        "global_stats": spark.createDataFrame([("b", 1), ("x", 2)], "model_id string, id int"),
        "video_stats": spark.createDataFrame(
            [("v", "x", 1, NOW), ("v", "b", 2, NOW), ("w", "b", 7, None), ("w", "4", 8, None)],
            "video_id string, model_id string, pos_count int, checked_at timestamp",
        ),
    }
    for name, df in old.items():
        df.write.parquet(str(tmp_path / "old" / name))
    store = StateTables(spark, str(tmp_path / "new"))
    jobs.migrate_job(spark, {t: str(tmp_path / "old" / t) for t in old}, store, NOW)
    assert {(r.model_id, r.model_name) for r in store.current("model_info").collect()} == {
        (4, "b"),
        (5, "x"),
    }
    assert {r.model_id for r in store.current("global_stats").collect()} == {4, 5}
    assert {(r.model_id, r.pos_count) for r in store.current("video_stats").collect()} == {
        (5, 1),
        (4, 2),
        (4, 8),
    }
    times = {r.video_id: r.checked_at for r in store.current("video_stats").collect()}
    assert times == {"v": NOW.replace(tzinfo=None), "w": None}
    assert store.current("raw_comments").first().model_id is None
    assert store.current("video_info").first().video_title_sentiment is None
    assert store.current("channel_info").count() == 0
