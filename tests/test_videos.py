from datetime import datetime, timedelta

from opinara import schemas
from opinara.operators import videos

AS_OF = datetime(2024, 1, 31)


def info(spark, rows):
    return spark.createDataFrame(rows, schemas.struct(schemas.STATE["video_info"]))


def video(name, days=None, active=1, title="t", label=None):
    date = None if days is None else AS_OF - timedelta(days=days, hours=1)
    return (name, "ch", title, date, active, None, label)


def test_every_rule_of_the_life_cycle(spark):
    rows = [
        video("undated"), video("old", 15), video("edge", 14), video("uncounted", 1),
        video("quiet", 4), video("grown", 4), video("young", 3), video("off", 1, active=0),
    ]
    stats = spark.createDataFrame(
        [("quiet", 1, 5), ("quiet", 2, 7), ("grown", 1, 5), ("young", 1, 9), ("edge", 1, 1)],
        "video_id string, model_id int, total_comments long",
    )
    counts = spark.createDataFrame(
        [(v, 7) for v in ("undated", "old", "edge", "quiet", "grown", "young", "off")],
        "video_id string, yt_count long",
    )
    active = videos.active_with_total(info(spark, rows), stats)
    out = {r.video_id: r.action for r in videos.decide(active, counts, AS_OF).collect()}
    assert out == {
        "undated": "skip_no_date", "old": "deactivate_old", "edge": "fetch",
        "uncounted": "skip_no_count", "quiet": "deactivate_quiet", "grown": "fetch",
        "young": "fetch",
    }


def test_fanout_repeats_a_video_per_model(spark):
    stats = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, 7)], "video_id string, model_id int, total_comments long"
    )
    table = info(spark, [video("a", 1), video("b", 1)])
    one = videos.active_with_total(table, stats).collect()
    assert {(r.video_id, r.total_comments) for r in one} == {("a", 7), ("b", 0)}
    many = videos.active_with_total(table, stats, fanout=True).collect()
    assert sorted((r.video_id, r.total_comments) for r in many) == [("a", 5), ("a", 7), ("b", 0)]


def test_register_adds_and_revives(spark):
    old = info(spark, [video("a", 20, active=0, label="positive"), video("b", 2)])
    found = spark.createDataFrame(
        [("a", "new title", "ch2", "Two", None), ("z", "zed", "ch3", "Three", AS_OF)],
        "video_id string, title string, channel_id string, channel_name string, "
        "published_at timestamp",
    )
    out = {r.video_id: r for r in videos.register(old, found, AS_OF).collect()}
    a = out["a"]
    assert (a.is_active, a.video_title, a.channel_id) == (1, "new title", "ch2")
    assert a.date_publication == AS_OF - timedelta(days=20, hours=1)
    assert (a.last_checked_at, a.video_title_sentiment) == (AS_OF, "positive")
    assert out["b"].last_checked_at is None and out["z"].is_active == 1


def test_slots_and_newest_found(spark):
    table = info(spark, [video("a", 1), video("b", 1), video("c", 1, active=0)])
    assert videos.free_slots(videos.active(table), 5) == 3
    assert videos.free_slots(videos.active(table), 1) == 0
    found = spark.createDataFrame(
        [("x", AS_OF), ("y", AS_OF - timedelta(1)), ("w", None)],
        "video_id string, published_at timestamp",
    )
    assert [r.video_id for r in videos.newest_found(found, 2).collect()] == ["x", "y"]


def test_channels_keep_the_last_name(spark):
    rows = [("c", "old", 1), ("c", "new", 2), ("d", "d", 1)]
    df = spark.createDataFrame(rows, "channel_id string, channel_name string, batch_id int")
    out = {r.channel_id: r.channel_name for r in videos.merge_channels(df).collect()}
    assert out == {"c": "new", "d": "d"}


def test_videos_are_selected_without_their_titles(spark, plan):
    rows = [(f"v{i}", f"title {k}", AS_OF - timedelta(days=i % 9, hours=k)) for i in range(50) for k in range(2)]
    found = spark.createDataFrame([*rows, ("undated", "x", None)], "video_id string, title string, published_at timestamp")
    out = videos.newest_found(found, 20)
    chosen = next(line for line in plan(out).splitlines() if "TakeOrderedAndProject" in line)
    assert "title" not in chosen
    once = {r.video_id: r for r in sorted(found.collect(), key=lambda r: (r.published_at or AS_OF.min, r.title))}
    first = sorted(once.values(), key=lambda r: (r.published_at is None, r.published_at and AS_OF - r.published_at, r.video_id))
    assert list(map(tuple, out.collect())) == list(map(tuple, first[:20]))
    assert set(map(tuple, videos.newest_found(found, 60, one_task=0).collect())) == set(map(tuple, first))
