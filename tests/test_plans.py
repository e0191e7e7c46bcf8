from opinara.operators import comments, sampling, stats
from opinara.plans import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_top_videos_and_their_comments(spark, plan):
    assert "TakeOrderedAndProject" in plan(stats.top_rows(fx.stats_now(spark, SF)))
    picked = stats.comments_of_top(
        fx.by_label(fx.comments_plain(spark, SF)), fx.stats_now(spark, SF)
    )
    assert "LeftSemi" in plan(picked) and "BroadcastHashJoin" in plan(picked)


def test_cap_is_cut_before_each_shuffle(spark, plan):
    rows = fx.comments_plain(spark, SF).select("video_id", "comment_id", "published_at")
    text = plan(comments.newest(rows, 20))
    assert text.count("WindowGroupLimit") == 4 and text.count("Partial") == 2


def test_counters_combine_before_the_shuffle(spark, plan):
    text = plan(stats.video_mood(fx.by_label(fx.comments_plain(spark, SF))))
    assert "partial_count" in text and text.count("Exchange") == 1
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type" in text


def test_median_counts_equal_likes_first(spark, plan):
    rows = fx.comments_plain(spark, SF).select("comment_id", "video_id", "likes")
    text = plan(sampling.video_medians(rows))
    assert "partial_count(1)" in text and "Window" not in text


def test_no_cross_joins(spark, plan):
    from opinara.plans.queries import QUERIES

    for name in ("comments_by_model", "zero_delta", "global_snapshot", "confusion_all_labels"):
        text = plan(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_listed_videos_reach_the_scan(spark, plan, tmp_path):
    fx.comments_plain(spark, SF).write.parquet(str(tmp_path / "t"))
    ids = [f"v{i}" for i in range(12)]
    picked = stats.comments_of_listed(spark.read.parquet(str(tmp_path / "t")), ids)
    text = picked._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters"))
    assert pushed.count("In(video_id") == 2
    kept = {r.video_id for r in picked.select("video_id").distinct().collect()}
    assert kept == set(ids)
