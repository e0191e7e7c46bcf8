"""What is left on the disk behind written tables."""

from pathlib import Path

from pyspark.sql import functions as F

from opinara.plans import fixtures as fx
from opinara.plans import landed
from opinara.runtime import FILES_GO, cut_lineage
from opinara.sources import landing
from opinara.sources.export import export_snapshot
from opinara.sources.gold import read_csv

SF = "/root/testdata/sf0.01"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(FILES_GO, None)
    rows = spark.range(10_000).withColumn("x", F.sha2(F.col("id").cast("string"), 256)).repartition(3, "x")
    written = cut_lineage(rows.groupBy("x").count())
    assert not shuffle_files(spark) - before
    assert written.count() == 10_000
    assert spark.conf.get(FILES_GO, None) == setting


def test_published_tables_are_packed_and_read_as_they_were(spark, tmp_path):
    text = 'a "quoted", long\nline ' * 100
    comments = spark.createDataFrame([(f"c{i}", m, text) for i in range(50) for m in (1, 2)], "comment_id string, model_id int, t string")
    tables = {"raw_comments": comments, "video_info": spark.createDataFrame([("v", " x ")], "video_id string, title string")}
    target = str(tmp_path / "export")
    assert sorted(export_snapshot(tables, target)) == ["comments", "videos"]
    files = list(Path(target, "comments").glob("part-*"))
    assert files and sum(f.stat().st_size for f in files) < 100 * len(text) / 5
    assert sorted(read_csv(spark, f"{target}/comments", comments.schema).collect()) == sorted(comments.collect())
    assert read_csv(spark, f"{target}/videos", tables["video_info"].schema).first()["title"] == " x "


def test_pages_land_in_parts_of_a_bounded_size(spark, monkeypatch):
    """Where texts are shuffled for pages, only those of a part are at a time; the pages are the same."""
    monkeypatch.setattr(fx, "BROADCAST_BYTES", 0)
    whole = landed.comment_pages(spark, SF)
    size = fx.text_bytes(spark, SF) * fx.events(spark, SF).count() // fx.documents(spark, SF)[1]
    monkeypatch.setattr(fx, "LANDED_BYTES", size // 4)
    parts = landed.page_parts(spark, SF)
    assert len(parts) == 5

    def rows(df):
        return df.select("video_id", "comments_disabled", F.xxhash64(F.to_json("items")).alias("h")).collect()

    found = [rows(p) for p in parts]
    assert sorted(map(str, sum(found, []))) == sorted(map(str, rows(whole)))
    assert max(map(len, found)) < len(rows(whole)) / 2
    folder = landed.write(spark, {"comments": landed.page_parts(spark, SF, flaws=False, filled=True)})
    assert not landing.read_pages(spark, folder, "comments").where("comments_disabled").count()
