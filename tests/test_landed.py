import time

from pyspark.sql import functions as F

from opinara.plans import fixtures as fx
from opinara.plans import landed
from opinara.runtime import cut_lineage, let_go, list_folder
from opinara.sources import landing
from opinara.sources.state import StateTables
from opinara.streaming import intake

SF = "/root/testdata/sf0.001"


def item_rows(pages):
    one = F.explode("items").alias("item")
    return sorted(map(tuple, pages.select("video_id", one).select("video_id", F.to_json("item")).collect()))


def test_pages_shuffle_no_texts(spark, plan, monkeypatch):
    pages = landed.comment_pages(spark, SF)
    assert "SortMergeJoin" not in plan(pages.where(~F.col("comments_disabled")))
    near = item_rows(pages)
    monkeypatch.setattr(fx, "BROADCAST_BYTES", -1)
    far = landed.comment_pages(spark, SF)
    assert "SortMergeJoin" in plan(far) and item_rows(far) == near


def test_read_pages_and_old_pending_rows_go(spark, monkeypatch):
    seen, write = [], landed.write

    def noted(session, pages, folder=None):
        seen.append(list_folder(session, f"{folder}/comments"))
        return write(session, pages, folder)

    monkeypatch.setattr(landed, "write", noted)
    store = landed.two_waves(spark, SF, fresh=True)
    assert seen == [[], []]
    assert "batch_id=0" not in list_folder(spark, store.path("pending_comments"))


def test_expire_keeps_what_the_newest_batches_read(spark, tmp_path):
    store = StateTables(spark, str(tmp_path / "s")).create()
    for batch in range(1, 5):
        watched = spark.createDataFrame([(f"v{batch}",)], "video_id string")
        store.write("watched_videos", watched, batch, commit=False)
        store.commit(batch)
    store.expire()
    assert [store.versions("watched_videos", b).first()["video_id"] for b in (4, 5)] == ["v3", "v4"]
    assert sorted(list_folder(spark, store.path("watched_videos"))) == ["batch_id=3", "batch_id=4"]


def test_shuffle_files_of_ended_jobs_go(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in found.mkString("|").split("|") if "/shuffle_" in f}

    let_go(spark)
    before = files()
    assert spark.range(1000).repartition(3).distinct().count() == 1000
    made = files() - before
    end = time.monotonic() + 20
    while made & files() and time.monotonic() < end:
        # a job after it: the scheduler may hold its last one
        assert spark.range(100).repartition(2).count() == 100
        let_go(spark)
        time.sleep(0.5)
    assert made and not made & files()


def test_waves_let_go_of_shuffles_and_checkpoints(spark, monkeypatch):
    """A wave found the texts that the waves before it had shuffled still on disk, and checkpoints stayed."""
    asked, named, scratch_dir = [], [], landed.scratch_dir
    monkeypatch.setattr(landed, "let_go", lambda session: asked.append(session))
    monkeypatch.setattr(landed, "scratch_dir", lambda s, name: named.append(scratch_dir(s, name)) or named[-1])
    landed.taken_in(spark, SF, landed.wave_pages(spark, SF)[:1], [fx.CUT])
    assert len(asked) == 2
    assert [list_folder(spark, f) for f in named if "/state-" not in f] == [[], []]


def seen_by_writes(monkeypatch, table):
    """Names in the work folder and in its staged table, each time ``table`` is written by a cycle."""
    seen, write = [], StateTables.write

    def noted(store, name, rows, batch_id, commit=True):
        if name == table and not commit:
            work = store.work(batch_id)
            seen.append((list_folder(store.spark, work), list_folder(store.spark, f"{work}/landed")))
        return write(store, name, rows, batch_id, commit)

    monkeypatch.setattr(StateTables, "write", noted)
    return seen


def test_a_late_wave_keeps_its_texts_in_one_table(spark, monkeypatch):
    """Staged rows, all ready rows and changed late ones lay side by side while scored rows were written."""
    seen = seen_by_writes(monkeypatch, "raw_comments")
    landed.late_waves(spark, SF)
    assert len(seen) == 2
    for work, staged in seen:
        assert "ready" in work and "late" not in work and "kind=comments" not in staged


def test_pages_go_once_they_are_staged(spark, monkeypatch):
    """Pages stayed until their cycle had ended, beside the staged and the stored texts."""
    seen, named, run, scratch_dir = [], [], intake.run_cycle, landed.scratch_dir

    def noted(*args):
        folder = next(f for f in named if "/landing-" in f)
        seen.append([list_folder(spark, f"{folder}/{kind}") for kind in landing.FOLDERS])
        return run(*args)

    monkeypatch.setattr(intake, "run_cycle", noted)
    monkeypatch.setattr(landed, "scratch_dir", lambda s, name: named.append(scratch_dir(s, name)) or named[-1])
    store = landed.two_waves(spark, SF, fresh=True)
    assert seen == [[[], [], []]] * 2
    # nothing repeats an ended wave: the pending rows ahead of the last one are done with
    assert list_folder(spark, store.path("pending_comments")) == ["batch_id=2"]


def test_tables_of_texts_are_packed_closer_than_by_default(spark, tmp_path):
    def size(folder):
        return sum(f.stat().st_size for f in folder.glob("*.parquet"))

    texts = fx.table(spark, "/root/testdata/sf0.01", "documents").select("text").coalesce(1)
    texts.write.option("compression", "zstd").parquet(str(tmp_path / "plain"))
    assert cut_lineage(texts, str(tmp_path / "packed")).count() == texts.count()
    assert size(tmp_path / "packed") < 0.96 * size(tmp_path / "plain")
