import base64
import gzip
import hashlib
from datetime import datetime

import pytest

from opinara.llm import warc

DATE = datetime(2024, 1, 31)
ROWS = [
    (1, "http://a/é x\r\ny", "<p>hi</p>", "x"),
    (2, None, "<p>hi</p>", "x"),
    (3, "http://c", None, "x"),
    (4, "http://d", "", None),
    (None, "http://e", "<p>hi</p>", "x"),
    (None, "http://f", "alone", "x"),
    (7, "http://g", "é" * 200_000, "x"),
    (7, "http://g", "é" * 200_000, "x"),
    (8, "http://h", "".join(chr(33 + (i * i) % 90) for i in range(90_000)), "x"),
]


def pages(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string").repartition(3)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip_in_small_splits(spark, tmp_path):
    files = warc.write_archives(pages(spark), f"file://{tmp_path}/w", DATE)
    want = sorted(
        ((i, digest(h), {2: 1, 4: 3, None: 1}.get(i) if h != "alone" else None) for i, _, h, _ in ROWS), key=str
    )
    for split in (700, 5_000, 1 << 25):
        rows = warc.read_archives(files, split_bytes=split).collect()
        assert sorted(((r["page_id"], r["payload_digest"], r["refers_to"]) for r in rows), key=str) == want
        for r in rows:
            assert (r["record_type"] == "revisit") == (r["refers_to"] is not None) == (r["payload"] is None)
            if r["payload"] is not None:
                assert len(r["payload"]) == r["payload_bytes"] and digest(r["payload"].decode()) == r["payload_digest"]
        assert {r["payload_bytes"] for r in rows if r["page_id"] == 2} == {9}
    assert sum(r["records"] for r in files.collect()) == len(ROWS)


def test_short_payloads_are_all_responses(spark, tmp_path):
    files = warc.write_archives(pages(spark), str(tmp_path / "w"), DATE, min_bytes=10)
    rows = warc.read_archives(files, with_payload=False).collect()
    assert all(r["record_type"] == "response" for r in rows if r["payload_bytes"] < 10)


def test_archives_are_plain_gzip_and_roll_over(spark, tmp_path):
    files = warc.write_archives(pages(spark), str(tmp_path / "w"), DATE, file_bytes=1).collect()
    assert len(files) == len(ROWS)
    for f in files:
        with gzip.open(f["path"]) as g:
            assert g.read().startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_revisits_name_a_record_of_the_archives(spark, tmp_path):
    rows = [r for i, r in enumerate(ROWS) if r not in ROWS[:i]]
    files = warc.write_archives(pages(spark, rows), str(tmp_path / "w"), DATE).collect()
    heads = []
    for f in files:
        source = warc.Source(f["path"])
        heads += [warc.fields_of(d.partition(b"\r\n\r\n")[0]) for _, d in warc.records_in(source, 0, source.size)]
    pages_of = {h["warc-record-id"]: h.get("warc-page-id") for h in heads}
    assert len(pages_of) == len(heads) == len(rows)
    revisits = [h for h in heads if h["warc-type"] == "revisit"]
    assert len(revisits) == 3
    for h in revisits:
        assert pages_of[h["warc-refers-to"]] == h["warc-refers-to-page-id"]


def test_places_that_only_look_like_a_start(tmp_path):
    data = warc.packed(warc.record(1, "u", b"one", None, "d"))
    false = warc.MAGIC + b"\x00" * 20
    other = gzip.compress(b"no archive " * 3)
    path = tmp_path / "x"
    path.write_bytes(false + data + false + other + warc.packed(warc.record(2, "u", b"two", None, "d")) + data[:40])
    found = [warc.parse(d)["payload"] for _, d in warc.records_in(warc.Source(str(path)), 0, 10**6)]
    assert found == [b"one", b"two"]
    size = path.stat().st_size
    owned = [p for a in range(0, size, 13) for p, _ in warc.records_in(warc.Source(str(path)), a, min(a + 13, size))]
    assert len(owned) == 2


def test_empty(spark, tmp_path):
    files = warc.write_archives(pages(spark).limit(0), str(tmp_path / "w"), DATE)
    assert warc.read_archives(files).count() == 0
    assert warc.round_trip(pages(spark, [(1, None, None, None)]), DATE).first()["payload_bytes"] == 0


def test_url_of_any_length(spark, tmp_path):
    rows = [(1, "data:text/html," + "é" * 20_000, "<p>hi</p>", "x"), (2, "http://b", "<p>hi</p>", "x"), (3, "u" * 3_000_000, "c", "x")]
    files = warc.write_archives(pages(spark, rows), str(tmp_path / "w"), DATE)
    for split in (5_000, 1 << 25):
        found = {r["page_id"]: r for r in warc.read_archives(files, split_bytes=split).collect()}
        assert set(found) == {1, 2, 3} and found[2]["refers_to"] == 1
        assert len(found[1]["url"]) == 15 + 6 * 20_000 and found[3]["url"] == "u" * 3_000_000
    assert warc.round_trip(pages(spark, rows), DATE).count() == 3


def test_records_that_are_not_read_back_are_an_error(spark, tmp_path):
    files = warc.write_archives(pages(spark), str(tmp_path / "w"), DATE)
    assert warc.all_read(warc.read_archives(files), files).count() == len(ROWS)
    for f in files.collect():
        with open(f["path"], "rb+") as file:
            file.truncate(20)
    with pytest.raises(ValueError, match="written and read"):
        warc.all_read(warc.read_archives(files), files)
