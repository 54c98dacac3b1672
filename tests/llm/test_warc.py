import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from sensorfold.llm.common import shared_dir, ship
from sensorfold.llm import op6_warc as op
from sensorfold.llm.op6_warc import plan_records, qualified, read_chunks, round_trip, write_archives

SHAPE = "page_id bigint, url string, html string"


def brute(rows, least=1_000):
    top = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= least:
            top[b] = max(top.get(b, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        to = top.get(b)
        revisit = to is not None and to != i
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a/", "x" * 1_000), (2, None, "x" * 1_000), (9_007_199_254_740_993, "http://a/\r\nWARC-Type: x", "x" * 1_000),
    (3, "http://a/", "x" * 999), (4, "http://a/", "x" * 999), (5, "http://b/", None), (6, "http://b/", ""),
    (7, "http://c/é", "é\r\n\r\nWARC/1.1\r\n" * 30_000), (8, "http://c/", "é\r\n\r\nWARC/1.1\r\n" * 30_000), (10, "u", "\u0000" * 70_000),
]


def test_round_trip(spark, crowded):
    df = crowded(spark.createDataFrame(ROWS, SHAPE)).repartition(3)
    got = round_trip(df, chunk=4_096)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(ROWS)


def test_repeated_ids_and_no_pages(spark):
    rows = [(1, "u", "y" * 2_000), (1, "u", "y" * 2_000), (0, "u", "y" * 2_000)]
    got = round_trip(spark.createDataFrame(rows, SHAPE))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
    assert round_trip(spark.createDataFrame([], SHAPE)).count() == 0


def test_archives_and_chunks(spark):
    ship(spark)
    folder = "file://" + shared_dir(spark).removeprefix("file:")
    pages = spark.createDataFrame(ROWS, SHAPE).coalesce(1)
    manifest = write_archives(plan_records(pages), folder, chunk=1_024)
    (row,) = manifest.collect()
    assert row["records"] == len(ROWS)
    data = gzip.open(row["archive"]).read()
    assert data.count(b"\r\nWARC-Record-ID: ") == len(ROWS) and data.startswith(b"WARC/1.1\r\n")
    # what a lost task left behind is not in the manifest and not read
    with open(os.path.dirname(row["archive"]) + "/stray.warc.gz", "wb") as stray:
        stray.write(b"junk")
    chunks = read_chunks(manifest, folder, chunk=1_024)
    whole = chunks.where("page_id = 8").orderBy("chunk_no").collect()
    payload = dict((i, h) for i, _, h in ROWS)[8].encode()
    assert b"".join(r["data"] for r in whole) == payload
    assert [r["chunk_no"] for r in whole] == list(range(len(whole))) and len(whole) > 400
    assert whole[3]["digest_so_far"] == hashlib.sha1(b"".join(r["data"] for r in whole[:4])).hexdigest()
    assert chunks.where("last").count() == len(ROWS)
    assert chunks.agg(F.max(F.octet_length("data"))).first()[0] <= 1_024


def test_a_damaged_archive_is_refused(spark):
    ship(spark)
    folder = "file://" + shared_dir(spark).removeprefix("file:")
    manifest = write_archives(plan_records(spark.createDataFrame(ROWS[:1], SHAPE)), folder)
    path = manifest.first()["archive"]
    with gzip.open(path) as f:
        data = f.read()
    with gzip.open(path, "wb") as f:
        f.write(data[:-6])
    with pytest.raises(Exception, match="archive ends|does not end"):
        read_chunks(manifest, folder).collect()


def test_a_folder_without_a_scheme_is_the_cluster_s(spark, tmp_path):
    rows = ROWS[:4]
    got = round_trip(spark.createDataFrame(rows, SHAPE), folder=f"{tmp_path}/archives")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
    assert [f for f in os.listdir(tmp_path / "archives") if f.endswith(".warc.gz")]
    default = spark._jsc.hadoopConfiguration()
    before = default.get("fs.defaultFS")
    default.set("fs.defaultFS", "viewfs://store/")
    default.set("fs.viewfs.mounttable.store.link./in", f"file://{tmp_path}")
    try:
        assert qualified(spark, "/in/archives") == "viewfs://store/in/archives"
    finally:
        default.set("fs.defaultFS", before or "file:///")
    assert qualified(spark, f"file://{tmp_path}") == qualified(spark, str(tmp_path)) == f"file://{tmp_path}"


def test_the_query_reads_chunk_rows_and_clears_up(spark, monkeypatch):
    seen = []
    real = op.read_chunks
    monkeypatch.setattr(op, "read_chunks", lambda *a, **b: seen.append((a[1], out := real(*a, **b))) or out)
    got = round_trip(spark.createDataFrame(ROWS, SHAPE), chunk=4_096)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(ROWS)
    ((folder, _),) = seen
    assert not os.path.exists(folder.removeprefix("file://"))


def test_only_payloads_that_came_twice_move(spark):
    plan = plan_records(spark.createDataFrame(ROWS, SHAPE))
    assert sorted((r["_id"], r["_type"]) for r in plan.collect() if r["_type"] == "revisit") == [(1, "revisit"), (2, "revisit"), (7, "revisit")]
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in text and text.count("LeftOuter") >= 2
