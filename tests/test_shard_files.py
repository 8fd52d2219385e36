"""Shard files written, listed and read by tasks in a mounted folder, held against Spark's own writer and readers."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shardloom.session import scratch_path
from shardloom.sources import fs
from shardloom.sources import readers as R
from shardloom.sources import shards as S

COLS = {"label": "int32", "name": "str", "raw": "bytes", "ids": "ndarray:int32"}


def _rows(spark, n=60):
    rows = [(i, None if i % 7 == 0 else i % 3, None if i % 5 == 0 else "é" * (i % 4), bytes([i]) if i % 2 else None,
             [i, None, 3] if i % 3 else None) for i in range(n)]
    return spark.createDataFrame(rows, "idx long, label int, name string, raw binary, ids array<int>")


def _all(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("compression", ["zstd", "none", "gzip"])
def test_both_writers_and_readers_give_the_same_export(spark, monkeypatch, compression):
    src = _rows(spark)
    a, b = scratch_path(spark, "test-by-tasks"), scratch_path(spark, "test-by-spark")
    ours = _all(S.export_shards(src, a, COLS, "idx", parts=3, size_limit=40, compression=compression))
    verified, head = _all(S.verify_export(spark, a, COLS, src)), _all(S.sample_shards(spark, a, COLS, "idx"))
    read, listed = spark.read.parquet(a), _all(R.list_artifacts(spark, a, "*.parquet").select(
        F.regexp_extract("path", r"/part=\d+/shard=\d+/", 0), F.col("bytes") > 0))
    with monkeypatch.context() as m:
        m.setattr(fs, "mounted", lambda *a: None)
        assert _all(S.export_shards(src, b, COLS, "idx", parts=3, size_limit=40, compression=compression)) == ours
        assert _all(S.verify_export(spark, b, COLS, src)) == verified and _all(S.sample_shards(spark, b, COLS, "idx")) == head
        assert _all(S.verify_export(spark, a, COLS, src)) == verified
        theirs = spark.read.parquet(b)
        assert theirs.schema == read.schema and _all(theirs) == _all(read) and len(_all(read)) == 60
        assert _all(R.list_artifacts(spark, b, "*.parquet").select(
            F.regexp_extract("path", r"/part=\d+/shard=\d+/", 0), F.col("bytes") > 0)) == listed
    assert _all(S.verify_export(spark, b, COLS, src)) == verified  # tasks read what Spark has written


def test_a_shard_costs_one_file_and_no_checksum_file(spark):
    p = scratch_path(spark, "test-files")
    man = S.export_shards(_rows(spark), p, COLS, "idx", parts=2, size_limit=30)
    shards = [os.path.join(p, f"part={r['part']}", f"shard={r['shard']}") for r in man.collect()]
    assert len(shards) > 20 and all(os.listdir(s) == ["part-00000.zstd.parquet"] for s in shards)


def test_verify_reads_the_files_once(spark, monkeypatch):
    p = scratch_path(spark, "test-once")
    src = _rows(spark)
    S.export_shards(src, p, COLS, "idx", parts=2, size_limit=100)
    opened = []
    monkeypatch.setattr(S, "_open", lambda *a, f=S._open: opened.append(a) or f(*a))
    assert all(r["rows_ok"] and r["hash_ok"] for r in S.verify_export(spark, p, COLS, src).collect())
    assert len(opened) == 1


def test_verify_finds_lost_changed_and_added_shards(spark):
    p = scratch_path(spark, "test-harm")
    src = _rows(spark)
    man = S.export_shards(src, p, COLS, "idx", parts=2, size_limit=100)
    n = man.filter("part = 0").count()
    fs.delete(spark, f"{p}/part=0/shard=1")
    spark.read.parquet(f"{p}/part=1/shard=0").withColumn("label", F.lit(8)).write.parquet(f"{p}/part=1/_new")
    fs.delete(spark, f"{p}/part=1/shard=0")
    spark.read.parquet(f"{p}/part=1/_new").write.parquet(f"{p}/part=1/shard=0")
    spark.read.parquet(f"{p}/part=0/shard=0").write.parquet(f"{p}/part=0/shard={n}")
    got = S.verify_export(spark, p, COLS, src).collect()
    bad = {(r["part"], r["shard"]): (r["rows_ok"], r["hash_ok"]) for r in got if not (r["rows_ok"] and r["hash_ok"])}
    assert bad[0, 1] == (False, False) and bad[0, n] == (False, False) and bad[1, 0] == (True, False) and not bad[-1, -1][1]
    assert len(bad) == 4


def test_an_export_is_replaced_and_a_failed_task_leaves_no_file(spark, tmp_path):
    p = scratch_path(spark, "test-again")
    S.export_shards(_rows(spark), p, COLS, "idx", parts=2, size_limit=30)
    S.export_shards(_rows(spark, 4), p, COLS, "idx", parts=1, size_limit=1 << 20)
    assert spark.read.parquet(p).count() == 4

    def batches(fail):
        yield pa.RecordBatch.from_pydict({"x": [1, 2], "part": [0, 0], "shard": [0, 1]})
        yield pa.RecordBatch.from_pydict({"x": [3], "part": [0], "shard": [1]})
        if fail:
            raise RuntimeError("lost")

    write = S._shard_files(str(tmp_path), "zstd", 7)
    with pytest.raises(RuntimeError):
        list(write(batches(True)))
    assert os.listdir(tmp_path / "part=0/shard=1") == []
    for _ in range(2):  # another attempt, and one more beside it
        list(write(batches(False)))
    assert [r["x"] for r in spark.read.parquet(str(tmp_path)).orderBy("x").collect()] == [1, 2, 3]


@pytest.mark.parametrize("glob", ["*", "*.parquet", "a?.{txt,bin}", "[a-b]1.*"])
def test_listing_is_that_of_sparks_reader(spark, tmp_path, monkeypatch, glob):
    for name in ("a1.txt", "a2.bin", "_hidden/a1.txt", ".x/a1.txt", "d/a1.parquet", "d/e f/g/a3.bin", "d/_SUCCESS", "d/.a1.crc",
                 "_k=1/b1.txt", "d/b1.parquet._COPYING_", "p=1/q=2/a1.parquet", "a+1.txt", "d/a%20.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * len(name))
    (tmp_path / "empty").mkdir()
    ours = R.list_artifacts(spark, str(tmp_path), glob)
    assert "binaryfile" not in ours._jdf.queryExecution().toString().lower()
    monkeypatch.setattr(fs, "mounted", lambda *a: None)
    theirs = R.list_artifacts(spark, str(tmp_path), glob)
    assert ours.schema.simpleString() == theirs.schema.simpleString() and _all(ours) == _all(theirs) and ours.count() > 0
