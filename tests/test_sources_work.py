"""Readers, writers, shard export and restartable work."""

import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shardloom.operators import workqueue as WQ
from shardloom.session import scratch_path
from shardloom.sources import fs
from shardloom.sources import readers as R
from shardloom.sources import shards as S
from shardloom.sources import writers as WR

from conftest import SF_SMALL


def test_read_lines_and_listing(spark):
    d = tempfile.mkdtemp(prefix="shardloom-test-", dir="/tmp")
    with open(os.path.join(d, "files.txt"), "w") as f:
        f.write("data/a.parquet\ndata/b.parquet\n")
    with open(os.path.join(d, "x.bin"), "wb") as f:
        f.write(b"0" * 2048)
    lines = R.read_lines(spark, os.path.join(d, "files.txt"))
    assert lines.columns == ["path"] and lines.count() == 2
    lst = R.list_artifacts(spark, d, "*.bin").collect()
    assert len(lst) == 1 and lst[0]["bytes"] == 2048 and lst[0]["size_gb"] == pytest.approx(2048 / 1024 ** 3)


def test_to_local_cap_and_from_local(spark):
    df = R.from_local(spark, pd.DataFrame({"a": [1, 2, 3]}), "a long")
    assert len(R.to_local(df, 3)) == 3
    with pytest.raises(ValueError):
        R.to_local(df, 2)


def _encoded(spark, n=40, length=8):
    rows = [(i, i % 2, [i] * length, [0] * length, [1] * length) for i in range(n)]
    return spark.createDataFrame(rows, "idx long, label int, input_ids array<int>, token_type_ids array<int>, "
                                       "attention_mask array<int>")


COLS = {"label": "int32", "input_ids": "ndarray:int32", "token_type_ids": "ndarray:int32",
        "attention_mask": "ndarray:int32"}


def test_export_shards_holds_each_row_once_and_verifies(spark):
    p = scratch_path(spark, "test-shards")
    man = S.export_shards(_encoded(spark), p, COLS, "idx", parts=3, size_limit=500)
    rows = man.orderBy("part", "shard").collect()
    assert sum(r["rows"] for r in rows) == 40
    assert all(r["bytes"] <= 500 for r in rows)          # 100-byte rows, limit 500
    assert [r["start"] for r in rows] == [sum(x["rows"] for x in rows[:i]) for i in range(len(rows))]
    back = spark.read.parquet(p)
    assert back.count() == 40 and back.select("idx").distinct().count() == 40
    v = S.verify_export(spark, p, COLS).collect()
    assert all(r["rows_ok"] and r["hash_ok"] for r in v)
    assert S.sample_shards(spark, p, COLS, "idx", 5).count() == 5


def test_verify_detects_a_changed_shard(spark):
    p = scratch_path(spark, "test-shards")
    S.export_shards(_encoded(spark), p, COLS, "idx", parts=2, size_limit=1000)
    target = f"{p}/part=0/shard=0"
    df = spark.read.parquet(target).withColumn("label", F.lit(9))
    df.write.mode("overwrite").parquet(target + "_tmp")
    spark.read.parquet(target + "_tmp").write.mode("overwrite").parquet(target)
    fs.delete(spark, target + "_tmp")
    bad = [r for r in S.verify_export(spark, p, COLS).collect() if not r["hash_ok"]]
    assert [(r["part"], r["shard"]) for r in bad] == [(0, 0)]


def test_merge_manifest_offsets(spark):
    a = spark.createDataFrame([(0, 0, 3), (0, 1, 2)], "part int, shard int, rows long")
    b = spark.createDataFrame([(1, 0, 4)], "part int, shard int, rows long")
    m = S.merge_manifest([a, b]).orderBy("part", "shard").collect()
    assert [r["start"] for r in m] == [0, 3, 5]


def test_split_tables_and_classes(spark):
    base = scratch_path(spark, "test-tables")
    df = spark.createDataFrame([(1, "train"), (2, "test"), (3, "train")], "k long, split string")
    names = WR.write_splits(df, "split", "t_split_x", base)
    assert names == ["t_split_x_test", "t_split_x_train"]
    assert R.read_table(spark, "t_split_x_train").count() == 2
    d = scratch_path(spark, "test-info")
    os.makedirs(d)
    with open(os.path.join(d, "info.json"), "w") as f:
        f.write('{"ds--x": {"features": {"names": ["a", "b", "c"]}}}')
    cl = R.read_classes(spark, d, ["ds--x", "features", "names"]).orderBy("category_id").collect()
    assert [(r["category_id"], r["category_name"]) for r in cl] == [(0, "a"), (1, "b"), (2, "c")]


def test_target_path_rules(spark):
    df = spark.createDataFrame([("http://h.example.com/a/b/c.txt",), ("https://h.example.com/a/b/",),
                                ("http://h.example.com",), ("http://h.example.com/x/y?q=1#frag",)], "url string")
    got = [r[0] for r in df.select(WQ.target_path("url", 1)).collect()]
    assert got == ["b/c.txt", "b/index.html", "index.html", "y?q=1"]
    got = [r[0] for r in df.select(WQ.target_path("url", 5)).collect()]
    assert got == ["c.txt", "index.html", "index.html", "y?q=1"]


def test_work_resumes_without_redoing_rows(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url")
    state = scratch_path(spark, "test-work")
    marker = tempfile.mkdtemp(prefix="shardloom-copies-", dir="/tmp")

    def copy(page_id, attempt):
        # idempotent side effect: one file per (row, attempt)
        open(os.path.join(marker, f"{page_id}-{attempt}"), "w").close()
        return 0 if (page_id + attempt) % 2 == 0 or attempt >= 2 else 8

    fn = WQ.row_function(copy)
    WQ.run_until_done(pages, fn, state, ["page_id"], max_rounds=1)
    first = set(os.listdir(marker))
    st, left = WQ.run_until_done(pages, fn, state, ["page_id"], max_rounds=5)
    assert left.count() == 0 and WQ.current_generation(spark, state) == 2
    second = set(os.listdir(marker)) - first
    done_first = {r["page_id"] for r in WQ.read_state(spark, state, 1).filter("status = 0").collect()}
    assert all(int(n.split("-")[0]) not in done_first for n in second)
    assert WQ.cleanup(spark, state, created=True) and not fs.exists(spark, state)


def test_work_stops_at_max_rounds_and_keeps_state(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url")
    state = scratch_path(spark, "test-work")
    st, left = WQ.run_until_done(pages, lambda pid, a: F.lit(4), state, ["page_id"], max_rounds=2)
    assert left.count() == pages.count() and WQ.current_generation(spark, state) == 2
    assert not WQ.cleanup(spark, state, created=True) and fs.exists(spark, state)
    assert not WQ.cleanup(spark, state, created=False)


def test_coco_frames(spark):
    images = spark.createDataFrame([(1, 10, 20)], "image_id long, width int, height int")
    objs = spark.createDataFrame([(1, 1, 2, 0.0, 0.0, 2.0, 3.0)],
                                 "image_id long, bbox_id long, category int, x double, y double, w double, h double")
    cls = spark.createDataFrame([(2, "dog")], "category_id int, category_name string")
    fr = WR.coco_frames(images, objs, cls)
    assert fr["annotations"].first()["area"] == 6.0
    assert fr["categories"].first()["supercategory"] == "none"
    p = scratch_path(spark, "test-coco")
    WR.write_coco(fr, p)
    assert spark.read.json(f"{p}/images").count() == 1


def test_shards_close_before_they_overflow(spark):
    df = spark.createDataFrame([(i, "x" * 100) for i in range(5)], "idx long, s string")
    got = {r["idx"]: r["shard"] for r in S.assign_shards(df, {"s": "str"}, "idx", 1, 250).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 1, 4: 2}


def test_digest_tells_moved_nulls_apart(spark):
    df = spark.createDataFrame([("x", None), (None, "x")], "a string, b string")
    d = [r[0] for r in df.select(S.row_digest({"a": "str", "b": "str"})).collect()]
    assert d[0] != d[1]


def _sequential(sizes, limit):
    out, cur, shard = [], 0, 0
    for s in sizes:
        if cur > 0 and cur + s > limit:
            cur, shard = 0, shard + 1
        cur += s
        out.append(shard)
    return out


@pytest.mark.parametrize("limit", [1, 10, 57, 1000])
def test_rollover_is_the_sequential_rule(spark, limit):
    import random
    rnd = random.Random(limit)
    texts = ["x" * rnd.choice([0, 0, 1, 3, 9, 10, 11, 700]) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "idx int, t string")
    got = S.assign_shards(df, {"t": "str"}, "idx", parts=1, size_limit=limit).orderBy("idx").collect()
    assert [r["shard"] for r in got] == _sequential([max(len(t), 1) for t in texts], limit)


def test_export_compares_with_its_source(spark):
    p = scratch_path(spark, "test-source")
    df = spark.createDataFrame([(i, f"t{i}") for i in range(30)], "idx int, t string")
    S.export_shards(df, p, {"idx": "int32", "t": "str"}, "idx", parts=2, size_limit=20)
    ok = S.verify_export(spark, p, {"idx": "int32", "t": "str"}, df).collect()
    assert all(r["rows_ok"] and r["hash_ok"] for r in ok)
    changed = df.withColumn("t", F.when(F.col("idx") == 3, F.lit("other")).otherwise(F.col("t")))
    bad = [r for r in S.verify_export(spark, p, {"idx": "int32", "t": "str"}, changed).collect() if not r["hash_ok"]]
    assert [(r["part"], r["rows_ok"]) for r in bad] == [(-1, True)]
    with pytest.raises(ValueError):
        S.export_shards(df.union(df), scratch_path(spark, "test-twice"), {"t": "str"}, "idx", parts=1)


def test_rounds_go_on_after_the_cap_and_failures_are_recorded(spark):
    path = scratch_path(spark, "test-resume")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, url string")

    def third_time(value, attempt):
        if value == "b":
            raise OSError("no such host")
        return 0 if attempt >= 3 else 8

    fn = WQ.row_function(third_time)
    state, left = WQ.run_until_done(df, fn, path, ["url"], max_rounds=2)
    assert left.count() == 2
    state, left = WQ.run_until_done(df, fn, path, ["url"], max_rounds=2)
    rows = {r["id"]: r for r in state.collect()}
    assert rows[1]["status"] == 0 and rows[1]["attempts"] == 3
    assert rows[2]["status"] == WQ.FAILED and rows[2]["error"] == "OSError: no such host"


def test_samples_are_read_by_position(spark):
    p = scratch_path(spark, "test-shards")
    man = S.export_shards(_encoded(spark, 200), p, COLS, "idx", parts=3, size_limit=1100)
    written = {(r["part"], r["shard"]): r for r in man.collect()}
    full = [r["idx"] for r in spark.read.parquet(p).orderBy("part", "shard", "idx").collect()]
    wanted = [0, 199, 57, 57, 10, 11, 120, -1, 200, None]
    asked = spark.createDataFrame([(w,) for w in wanted], "position long")
    got = S.read_positions(spark, p, asked).collect()
    assert sorted(r["position"] for r in got) == sorted([0, 199, 57, 57, 10, 11, 120])
    for r in got:
        assert r["idx"] == full[r["position"]] and r["input_ids"] == [r["idx"]] * 8
        assert r["position"] == written[r["part"], r["shard"]]["start"] + r["offset"]
    outside = S.locate_positions(man, asked).filter("shard is null").collect()
    assert sorted((r["position"] is None, r["position"] or 0) for r in outside) == [(False, -1), (False, 200), (True, 0)]
    everything = S.read_positions(spark, p, spark.range(200).withColumnRenamed("id", "position"), most_listed=3)
    assert [r["idx"] for r in everything.orderBy("position").collect()] == full


def test_a_positional_read_opens_the_needed_shards_only(spark):
    p = scratch_path(spark, "test-shards")
    S.export_shards(_encoded(spark, 200), p, COLS, "idx", parts=3, size_limit=1100)
    got = S.read_positions(spark, p, spark.createDataFrame([(0,), (3,)], "position long"), columns=["label"])
    assert got.columns == ["position", "part", "shard", "offset", "label"] and got.count() == 2
    files = [f for f in got.inputFiles() if "/part=" in f]
    assert len(files) == 1 and "/part=0/shard=0/" in files[0]
    assert S.read_positions(spark, p, spark.createDataFrame([(999,)], "position long")).count() == 0


def test_the_manifest_is_that_of_the_files(spark):
    p = scratch_path(spark, "test-shards")
    src = _encoded(spark, 50).withColumn("label", F.col("label").cast("long"))  # written as int32
    man = S.export_shards(src, p, COLS, "idx", parts=2, size_limit=700)
    read = S._scan(spark, p, COLS)
    columns = ["part", "shard", "rows", "bytes", "hash"]
    assert sorted(map(tuple, man.select(columns).collect())) == sorted(map(tuple, read.select(columns).collect()))


def test_due_rows_by_status_class_and_host(spark):
    rows = [(1, "a", None, 0, None), (2, "a", 503, 1, 100), (3, "a", 503, 3, 100), (4, "a", 404, 1, 0), (5, "a", 0, 1, 0),
            (6, None, WQ.FAILED, 1, 0), (7, None, None, 0, None), (8, "b", 503, 60, 0), (9, "b", 503, 1, None)]
    df = spark.createDataFrame(rows, "k long, host string, status int, attempts int, last_try long")
    nxt = {r["k"]: (r["final"], r["next_try"]) for r in WQ.with_next_try(df).collect()}
    assert nxt == {1: (False, 0), 2: (False, 160), 3: (False, 340), 4: (True, None), 5: (True, None), 6: (False, 60),
                   7: (False, 0), 8: (False, 86_400), 9: (False, 60)}
    assert sorted(r["k"] for r in WQ.due_rows(df, 160, "k").collect()) == [1, 2, 6, 7, 9]
    assert sorted(r["k"] for r in WQ.due_rows(df, 160, "k", per_host=1).collect()) == [1, 7, 9]
    assert WQ.due_rows(df.limit(0), 160, "k", per_host=1).count() == 0


def test_due_rounds_try_each_host_a_bounded_number_of_times(spark):
    state = scratch_path(spark, "test-due")
    df = spark.range(25).select(F.col("id").alias("k"), F.when(F.col("id") < 20, "hot").otherwise("b").alias("host"),
                                F.lit(None).cast("bigint").alias("last_try"))
    WQ.init_state(df, state)
    tried = [WQ.run_due_round(spark, state, lambda k, n: F.lit(0), ["k"], now, "k", per_host=8)[1] for now in range(4)]
    assert tried == [13, 8, 4, 0]  # 8 + 5, 8, 4, nothing left
    done = WQ.read_state(spark, state)
    assert done.filter("status = 0 and attempts = 1").count() == 25
    assert WQ.current_generation(spark, state) == 3  # an idle round writes no generation


def test_fresh_copies_are_skipped(spark):
    df = spark.createDataFrame([("a", 5, 10), ("b", 5, 10), ("c", 5, 10), ("d", None, 10), ("e", 5, 10)],
                               "target string, bytes long, modified long")
    have = spark.createDataFrame([("a", 5, 10), ("a", 5, 3), ("b", 6, 99), ("c", 5, 9), ("d", None, 99)], df.schema)
    assert sorted(r[0] for r in WQ.skip_fresh(df, have).select("target").collect()) == ["b", "c", "d", "e"]


def test_many_folders_are_listed_by_few_tasks(spark):
    p = scratch_path(spark, "test-folders")
    S.export_shards(_encoded(spark, 600), p, COLS, "idx", parts=1, size_limit=100)  # a sample a shard
    before = spark.conf.get(fs._LISTING)
    spark.sparkContext.setJobGroup("listing", "listing")
    assert R.list_artifacts(spark, p, "*.parquet").count() == 600
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(s.numTasks for s in stages if s) <= max(32, 8 * spark.sparkContext.defaultParallelism)
    assert spark.conf.get(fs._LISTING) == before
