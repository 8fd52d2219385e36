"""Full batches and worker-lifetime models (N1), failing rows (P11), append-only work state."""

import collections
import math
import os

import pytest
from pyspark.sql import functions as F

from shardloom.operators import model as N
from shardloom.operators import workqueue as WQ
from shardloom.session import scratch_path


@pytest.mark.parametrize("size", [64, 100, 5000])
def test_only_the_last_batch_of_a_partition_is_short(spark, size):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        df = spark.range(1000).repartition(3).withColumn("part", F.spark_partition_id())
        got = N.predict_batches(df, lambda: lambda pdf: [len(pdf)] * len(pdf), ["id"], "long", batch_size=size).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r["id"] for r in got) == list(range(1000))
    for part in range(3):
        sizes = collections.Counter(r["prediction"] for r in got if r["part"] == part)
        n = sum(sizes.values())
        assert sizes == {k: v for k, v in {size: n - n % size, n % size: n % size}.items() if v}


def test_a_worker_builds_its_model_once(spark, tmp_path):
    where = str(tmp_path)

    def make_model(weights):
        import uuid
        open(os.path.join(where, f"{os.getpid()}-{uuid.uuid4().hex}"), "w").close()
        return lambda pdf: (pdf["id"] * weights).tolist()

    df = spark.range(400).repartition(40)
    for _ in range(2):  # the second query finds the models of the first
        got = N.predict_batches(df, make_model, ["id"], "long", batch_size=7, weights=3).collect()
        assert all(r["prediction"] == 3 * r["id"] for r in got)
    pids = [n.split("-")[0] for n in os.listdir(where)]
    assert len(pids) == len(set(pids)) < 40
    other = N.predict_batches(df, make_model, ["id"], "long", batch_size=7, weights=5).collect()  # other weights, another model
    assert all(r["prediction"] == 5 * r["id"] for r in other)


@pytest.mark.parametrize("bad", [set(), {0}, {3, 4, 99}, set(range(0, 1000, 50)), set(range(1000))])
def test_failing_rows_are_isolated(spark, bad):
    calls = spark.sparkContext.accumulator(0)

    def fn(pdf):
        calls.add(1)
        hit = [i for i in pdf["id"] if i in bad]
        if hit:
            raise KeyError(f"row {hit[0]}")
        return (pdf["id"] * 2).tolist()

    batch = 64
    df = spark.range(1000).repartition(2).withColumn("note", F.lit("x"))
    good, failed = N.isolate_failures(df, fn, ["id"], "bigint", batch_size=batch)
    assert {(r["id"], r["result"], r["note"]) for r in good.collect()} == {(i, 2 * i, "x") for i in range(1000) if i not in bad}
    assert {(r["id"], r["error"]) for r in failed.collect()} == {(i, f"KeyError: 'row {i}'") for i in bad}
    assert calls.value <= 1000 // batch + 2 + 2 * len(bad) * math.log2(batch)


def test_isolation_of_short_answers_and_empty_input(spark):
    good, failed = N.isolate_failures(spark.range(10), lambda pdf: [1] * (len(pdf) - (4 in set(pdf["id"]))), ["id"], "int", batch_size=4)
    assert good.count() == 9 and [(r["id"], r["error"]) for r in failed.collect()] == [(4, "ValueError: 0 outputs for 1 rows")]
    good, failed = N.isolate_failures(spark.range(0), lambda pdf: [], ["id"], "int", require_rows=True)
    assert good.count() == failed.count() == 0

    def never(pdf):
        raise OSError("gone")

    with pytest.raises(ValueError):
        N.isolate_failures(spark.range(5), never, ["id"], "int", require_rows=True)


def _status(k, attempt):
    """Row k is done in round k + 1."""
    return F.when(attempt > k, 0).otherwise(8)


def _rows(spark, path, name):
    return spark.read.parquet(f"{path}/{name}").count()


def test_a_round_writes_the_rows_it_tried(spark):
    path = scratch_path(spark, "state")
    df = spark.range(6).withColumnRenamed("id", "k")
    state, left = WQ.run_until_done(df, _status, path, ["k"], max_rounds=4)
    assert [_rows(spark, path, f"gen={g:06d}") for g in range(5)] == [6, 6, 5, 4, 3]
    assert sorted((r["k"], r["status"], r["attempts"]) for r in state.collect()) == [(0, 0, 1), (1, 0, 2), (2, 0, 3), (3, 0, 4), (4, 8, 4), (5, 8, 4)]
    assert sorted(r["k"] for r in left.collect()) == [4, 5]


def test_compaction_keeps_every_row_and_few_parts(spark):
    path = scratch_path(spark, "state")
    WQ.init_state(spark.range(24).withColumnRenamed("id", "k"), path)
    for g in range(1, 25):
        assert WQ.run_round(spark, path, _status, ["k"]) == g
        WQ.compact_state(spark, path, most_parts=3)
        if g % 6 == 0:
            got = sorted((r["k"], r["status"], r["attempts"]) for r in WQ.read_state(spark, path).collect())
            assert got == [(k, 0, k + 1) if k < g else (k, 8, g) for k in range(24)]
    _, parts = WQ._pointer(spark, path)
    assert len(parts) <= 4 and sum(p["rows"] for p in parts) == 24
    assert len([n for n in os.listdir(path) if n.startswith(("gen=", "done="))]) <= 5


def test_killed_rounds_and_compactions_lose_nothing(spark, monkeypatch):
    path = scratch_path(spark, "state")
    df = spark.range(8).withColumnRenamed("id", "k")
    WQ.run_until_done(df, _status, path, ["k"], max_rounds=5)
    before = sorted(map(tuple, WQ.read_state(spark, path).collect()), key=str)

    def killed(*a):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(WQ, "_commit", killed)
        for step in (lambda: WQ.compact_state(spark, path, most_parts=2), lambda: WQ.run_round(spark, path, _status, ["k"])):
            with pytest.raises(KeyboardInterrupt):
                step()
            assert sorted(map(tuple, WQ.read_state(spark, path).collect()), key=str) == before
    assert WQ.compact_state(spark, path, most_parts=2)
    assert sorted(map(tuple, WQ.read_state(spark, path).collect()), key=str) == before
    state, left = WQ.run_until_done(df, _status, path, ["k"])
    assert left.count() == 0 and sorted((r["k"], r["attempts"]) for r in state.collect()) == [(k, k + 1) for k in range(8)]
