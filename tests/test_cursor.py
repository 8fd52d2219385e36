"""Workers that stop and go on in another number read every sample of an epoch once."""

import pytest
from pyspark.sql import functions as F

from shardloom.session import scratch_path
from shardloom.sources import cursor as C
from shardloom.sources import shards as S


@pytest.fixture(scope="module")
def export(spark):
    rows = spark.range(157).select(F.col("id").alias("idx"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("sentence"),
                                   (F.col("id") % 3).alias("label"))
    path = scratch_path(spark, "cursor-shards")
    S.export_shards(rows, path, {"idx": "int64", "sentence": "str", "label": "int64"}, "idx", parts=3, size_limit=400)
    return path


def _expand(ranges):
    """(batch, place, part, shard, offset) of every sample."""
    return sorted((r["batch"], r["place"] + k, r["part"], r["shard"], r["offset"] + k) for r in ranges for k in range(r["rows"]))


@pytest.mark.parametrize("rounds", [0, 1, 2, 3, 4, 7])
def test_three_workers_then_five_read_each_sample_once(spark, export, rounds):
    man, total = S.read_manifest(spark, export), 157
    assert man.count() > 5
    start = C.Cursor(epoch=2)
    rest = C.advance(start, rounds, 3, 8, total)
    first = C.worker_ranges(man, start, 3, 8, rounds=rounds, seed=1).collect()
    then = C.worker_ranges(man, rest, 5, 8, seed=1).collect() if rest.epoch == 2 else []
    one = _expand(C.worker_ranges(man, start, 1, 8, seed=1).collect())
    assert len(one) == total and len({x[2:] for x in one}) == total
    stream = [x[2:] for x in sorted(one)]
    assert [x[2:] for x in _expand(first)] + [x[2:] for x in _expand(then)] == stream
    for ranges, workers in ((first, 3), (then, 5)):
        assert all(r["worker"] == r["batch"] % workers for r in ranges)
    assert len({r["batch"] for r in first}) == min(3 * rounds, -(-total // 8))


def test_batches_hold_the_samples_of_their_ranges(spark, export):
    man, at = S.read_manifest(spark, export), C.Cursor(1, 50)
    got = C.read_batches(spark, export, at, 4, 10, rounds=2, seed=3)
    assert got.columns == ["worker", "batch", "place", "part", "shard", "offset", "idx", "sentence", "label"]
    got = got.collect()
    assert sorted(tuple(r[c] for c in ("batch", "place", "part", "shard", "offset")) for r in got) == _expand(
        C.worker_ranges(man, at, 4, 10, rounds=2, seed=3).collect())
    places = S.locate_positions(man, spark.range(157).withColumnRenamed("id", "position"))
    where = {(r["part"], r["shard"], r["offset"]): r["position"] for r in places.collect()}
    assert len(got) == 80 and all(where[r["part"], r["shard"], r["offset"]] == r["idx"] and r["sentence"] == f"s{r['idx']}" for r in got)


def test_only_the_round_s_shards_are_opened(spark, export):
    read = C.read_batches(spark, export, C.Cursor(0, 0), 1, 5, rounds=1)
    opened = {f.rsplit("/", 1)[0] for f in read.inputFiles() if "/shard=" in f}
    assert 1 <= len(opened) <= 2
    every = C.read_batches(spark, export, C.Cursor(0, 0), 1, 5, rounds=1, most_listed=0)
    assert sorted(map(tuple, every.collect())) == sorted(map(tuple, read.collect()))


def test_epochs_differ_and_cursors_roll_over(spark, export):
    man = S.read_manifest(spark, export)
    orders = [[(r["part"], r["shard"]) for r in C.epoch_order(man, e, 5).orderBy("stream_start").collect()] for e in (0, 0, 1)]
    assert orders[0] == orders[1] != orders[2] and sorted(orders[0]) == sorted(orders[2])
    assert C.advance(C.Cursor(0, 10), 2, 3, 4, 100) == C.Cursor(0, 34)
    assert C.advance(C.Cursor(0, 76), 2, 3, 4, 100) == C.Cursor(1, 0)
    assert C.advance(C.Cursor(3, 99), 5, 1, 1, 100) == C.Cursor(4, 0)
    for bad in ({"workers": 0}, {"batch": 0}, {"rounds": -1}):
        with pytest.raises(ValueError):
            C.advance(C.Cursor(), **{"rounds": 1, "workers": 1, "batch": 1, "total": 5, **bad})


def test_an_empty_export_and_the_end_of_an_epoch_give_no_batches(spark, export):
    man = S.read_manifest(spark, export)
    assert C.worker_ranges(man.limit(0), C.Cursor(), 2, 4).count() == 0
    assert C.worker_ranges(man, C.Cursor(0, 157), 2, 4).count() == 0
    assert C.read_batches(spark, export, C.Cursor(0, 157), 2, 4).count() == 0
