"""Row operators, scoring and batch inference."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.functions.arrays import argmax, softmax
from shardloom.operators import model as N
from shardloom.operators import rows as P

from conftest import SF_SMALL


def test_argmax_first_wins_and_softmax_sums_to_one(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, -1.0],)], "a array<double>")
    r = df.select(argmax("a").alias("k"), softmax("a").alias("p")).first()
    assert r["k"] == 1 and sum(r["p"]) == pytest.approx(1.0)


def test_cross_entropy_and_accuracy(spark):
    rows = [([2.0, 0.5, -1.0], 0), ([0.1, 0.2, 0.3], 1)]
    df = spark.createDataFrame(rows, "logits array<double>, label int")
    ce = N.cross_entropy(df, "logits", "label").first()["cross_entropy"]
    exp = np.mean([-(l[y] - math.log(sum(math.exp(v) for v in l))) for l, y in rows])
    assert ce == pytest.approx(exp)
    acc = N.accuracy(N.with_argmax(df, "logits"), "pred", "label").first()["accuracy"]
    assert acc == 0.5


def test_predict_batches_batch_size_and_model_per_worker(spark):
    calls = spark.sparkContext.accumulator(0)

    def make_model():
        calls.add(1)
        return lambda pdf: [len(pdf)] * len(pdf)

    df = spark.range(1000).repartition(3)
    out = N.predict_batches(df, make_model, ["id"], "long", batch_size=100)
    sizes = [r["prediction"] for r in out.collect()]
    assert max(sizes) <= 100 and len(sizes) == 1000
    assert 1 <= calls.value <= 3  # three tasks, and no worker builds it twice


def test_pending_and_split_valid(spark):
    df = spark.createDataFrame([(1, None), (2, 0), (3, 8)], "k long, status int")
    assert sorted(r["k"] for r in P.pending(df).collect()) == [1, 3]
    good, bad = P.split_valid(df, {"tried": F.col("status").isNotNull(), "ok": F.col("status") == 0})
    assert [r["k"] for r in good.collect()] == [2]
    assert {r["k"]: r["reason"] for r in bad.collect()} == {1: "tried", 3: "ok"}
    with pytest.raises(ValueError):
        P.split_valid(df.filter("k = 3"), {"ok": F.col("status") == 0}, require_rows=True)


def test_conform_raises_on_overflow(spark):
    df = spark.createDataFrame([(2 ** 40,)], "v long")
    with pytest.raises(Exception):
        P.conform(df, {"v": "int32"}).collect()
    assert P.conform(spark.createDataFrame([([1, 2],)], "a array<bigint>"),
                     {"a": "ndarray:int32"}).dtypes == [("a", "array<int>")]


def test_image_bytes_struct_or_binary(spark):
    a = spark.createDataFrame([(bytearray(b"\x01\x02"),)], "image binary")
    b = spark.createDataFrame([((bytearray(b"\x03"),),)], "image struct<bytes: binary>")
    assert bytes(P.image_bytes(a).first()["image_bytes"]) == b"\x01\x02"
    assert bytes(P.image_bytes(b).first()["image_bytes"]) == b"\x03"
    with pytest.raises(TypeError):
        P.image_bytes(spark.createDataFrame([("x",)], "image string"))


def test_take_n_is_top_k(spark, capsys):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    capsys.readouterr()
    P.take_n(df, 5, [F.desc("o_totalprice")]).explain()
    assert "TakeOrderedAndProject" in capsys.readouterr().out


def test_latest_by_no_match_gives_no_row(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    assert P.latest_by(ev, "event_id", "ts", pred=F.col("event_type") == "none").count() == 0
