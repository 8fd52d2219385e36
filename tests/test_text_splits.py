"""Tokens, vocabulary, encoding, splits, groups, batches."""

import pytest
from pyspark.sql import functions as F

from shardloom.functions.text import CLS, PAD, SEP, UNK, tokens
from shardloom.operators import splits as B
from shardloom.operators import text as T

from conftest import SF_SMALL


def test_tokens_lowercase_unicode(spark):
    df = spark.createDataFrame([("Über-Straße, ÑANDÚ 42!!",)], "text string")
    assert df.select(tokens("text").alias("t")).first()["t"] == ["über", "straße", "ñandú", "42"]


def test_encode_edges(spark):
    docs = spark.createDataFrame([(1, ""), (2, "a b c d e f"), (3, "zzz a")], "id long, text string")
    vocab = T.build_vocab(spark.createDataFrame([("a b a",)], "text string"), "text", 10)
    enc = {r["id"]: r for r in T.encode(docs, vocab, "id", "text", 5).collect()}
    a, b = [r["id"] for r in vocab.filter("token in ('a','b')").orderBy("token").collect()]
    assert enc[1]["input_ids"] == [CLS, SEP, PAD, PAD, PAD]
    assert enc[1]["attention_mask"] == [1, 1, 0, 0, 0]
    assert enc[2]["input_ids"] == [CLS, a, b, UNK, SEP]          # truncated to max_length
    assert enc[3]["input_ids"] == [CLS, UNK, a, SEP, PAD]
    assert enc[3]["token_type_ids"] == [0] * 5


def test_vocab_ids_follow_specials_and_ties(spark):
    v = T.build_vocab(spark.createDataFrame([("b a c b a d",)], "text string"), "text", 3)
    rows = [(r["token"], r["id"]) for r in v.orderBy("id").collect()]
    assert rows == [("[PAD]", 0), ("[UNK]", 1), ("[CLS]", 2), ("[SEP]", 3), ("a", 4), ("b", 5), ("c", 6)]


def _docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id")


@pytest.mark.parametrize("how", ["ordered", "hash"])
def test_split_disjoint_and_complete(spark, how):
    s = B.train_test_split(_docs(spark), 0.2, "doc_id", how)
    n = _docs(spark).count()
    assert s.count() == n and s.select("doc_id").distinct().count() == n
    test = s.filter("split = 'test'").count()
    if how == "ordered":
        assert test == n - (n * 4) // 5


def test_groups_fewer_rows_than_groups(spark):
    df = spark.range(3).withColumnRenamed("id", "k")
    g = {r["k"]: r["group"] for r in B.assign_groups(df, 5, "k").collect()}
    assert g == {0: 4, 1: 4, 2: 4}
    g = [r["group"] for r in B.assign_groups(spark.range(11).withColumnRenamed("id", "k"), 3, "k")
         .orderBy("k").collect()]
    assert g == [0, 0, 0, 1, 1, 1, 2, 2, 2, 2, 2]


def test_batches_drop_last_and_cap(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    b = B.assign_batches(df, 4, "k", drop_last=True)
    assert sorted(r["batch"] for r in b.collect()) == [0] * 4 + [1] * 4
    b = B.assign_batches(df, 4, "k", max_batches=1)
    assert b.count() == 4
    assert B.batch_count(df, 4, True).first()["n_batches"] == 2
    assert B.batch_count(df, 4, False).first()["n_batches"] == 3


def test_workers_shares_differ_by_at_most_one(spark):
    w = B.assign_workers(spark.range(101).withColumnRenamed("id", "k"), 8, "k")
    sizes = [r["count"] for r in w.groupBy("worker").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 101


def test_parallelism_floor(spark):
    df = spark.range(10).coalesce(1)
    assert B.with_parallelism(df, floor_factor=2).rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
    assert B.with_parallelism(df, n=3).rdd.getNumPartitions() == 3


def test_collate_and_pad(spark):
    df = spark.createDataFrame([(0, 0, [1, 2], 1), (1, 0, [3], 0), (2, 1, [4, 5, 6], 1)],
                               "i long, batch long, x array<int>, label int")
    c = {r["batch"]: r for r in T.collate(df, "batch", "i", ["x"], "label").collect()}
    assert c[0]["x"] == [[1, 2], [3]] and c[0]["labels"] == [1, 0]
    p = {r["i"]: r for r in T.pad_batch(df, "x", "batch", 0, "mask").collect()}
    assert p[1]["x"] == [3, 0] and p[1]["mask"] == [1, 0] and p[2]["mask"] == [1, 1, 1]


def test_describe_encoded(spark):
    df = spark.createDataFrame([(1, [5, 6, 7])], "k long, ids array<int>")
    r = T.describe_encoded(df, ["ids"], head=2, keys=["k"]).first()
    assert r["first_ids"] == [5, 6] and r["length"] == 3 and r["dtype"] == "array<int>"
    m = T.map_columns(df, {"n": F.size("ids")}, remove=["ids"])
    assert m.columns == ["k", "n"]


def test_encode_keeps_rows_of_a_repeated_key(spark):
    df = spark.createDataFrame([(1, "aa bb"), (1, "bb cc dd ee")], "id long, text string")
    vocab = T.build_vocab(df, "text", 100)
    rows = T.encode(df, vocab, "id", "text", 5).collect()
    assert len(rows) == 2 and all(len(r["input_ids"]) == 5 and r["id"] == 1 for r in rows)


def test_token_counts_read_whole_texts(spark):
    df = spark.createDataFrame([("x", "aa " * 500), (None, "bb"), (None, None)], "g string, text string")
    vocab = T.build_vocab(df.limit(1), "text", 100)
    got = {r["g"]: (r["n_docs"], r["n_tokens"], r["n_unknown"]) for r in T.token_counts(df, vocab, ["g"]).collect()}
    assert got == {"x": (1, 500, 0), None: (2, 1, 1)}


def test_small_shares_are_exact(spark):
    df = spark.range(200_000).withColumnRenamed("id", "k")
    n = B.train_test_split(df, 0.00001, "k", "hash").filter("split = 'test'").count()
    assert n <= 10  # 2 expected
    n = B.train_test_split(df, 0.001, "k", "hash").filter("split = 'test'").count()
    assert 130 <= n <= 270  # 200 expected
