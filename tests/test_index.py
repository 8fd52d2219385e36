"""Distributed row index and running sums: exact, gap-free, and the same
under 1, 4 and 16 partitions."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shardloom.operators.index import running_sum, with_row_index

from conftest import SF_SMALL


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_row_index_gap_free(spark, parts):
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey",
                                                                    "l_suppkey", "l_quantity", "l_extendedprice")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    got = with_row_index(df, keys, num_partitions=parts, count_name="n").toPandas()
    exp = df.toPandas().sort_values(keys).reset_index(drop=True)
    got = got.sort_values("row_idx").reset_index(drop=True)
    assert list(got["row_idx"]) == list(range(len(exp)))
    assert (got["n"] == len(exp)).all()
    pd.testing.assert_frame_equal(got[keys], exp[keys], check_dtype=False)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_row_index_groups(spark, parts):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang")
    got = with_row_index(df, ["doc_id"], groups=["lang"], num_partitions=parts, count_name="n").toPandas()
    pdf = df.toPandas().sort_values(["lang", "doc_id"])
    pdf["exp"] = pdf.groupby("lang").cumcount()
    m = got.merge(pdf, on=["doc_id", "lang"])
    assert (m["row_idx"] == m["exp"]).all()
    assert (m["n"] == m.groupby("lang")["doc_id"].transform("count")).all()


@pytest.mark.parametrize("parts", [1, 5, 16])
def test_running_sum_matches_pandas(spark, parts):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_totalprice")
    got = running_sum(df, [F.desc("o_totalprice"), F.asc("o_orderkey")],
                      {"k": F.lit(1).cast("bigint"), "s": F.round(F.col("o_totalprice") * 100).cast("bigint")},
                      groups=["o_orderstatus"], num_partitions=parts).toPandas()
    pdf = df.toPandas().sort_values(["o_orderstatus", "o_totalprice", "o_orderkey"], ascending=[True, False, True])
    pdf["ek"] = pdf.groupby("o_orderstatus").cumcount() + 1
    pdf["es"] = (pdf["o_totalprice"] * 100).round().astype("int64").groupby(pdf["o_orderstatus"]).cumsum()
    m = got.merge(pdf, on="o_orderkey")
    assert (m["k"] == m["ek"]).all() and (m["s"] == m["es"]).all()


def test_row_index_plan_has_no_single_partition_on_rows(spark, capsys):
    """Only the per-partition count frame may pass through one partition."""
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey",
                                                                    "l_suppkey", "l_extendedprice")
    out = with_row_index(df, df.columns, num_partitions=4)
    capsys.readouterr()
    out.explain(mode="simple")
    plan = capsys.readouterr().out
    for block in plan.split("Exchange SinglePartition")[1:]:
        head = block[:400]
        assert "_pid" in head, head


def test_running_sum_totals_and_subset_positions(spark):
    from shardloom.operators.index import subset_positions
    df = spark.createDataFrame([(g, i, i % 3 == 0) for g in ("a", "b") for i in range(20)],
                               "g string, i long, hit boolean")
    r = running_sum(df, ["i"], {"n": F.lit(1).cast("bigint")}, groups=["g"], num_partitions=5, totals=True)
    rows = r.collect()
    assert all(x["n"] == x["i"] + 1 and x["n_total"] == 20 for x in rows)
    pos, ranged = subset_positions(df, ["i"], ["g"], F.col("hit"), num_partitions=4)
    got = {(x["g"], x["i"]): (x["pos_all"], x["pos_sub"]) for x in pos.collect()}
    assert got == {(g, i): (i, i // 3) for g in ("a", "b") for i in range(0, 20, 3)}
    assert ranged.count() == 40


@pytest.mark.parametrize("parts", [1, 4])
def test_null_groups_are_groups(spark, parts):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i % 3) for i in range(90)], "k long, g int")
    got = with_row_index(df, ["k"], groups=["g"], num_partitions=parts, count_name="n").collect()
    assert len(got) == 90 and all(r["n"] == 30 for r in got)
    for g in (None, 1, 2):
        assert sorted(r["row_idx"] for r in got if r["g"] == g) == list(range(30))
    sums = running_sum(df, ["k"], {"s": F.lit(1)}, groups=["g"], num_partitions=parts, totals=True).collect()
    assert len(sums) == 90 and all(r["s_total"] == 30 for r in sums)
    for g in (None, 1, 2):
        assert [r["s"] for r in sorted(sums, key=lambda r: r["k"]) if r["g"] == g] == list(range(1, 31))
