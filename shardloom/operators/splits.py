"""Splits, contiguous groups, parallelism, mini-batches and worker shares
(B1-B5, B8, B9).

All positional operators stand on ``with_row_index`` (a distributed 0-based
index in a key order), so no plan funnels rows through one task.  Fractions
are turned into exact ratios so that ``n * (1 - 0.2)`` never loses a row to
float rounding.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .index import with_row_index


def _ratio(x: float) -> Fraction:
    f = Fraction(str(x))
    if not 0 <= f <= 1:
        raise ValueError("fraction must be within [0, 1]")
    return f


def split_of(df: DataFrame, name: str, split_col: str = "split") -> DataFrame:
    """B1: rows of one named split."""
    return df.filter(F.col(split_col) == F.lit(name))


HASH_BITS = 60


def chosen(key: Column, share: float) -> Column:
    """True for a ``share`` of the keys: the first 60 bits of the md5 of the
    key's text against ``share * 2^60`` (same on every run, retry and
    partitioning, unlike ``rand()``, and exact down to shares of 1e-18)."""
    f = _ratio(share)
    cut = f.numerator * (1 << HASH_BITS) // f.denominator
    return F.conv(F.substring(F.md5(key.cast("string")), 1, HASH_BITS // 4), 16, 10).cast("bigint") < F.lit(cut)


def train_test_split(df: DataFrame, test_size: float, key: Sequence[str] | str,
                     how: str = "ordered", split_col: str = "split",
                     num_partitions: int | None = None) -> DataFrame:
    """B2: label rows ``train``/``test``.

    ``ordered`` (the reference's unshuffled default): the first
    ``floor(n * (1 - test_size))`` rows in key order are train, the tail is
    test.  ``hash``: a row is test when its key's md5, read as a fraction, falls
    under ``test_size``; no count or order needed, stable under re-execution.
    """
    t = _ratio(test_size)
    keys = [key] if isinstance(key, str) else list(key)
    if how == "ordered":
        idx = with_row_index(df, keys, "_ri", num_partitions=num_partitions, count_name="_n")
        n_train = F.expr(f"(_n * {t.denominator - t.numerator}) div {t.denominator}")
        return (idx.withColumn(split_col, F.when(F.col("_ri") < n_train, F.lit("train")).otherwise(F.lit("test")))
                .drop("_ri", "_n"))
    if how == "hash":
        is_test = chosen(F.concat_ws("\u001f", *[F.col(k).cast("string") for k in keys]), test_size)
        return df.withColumn(split_col, F.when(is_test, F.lit("test")).otherwise(F.lit("train")))
    raise ValueError(f"unknown split method {how!r}")


def assign_groups(df: DataFrame, n: int, key: Sequence[str] | str, group_col: str = "group",
                  num_partitions: int | None = None) -> DataFrame:
    """``n`` contiguous groups in key order; size ``total // n``, the last
    group takes the rest.  With fewer rows than groups the size is 0 and every
    row lands in the last group (the others stay empty)."""
    if n < 1:
        raise ValueError("n must be positive")
    keys = [key] if isinstance(key, str) else list(key)
    idx = with_row_index(df, keys, "_ri", num_partitions=num_partitions, count_name="_n")
    size = F.expr(f"_n div {n}")
    g = F.when(size == 0, F.lit(n - 1)).otherwise(
        F.least(F.expr(f"_ri div greatest(_n div {n}, 1)"), F.lit(n - 1)))
    return idx.withColumn(group_col, g.cast("int")).drop("_ri", "_n")


def with_parallelism(df: DataFrame, n: int | None = None, floor_factor: int = 10) -> DataFrame:
    """A fixed part count, or ``floor_factor`` x default parallelism parts
    (per-row work behind it costs far more than the round-robin shuffle).
    Nothing is run to find out how many parts there are."""
    return df.repartition(int(n) if n is not None else floor_factor * df.sparkSession.sparkContext.defaultParallelism)


def assign_batches(df: DataFrame, size: int, key: Sequence[str] | str, drop_last: bool = False,
                   max_batches: int = -1, batch_col: str = "batch", index_col: str | None = None,
                   num_partitions: int | None = None) -> DataFrame:
    """Batch number ``row_idx div size``; with ``drop_last`` the short
    final batch is removed; ``max_batches`` >= 0 keeps only that many
    batches (-1 keeps all)."""
    if size < 1:
        raise ValueError("size must be positive")
    keys = [key] if isinstance(key, str) else list(key)
    idx = with_row_index(df, keys, "_ri", num_partitions=num_partitions, count_name="_n")
    out = idx.withColumn(batch_col, F.expr(f"_ri div {size}"))
    if drop_last:
        out = out.filter(F.col(batch_col) < F.expr(f"_n div {size}"))
    if max_batches >= 0:
        out = out.filter(F.col(batch_col) < F.lit(max_batches))
    if index_col:
        out = out.withColumnRenamed("_ri", index_col)
    return out.drop("_ri", "_n")


def batch_count(df: DataFrame, size: int, drop_last: bool = False) -> DataFrame:
    """Number of batches (the reference prints it as a sample count)."""
    n = F.count(F.lit(1))
    nb = F.floor(n / F.lit(size)) if drop_last else F.ceil(n / F.lit(size))
    return df.agg(n.alias("n_rows"), nb.cast("bigint").alias("n_batches"))


def assign_workers(df: DataFrame, n: int, key: Sequence[str] | str, worker_col: str = "worker",
                   num_partitions: int | None = None) -> DataFrame:
    """Each worker's share: ``row_idx % n`` (shares differ by at most 1)."""
    keys = [key] if isinstance(key, str) else list(key)
    idx = with_row_index(df, keys, "_ri", num_partitions=num_partitions)
    return idx.withColumn(worker_col, (F.col("_ri") % F.lit(n)).cast("int")).drop("_ri")
