"""Projections, filters, limits and inspection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared sample dtypes of the shard writer and their Spark types.
DTYPES = {
    "int32": "int",
    "int": "bigint",
    "int64": "bigint",
    "float32": "float",
    "float64": "double",
    "str": "string",
    "bytes": "binary",
    "ndarray:int32": "array<int>",
    "ndarray:int64": "array<bigint>",
    "ndarray:float32": "array<float>",
    "ndarray:float64": "array<double>",
}


def with_url(df: DataFrame, base: str, path_col: str = "path", out: str = "url",
             keep: Sequence[str] = ()) -> DataFrame:
    """Prefix a path with a literal base (constant-folded by Catalyst)."""
    return df.select(*keep, F.concat(F.lit(base), F.col(path_col)).alias(out))


def keep_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep the named columns (pruned down to the scan)."""
    return df.select(*names)


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Remove the named columns."""
    return df.drop(*names)


def conform_columns(dtype_map: dict[str, str]) -> list[Column]:
    """The declared columns in declared order, cast to the declared sample
    dtype (``ndarray`` without a dtype keeps the element type)."""
    cols = []
    for name, dt in dtype_map.items():
        if dt == "ndarray":
            cols.append(F.col(name))
        elif dt in DTYPES:
            cols.append(F.col(name).cast(DTYPES[dt]).alias(name))
        else:
            raise ValueError(f"unknown dtype {dt!r} for {name}")
    return cols


def conform(df: DataFrame, dtype_map: dict[str, str]) -> DataFrame:
    """Conform a frame to a declared dtype map.  Under ANSI mode an
    out-of-range value raises instead of wrapping."""
    return df.select(*conform_columns(dtype_map))


def take_n(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """First ``n`` rows in a stated order (planned as a top-k, no full sort)."""
    return df.orderBy(*order_by).limit(n)


def exclude_rows(df: DataFrame, positions: Sequence[int], index_col: str = "row_idx") -> DataFrame:
    """P5: drop rows at the given positions.  Positions are row indexes (see
    ``with_row_index``), not ids.  A short literal list is a ``NOT IN``
    filter that reaches the scan when the index is stored."""
    return df.filter(~F.col(index_col).isin([int(p) for p in positions]))


def pending(df: DataFrame, status_col: str = "status") -> DataFrame:
    """Rows not yet done (never tried, or failed)."""
    s = F.col(status_col)
    return df.filter(s.isNull() | (s != 0))


def profile(df: DataFrame) -> DataFrame:
    """One row with the row count, column count and schema text."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_columns"),
        F.lit(df.schema.simpleString()).alias("schema"))


def latest_by(df: DataFrame, id_col: str, ts_col: str, pred: Column | None = None,
              by: Sequence[str] = ()) -> DataFrame:
    """The id of the newest row matching ``pred`` (ties: larger id), per
    ``by`` groups or overall; no row when nothing matches.  A partial
    ``max_by`` per task first, so a hot group costs one row per task."""
    src = df.filter(pred) if pred is not None else df
    pick = F.max_by(F.col(id_col), F.struct(F.col(ts_col), F.col(id_col))).alias(id_col)
    if by:
        return src.groupBy(*by).agg(pick)
    return src.agg(pick, F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 0).drop("_n")


def image_bytes(df: DataFrame, col: str = "image", out: str = "image_bytes") -> DataFrame:
    """P10: raw bytes from a ``{bytes: ...}`` struct or a binary column,
    resolved once from the schema; any other type is an error."""
    dt = df.schema[col].dataType
    if isinstance(dt, T.BinaryType):
        return df.withColumn(out, F.col(col))
    if isinstance(dt, T.StructType) and "bytes" in dt.fieldNames() and \
            isinstance(dt["bytes"].dataType, T.BinaryType):
        return df.withColumn(out, F.col(f"{col}.bytes"))
    raise TypeError(f"column {col} has type {dt.simpleString()}, expected binary or struct<bytes: binary>")


def split_valid(df: DataFrame, rules: dict[str, Column], reason_col: str = "reason",
                require_rows: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows failing a rule are set aside with the first failing rule's
    name; returns ``(good, rejected)``.  ``require_rows`` raises when no row
    passes (an action, so only on request)."""
    reason = F.lit(None).cast("string")
    for name, ok in reversed(list(rules.items())):
        reason = F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)).otherwise(reason)
    tagged = df.withColumn(reason_col, reason)
    good = tagged.filter(F.col(reason_col).isNull()).drop(reason_col)
    bad = tagged.filter(F.col(reason_col).isNotNull())
    if require_rows and good.limit(1).count() == 0:
        raise ValueError("no row passed validation")
    return good, bad
