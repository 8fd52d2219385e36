"""Readers (S1-S3, S6, S10, S12, S13)."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fs


def read_lines(spark: SparkSession, path: str, name: str = "path") -> DataFrame:
    """One row per line of a text file (or folder), column renamed."""
    return spark.read.text(path).toDF(name)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Every parquet file under a folder as one dataset (splits stored
    side by side mix unless a partition column tells them apart)."""
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """S3: a catalog table (``catalog.schema.table`` or a session view)."""
    return spark.table(name)


def read_classes(spark: SparkSession, path: str, field_path: Sequence[str]) -> DataFrame:
    """Class names from a JSON info document at a fixed field path,
    numbered from 0: ``(category_id, category_name)``; the same frame serves
    both directions of the id/name lookup."""
    doc = spark.read.option("multiLine", True).json(path)
    names = F.col("`" + field_path[0] + "`")
    for f in field_path[1:]:
        names = names.getField(f)
    return doc.select(F.posexplode(names).alias("category_id", "category_name")).select(
        F.col("category_id").cast("int"), "category_name")


def list_artifacts(spark: SparkSession, path: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """Files under a folder matching a glob, with size in bytes and GB
    (bytes / 1024^3).  Only the listing columns are read, never contents; a
    folder that all tasks mount is listed by tasks."""
    local = fs.mounted(spark, path) if recursive else None
    if local is not None and os.path.isdir(local):
        name = spark._jvm.org.apache.hadoop.fs.GlobPattern.compile(glob).pattern()
        found = fs.files_below(spark, local).filter(F.element_at(F.split("path", "/"), -1).rlike(f"^(?:{name})$"))
        return found.select(F.concat(F.lit("file:"), "path").alias("path"), "bytes",
                            (F.col("bytes") / F.lit(1024.0 ** 3)).alias("size_gb"))
    with fs.few_listing_tasks(spark):
        df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
              .option("recursiveFileLookup", str(recursive).lower()).load(path))
    return df.select("path", F.col("length").alias("bytes"),
                     (F.col("length") / F.lit(1024.0 ** 3)).alias("size_gb"))


def from_local(spark: SparkSession, pdf, schema) -> DataFrame:
    """A local pandas frame to Spark with a declared schema (Arrow)."""
    return spark.createDataFrame(pdf, schema=schema)


def to_local(df: DataFrame, max_rows: int = 10000):
    """A small result to pandas; refuses more than ``max_rows`` rows
    instead of pulling a whole dataset through the driver."""
    out = df.limit(max_rows + 1).toPandas()
    if len(out) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; write it instead of collecting it")
    return out
