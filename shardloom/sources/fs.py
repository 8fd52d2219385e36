"""Small file-system helpers over the Hadoop FileSystem API (works for local
paths, HDFS and object stores alike); metadata only, no data passes here."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders found while a frame is opened are listed by some tasks per core,
    not by a task for each of up to 10,000 folders: with a small file in each
    folder, starting the tasks takes longer than the listing."""
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(min(int(before), max(32, 8 * spark.sparkContext.defaultParallelism))))
    try:
        yield
    finally:
        spark.conf.set(_LISTING, before)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p))


def stored(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, p = _fs_path(spark, path)
    return fs.getContentSummary(p).getLength()


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.delete(p, True))


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.mkdirs(p)


def mounted(spark: SparkSession, path: str) -> str | None:
    """The plain path of a folder in a file system that every machine mounts (scheme ``file``), where Python tasks reach it as
    Spark does; None for any other store."""
    fs, p = _fs_path(spark, path)
    return fs.makeQualified(p).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def walker():
    """(what Spark's readers see of a mounted folder, all files below it with their sizes), as functions that need no
    package where they run."""
    def entries(folder: str) -> Iterator[os.DirEntry]:
        with os.scandir(folder) as found:
            for e in found:
                hidden = e.name.startswith(".") or (e.name.startswith("_") and "=" not in e.name) or e.name.endswith("._COPYING_")
                if not hidden:
                    yield e

    def below(folder: str) -> Iterator[tuple[str, int]]:
        for e in entries(folder):
            if e.is_dir():
                yield from below(e.path)
            else:
                yield e.path, e.stat().st_size

    return entries, below


def _listed(whole: bool):
    """Arrow batches (path, bytes; null for a folder) -> the same with folders replaced by what is in them, or with
    ``whole`` by all files below them."""
    entries, below = walker()

    def found(path: str) -> Iterator[tuple[str, int | None]]:
        return below(path) if whole else ((e.path, None if e.is_dir() else e.stat().st_size) for e in entries(path))

    def batch(rows: list[tuple[str, int | None]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())],
                                          names=["path", "bytes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, int | None]] = []
        for b in batches:
            for path, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for x in found(path) if size is None else [(path, size)]:
                    out.append(x)
                    if len(out) == 10_000:
                        yield batch(out)
                        out = []
        if out:
            yield batch(out)
    return run


def files_below(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, bytes)`` of all files below a mounted folder, as Spark's readers see them.  The driver lists the folder
    itself, tasks the folders in it, and further tasks all that is below those."""
    kind = "path string, bytes long"
    top = [(e.path, None if e.is_dir() else e.stat().st_size) for e in walker()[0](folder)]
    tasks = 8 * spark.sparkContext.defaultParallelism
    start = spark.createDataFrame(top, kind).repartition(min(tasks, max(1, len(top))), "path")
    return start.mapInArrow(_listed(False), kind).repartition(tasks, F.xxhash64("path")).mapInArrow(_listed(True), kind)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()

