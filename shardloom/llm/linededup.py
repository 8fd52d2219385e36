"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line without white space at its ends, A-Z lower-cased; 128 bits of its hash
stand for it.  ``LineRuns`` counts in how many documents each key occurs, as an LSM tree would: a
batch of documents becomes one run (key, number of documents); when a level holds ``fanout`` runs
they are merged into one run of the next level.  Keys that have reached ``min_docs`` lie in the
settled part of their run, and each new batch is first merge-anti-joined with the settled parts of
all runs, so later batches never add to a settled key (the hot boilerplate lines).

A run is a table bucketed and sorted by key, all with one number of buckets, one file a bucket: the
anti-join is a sort-merge join in which only the batch is shuffled (once, to count it), and a merge
of runs shuffles nothing.  Runs lie in the shared checkpoint folder; a run is written in full before
those it replaces are deleted, and a lost executor costs no more than the tasks it ran.

``dedup_lines`` then drops, in every document, all lines whose key is settled.

Defined results: a null or empty text is one empty line; keys of fewer than ``min_chars`` code
points are never dropped; a document without lines left has the empty text; repeated rows count as
documents of their own and get equal results; a null id is kept; an empty table gives no rows.
A key found in exactly ``min_docs`` documents is settled.  A very long text is read whole; its keys
are one row's list of 16 bytes a distinct line.  Columns other than the id, the text and those in
``carry`` are not read, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import fs
from .common import KEY, as_large, carry_struct, key_columns, slices


def _keys(texts: pa.Array, min_chars: int) -> tuple[pa.Array, list[bytes | None], np.ndarray]:
    """(lines, the 16-byte key of each line or None if too short, number of lines of each text)."""
    lists = pc.split_pattern(texts, "\n")
    lines = lists.flatten()
    folded = pc.dictionary_encode(pc.ascii_lower(pc.ascii_trim_whitespace(lines)))
    digest = xxhash.xxh3_128_digest
    distinct = [digest(x) if len(x) >= min_chars else None for x in folded.dictionary.to_pylist()]
    return lines, [distinct[i] for i in folded.indices.to_pylist()], pc.list_value_length(lists).to_numpy()


def _distinct_keys(min_chars: int):
    """Arrow UDF: text -> the distinct keys of its lines."""
    def run(texts: pa.Array) -> pa.Array:
        out, texts = [], as_large(texts)
        for a, b in slices(texts):
            _, keys, counts = _keys(texts[a:b], min_chars)
            at = 0
            for n in counts.tolist():
                out.append([k for k in dict.fromkeys(keys[at:at + n]) if k is not None])
                at += n
        return pa.array(out, type=pa.list_(pa.binary()))

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<binary>")


def _drop(min_chars: int):
    """Arrow UDF: (text, keys to drop) -> number of lines, number dropped, text without them."""
    kind = pa.struct([("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("text", pa.string())])

    def run(texts: pa.Array, settled: pa.Array) -> pa.Array:
        texts = as_large(texts)
        gone = settled.to_pylist()
        n_lines, n_dropped, kept = [], [], []
        for a, b in slices(texts):
            lines, keys, counts = _keys(texts[a:b], min_chars)
            at = 0
            for i, n in enumerate(counts.tolist(), a):
                drop = set(gone[i] or ())
                left = lines[at:at + n].to_pylist() if drop else None
                if drop:
                    left = [x for x, k in zip(left, keys[at:at + n], strict=True) if k not in drop]
                n_lines.append(n)
                n_dropped.append(n - len(left) if drop else 0)
                kept.append("\n".join(left) if drop else texts[i].as_py())
                at += n
        return pa.StructArray.from_arrays([pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                                           pa.array(kept, pa.string())], fields=list(kind))

    run.__annotations__ = {"texts": pa.Array, "settled": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "struct<n_lines bigint, n_dropped bigint, text string>")


class LineRuns:
    """Levelled runs (key binary, n long, done boolean) under ``folder``; ``done`` keys are the settled
    ones, found in ``min_docs`` documents or more."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 3, folder: str | None = None,
                 buckets: int | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.folder = folder or scratch_path(spark, "line-runs")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]

    def _write(self, df: DataFrame) -> str:
        """One run from (key, n), its settled keys apart: the name of its table."""
        name = f"line_run_{uuid.uuid4().hex}"
        (df.withColumn("done", F.col("n") >= self.min_docs).write.partitionBy("done").bucketBy(self.buckets, "key")
         .sortBy("key").format("parquet").option("path", f"{self.folder}/{name}").saveAsTable(name))
        return name

    def _delete(self, names: Sequence[str]) -> None:
        for name in names:
            self.spark.sql(f"drop table {name}")
            fs.delete(self.spark, f"{self.folder}/{name}")

    def unsettled(self, batch: DataFrame) -> DataFrame:
        """``batch``, a frame with one row for each document and key, counted, without the settled keys."""
        counted = batch.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        for name in (name for runs in self.levels for name in runs):
            settled = self.spark.table(name).filter("done").select("key")
            counted = counted.join(settled.hint("merge"), "key", "left_anti")
        return counted

    def merged(self, names: Sequence[str]) -> DataFrame:
        """(key, n) of several runs; a settled key stays settled, as its count only grows."""
        union = self.spark.table(names[0])
        for name in names[1:]:  # whole tables: the union then keeps their buckets
            union = union.unionByName(self.spark.table(name))
        return union.groupBy("key").agg(F.sum("n").alias("n"))

    def add(self, batch: DataFrame) -> None:
        """Enter a new batch of documents: one row for each document and key."""
        self.levels[0].append(self._write(self.unsettled(batch)))
        for level in range(len(self.levels)):
            runs = self.levels[level]
            if len(runs) >= self.fanout:
                run = self._write(self.merged(runs))
                self.levels[level] = []
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(run)
                self._delete(runs)

    def finish(self) -> DataFrame:
        """Merge all that is left; all settled keys.  Nothing can be added afterwards."""
        left = [name for runs in self.levels for name in runs]
        self.levels = []
        if not left:
            return self.spark.createDataFrame([], "key binary")
        last = left[0] if len(left) == 1 else self._write(self.merged(left))
        if len(left) > 1:
            self._delete(left)
        self.spark.sql(f"drop table {last}")  # its files stay
        return (self.spark.read.schema("key binary, n bigint, done boolean").parquet(f"{self.folder}/{last}")
                .filter("done").select("key"))


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4, fanout: int = 3,
                id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text (and ``carried``, a struct of the ``carry`` columns)."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "line-dedup")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       *key_columns(id_col, text_col), *carry_struct(carry))
    # one pass over the texts: the distinct keys of every document, apart for every batch
    kind = "_id long, _null int, _h long, keys array<binary>, batch int"
    (base.select(*KEY, _distinct_keys(min_chars)("text").alias("keys"),
                 F.pmod(F.col("_h"), F.lit(batches)).cast("int").alias("batch"))
     .write.partitionBy("batch").parquet(f"{folder}/keys"))
    keyed = spark.read.schema(kind).parquet(f"{folder}/keys")
    runs = LineRuns(spark, min_docs, fanout, f"{folder}/runs")
    for b in range(batches):
        runs.add(keyed.filter(F.col("batch") == b).select(F.explode("keys").alias("key")))
    settled = runs.finish()

    hits = (keyed.select(*KEY, F.explode("keys").alias("key")).join(settled, "key", "left_semi")
            .groupBy(*KEY).agg(F.collect_set("key").alias("gone")))
    out = base.join(hits, KEY, "left").withColumn("r", _drop(min_chars)("text", "gone"))
    return out.select("doc_id", "r.n_lines", "r.n_dropped", F.col("r.text").alias("kept_text"),
                      *(["carried"] if carry else []))
