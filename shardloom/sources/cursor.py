"""Resumable reads of exported shards by a changing number of workers (B5, B9 over S7).

An epoch is one pass over all samples: its shards in an order drawn from the seed and the epoch, the samples of a
shard as they lie.  A sample's place in this stream is arithmetic on the manifest, so the state of a run is two
numbers, ``Cursor(epoch, consumed)``: whatever the number of workers was or will be, the rest of the epoch is the
places from ``consumed`` on.  Batches are numbered from there; batch ``b`` belongs to worker ``b % workers``, and
a round is one batch for each worker.

Defined results: shards without rows take no place; the last batch of an epoch may be short, and the last round may
leave workers without one; an empty export has no batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.index import running_sum
from .shards import read_manifest


class Cursor(NamedTuple):
    epoch: int = 0
    consumed: int = 0


def _positive(**numbers: int) -> None:
    for name, n in numbers.items():
        if n < 1:
            raise ValueError(f"{name} must be positive")


def advance(cursor: Cursor, rounds: int, workers: int, batch: int, total: int) -> Cursor:
    """The cursor behind ``rounds`` more rounds over an export of ``total`` samples; a finished epoch leads to the
    start of the next, and rounds do not reach beyond it."""
    _positive(workers=workers, batch=batch)
    if rounds < 0 or cursor.consumed < 0:
        raise ValueError("rounds and consumed must not be negative")
    consumed = cursor.consumed + rounds * workers * batch
    return Cursor(cursor.epoch, consumed) if consumed < total else Cursor(cursor.epoch + 1, 0)


def epoch_order(manifest: DataFrame, epoch: int, seed: int = 0) -> DataFrame:
    """``(part, shard, rows, stream_start)``: the shards of one epoch with the samples before each in the stream."""
    drawn = manifest.filter("rows > 0").select("part", "shard", F.col("rows").cast("bigint").alias("rows")).withColumn(
        "_draw", F.md5(F.concat_ws(":", F.lit(seed), F.lit(epoch), F.col("part").cast("string"), F.col("shard").cast("string"))))
    ordered = running_sum(drawn, ["_draw", "part", "shard"], {"_end": F.col("rows")})
    return ordered.select("part", "shard", "rows", (F.col("_end") - F.col("rows")).cast("bigint").alias("stream_start"))


def _last(cursor: Cursor, workers: int, batch: int, rounds: int | None) -> Column:
    """The first place that is not read any more."""
    return F.lit(None if rounds is None else cursor.consumed + rounds * workers * batch).cast("bigint")


def worker_ranges(manifest: DataFrame, cursor: Cursor, workers: int, batch: int, rounds: int | None = None,
                  seed: int = 0) -> DataFrame:
    """``(worker, batch, place, part, shard, offset, rows)``: what each worker reads next, up to the end of the epoch or for
    ``rounds`` rounds.  A batch is one range of a shard, or one of each shard that it runs across; ``place`` is
    the range's first place in its batch.  Each shard works out its own ranges, so nothing is joined."""
    _positive(workers=workers, batch=batch)
    at = F.greatest(F.col("stream_start"), F.lit(cursor.consumed)) - F.lit(cursor.consumed)
    end = F.least(F.col("stream_start") + F.col("rows"), _last(cursor, workers, batch, rounds)) - F.lit(cursor.consumed)
    spans = epoch_order(manifest, cursor.epoch, seed).select(
        "part", "shard", (F.col("stream_start") - F.lit(cursor.consumed)).alias("_start"), at.alias("_at"), end.alias("_end")).filter("_at < _end")
    cut = spans.withColumn("batch", F.explode(F.sequence(F.expr(f"_at div {batch}"), F.expr(f"(_end - 1) div {batch}"))))
    first = F.greatest(F.col("_at"), F.col("batch") * batch)
    return cut.select((F.col("batch") % workers).cast("int").alias("worker"), "batch", (first - F.col("batch") * batch).alias("place"),
                      "part", "shard", (first - F.col("_start")).alias("offset"),
                      (F.least(F.col("_end"), (F.col("batch") + 1) * batch) - first).alias("rows"))


def read_batches(spark: SparkSession, path: str, cursor: Cursor, workers: int, batch: int, rounds: int | None = None,
                 seed: int = 0, columns: Sequence[str] | None = None, most_listed: int = 10_000) -> DataFrame:
    """The samples of ``worker_ranges`` as ``(worker, batch, place, part, shard, offset, sample columns)``.

    A sample finds its batch from its shard's place in the stream and its row in the file: one equi-join with a
    row for each shard.  Up to ``most_listed`` shards are named to the reader, which opens no other."""
    _positive(workers=workers, batch=batch)
    wanted = epoch_order(read_manifest(spark, path), cursor.epoch, seed).filter(
        (F.col("stream_start") + F.col("rows") > cursor.consumed)
        & F.coalesce(F.col("stream_start") < _last(cursor, workers, batch, rounds), F.lit(True))).checkpoint()
    listed = wanted.select("part", "shard").limit(most_listed + 1).collect()
    base = path.rstrip("/")
    folders = [f"{base}/part={r['part']}/shard={r['shard']}" for r in listed] if 0 < len(listed) <= most_listed else [base]
    files = spark.read.option("basePath", base).parquet(*folders).select("*", F.col("_metadata.row_index").alias("_offset"))
    samples = [c for c in (columns or files.columns) if c not in ("part", "shard", "_offset")]
    taken = files.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(samples)], F.col("part").alias("_part"),
                         F.col("shard").alias("_shard"), F.col("_offset").alias("offset"))
    at = F.col("stream_start") + F.col("offset")
    inside = (at >= cursor.consumed) & F.coalesce(at < _last(cursor, workers, batch, rounds), F.lit(True))
    placed = taken.join(wanted, (F.col("part") == F.col("_part")) & (F.col("shard") == F.col("_shard"))).filter(inside).withColumn(
        "_at", at - F.lit(cursor.consumed)).withColumn("batch", F.expr(f"_at div {batch}"))
    return placed.select((F.col("batch") % workers).cast("int").alias("worker"), "batch", (F.col("_at") % batch).alias("place"),
                         "part", "shard", "offset", *[F.col(f"_s{i}").alias(c) for i, c in enumerate(samples)])
