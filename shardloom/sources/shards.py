"""Sharded training-data export (S7), manifest merge (S8) and read-back
verification (S9).

Rows are spread over contiguous groups in key order (B3), the parts; inside
a part the sequential writer's rule holds: a shard closes when the next
sample would push it past ``size_limit``.  Without a stated number of parts
there are as many as the total bytes need at ``part_bytes`` each, so a part
is one task's work at any input size.  Positions and cut points are computed
on (key, bytes) rows only; samples are moved once, to their shard.  A sample
counts one byte at least, so a shard's rows are bounded too.

Every shard is a zstd parquet file under ``part=P/shard=S``.  Its manifest
row, aggregated from the rows that were placed and not read back from the
files, holds the row count, bytes, start offset and a hash: the sums (mod
2^32) of the five words of the rows' sha1, which partial aggregation can
build in any order.  ``verify_export`` is the pass that reads the files.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.index import running_sum
from ..operators.rows import conform_columns
from ..operators.splits import assign_groups
from . import fs

# Bytes per element of each declared sample dtype.
ELEMENT_BYTES = {"int32": 4, "int": 8, "int64": 8, "float32": 4, "float64": 8}
_WIDTH = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8}

INDEX_DIR = "_index"
_NULL = "\u001e"


def row_bytes(columns: dict[str, str], schema: T.StructType | None = None) -> Column:
    """Stored size of one sample by declared dtypes (strings and bytes by
    their UTF-8 / raw length, arrays by element count), one byte at least.
    Arrays without a stated dtype have the width of ``schema``'s element
    type (8 bytes if it is not given)."""
    total = F.lit(0).cast("bigint")
    for name, dt in columns.items():
        c = F.col(name)
        if dt in ELEMENT_BYTES:
            size = F.lit(ELEMENT_BYTES[dt])
        elif dt in ("str", "bytes"):
            size = F.coalesce(F.octet_length(c), F.lit(0))
        elif dt.startswith("ndarray:"):
            size = F.coalesce(F.size(c), F.lit(0)) * F.lit(ELEMENT_BYTES[dt.split(":", 1)[1]])
        elif dt == "ndarray":
            el = schema[name].dataType.elementType.simpleString() if schema is not None else ""
            size = F.coalesce(F.size(c), F.lit(0)) * F.lit(_WIDTH.get(el, 8))
        else:
            raise ValueError(f"unknown dtype {dt!r}")
        total = total + size.cast("bigint")
    return F.greatest(total, F.lit(1).cast("bigint"))


def row_digest(columns: dict[str, str]) -> Column:
    """sha1 of the row's values as text in declared column order (arrays
    comma-joined, fields separated by 0x1f, a null field or element is 0x1e)."""
    parts = []
    for name, dt in columns.items():
        c = F.col(name)
        if dt.startswith("ndarray"):
            c = F.array_join(F.transform(c, lambda x: x.cast("string")), ",", _NULL)
        parts.append(F.coalesce(c.cast("string"), F.lit(_NULL)))
    return F.sha1(F.concat_ws("\u001f", *parts))


def combined_digest(digest: str = "_digest") -> Column:
    """Aggregate: the five 32-bit words of the rows' sha1, summed mod 2^32."""
    words = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(5)]
    return F.concat(*[F.lower(F.lpad(F.hex(F.sum(w) % (1 << 32)), 8, "0")) for w in words])


def _rollover(size_limit: int):
    """Shard numbers of rows sorted by (part, key), found by a jump for each
    shard (a search in the running byte count).  State is carried across
    batches."""
    def run(batches):
        import numpy as np
        part, used, shard = None, 0, 0
        for pdf in batches:
            parts, sizes = pdf["part"].to_numpy(), pdf["row_bytes"].to_numpy()
            out = np.empty(len(pdf), dtype="int32")
            edges = np.flatnonzero(np.diff(parts, prepend=parts[0])).tolist() if len(pdf) else []
            for a, b in zip([0, *edges], [*edges, len(pdf)]):
                if a == b:
                    continue
                if parts[a] != part:
                    part, used, shard = parts[a], 0, 0
                total = np.concatenate(([0], np.cumsum(sizes[a:b])))
                at = 0
                while at < b - a:
                    stop = int(np.searchsorted(total, total[at] + size_limit - used, side="right")) - 1
                    if used == 0:
                        stop = max(stop, at + 1)  # a sample larger than the limit has a shard of its own
                    out[a + at:a + stop] = shard
                    used += int(total[stop] - total[at])
                    at = stop
                    if at < b - a:
                        used, shard = 0, shard + 1
            yield pdf.assign(shard=out)
    return run


def assign_shards(df: DataFrame, columns: dict[str, str], key: Sequence[str] | str, parts: int | None = None,
                  size_limit: int = 64 << 20, num_partitions: int | None = None,
                  part_bytes: int = 4 << 30) -> DataFrame:
    """``(key, part, shard, row_bytes)`` for every row: contiguous parts in
    key order (B3), shards within a part numbered from 0 by the sequential
    writer's rule.  ``key`` must identify a row."""
    keys = [key] if isinstance(key, str) else list(key)
    return _placed(df.select(*keys, row_bytes(columns, df.schema).alias("row_bytes")), keys, parts, size_limit,
                   num_partitions, part_bytes)


def _placed(narrow: DataFrame, keys: Sequence[str], parts: int | None, size_limit: int, num_partitions: int | None,
            part_bytes: int) -> DataFrame:
    """``narrow`` (keys, row_bytes, further columns) with each row's part and shard."""
    if parts is None:
        total = narrow.agg(F.sum("row_bytes")).first()[0] or 0
        parts = max(1, -(-total // part_bytes))
    grouped = assign_groups(narrow, parts, keys, "part", num_partitions)
    ordered = grouped.repartition("part").sortWithinPartitions("part", *keys)
    schema = T.StructType(ordered.schema.fields + [T.StructField("shard", T.IntegerType(), False)])
    return ordered.mapInPandas(_rollover(int(size_limit)), schema)


def _no_repeated_keys(placed: DataFrame, keys: Sequence[str]) -> None:
    twice = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").limit(1).count()
    missing = placed.filter(" or ".join(f"`{k}` is null" for k in keys)).limit(1).count()
    if twice or missing:
        raise ValueError(f"{list(keys)} does not identify the rows to export")


def export_shards(df: DataFrame, path: str, columns: dict[str, str], key: Sequence[str] | str,
                  parts: int | None = None, size_limit: int = 64 << 20, compression: str = "zstd", level: int = 7,
                  num_partitions: int | None = None, part_bytes: int = 4 << 30) -> DataFrame:
    """Write shards and their merged manifest (under ``path/_index``);
    returns the manifest read back from storage.  ``mode=overwrite``
    replaces only this export's own folder."""
    spark = df.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    extra = [k for k in keys if k not in columns]
    typed = df.select(*conform_columns(columns), *extra)
    # the digest and the stored size of the written types travel with the key, so the manifest needs no second read
    facts = df.select(*keys, row_bytes(columns, df.schema).alias("row_bytes"),
                      F.struct(*conform_columns(columns)).alias("_typed"))
    inner = [F.col(f"_typed.{c}").alias(c) for c in columns]
    outer = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    facts = (facts.select(*outer, "row_bytes", *inner)
             .select(*[f"_key{i}" for i in range(len(keys))], "row_bytes",
                     row_bytes(columns, typed.schema).alias("_bytes"), row_digest(columns).alias("_digest")))
    renamed = {f"_key{i}": k for i, k in enumerate(keys)}
    placed = _placed(facts.withColumnsRenamed(renamed), keys, parts, size_limit, num_partitions, part_bytes).checkpoint()
    _no_repeated_keys(placed, keys)
    sized = placed.select(*keys, "part", "shard")
    rows = (df.join(sized, keys).select(*conform_columns(columns), *extra, "part", "shard")
            .repartition("part", "shard").sortWithinPartitions("part", "shard", *keys))
    _write_shards(rows, path, compression, level)
    manifest = merge_manifest([_shard_facts(placed)])
    manifest.write.mode("overwrite").json(f"{path.rstrip('/')}/{INDEX_DIR}")
    return read_manifest(spark, path)


#: codecs by the names that Spark's writer and Arrow's have for them
_CODECS = {"zstd": "zstd", "snappy": "snappy", "gzip": "gzip", "none": "none", "uncompressed": "none"}


def _plain(kind: T.DataType) -> bool:
    """Whether Arrow writes the type so that Spark reads the same type back."""
    if isinstance(kind, T.ArrayType):
        return _plain(kind.elementType)
    if isinstance(kind, T.StructType):
        return len(kind) > 0 and all(_plain(f.dataType) for f in kind)
    return isinstance(kind, (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType))


def _write_shards(rows: DataFrame, path: str, compression: str, level: int) -> None:
    """``rows``, sorted by part and shard with a shard in one partition only, as one file a shard.

    In a folder that all tasks mount, the tasks write the files themselves: Spark's writer starts a ``chmod``
    process or more for every file and folder there, unless Hadoop's native library is installed, which takes
    many times as long as writing a small file.  In any other store it is Spark's writer."""
    spark = rows.sparkSession
    local = fs.mounted(spark, path)
    if local is None or compression not in _CODECS or not _plain(rows.schema):
        (rows.write.mode("overwrite").option("compression", compression)
         .option("parquet.compression.codec.zstd.level", str(level)).partitionBy("part", "shard").parquet(path))
        return
    fs.delete(spark, path)
    fs.make_folder(spark, path)
    (rows.mapInArrow(_shard_files(local, compression, level), "part int, shard int, rows long")
     .agg(F.sum("rows")).collect())
    fs.write_text(spark, f"{path.rstrip('/')}/_SUCCESS", "")


def _shard_files(base: str, compression: str, level: int):
    """Writes runs of equal (part, shard) as ``part=P/shard=S/part-00000.*.parquet``, an Arrow batch at a time.  A file
    gets its name when it is whole, and the name is the same in every attempt of a task, so one stays of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.parquet as pq
        codec = _CODECS[compression]
        at = writer = begun = None
        done: list[tuple[int, int, int]] = []
        folders = set()

        def finish() -> None:
            writer.close()
            os.replace(begun, os.path.join(os.path.dirname(begun), f"part-00000{'' if codec == 'none' else '.' + compression}.parquet"))

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64()))],
                                              names=["part", "shard", "rows"])

        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                part, shard = (batch.column(c).to_numpy() for c in ("part", "shard"))
                samples = batch.drop_columns(["part", "shard"])
                edges = np.flatnonzero((part[1:] != part[:-1]) | (shard[1:] != shard[:-1])) + 1
                for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(part)]):
                    here = (int(part[a]), int(shard[a]))
                    if here != at:
                        if writer is not None:
                            finish()
                        folder = os.path.join(base, f"part={here[0]}", f"shard={here[1]}")
                        if here[0] not in folders:
                            os.makedirs(os.path.dirname(folder), exist_ok=True)
                            folders.add(here[0])
                        os.makedirs(folder, exist_ok=True)
                        begun = os.path.join(folder, f".{uuid.uuid4().hex}")
                        writer = pq.ParquetWriter(begun, samples.schema, compression=codec, store_schema=False, write_page_checksum=True,
                                                  compression_level=level if codec == "zstd" else None)
                        at = here
                    writer.write_batch(samples.slice(a, b - a))
                    done.append((*here, b - a))
                yield counted()
                done = []
            if writer is not None:
                finish()
                writer = None
        finally:
            if writer is not None and os.path.exists(begun):  # the task fails
                writer.close()
                os.unlink(begun)
    return run


def _shard_facts(rows: DataFrame) -> DataFrame:
    """Rows, bytes and hash of every shard from (part, shard, _bytes, _digest)."""
    return rows.groupBy("part", "shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("_bytes").cast("bigint").alias("bytes"),
                                             combined_digest().alias("hash"))


def _open(spark: SparkSession, path: str) -> DataFrame:
    """All rows with part and shard.  In a folder that all tasks mount, tasks list and read the files themselves: Spark's
    reader would hold the folders and files of all shards in the driver and open several streams for each."""
    local = fs.mounted(spark, path)
    one = _one_file(local) if local is not None else None
    schema = spark.read.parquet(one).schema if one else None
    if schema is None or not _plain(schema):
        with fs.few_listing_tasks(spark):
            return spark.read.parquet(path)
    size = read_manifest(spark, path).agg(F.sum("bytes")).first()[0] or 0
    tasks = max(8 * spark.sparkContext.defaultParallelism, size >> 27)
    schema = schema.add("part", T.IntegerType()).add("shard", T.IntegerType())
    return fs.files_below(spark, local).select("path").repartition(tasks, F.xxhash64("path")).mapInArrow(_shard_rows(schema), schema)


def _one_file(folder: str) -> str | None:
    """A file of any shard below a mounted folder."""
    try:
        return next((p for p, _ in fs.walker()[1](folder)), None)
    except FileNotFoundError:
        return None


_SHARD_FILE = re.compile(r"/part=(\d+)/shard=(\d+)/[^/]+$")


def _shard_rows(schema: T.StructType):
    """Arrow batches of paths -> the rows of these files, some 10,000 rows or 16 MB at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema
    kind = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        held: list[pa.RecordBatch] = []
        rows = size = 0
        for paths in batches:
            for path in paths.column(0).to_pylist():
                place = _SHARD_FILE.search(path)
                if place is None:
                    raise ValueError(f"{path} is in no shard's folder")
                with pq.ParquetFile(path, page_checksum_verification=True) as file:
                    for batch in file.iter_batches(batch_size=10_000):
                        n = batch.num_rows
                        found = dict(zip(batch.schema.names, batch.columns))
                        found |= {c: pa.repeat(pa.scalar(int(x), pa.int32()), n) for c, x in zip(("part", "shard"), place.groups())}
                        held.append(pa.RecordBatch.from_arrays(
                            [found[f.name].cast(f.type) if f.name in found else pa.nulls(n, f.type) for f in kind], schema=kind))
                        rows, size = rows + n, size + batch.nbytes
                        if rows >= 10_000 or size >= 16 << 20:
                            yield pa.concat_batches(held)
                            held, rows, size = [], 0, 0
        if held:
            yield pa.concat_batches(held)
    return run


def _scan(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Rows, bytes and hash of every shard, from its file."""
    back = _open(spark, path)
    return _shard_facts(back.withColumn("_digest", row_digest(columns)).withColumn("_bytes", row_bytes(columns, back.schema)))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(
        "part int, shard int, rows long, bytes long, hash string, start long").json(
        f"{path.rstrip('/')}/{INDEX_DIR}")


def merge_manifest(manifests: Sequence[DataFrame], order: Sequence[str] = ("part", "shard")) -> DataFrame:
    """One root index from per-part (or per-export) indexes, each shard
    with its start offset: a distributed running row count over the shard
    list (one row per shard), so even millions of shards never pass through
    one task."""
    m = manifests[0]
    for x in manifests[1:]:
        m = m.unionByName(x)
    r = running_sum(m, list(order), {"_end": F.col("rows").cast("bigint")})
    return r.withColumn("start", (F.col("_end") - F.col("rows")).cast("bigint")).drop("_end")


def verify_export(spark: SparkSession, path: str, columns: dict[str, str], source: DataFrame | None = None) -> DataFrame:
    """Read the shards back and compare every shard's row count and hash
    with the manifest: ``(part, shard, rows, rows_ok, hash_ok)``.  With the
    ``source`` frame, one more row (part and shard -1) compares the rows and
    the hash of all shards together with those of the source."""
    scanned = _scan(spark, path, columns)
    if source is not None:
        scanned = scanned.checkpoint()  # a row a shard, from which the hash of all of them follows without a second read
    got = scanned.select("part", "shard", F.col("rows").alias("_rows"), F.col("hash").alias("_hash"))
    j = read_manifest(spark, path).join(got, ["part", "shard"], "full_outer")
    out = j.select("part", "shard", F.coalesce("rows", "_rows").alias("rows"),
                   F.coalesce(F.col("rows") == F.col("_rows"), F.lit(False)).alias("rows_ok"),
                   F.coalesce(F.col("hash") == F.col("_hash"), F.lit(False)).alias("hash_ok"))
    if source is None:
        return out

    def whole(df: DataFrame, side: str, rows: Column, digest: str) -> DataFrame:
        return df.agg(F.lit(side).alias("side"), F.coalesce(rows, F.lit(0)).alias("n"),
                      F.coalesce(combined_digest(digest), F.lit("")).alias("h"))

    # the written types, so that both sides print their values alike
    digests = source.select(*conform_columns(columns)).select(row_digest(columns).alias("_digest"))
    both = whole(digests, "src", F.count(F.lit(1)), "_digest").unionByName(whole(scanned, "out", F.sum("rows"), "hash"))
    return out.unionByName(both.agg(
        F.lit(-1).alias("part"), F.lit(-1).alias("shard"), F.max(F.when(F.col("side") == "src", F.col("n"))).alias("rows"),
        (F.min("n") == F.max("n")).alias("rows_ok"), (F.min("h") == F.max("h")).alias("hash_ok")))


def locate_positions(manifest: DataFrame, positions: DataFrame, name: str = "position") -> DataFrame:
    """``(position, part, shard, offset)`` for every asked 0-based position of the whole export.

    The interval search is an equi-join: positions and shards meet in blocks as wide as the average shard, so a shard
    lies in two blocks on average and a position meets the few shards of its block.  A position asked twice comes
    twice; null, negative and too large positions are in no shard and come back with null part, shard and offset."""
    size = manifest.agg(F.sum("rows").alias("n"), F.count(F.lit(1)).alias("k")).first()
    width = max(1, (size["n"] or 0) // max(1, size["k"]))
    first, last = (F.floor(c / F.lit(width)).cast("bigint") for c in (F.col("start"), F.col("start") + F.col("rows") - 1))
    spans = (manifest.filter("rows > 0").select("part", "shard", "start", "rows", F.explode(F.sequence(first, last)).alias("_block")))
    asked = positions.select(F.col(name).cast("bigint").alias("_position"))
    asked = asked.withColumn("_block", F.floor(F.col("_position") / F.lit(width)).cast("bigint"))
    inside = ((asked["_block"] == spans["_block"]) & (F.col("_position") >= F.col("start"))
              & (F.col("_position") < F.col("start") + F.col("rows")))
    return asked.join(spans, inside, "left").select(F.col("_position").alias(name), "part", "shard",
                                                    (F.col("_position") - F.col("start")).alias("offset"))


def read_positions(spark: SparkSession, path: str, positions: DataFrame, name: str = "position",
                   columns: Sequence[str] | None = None, most_listed: int = 10_000) -> DataFrame:
    """The samples at the asked positions, as ``(position, part, shard, offset, sample columns)``.

    A sample's place in its shard is the row index that the file itself gives, so a file may be split between tasks.
    Up to ``most_listed`` shards are named to the reader, which then lists and opens only their folders; a request
    that touches more reads the export and leaves the pruning of shards to the join.  Positions outside the export
    give no row; ask ``locate_positions`` for them."""
    places = locate_positions(read_manifest(spark, path), positions, name).filter("shard is not null").checkpoint()
    needed = places.select("part", "shard").distinct()
    listed = needed.limit(most_listed + 1).collect()
    base = path.rstrip("/")
    if not listed:
        schema = spark.read.parquet(base).schema
        files = spark.createDataFrame([], schema).withColumn("_offset", F.lit(0).cast("bigint"))
    else:
        folders = [f"{base}/part={r['part']}/shard={r['shard']}" for r in listed] if len(listed) <= most_listed else [base]
        files = spark.read.option("basePath", base).parquet(*folders).select("*", F.col("_metadata.row_index").alias("_offset"))
    samples = [c for c in (columns or files.columns) if c not in ("part", "shard", "_offset")]
    taken = files.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(samples)], F.col("part").alias("_part"),
                         F.col("shard").alias("_shard"), "_offset")
    on = ((F.col("part") == F.col("_part")) & (F.col("shard") == F.col("_shard")) & (F.col("offset") == F.col("_offset")))
    return places.join(taken, on).select(name, "part", "shard", "offset",
                                         *[F.col(f"_s{i}").alias(c) for i, c in enumerate(samples)])


def sample_shards(spark: SparkSession, path: str, columns: dict[str, str], key: str, n: int = 5) -> DataFrame:
    """S9 display: the first ``n`` samples in (part, shard, key) order with
    each array column's length and element type."""
    back = _open(spark, path)
    types = dict(back.dtypes)
    sel = [F.col("part"), F.col("shard"), F.col(key)]
    for c, dt in columns.items():
        if dt.startswith("ndarray"):
            sel += [F.size(c).alias(f"{c}_len"), F.lit(types[c]).alias(f"{c}_type")]
        else:
            sel.append(F.col(c))
    return back.select(*sel).orderBy("part", "shard", key).limit(n)
