"""WARC fixity audit by Merkle trees.

Each record of an archive is hashed where it lies; only (file, sequence number, length, digest) rows
are moved.  A file's records, in order, are the leaves of a tree: a node covers ``FANOUT`` consecutive
children, that is an offset range of the file, and its digest is the SHA-256 of their lengths and
digests.  ``audit`` compares the roots of two replicas and then, level by level, only the children of
nodes that differ, down to the damaged records.  A file of at most ``PER_FILE`` records has a tree of
fixed depth, so a group is never larger than ``FANOUT`` rows.

Records come from WARC files (``scan_warc`` of what ``write_warc`` or ``write_records`` wrote, plain or with
one gzip member for each record; ``audit_archives``), or straight from a table (``table_leaves``, ``audit_tables``).
Beside its files an archive has a catalogue: for the record at place ``at`` of a file its number ``seq`` in the
collection's file of that name and the byte at which it starts.  A replica that lost records keeps its catalogue,
so the others are compared with their own counterparts.

Defined results: null urls and bodies are written as empty; the records of one id (null ids too) are
told apart by their order of digest, equal ones (repeated rows, ties) take any order; a record that only one
replica has is ``missing`` or ``extra``; equal replicas and empty tables give no rows.  Very long records are
hashed and unpacked in blocks when scanned.  Only the columns named are read, whatever else a table has.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.index import with_row_index
from ..session import checkpoint_dir, scratch_path
from .tokenfiles import _open_fs

FANOUT = 16
DEPTH = 3
PER_FILE = FANOUT ** DEPTH
LEAF = "file string, seq long, length long, digest string"
CATALOGUE = "file string, at long, seq long, start long"
TASKS = 16_384  # at most so many tasks write or scan; twice as many keys go through the driver
BLOCK = 1 << 16
LEVEL = 3


def record(url: Column, body: Column) -> Column:
    """The bytes of a response record (as text)."""
    body = F.coalesce(body, F.lit(""))
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
                    F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
                    F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def table_leaves(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """(id, copy, length, digest) of the record of every row; ``copy`` numbers the rows of one id."""
    checkpoint_dir(pages.sparkSession)
    each = pages.select(F.col(id_col).alias("id"), record(F.col(url_col), F.col(body_col)).alias("r")).select(
        "id", F.octet_length("r").cast("long").alias("length"), F.sha2("r", 256).alias("digest")).checkpoint()
    # with one row for each id, by far the usual case, this costs a sort of the digest rows
    return with_row_index(each, ["digest"], "copy", groups=["id"])


def place(leaves: DataFrame, per_file: int = PER_FILE) -> DataFrame:
    """The leaves in id order with file, seq and offset: ``per_file`` records to a file."""
    return _placed(leaves, per_file).drop("_at")


def _placed(leaves: DataFrame, per_file: int) -> DataFrame:
    at = with_row_index(leaves, ["id", "copy"], "_at")
    placed = at.withColumn("file", F.format_string("%08d.warc", F.expr(f"_at div {per_file}"))).withColumn(
        "seq", F.col("_at") % per_file)
    before = Window.partitionBy("file").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)  # one file: bounded
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def _tree(leaves: DataFrame) -> list[DataFrame]:
    """Levels 0 (leaves) to DEPTH (roots): (file, at, length, digest)."""
    path = scratch_path(leaves.sparkSession, "merkle")
    schema = "file string, at long, length long, digest string"
    leaves.select("file", F.col("seq").alias("at"), "length", "digest").write.parquet(f"{path}/0")
    levels = [leaves.sparkSession.read.schema(schema).parquet(f"{path}/0")]
    for level in range(1, DEPTH + 1):
        children = F.sort_array(F.collect_list(F.struct("at", "length", "digest")))
        (levels[-1].groupBy("file", F.expr(f"at div {FANOUT}").alias("node")).agg(F.sum("length").alias("length"),
                                                                                 children.alias("c"))
         .select("file", F.col("node").alias("at"), "length",
                 F.sha2(F.array_join(F.transform("c", lambda x: F.concat_ws(":", x["at"], x["length"], x["digest"])), ","), 256)
                 .alias("digest")).write.parquet(f"{path}/{level}"))
        levels.append(leaves.sparkSession.read.schema(schema).parquet(f"{path}/{level}"))
    return levels


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """(file, seq, primary_sha256, replica_sha256, status) of the records that differ; both sides are
    leaves (file, seq, length, digest) of files of at most ``PER_FILE`` records."""
    ours, theirs = _tree(primary), _tree(replica)
    suspect = None
    for level in range(DEPTH, -1, -1):
        a, b = (side[level].select("file", "at", "length", "digest") for side in (ours, theirs))
        if suspect is not None:  # only below nodes that differ
            parent = suspect.select("file", F.col("at").alias("_p"))
            a, b = (s.withColumn("_p", F.expr(f"at div {FANOUT}")).join(parent, ["file", "_p"], "left_semi").drop("_p")
                    for s in (a, b))
        a = a.select("file", "at", F.col("length").alias("n1"), F.col("digest").alias("d1"))
        b = b.select("file", "at", F.col("length").alias("n2"), F.col("digest").alias("d2"))
        suspect = a.join(b, ["file", "at"], "full").filter(~(F.col("d1").eqNullSafe(F.col("d2")) & F.col("n1").eqNullSafe(F.col("n2"))))
        if level:
            suspect = suspect.checkpoint()
    return suspect.select("file", F.col("at").alias("seq"), F.col("d1").alias("primary_sha256"), F.col("d2").alias("replica_sha256"),
                          F.when(F.col("d2").isNull(), "missing").when(F.col("d1").isNull(), "extra").otherwise("altered").alias("status"))


def audit_tables(primary: DataFrame, replica: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 body_col: str = "html") -> DataFrame:
    """The damaged records of ``replica``: their id, file, seq, offset and length in the primary, both
    digests and the status.  Records of ids that the primary lacks come last, without a place."""
    manifest = place(table_leaves(primary, id_col, url_col, body_col)).checkpoint()
    other = table_leaves(replica, id_col, url_col, body_col).withColumnsRenamed({"id": "_id", "copy": "_copy"})
    spot = manifest.select(F.col("id"), "copy", "file", "seq")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("copy") == F.col("_copy"))
    placed = other.join(spot, same, "left").checkpoint()
    found = audit(manifest, placed.filter("file is not null"))
    out = found.join(manifest.select("id", "file", "seq", "offset", "length"), ["file", "seq"], "left").select(
        "id", "file", "seq", "offset", "length", "primary_sha256", "replica_sha256", "status")
    extra = placed.filter("file is null").select(
        F.col("_id").alias("id"), F.lit(None).cast("string").alias("file"), *[F.lit(None).cast("long").alias(c) for c in ("seq", "offset")],
        "length", F.lit(None).cast("string").alias("primary_sha256"), F.col("digest").alias("replica_sha256"), F.lit("extra").alias("status"))
    return out.unionByName(extra)


class _Writer:
    """The files of one task, each written under the attempt's own name and renamed when it is whole."""

    def __init__(self, path: str):
        at = TaskContext.get()
        self.files, self.base = _open_fs(path)
        self.attempt = f"{at.stageId()}-{at.taskAttemptId()}"
        self.name = self.out = None

    def add(self, name: str, seq: int, raw: bytes) -> pa.RecordBatch | None:
        """Append a record; the catalogue of the file before, if this one begins another."""
        done = self.close() if name != self.name else None
        if self.out is None:
            self.name, self.out, self.start, self.rows = name, self.files.open_output_stream(f"{self.base}/.{name}.{self.attempt}"), 0, []
        self.out.write(raw)
        self.rows.append((name, len(self.rows), seq, self.start))
        self.start += len(raw)
        return done

    def close(self) -> pa.RecordBatch | None:
        if self.out is None:
            return None
        self.out.close()
        self.files.move(f"{self.base}/.{self.name}.{self.attempt}", f"{self.base}/{self.name}")
        self.out = None
        return _batch(self.rows, CATALOGUE)


_ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, (_, t) in zip(columns, fields, strict=True)],
                                      names=[n for n, _ in fields])


def _packed(raw: Column, gzip: bool) -> Column:
    """The record as a gzip member of its own, or as it is."""
    def pack(records: pa.Array) -> pa.Array:
        out = []
        for r in records:
            member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            out.append(member.compress(r.as_buffer()) + member.flush())
        return pa.array(out, pa.binary())

    pack.__annotations__ = {"records": pa.Array, "return": pa.Array}
    return F.arrow_udf(pack, "binary")(raw) if gzip else raw


def _key(i, digest: str) -> tuple:
    return (False, 0, digest) if i is None else (True, i, digest)


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CATALOGUE).parquet(f"{path}/catalogue")


def write_records(rows: DataFrame, path: str, gzip: bool = False) -> DataFrame:
    """Write (file, seq, record) as WARC files; every file's rows lie in one partition, in order, as
    ``read_warc`` gives them, so nothing is shuffled.  The archive's catalogue."""
    files, base = _open_fs(path)
    files.create_dir(base, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Writer(path)
        for batch in batches:
            for name, seq, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if (done := out.add(name, seq, raw.as_py())) is not None:
                    yield done
        if (done := out.close()) is not None:
            yield done

    rows.select("file", "seq", _packed(F.col("record"), gzip)).mapInArrow(write, CATALOGUE).write.parquet(f"{path}/catalogue")
    return catalogue(rows.sparkSession, path)


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
               per_file: int = PER_FILE, gzip: bool = False) -> DataFrame:
    """Write the records as WARC files under ``path``, ``per_file`` to a file in id order, with the catalogue
    beside them, and return the manifest (id, copy, file, seq, offset, length, digest; without gzip).

    Places come from the digest rows.  A task takes a range of whole files, so a record finds its task among
    the ranges' first keys and is shuffled once.  A key (id and digest) whose copies reach beyond one task is
    sent once to each of its tasks, with the number of copies that this one writes."""
    spark = pages.sparkSession
    placed = _placed(table_leaves(pages, id_col, url_col, body_col), per_file).checkpoint()
    total = placed.count()
    per_task = per_file * max(1, -(-total // (per_file * TASKS)))
    tasks = max(1, -(-total // per_task))
    edge = F.col("_at") % per_task
    edges = {r["_at"]: (r["id"], r["digest"]) for r in
             placed.filter((edge == 0) | (edge == per_task - 1)).select("_at", "id", "digest").collect()}
    firsts = [_key(*edges[t * per_task]) for t in range(tasks if total else 0)]
    wide = {firsts[t]: edges[t * per_task] for t in range(1, len(firsts)) if _key(*edges[t * per_task - 1]) == firsts[t]}

    def task(ids: pa.Array, digests: pa.Array) -> pa.Array:
        keys = [_key(i, d) for i, d in zip(ids.to_pylist(), digests.to_pylist(), strict=True)]
        return pa.array([-1 if k in wide else bisect_right(firsts, k) - 1 for k in keys], pa.int32())

    task.__annotations__ = {"ids": pa.Array, "digests": pa.Array, "return": pa.Array}
    raw = pages.select(F.col(id_col).alias("id"), record(F.col(url_col), F.col(body_col)).cast("binary").alias("r")).withColumn(
        "digest", F.sha2("r", 256)).withColumn("task", F.arrow_udf(task, "int")("id", "digest"))
    rows = raw.filter("task >= 0").select("task", "id", "digest", F.lit(1).cast("long").alias("times"), _packed(F.col("r"), gzip).alias("r"))
    if wide:
        schema = placed.select("id", "digest").schema
        keys = F.broadcast(spark.createDataFrame(list(wide.values()), schema).withColumnsRenamed({"id": "_i", "digest": "_d"}))
        same = F.col("id").eqNullSafe(F.col("_i")) & (F.col("digest") == F.col("_d"))
        shares = []
        for i, d, a, n in placed.join(keys, same).groupBy("id", "digest").agg(F.min("_at"), F.count("*")).collect():
            shares += [(i, d, t, min(a + n, (t + 1) * per_task) - max(a, t * per_task))
                       for t in range(a // per_task, (a + n - 1) // per_task + 1)]
        shares = F.broadcast(spark.createDataFrame(shares, T.StructType(
            [T.StructField("_i", schema["id"].dataType), T.StructField("_d", T.StringType()), T.StructField("task", T.IntegerType()),
             T.StructField("times", T.LongType())])))
        one = raw.filter("task < 0").groupBy("id", "digest").agg(F.first("r").alias("r")).join(shares, same)
        rows = rows.unionByName(one.select("task", "id", "digest", "times", _packed(F.col("r"), gzip).alias("r")))
    rows = rows.repartitionById(tasks, F.col("task")).sortWithinPartitions(F.col("id").asc_nulls_first(), "digest")
    files, base = _open_fs(path)
    files.create_dir(base, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at = _Writer(path), None
        for batch in batches:
            for t, times, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                at = t * per_task if at is None else at
                raw = raw.as_py()
                for _ in range(times):
                    if (done := out.add(f"{at // per_file:08d}.warc", at % per_file, raw)) is not None:
                        yield done
                    at += 1
        if (done := out.close()) is not None:
            yield done

    rows.select("task", "times", "r").mapInArrow(write, CATALOGUE).write.parquet(f"{path}/catalogue")
    return placed.drop("_at")


def _next_member(f, size: int, at: int) -> int:
    """The first byte from ``at`` on where a gzip member of a WARC record begins (``size``: none)."""
    while at < size:
        block = f.read_at(min(BLOCK, size - at), at)
        found = block.find(b"\x1f\x8b\x08")
        if found < 0:
            at += max(1, len(block) - 2)
            continue
        at += found
        try:
            if zlib.decompressobj(31).decompress(f.read_at(min(4096, size - at), at), 5) == b"WARC/":
                return at
        except zlib.error:
            pass
        at += 1
    return size


def _gzip_records(f, size: int, starts: list[int] | None, keep: bool) -> Iterator[tuple[int, int, str, bytes]]:
    """(at, length, digest, record) of each member.  One that does not unpack counts with its packed bytes, up to
    the next member that does; with the catalogue's ``starts`` the place goes on behind all that lie between."""
    start = at = 0
    block, read = b"", 0  # block: the bytes read but not used, up to ``read``
    while start < size:
        member, digest, length, kept = zlib.decompressobj(31), hashlib.sha256(), 0, []
        try:
            while not member.eof and (block or read < size):
                if not block:
                    block = f.read_at(min(BLOCK, size - read), read)
                    read += len(block)
                part = member.decompress(block, 1 << 20)
                block = member.unused_data if member.eof else member.unconsumed_tail
                digest.update(part)
                length += len(part)
                if keep:
                    kept.append(part)
                if not part and not member.eof and not block and read >= size:
                    break
            whole = member.eof
        except zlib.error:
            whole = False
        if whole:
            end = read - len(block)
        else:
            end, digest, length, kept = _next_member(f, size, start + 1), hashlib.sha256(), 0, []
            while start + length < end:
                part = f.read_at(min(1 << 20, end - start - length), start + length)
                digest.update(part)
                length += len(part)
                if keep:
                    kept.append(part)
            block, read = b"", end
        yield at, length, digest.hexdigest(), b"".join(kept)
        at = max(at + 1, bisect_left(starts, end)) if starts and not whole else at + 1
        start = end


def _plain_records(f, size: int, known: list[int] | None, keep: bool) -> Iterator[tuple[int, int, str, bytes]]:
    at = n = 0
    while at < size:
        head = f.read_at(min(BLOCK, size - at), at)
        end = head.find(b"\r\n\r\n")
        sizes = [x.split(b":", 1)[1] for x in head[:max(end, 0)].split(b"\r\n") if x.lower().startswith(b"content-length:")]
        ok = head.startswith(b"WARC/") and sizes and sizes[0].strip().isdigit()
        length = end + 8 + int(sizes[0]) if ok else size - at
        own = known[n] if known and n < len(known) else None
        if own is not None and own != length and not (
                ok and (at + length == size or at + length < size and f.read_at(min(5, size - at - length), at + length) == b"WARC/")):
            length = own
        length = min(length, size - at)
        digest, left, kept = hashlib.sha256(), length, []
        while left:
            part = f.read_at(min(left, 1 << 20), at + length - left)
            digest.update(part)
            left -= len(part)
            if keep:
                kept.append(part)
        yield n, length, digest.hexdigest(), b"".join(kept)
        at, n = at + length, n + 1


def _listed(spark: SparkSession, path: str, names: list[str] | None, manifest: DataFrame | None) -> DataFrame:
    """(file, known lengths, known starts), a file or more to a partition; a file has at most ``PER_FILE`` records."""
    if names is None:
        listed = catalogue(spark, path).groupBy("file").agg(F.sort_array(F.collect_list(F.struct("at", "start"))).alias("c")).select(
            "file", F.col("c.start").alias("starts"))
    else:
        listed = spark.createDataFrame([(n,) for n in names], "file string").withColumn("starts", F.lit(None).cast("array<long>"))
    if manifest is None:
        listed = listed.withColumn("known", F.lit(None).cast("array<long>"))
    else:
        known = manifest.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("seq", "length"))).alias("k"))
        listed = listed.join(known.select("file", F.col("k.length").alias("known")), "file", "left")
    listed = listed.checkpoint()
    return listed.select("file", "known", "starts").repartitionByRange(max(1, min(TASKS, listed.count())), "file")


def _read(spark: SparkSession, path: str, listed: DataFrame, schema: str, keep: bool) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open_fs(path)
        for batch in batches:
            for name, known, starts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, held = [], 0
                with files.open_input_file(f"{base}/{name}") as f:
                    size = f.size()
                    zipped = any(f.read_at(2, s) == b"\x1f\x8b" for s in (starts or [0])[:64] if s + 2 <= size)
                    for at, length, digest, raw in _gzip_records(f, size, starts, keep) if zipped else _plain_records(f, size, known, keep):
                        rows.append((name, at, raw) if keep else (name, at, length, digest))
                        held += len(raw)
                        if held > 4 << 20:
                            yield _batch(rows, schema)
                            rows, held = [], 0
                yield _batch(rows, schema)

    return listed.mapInArrow(read, schema)


def scan_warc(spark: SparkSession, path: str, names: list[str] | None = None, manifest: DataFrame | None = None) -> DataFrame:
    """Leaves (file, seq, length, digest) of WARC files (``names``, or those of the catalogue), each record hashed
    as it is read; ``seq`` is its place in the file.

    Plain files: with the ``manifest`` of ``write_warc``, a record whose header does not parse, or whose length
    leads neither to the next record nor to the end of the file, has the length that it has there, so the scan
    goes on behind it.  Without a manifest, or past its records, the rest of the file is then one record.
    Gzip members: the scan goes on at the next member that unpacks to a record."""
    return _read(spark, path, _listed(spark, path, names, manifest), LEAF, False)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, record) of all records of an archive, each file's in one partition and in order."""
    return _read(spark, path, _listed(spark, path, None, None), "file string, at long, record binary", True)


def audit_archives(spark: SparkSession, primary: str, replica: str, manifest: DataFrame) -> DataFrame:
    """``audit`` of what is read from the files of two archives: id, file, seq, offset and length of the damaged
    records by the primary's ``manifest``, both digests and the status.  Records that the replica's catalogue
    does not name come last, as ``extra``, without an id or a number."""
    ours = scan_warc(spark, primary)
    theirs = scan_warc(spark, replica).withColumnRenamed("seq", "at").join(
        catalogue(spark, replica).select("file", "at", "seq"), ["file", "at"], "left").checkpoint()
    found = audit(ours, theirs.filter("seq is not null").select("file", "seq", "length", "digest"))
    out = found.join(manifest.select("id", "file", "seq", "offset", "length"), ["file", "seq"], "left").select(
        "id", "file", "seq", "offset", "length", "primary_sha256", "replica_sha256", "status")
    extra = theirs.filter("seq is null").select(
        F.lit(None).cast(manifest.schema["id"].dataType).alias("id"), "file", F.lit(None).cast("long").alias("seq"),
        F.lit(None).cast("long").alias("offset"), "length", F.lit(None).cast("string").alias("primary_sha256"),
        F.col("digest").alias("replica_sha256"), F.lit("extra").alias("status"))
    return out.unionByName(extra)
