"""Token files: each document's ids compressed on their own against one shared zstandard dictionary.

A shard file is, in order: the magic, the width of an id in bytes, the SHA-256 of the dictionary, the
compressed frames of its documents in ascending id order, and an index (ids, null flags, frame
offsets, token counts) followed by where the index starts and how many documents it has.  Reading
one short document costs its index entry, one frame and the dictionary.  The dictionary lies once
beside the shards; a shard whose dictionary hash differs is refused.

Writing: documents are range-partitioned by (id, text hash), sorted, and every partition streams its
documents into shards, closing one when it has reached ``shard_bytes``; so a shard, and what a task
holds of it, is bounded at any input size.  A task writes under a name of its own attempt and renames
at the end of each shard, so a retried task replaces the files with the same bytes.  A manifest (one
row for each shard) holds the number of ids in earlier shards, from which readers know every
document's place in the whole stream.

The dictionary is trained on a bounded sample: of the ``sample_docs`` documents with the smallest hash,
of whatever length, one piece of at most ``sample_chars`` characters each, at a hashed offset.  It
changes the size of the files, never the ids read back.  A small sample gives a small dictionary;
only where there is nothing to train on (no ids that repeat) are the sampled ids the dictionary.

Defined results: a null or empty text is the end id alone; a null id sorts first and stays null;
repeated rows are written one by one; rows of one id are ordered by the hash of their text; a very
long text is one frame (and may make its shard larger than ``shard_bytes``); an empty table gives an
empty manifest and no documents.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import as_large, encoder, hashed_sample, slices

MAGIC = b"TOKF1\n"
SHARD = "shard string, path string, n_docs long, n_tokens long, n_bytes long, dictionary string"


def _open_fs(path: str):
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def _documents(texts: pa.Array, tokenizer: str, end_id: int) -> Iterator[np.ndarray]:
    tail = np.array([end_id], dtype="<u4")
    for a, b in slices(texts):
        ids, at = encoder(tokenizer).ids(texts[a:b])
        for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            yield np.concatenate((ids[s:e], tail))


def train_dictionary(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                     end_id: int = 1, sample_docs: int = 2000, sample_chars: int = 8192,
                     size: int = 64 << 10, width: int = 2) -> bytes:
    """The shared dictionary, from at most ``sample_docs * sample_chars`` characters on the driver."""
    room = F.greatest(F.length("t") - F.lit(sample_chars), F.lit(0)) + 1
    piece = F.substring(F.col("t"), F.pmod(F.xxhash64(F.lit("offset"), F.col("t")), room).cast("int") + 1, F.lit(sample_chars))
    chosen = hashed_sample(docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).filter(F.length("t") > 0),
                           ["i", "t"], sample_docs)
    rows = chosen.select(piece.alias("t")).collect()
    texts = as_large(pa.array([r["t"] for r in rows], pa.string()))
    samples = [d.astype(f"<u{width}").tobytes() for d in _documents(texts, tokenizer, end_id)] if rows else []
    if not samples:
        return b""
    # the trainer wants many samples and sixteen times the dictionary: short blocks, all of them again if they are few
    blocks = [x[i:i + 1024] for x in samples for i in range(0, len(x), 1024)]
    size = max(512, min(size, sum(map(len, blocks)) // 16))
    blocks *= -(-16 * size // sum(map(len, blocks)))
    try:
        return zstandard.train_dictionary(size, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    if not raw:
        return None
    trained = raw.startswith(b"\x37\xa4\x30\xec")
    return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_FULLDICT if trained
                                         else zstandard.DICT_TYPE_RAWCONTENT)


class _ShardWriter:
    """One shard file, written under ``temp`` and renamed when it is closed."""

    def __init__(self, name: str, temp: str, width: int, digest: bytes):
        self.files, self.final = _open_fs(name)
        self.name, self.temp, self.width, self.digest = name, f"{self.final}.{temp}", width, digest
        self.ids, self.null, self.offsets, self.sizes = array("q"), array("b"), array("q"), array("q")
        self.place = len(MAGIC) + 1 + 32
        self.out = self.files.open_output_stream(self.temp)
        self.out.write(MAGIC + bytes([width]) + digest)

    def add(self, doc_id: int | None, n_tokens: int, frame: bytes) -> None:
        self.out.write(frame)
        self.ids.append(doc_id or 0)
        self.null.append(doc_id is None)
        self.offsets.append(self.place)
        self.sizes.append(n_tokens)
        self.place += len(frame)

    def close(self, shard: str) -> pa.RecordBatch:
        """Write the index, rename the file; the shard's row of the manifest."""
        index = [np.array(self.ids, "<i8"), np.array(self.null, "<u1"),
                 np.append(np.array(self.offsets, "<u8"), np.uint64(self.place)), np.array(self.sizes, "<u8")]
        for part in index:
            self.out.write(part.tobytes())
        self.out.write(struct.pack("<QQ", self.place, len(self.ids)) + MAGIC)
        self.out.close()
        self.files.move(self.temp, self.final)
        n_bytes = self.place + sum(p.nbytes for p in index) + 16 + len(MAGIC)
        return pa.RecordBatch.from_pydict({"shard": [shard], "path": [self.name], "n_docs": [len(self.ids)],
                                           "n_tokens": [sum(self.sizes)], "n_bytes": [n_bytes],
                                           "dictionary": [self.digest.hex()]})


def write_token_files(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = 1, partitions: int | None = None, level: int = 3, width: int = 2,
                      dictionary: bytes | None = None, shard_bytes: int = 128 << 20) -> DataFrame:
    """Write the shards, the dictionary and the manifest under ``path``; the manifest with
    ``first_token`` (ids in all earlier shards).  ``partitions`` tasks write (by default the session's
    shuffle partitions), each one shard or more."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    raw = train_dictionary(docs, tokenizer, id_col, text_col, end_id, width=width) if dictionary is None else dictionary
    files, base = _open_fs(path)
    files.create_dir(f"{base}/shards", recursive=True)
    with files.open_output_stream(f"{base}/dictionary") as f:
        f.write(raw)
    digest = hashlib.sha256(raw).digest()
    limit = 1 << (8 * width)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get()
        zipped = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(raw))
        out, shard, done = None, "", 0
        for batch in batches:
            coded = _documents(as_large(batch.column(1)), tokenizer, end_id)
            for doc_id, doc in zip(batch.column(0).to_pylist(), coded, strict=True):
                if int(doc.max()) >= limit:
                    raise ValueError(f"an id does not fit {width} bytes")
                if out is None:
                    shard = f"{at.partitionId():06d}-{done:06d}"
                    out = _ShardWriter(f"{path}/shards/{shard}.tok", f"{at.stageId()}-{at.taskAttemptId()}", width, digest)
                out.add(doc_id, len(doc), zipped.compress(doc.astype(f"<u{width}").tobytes()))
                if out.place >= shard_bytes:
                    yield out.close(shard)
                    out, done = None, done + 1
        if out is not None:
            yield out.close(shard)

    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("h")]
    # no text in the sort keys of the range cut: its sample then holds ids and hashes only
    cut = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("h"))
           .repartitionByRange(n, *order).sortWithinPartitions(*order))
    cut.select("doc_id", "text").mapInArrow(write, SHARD).write.mode("overwrite").parquet(f"{path}/manifest")
    return manifest(spark, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row for each shard; the running sum is over that small frame only."""
    rows = spark.read.schema(SHARD).parquet(f"{path}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


class TokenShard:
    """Random access to one shard file."""

    def __init__(self, path: str, dictionary: bytes):
        files, name = _open_fs(path)
        self.file = files.open_input_file(name)
        head = self.file.read_at(len(MAGIC) + 33, 0)
        if head[:len(MAGIC)] != MAGIC or head[len(MAGIC) + 1:] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path}: not a token file of this dictionary")
        self.width = head[len(MAGIC)]
        size = self.file.size()
        start, n = struct.unpack("<QQ", self.file.read_at(16, size - 16 - len(MAGIC)))
        raw = self.file.read_at(size - 16 - len(MAGIC) - start, start)
        null = np.frombuffer(raw, "<u1", n, 8 * n)
        self.ids = [None if x else int(i) for i, x in zip(np.frombuffer(raw, "<i8", n), null, strict=True)]
        self.offsets = np.frombuffer(raw, "<u8", n + 1, 9 * n).tolist()
        self.sizes = np.frombuffer(raw, "<u8", n, 17 * n + 8).tolist()
        self.unzip = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def __len__(self) -> int:
        return len(self.ids)

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document, from its own frame alone."""
        frame = self.file.read_at(self.offsets[i + 1] - self.offsets[i], self.offsets[i])
        return np.frombuffer(self.unzip.decompress(frame), f"<u{self.width}").astype("<u4")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit) of every document, from the files."""
    files, base = _open_fs(path)
    with files.open_input_stream(f"{base}/dictionary") as f:
        raw = f.read()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = TokenShard(name, raw)
                for a in range(0, len(shard), 1000):
                    b = min(a + 1000, len(shard))
                    docs = [shard.document(i) for i in range(a, b)]
                    starts = start + np.cumsum([0, *map(len, docs)])
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(shard.ids[a:b], pa.int64()), "start": pa.array(starts[:-1], pa.int64()),
                        "n_tokens": pa.array([len(d) for d in docs], pa.int64()),
                        "ids": pa.array([d.tobytes() for d in docs], pa.binary())})
                    start = int(starts[-1])

    shards = manifest(spark, path).select("path", "first_token").checkpoint()
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return (shards.repartitionByRange(n, "first_token")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary"))
