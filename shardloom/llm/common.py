"""Helpers shared by the operators of this subpackage.

Text conventions used throughout: white space is ``[\\x20\\x09-\\x0D]``; a null text reads as the
empty text; document rows are handled one by one, so repeated ids or repeated rows are separate
documents.  Operators read only the id and text columns they are told to (plus columns they are
asked to carry, packed in one struct), so further columns of any name cannot clash.
"""

from __future__ import annotations

import ctypes
import gc
import os
import time
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: texts are worked on in slices of about this many bytes, which bounds a task's scratch arrays
SLICE_BYTES = 3 << 20


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver did."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of frames that are no longer used: it acts when the
    driver's garbage is collected, which by itself may come long after the disk is needed again.

    The JVM learns of frames that Python has dropped from a thread that looks once a second; collected before that, it
    would find them in use and keep their files until it is asked again.  The last job's frames are in use until
    another job has run, so a job of one row goes first."""
    gc.collect()
    spark.range(1).collect()
    dropped = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", None)
    until = time.monotonic() + 10
    while dropped and time.monotonic() < until:
        time.sleep(0.05)
    time.sleep(0.05)  # the last one may be on its way
    spark.sparkContext._jvm.System.gc()


#: key of a document row: id (-1 for null), whether it is null, hash of the text
KEY = ["_id", "_null", "_h"]


def key_columns(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """The columns of KEY, none of them null, so that rows meet in plain equality joins."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("_id"),
            F.col(id_col).isNull().cast("int").alias("_null"),
            F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_h")]


def carry_struct(columns: Sequence[str]) -> list[Column]:
    """One struct column ``carried`` of further columns, whatever their names (none if there are none)."""
    return [F.struct(*[F.col(f"`{c}`") for c in columns]).alias("carried")] if columns else []


def as_documents(columns: Sequence[str], text: Column, id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """The columns of a documents table again, from doc_id, a new text and ``carried``."""
    return [F.col("doc_id").alias(c) if c == id_col else text.alias(c) if c == text_col
            else F.length(text).cast("long").alias(c) if c == "n_chars"
            else F.col("carried").getField(c).alias(c) for c in columns]


def id_bucket(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id written as text, mod 5: 0 is the held-out part (null for a null id)."""
    return F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")) % 5


def hashed_sample(rows: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """The ``limit`` rows with the smallest hash of ``keys``.  A first cut by hash, from the number of rows,
    leaves about twice as many, so no task and no driver gathers more than that at any input size."""
    n = rows.count()
    h = F.xxhash64(*keys)
    share = min(1.0, (2 * limit + 100) / max(n, 1))
    most = min((1 << 63) - 1, -(1 << 63) + int(share * (1 << 64)))
    return rows.filter(h <= F.lit(most)).orderBy(h, *keys).limit(limit)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    return F.coalesce(id_bucket(doc_id) == 0, F.lit(False))


def as_large(texts: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Texts as one large_string array without nulls."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    pa.default_memory_pool().release_unused()  # what the batch before has left
    return pc.fill_null(pc.cast(texts, pa.large_string()), "")


def slices(texts: pa.Array, budget: int = SLICE_BYTES, rows: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """(start, stop) ranges of at most ``rows`` rows with about ``budget`` bytes each; one long text is a
    range of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start, n = 0, len(texts)
    while start < n:
        done = ends[start - 1] if start else 0
        stop = min(start + rows, max(start + 1, int(np.searchsorted(ends, done + budget, side="right"))))
        yield start, stop
        start = stop


class Words:
    """The words of a slice of texts, as codes into their distinct words."""

    def __init__(self, texts: pa.Array, lower: bool = False, lower_ascii_words: bool = False):
        trimmed = pc.ascii_trim_whitespace(texts)
        if lower:
            trimmed = pc.ascii_lower(trimmed)
        lists = pc.ascii_split_whitespace(trimmed)
        flat = lists.flatten()
        if lower_ascii_words:  # words with other letters or marks keep their case
            flat = pc.if_else(pc.string_is_ascii(flat), pc.ascii_lower(flat), flat)
        coded = pc.dictionary_encode(flat)
        self.distinct: list[str] = coded.dictionary.to_pylist()
        self.codes = coded.indices.to_numpy(zero_copy_only=False)
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        if "" in self.distinct:  # a text without words splits into one empty string
            blank = self.distinct.index("")
            at = np.repeat(np.arange(len(counts)), counts)
            counts = counts - np.bincount(at[self.codes == blank], minlength=len(counts))
            self.codes = self.codes[self.codes != blank]
            self.codes = self.codes - (self.codes > blank)
            del self.distinct[blank]
        self.counts = counts
        self.starts = np.concatenate(([0], np.cumsum(counts)))


#: Between a letter and an ASCII symbol (not the apostrophe, which opens contractions) a tokenizer
#: that keeps letters and symbols apart has a boundary, so a space there changes no id.
_SYMBOL = r"[!-&(-/:-@\[-`{-~]"
_EDGES = ((rf"(\pL)({_SYMBOL})", r"\1 \2"), (rf"({_SYMBOL})(\pL)", r"\1 \2"))


class WordEncoder:
    """Token ids of whole texts through the ids of their distinct runs of letters or symbols.

    Valid for lower-casing tokenizers that drop white space and keep letters and symbols apart
    before merging, and mark the end of each such run in its last token: the ids of a text are
    then the ids of its runs, one after another.  Each distinct run is encoded once; the cache of
    runs lives as long as the Python worker and has a bounded size.  Texts that may spell a
    special token are encoded as they are."""

    RUNS = 400_000

    def __init__(self, path: str, end_mark: str = "</w>"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        pieces = self.tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(pieces.values()) + 1, dtype=bool)
        self.last[[i for piece, i in pieces.items() if piece.endswith(end_mark)]] = True
        self.runs: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, dtype="<u4")
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        plain = [r for r in new if r.isalpha()]
        rest = [r for r in new if not r.isalpha()]
        for at in range(0, len(plain), 256):
            some = plain[at:at + 256]
            ids = self._whole([" ".join(some)])[0]
            cut = np.flatnonzero(self.last[ids]) + 1
            if len(cut) == len(some):  # one end for each run
                raw, ends = ids.tobytes(), (4 * cut).tolist()
                self.runs.update(zip(some, (raw[a:b] for a, b in zip([0, *ends], ends)), strict=True))
            else:
                rest += some
        for at in range(0, len(rest), 4096):
            some = rest[at:at + 4096]
            self.runs.update(zip(some, (x.tobytes() for x in self._whole(some)), strict=True))

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids as uint32, start of each text's ids with the total appended)."""
        special = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        spaced = pc.if_else(pa.array(special), "", texts) if special.any() else texts
        for edge, cut in _EDGES:
            spaced = pc.replace_substring_regex(spaced, edge, cut)
        words = Words(spaced, lower_ascii_words=True)
        new = [w for w in words.distinct if w not in self.runs]
        if len(self.runs) + len(new) > self.RUNS:
            self.runs.clear()
            new = words.distinct
        self._learn(new)
        blobs = [self.runs[w] for w in words.distinct]
        size = np.fromiter(map(len, blobs), dtype=np.int64, count=len(blobs)) // 4
        table = np.frombuffer(b"".join(blobs), dtype="<u4")
        begin = np.cumsum(size) - size
        length = size[words.codes]
        ends = np.concatenate(([0], np.cumsum(length)))
        at = np.arange(ends[-1])
        at += np.repeat(begin[words.codes] - ends[:-1], length)
        ids = table[at]
        starts = ends[words.starts]
        if not special.any():
            return ids, starts
        parts = np.split(ids, starts[1:-1])
        for i in np.flatnonzero(special).tolist():
            parts[i] = self._whole([texts[i].as_py()])[0]
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each tokenizer file and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def give_back() -> None:
    """Hand memory that a task no longer uses back to the system: workers outlive their tasks and stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def token_binary(path: str, end_id: int | None = 1):
    """Arrow UDF: text -> its ids as little-endian unsigned 32-bit integers, the end id appended.  The encoder and the
    runs it remembers live as long as the task."""
    tail = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = WordEncoder(path)
        for texts in parts:
            texts, out = as_large(texts), []
            for a, b in slices(texts):
                ids, at = own.ids(texts[a:b])
                raw = memoryview(ids.tobytes())
                out += [raw[4 * s:4 * e].tobytes() + tail for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.array(out, type=pa.binary())
        del own
        give_back()

    run.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "binary")
