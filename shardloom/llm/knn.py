"""Quality classifier: similarity-weighted votes of the nearest labelled documents in a latent space.

A document's features are hashed character trigrams and words (case kept, ``BUCKETS`` of them, log
counts times inverse document frequency) and a few measures of its shape (shares of capitals,
digits, marks and repeated words, line and word lengths).  At most ``SAMPLE`` labelled rows, those with
the smallest id hashes, are vectorised on the executors and gathered; a truncated singular value
decomposition of them gives the latent space.  The labelled vectors (``SAMPLE`` x ``RANK`` floats) and the
projection (``BUCKETS`` x ``RANK``) are broadcast: both are bounded by these parameters.

Every document is scored in one scan: blocks of documents are projected and multiplied with all
labelled vectors (exact cosines, no index), and the labels of the ``NEIGHBOURS`` nearest are averaged
with their similarity as weight (its cube, so that close ones prevail).

Defined results: a null text is the empty text, which has a score like any other; a document with no
direction in the latent space gets the sample's share of label 1; without labelled rows all scores
are 0.5; an id labelled twice has its larger label; repeated rows get equal scores; a null id is kept; an empty
table gives no rows.  Only the
text is an input of a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, as_large, hashed_sample, slices

BUCKETS = 1 << 12
SAMPLE = 6000
RANK = 64
NEIGHBOURS = 15
BLOCK = 512
SHAPES = 10
_M = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
_SLICE = 1 << 20


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of each word's trigrams and of itself, how many, [word, class] counts of characters)."""
    cp = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    blank = cp == 32
    word_of = np.cumsum(blank) - 1
    x = cp.astype(np.uint64)
    with np.errstate(over="ignore"):
        h = x[:-2] * _M[0] + x[1:-1] * _M[1] + x[2:] * _M[2]
        h = (h ^ (h >> np.uint64(29))) * _M[1]
        of = word_of[1:-1]
        inside = ~blank[1:-1]
        h, of = h[inside], of[inside]
        whole = np.add.reduceat(h, np.flatnonzero(np.diff(of, prepend=-1)))
        whole = (whole ^ (whole >> np.uint64(31))) * _M[0]
    n = len(words)
    at = (np.concatenate((h, whole)) >> np.uint64(52)).astype(np.int64) % BUCKETS
    of = np.concatenate((of, np.arange(n)))
    order = np.argsort(of, kind="stable")
    kinds, which = np.unique(cp, return_inverse=True)
    letters = [chr(c) for c in kinds.tolist()]
    classes = np.array([[c.isupper(), c.islower(), c.isdigit(), not (c.isalnum() or c == " "), c != " "] for c in letters], float)
    chars = np.stack([np.bincount(word_of, classes[which, j], minlength=n + 1)[:n] for j in range(classes.shape[1])], axis=1)
    return at[order], np.bincount(of, minlength=n), chars


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """([document, bucket] log counts, [document, shape] measures) of a slice of texts."""
    n = len(texts)
    words = Words(texts)
    counts = np.zeros((n, BUCKETS), np.float32)
    shape = np.zeros((n, SHAPES), np.float32)
    raw = texts.to_pylist()
    shape[:, 0] = np.log1p(words.counts)
    lines = [t.split("\n") for t in raw]
    shape[:, 1] = [1 - len(set(x)) / len(x) for x in lines]
    shape[:, 2] = [np.log1p(len(t) / len(x)) for t, x in zip(raw, lines, strict=True)]
    if len(words.codes):
        at, size, chars = _grams(words.distinct)
        doc = np.repeat(np.arange(n), words.counts)
        pair, times = np.unique(doc * len(words.distinct) + words.codes, return_counts=True)
        doc, code = pair // len(words.distinct), pair % len(words.distinct)
        begin = np.cumsum(size) - size
        length = size[code]
        ends = np.cumsum(length)
        take = np.arange(ends[-1]) + np.repeat(begin[code] - (ends - length), length)
        flat = np.bincount(np.repeat(doc, length) * BUCKETS + at[take], np.repeat(times, length), minlength=n * BUCKETS)
        counts = np.log1p(flat).reshape(n, BUCKETS).astype(np.float32)
        totals = np.stack([np.bincount(doc, times * chars[code, j], minlength=n) for j in range(5)], axis=1)
        size = np.maximum(totals[:, 4:5], 1)
        shape[:, 3:7] = totals[:, :4] / size
        shape[:, 7] = np.log1p(totals[:, 4] / np.maximum(words.counts, 1))
        distinct = np.bincount(doc, minlength=n)
        shape[:, 8] = 1 - distinct / np.maximum(words.counts, 1)
        most = np.zeros(n)
        np.maximum.at(most, doc, times)
        shape[:, 9] = most / np.maximum(words.counts, 1)
    return counts, shape


class Model:
    """Scaling, projection and labelled vectors."""

    def __init__(self, counts: np.ndarray, shape: np.ndarray, labels: np.ndarray):
        self.labels = labels.astype(np.float32)
        if not len(labels):
            return
        self.idf = np.log((1 + len(labels)) / (1 + (counts > 0).sum(0))).astype(np.float32) + 1
        self.mean, self.scale = shape.mean(0), 3 * np.maximum(shape.std(0), 1e-3)
        x = self.combined(counts, shape)
        rng = np.random.default_rng(7)
        rank = min(RANK, len(x))
        q = rng.standard_normal((x.shape[1], min(rank + 16, len(x)))).astype(np.float32)
        for _ in range(4):  # power iterations of a randomised SVD
            q = np.linalg.qr(x.T @ np.linalg.qr(x @ q)[0])[0]
        _, _, v = np.linalg.svd(x @ q, full_matrices=False)
        self.projection = (q @ v[:rank].T).astype(np.float32)
        self.vectors = _unit(x @ self.projection)

    def combined(self, counts: np.ndarray, shape: np.ndarray) -> np.ndarray:
        return np.concatenate((_unit(counts * self.idf), (shape - self.mean) / self.scale * 0.5), axis=1).astype(np.float32)

    def score(self, counts: np.ndarray, shape: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        x = _unit(self.combined(counts, shape) @ self.projection)
        out = np.empty(len(x))
        k = min(NEIGHBOURS, len(self.labels))
        for a in range(0, len(x), BLOCK):
            near = x[a:a + BLOCK] @ self.vectors.T
            top = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(near, top, axis=1), 0).astype(float) ** 3
            total = weight.sum(1)
            votes = (weight * self.labels[top]).sum(1)
            out[a:a + BLOCK] = np.where(total > 0, votes / np.maximum(total, 1e-12), self.labels.mean())
        return np.clip(out, 0, 1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, label) -> (label, sparse counts, shape) for the labelled sample."""
    for batch in batches:
        texts = as_large(batch.column(0))
        for a, b in slices(texts, _SLICE, 2 * BLOCK):
            counts, shape = features(texts[a:b])
            at = [np.flatnonzero(x) for x in counts]
            yield pa.RecordBatch.from_pydict({
                "label": batch.column(1)[a:b], "at": [x.astype("<u2").tobytes() for x in at],
                "n": [r[x].tobytes() for r, x in zip(counts, at, strict=True)], "shape": [x.tobytes() for x in shape]})


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """The model of at most ``sample`` labelled rows; ``labels`` has the ids and 0/1 labels to learn from."""
    known = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"))
             .filter("_id is not null and label is not null").groupBy("_id").agg(F.max("label").alias("label")))
    chosen = hashed_sample(known, ["_id"], sample)
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "_id")
            .select("text", "label", "_id").sortWithinPartitions("_id").select("text", "label")
            .mapInArrow(_vectors, "label int, at binary, n binary, shape binary").toArrow())
    labelled = rows["label"].to_numpy()
    counts = np.zeros((len(labelled), BUCKETS), np.float32)
    for i, (at, n) in enumerate(zip(rows["at"].to_pylist(), rows["n"].to_pylist(), strict=True)):
        counts[i, np.frombuffer(at, "<u2")] = np.frombuffer(n, np.float32)
    shape = np.array([np.frombuffer(x, np.float32) for x in rows["shape"].to_pylist()], np.float32).reshape(-1, SHAPES)
    return Model(counts, shape, labelled)


def score_column(spark, model: Model, text: str | Column = "text") -> Column:
    shared = spark.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> pa.Array:
        texts = as_large(texts)
        out = [shared.value.score(*features(texts[a:b])) for a, b in slices(texts, _SLICE, 2 * BLOCK)]
        return pa.array(np.concatenate(out) if out else [], pa.float64())

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "double")(F.col(text) if isinstance(text, str) else text)
