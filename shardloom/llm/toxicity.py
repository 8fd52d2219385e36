"""Toxicity classifier: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character 3- to 6-grams (``<`` and ``>`` mark its ends) and itself, each hashed to
one of ``BUCKETS`` embedding rows; its vector is the mean of theirs, so a misspelt word that was never seen
shares most of the vector of the word it stands for.  A document's words are cut evenly into passages of at
most ``PASSAGE``; a passage's vector is the mean of its words' (at least ``LEAST`` of them, short passages
being filled up with zero vectors), and a softmax over a linear map of it gives the passage's classes.  The document
has the class probabilities of its most toxic passage: one insult in a long text is not averaged away, and
every passage of the text is read.

Embeddings and softmax are trained together in numpy (Adam, all passages in each step) on at most ``SAMPLE``
labelled documents of each class, those with the smallest id hashes, weighted back to the classes' shares.
Every passage of a document has the document's label, in equal shares, so what is common to both classes is left
undecided and what only toxic documents hold stands out.  Since the softmax is linear, a step needs
the class scores of the buckets only, summed over words and passages.  A quarter of the sample (every
fourth by hash) is kept out of the training; on it, a scale and a shift of the most toxic passage's margin are
fitted, so that the threshold of one half holds for documents, not for passages.  The training is one task
over the sample, bounded by ``SAMPLE`` documents a class; the driver receives the model only.  The trained
scores (``BUCKETS`` x classes) are broadcast; every document is scored in one scan.

Defined results: case is ignored for A-Z; a null text is the empty text, one passage without words, which has a
score like any other; words over ``LONGEST`` code points are read in pieces of that length, so a very
long word or text needs no more memory than its characters; without labelled rows of both classes every score
is the share of label 1 in them (0 without any); an id labelled twice has its larger label, documents of one id
are all learnt from; repeated rows get equal scores; ties between passages change nothing; a null id is kept
and never learnt from; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, as_large, hashed_sample, slices

BUCKETS = 1 << 17
DIM = 12
SAMPLE = 2500
PASSAGE, LEAST = 4, 2
LONGEST = 64
STEPS, RATE, DECAY = 60, 0.1, 3e-6
KEPT, MIN_PAIRS = 0.3, 4
_SLICE, _WORDS = 1 << 20, 1 << 14
_M = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
               0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each subword, number of subwords of each word); a word's subwords lie together."""
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cp = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    blank = cp == 32
    word_of = np.cumsum(blank) - 1  # a space counts to the word after it
    x = cp.astype(np.uint64)
    at, of = [], []
    with np.errstate(over="ignore"):
        h, inside = x[:-1] * _M[0], ~blank[1:]
        for size in (2, 3, 4, 5, 6):  # the n-grams inside one word, its two marks included
            h = h[:len(x) - size + 1] + x[size - 1:] * _M[size - 1]
            if size > 2:
                inside = inside[:len(h)] & ~blank[size - 2:size - 2 + len(h)]
                at.append(h[inside] + np.uint64(size))
                of.append(word_of[1:1 + len(h)][inside])
        letters = ~blank[1:-1]
        mixed = (x[1:-1] * _M[1])[letters]
        own = word_of[1:-1][letters]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        place = (np.arange(len(own)) - np.repeat(first, np.diff(first, append=len(own)))).astype(np.uint64)
        mixed = (mixed + place * _M[3]) * _M[2]
        whole = np.add.reduceat(mixed ^ (mixed >> np.uint64(29)), first)
        at.append(whole)
        of.append(np.arange(n))
        h, of = np.concatenate(at), np.concatenate(of)
        h = (h ^ (h >> np.uint64(32))) * _M[0]
    order = np.argsort(of, kind="stable")
    return (h >> np.uint64(40)).astype(np.int64)[order] % BUCKETS, np.bincount(of, minlength=n)


def pieces(words: list[str]) -> tuple[list[str], np.ndarray]:
    """Words, long ones in pieces, and the number of pieces of each word."""
    if not words or max(map(len, words)) <= LONGEST:
        return words, np.ones(len(words), np.int64)
    cut = [[w[a:a + LONGEST] for a in range(0, len(w), LONGEST)] for w in words]
    return [p for w in cut for p in w], np.array([len(w) for w in cut])


def word_scores(words: list[str], table: np.ndarray) -> np.ndarray:
    """[word, class] mean score of each word's subwords."""
    out, step = [], _WORDS
    for a in range(0, len(words), step):
        some, n = pieces(words[a:a + step])
        for b in range(0, len(some), step):
            at, size = subwords(some[b:b + step])
            out.append(np.add.reduceat(table[at], np.cumsum(size) - size, axis=0) / size[:, None])
        if len(n) != len(some):
            here = np.concatenate(out[-(-(-len(some) // step)):])
            del out[-(-(-len(some) // step)):]
            out.append(np.add.reduceat(here, np.cumsum(n) - n, axis=0) / n[:, None])
    return np.concatenate(out) if out else np.zeros((0, table.shape[1]))


def passages(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of words of each passage, number of passages of each document)."""
    n = np.maximum(-(-counts // PASSAGE), 1)
    doc = np.repeat(np.arange(len(counts)), n)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    share, extra = counts // n, counts % n
    return share[doc] + (place < extra[doc]), n


class Model:
    """Bucket embeddings [BUCKETS, DIM], softmax weights [DIM, 2] and bias [2]; ``table`` is the product of the first
    two.  ``scale`` and ``shift`` take a document's largest margin to the log odds of the document."""

    def __init__(self, embeddings: np.ndarray, weights: np.ndarray, bias: np.ndarray, scale: float = 1.0, shift: float = 0.0):
        self.embeddings, self.weights, self.bias, self.scale, self.shift = embeddings, weights, bias, scale, shift

    @property
    def table(self) -> np.ndarray:
        return (self.embeddings @ self.weights).astype(np.float32)


def _odds(margin: np.ndarray) -> np.ndarray:
    """The second class's softmax share, from its score less the first one's."""
    return 1 / (1 + np.exp(-np.clip(margin, -700, 700)))


def _means(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows over their number, at least LEAST."""
    ends = np.cumsum(sizes)
    total = np.concatenate((np.zeros((1, rows.shape[1])), np.cumsum(rows, axis=0, dtype=float)))
    return (total[ends] - total[ends - sizes]) / np.maximum(sizes, LEAST)[:, None]


def _entries(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bucket, word, share of the word's mean) of every subword, some words at a time."""
    for a in range(0, len(words), _WORDS):
        some, n = pieces(words[a:a + _WORDS])
        at, size = subwords(some)
        of = np.repeat(np.arange(len(n)), n)
        yield at.astype(np.int32), np.repeat(a + of, size).astype(np.int32), np.repeat(1 / (size * n[of]), size).astype(np.float32)


def train(words: list[str], codes: np.ndarray, counts: np.ndarray, labels: np.ndarray,
          weights: np.ndarray | None = None, seed: int = 11) -> Model:
    """Fit on documents of ``counts`` words each (``codes`` into the distinct ``words``) with 0/1 ``labels`` and
    weights.  Each step leaves out a random part of every word's subwords, so that a few of them suffice; subwords
    of fewer than MIN_PAIRS pairs of word and document learn nothing.  Of two classes only the difference matters to
    a softmax, so sums over words and passages are taken of that."""
    rng = np.random.default_rng(seed)
    weights = np.ones(len(labels)) if weights is None else weights
    weights = weights / max(weights.sum(), 1e-300)
    share = float(labels @ weights)
    if not len(labels) or not 0 < labels.mean() < 1 or not words:
        return Model(np.zeros((BUCKETS, DIM)), np.zeros((DIM, 2)), np.log(np.maximum([1 - share, share], 1e-300)))
    sizes, n_pass = passages(counts)
    pass_doc = np.repeat(np.arange(len(counts)), n_pass)
    word_pass = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    pairs = np.unique(pass_doc[word_pass].astype(np.int64) * len(words) + codes) % len(words)
    in_docs = np.bincount(pairs, minlength=len(words))
    at, of, weight_of = (np.concatenate(x) for x in zip(*_entries(words), strict=True))
    known = np.bincount(at, in_docs[of], BUCKETS)[at] >= MIN_PAIRS
    used, at = np.unique(at[known], return_inverse=True)
    at, of, weight_of = at.astype(np.int32), of[known], weight_of[known]
    even = np.repeat(weights / n_pass, n_pass)
    goal = labels.astype(float)[pass_doc]
    e = rng.normal(0, 0.1, (len(used), DIM))
    w, b = rng.normal(0, 0.1, (DIM, 2)), np.log([1 - share, share])
    state = [np.zeros_like(x) for x in (e, w, b, e, w, b)]
    for t in range(1, STEPS + 1):
        lean = w[:, 1] - w[:, 0]
        kept = weight_of * (rng.random(len(at), dtype=np.float32) < KEPT) / np.float32(KEPT)
        scored = np.bincount(of, kept * (e @ lean)[at], len(words))
        margin = _means(scored[codes][:, None], sizes)[:, 0] + b[1] - b[0]
        p = _odds(margin)
        error = (p - goal) * even  # of class 1; of class 0 the same with the other sign
        back = np.bincount(codes, (error / np.maximum(sizes, LEAST))[word_pass], len(words))
        sub = np.bincount(at, kept * back[of], len(used))
        pull = e.T @ sub
        total = error.sum()
        for i, (x, g) in enumerate(((e, sub[:, None] * lean + DECAY * e), (w, np.stack((-pull, pull), axis=1)), (b, np.array([-total, total])))):
            m, v = state[i], state[i + 3]
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            x -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    full = np.zeros((BUCKETS, DIM))
    full[used] = e
    return Model(full, w, b)


def calibrate(margin: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Scale (positive) and shift of a logistic regression of labels on margins, by damped Newton steps."""
    if not 0 < labels.mean() < 1:
        return 1.0, 0.0
    middle, spread = np.average(margin, weights=weights), max(float(np.std(margin)), 1e-9)
    x = np.stack(((margin - middle) / spread, np.ones_like(margin)), axis=1)
    weights = weights / weights.mean()
    c = np.array([1.0, 0.0])
    for _ in range(50):
        p = _odds(x @ c)
        slope = x.T @ (weights * (labels - p)) - np.array([0.01, 0.0]) * c
        bend = (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag([0.02, 0.01])
        step = np.linalg.solve(bend, slope)
        c += step * min(1.0, 2 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    if c[0] <= 0:
        return 1.0, 0.0
    return float(c[0] / spread), float(c[1] - c[0] * middle / spread)


def learn(words: list[str], codes: np.ndarray, counts: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> Model:
    """Train on three documents of four and calibrate on the others."""
    out = np.arange(len(counts)) % 4 == 3
    of = np.repeat(out, counts)
    model = train(words, codes[~of], counts[~out], labels[~out], weights[~out])
    if out.any() and len(words):
        rows = word_scores(words, model.table)[codes[of]]
        model.scale, model.shift = calibrate(_margins(rows, counts[out], model.bias), labels[out], weights[out])
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """The model of at most ``sample`` labelled documents of each class; ``labels`` has the ids and 0/1 labels to
    learn from."""
    known = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"))
             .filter("_id is not null and label in (0, 1)").groupBy("_id").agg(F.max("label").alias("label")))
    share = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    chosen = hashed_sample(known.filter("label = 1"), ["_id"], sample).union(hashed_sample(known.filter("label = 0"), ["_id"], sample))
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(chosen), "_id")
    rows = hashed_sample(rows.select("_id", "text", "label"), ["_id", "text"], 2 * sample)  # an id may stand for many rows

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[str, int] = {}
        codes, counts, known = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch in batches:
            texts = as_large(batch.column(0))
            for a, b in slices(texts, _SLICE):
                words = Words(texts[a:b], lower=True)
                own = np.array([number.setdefault(w, len(number)) for w in words.distinct], dtype=np.int32)
                codes.append(own[words.codes])
                counts.append(words.counts)
            known.append(batch.column(1).to_numpy(zero_copy_only=False))
        y = np.concatenate(known).astype(np.int64)
        here = np.bincount(y, minlength=2)
        each = np.array([share.get(k, 0) / max(here[k], 1) for k in range(2)])
        m = learn(list(number), np.concatenate(codes), np.concatenate(counts), y, each[y])
        yield pa.RecordBatch.from_pydict({"embeddings": [m.embeddings.astype(np.float32).tobytes()], "weights": [m.weights.tolist()],
                                          "bias": [m.bias.tolist()], "scale": [m.scale], "shift": [m.shift]})

    got = rows.select("text", "label").repartition(1).mapInArrow(
        task, "embeddings binary, weights array<array<double>>, bias array<double>, scale double, shift double").collect()
    if not got:  # no partition at all
        return train([], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    r = got[0]
    return Model(np.frombuffer(r["embeddings"], np.float32).reshape(BUCKETS, DIM), np.array(r["weights"]), np.array(r["bias"]), r["scale"], r["shift"])


def _margins(rows: np.ndarray, counts: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Each document's largest margin of class 1 over its passages, from the class scores of its words."""
    sizes, n = passages(counts)
    logits = _means(rows, sizes) + bias
    return np.maximum.reduceat(logits[:, 1] - logits[:, 0], np.cumsum(n) - n)


def score_texts(texts: pa.Array, table: np.ndarray, bias: np.ndarray, scale: float = 1.0, shift: float = 0.0) -> np.ndarray:
    """Probability of label 1 of each text, from its most toxic passage."""
    words = Words(texts, lower=True)
    rows = word_scores(words.distinct, table)[words.codes] if len(words.codes) else np.zeros((0, 2))
    return _odds(scale * _margins(rows, words.counts, bias) + shift)


def score_column(spark: SparkSession, model: Model, text: str | Column = "text") -> Column:
    shared = spark.sparkContext.broadcast((model.table, model.bias, model.scale, model.shift))

    def run(texts: pa.Array) -> pa.Array:
        texts = as_large(texts)
        out = [score_texts(texts[a:b], *shared.value) for a, b in slices(texts, _SLICE)]
        return pa.array(np.concatenate(out) if out else [], pa.float64())

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "double")(F.col(text) if isinstance(text, str) else text)
