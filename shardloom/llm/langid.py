"""Language identification by Viterbi over per-word scores.

Training counts, for every language of the labelled rows, hashed character bigrams, trigrams and
whole words (lower-cased, with word boundaries), and how many words each script has.  Partitions
emit sums, so the shuffle holds at most languages x (buckets + scripts) rows for each task; the model
(languages x buckets floats) is broadcast, its size fixed by ``BUCKETS`` and checked against
``MAX_LANGUAGES``.

Prediction: the script of a word's first letter (Unicode ranges) narrows the candidate languages to
those that write at least ``SCRIPT_SHARE`` of their words in it; a word's score in a language is the
sum of its features' log probabilities.  Viterbi then finds, for each document, the labelling of all
its words that maximises the sum of scores less ``switch`` for each change of language.  Documents
of a slice advance in step, longest first, so the work per word is a few array operations.  The
document's language is the label of most of its words with letters (the first name on ties), the
score their share.

Defined results: null or letterless texts give ``und`` with score 0; words without letters take the
language around them; with no labelled rows everything is ``und``; rows are independent, so repeated
rows get equal results; an empty table gives no rows.  Only the text is an input of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, as_large, slices

BUCKETS = 1 << 16
MAX_LANGUAGES = 512
SCRIPT_SHARE = 0.001
SWITCH = 8.0
UNKNOWN = "und"
#: bytes of text at a time: a character's features take about fifty times its size
SLICE = 1 << 20
#: fixed values: first and last code point of the blocks of each script
SCRIPTS = (
    ("latin", ((0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xB5, 0xB5), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F),)),
    ("armenian", ((0x530, 0x58F),)),
    ("hebrew", ((0x590, 0x5FF),)),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF))),
    ("indic", ((0x900, 0xDFF),)),
    ("thai", ((0xE00, 0xE7F),)),
    ("georgian", ((0x10A0, 0x10FF),)),
    ("ethiopic", ((0x1200, 0x137F),)),
    ("hangul", ((0x1100, 0x11FF), (0xAC00, 0xD7AF))),
    ("kana", ((0x3040, 0x30FF),)),
    ("han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FFFF))),
)
OTHER, NONE = len(SCRIPTS), len(SCRIPTS) + 1  # another script; no letter
_EDGES = sorted((a, b, i) for i, (_, blocks) in enumerate(SCRIPTS) for a, b in blocks)
_FIRST, _LAST, _SCRIPT = (np.array(x) for x in zip(*_EDGES, strict=True))
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(48)).astype(np.int64) % BUCKETS


def word_features(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, number of features of each word, script of each word); a word's
    features lie together."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    cp = np.frombuffer((" " + " ".join(words).lower() + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    blank = cp == 32
    word_of = np.cumsum(blank) - 1  # a space counts to the word after it
    x = cp.astype(np.uint64)
    with np.errstate(over="ignore"):
        two = x[:-1] * _MULT[0] + x[1:] * _MULT[1] + np.uint64(7)
        three = two[:-1] + x[2:] * _MULT[2]
        middle = ~blank[1:-1]
        tri, tri_word = three[middle], word_of[1:-1][middle]
        mixed = (tri ^ (tri >> np.uint64(31))) * _MULT[0]
        first = np.flatnonzero(np.diff(tri_word, prepend=-1))
        whole = np.add.reduceat(mixed, first) + np.uint64(1)
    n = len(words)
    of = np.concatenate((word_of[:-1], tri_word, np.arange(n)))
    at = np.concatenate((_bucket(two), _bucket(tri), _bucket(whole)))
    order = np.argsort(of, kind="stable")
    at, counts = at[order], np.bincount(of, minlength=n)
    # the script of the first letter
    seen, which = np.unique(cp, return_inverse=True)
    letters = np.flatnonzero(np.array([chr(c).isalpha() for c in seen.tolist()])[which])
    script = np.full(n, NONE)
    if len(letters):
        one = letters[np.flatnonzero(np.diff(word_of[letters], prepend=-1))]
        block = np.searchsorted(_FIRST, cp[one], side="right") - 1
        inside = (block >= 0) & (cp[one] <= _LAST[np.maximum(block, 0)])
        script[word_of[one]] = np.where(inside, _SCRIPT[np.maximum(block, 0)], OTHER)
    return at, counts, script


def train(labelled: DataFrame, text: str | Column = "text", lang: str | Column = "lang"):
    """(languages, log probabilities [bucket, language], allowed [script, language])."""
    text, lang = (F.col(c) if isinstance(c, str) else c for c in (text, lang))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, names = as_large(batch.column(0)), pc.dictionary_encode(batch.column(1))
            codes, known = names.indices.to_numpy(zero_copy_only=False), names.dictionary.to_pylist()
            for a, b in slices(texts, SLICE):
                words = Words(texts[a:b])
                if not len(words.codes):
                    continue
                at, n, script = word_features(words.distinct)
                d = len(words.distinct)
                times = np.bincount(np.repeat(codes[a:b].astype(np.int64), words.counts) * d + words.codes,
                                    minlength=len(known) * d).reshape(len(known), d)
                for i, name in enumerate(known):
                    if times[i].any():
                        one = np.bincount(at, np.repeat(times[i], n), BUCKETS + NONE + 1)
                        one[BUCKETS:] += np.bincount(script, times[i], NONE + 1)
                        sums[name] = sums[name] + one if name in sums else one
        for name, all_of in sums.items():
            at = np.flatnonzero(all_of)
            yield pa.RecordBatch.from_pydict({"lang": [name] * len(at), "at": pa.array(at, pa.int32()),
                                              "n": pa.array(all_of[at].astype(np.int64))})

    rows = (labelled.select(text.alias("t"), lang.cast("string").alias("l")).filter("l is not null and t is not null")
            .mapInArrow(count, "lang string, at int, n long").groupBy("lang", "at").agg(F.sum("n").alias("n")))
    found = rows.toArrow()
    names = sorted(pc.unique(found["lang"]).to_pylist())
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"{len(names)} languages; the model is broadcast for at most {MAX_LANGUAGES}")
    table = np.zeros((BUCKETS + NONE + 1, max(len(names), 1)))
    if names:
        col = pc.index_in(found["lang"], pa.array(names)).to_numpy()
        table[found["at"].to_numpy(), col] = found["n"].to_numpy()
    grams, script = table[:BUCKETS], table[BUCKETS:]
    logs = np.log((grams + 0.5) / (grams.sum(0) + 0.5 * BUCKETS)).astype(np.float32)
    allowed = script >= SCRIPT_SHARE * np.maximum(script.sum(0), 1)
    allowed[~allowed.any(1)] = True  # a script that no language writes narrows nothing
    return names, logs, allowed


def word_scores(words: Sequence[str], logs: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """([word, language] scores, whether the word has a letter)."""
    at, n, script = word_features(words)
    if not len(n):
        return np.zeros((0, logs.shape[1]), np.float32), np.zeros(0, bool)
    scores = np.stack([np.add.reduceat(logs[at, j], np.cumsum(n) - n) for j in range(logs.shape[1])], axis=1)
    scores = np.where(allowed[script], scores, scores.min(1, keepdims=True) - 50)
    lettered = script != NONE
    scores[~lettered] = 0
    return scores - scores.max(1, keepdims=True), lettered


def viterbi(scores: np.ndarray, counts: np.ndarray, switch: float) -> np.ndarray:
    """Best label of each word; ``scores`` has the words of all documents one after another."""
    labels = np.zeros(len(scores), dtype=np.int32)
    if not len(scores):
        return labels
    order = np.argsort(-counts, kind="stable")
    counts, starts = counts[order], (np.cumsum(counts) - counts)[order]
    active = np.searchsorted(-counts, -np.arange(int(counts[0])), side="left")  # documents longer than t
    from_best = np.zeros(scores.shape, dtype=bool)  # the step came by a switch
    best_before = np.zeros(len(scores), dtype=np.int32)
    total = scores[starts[:active[0]]].astype(np.float64)
    for t in range(1, len(active)):
        n = active[t]
        total_n, at = total[:n], starts[:n] + t
        best_before[at] = total_n.argmax(1)
        moved = total_n.max(1, keepdims=True) - switch
        from_best[at] = moved > total_n
        np.maximum(total_n, moved, out=total_n)
        total_n += scores[at]
    state = total.argmax(1)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        labels[at] = state[:n]
        if t:
            state[:n] = np.where(from_best[at, state[:n]], best_before[at], state[:n])
    return labels


def _predict(model, switch: float, spans: bool):
    kind = [("lang_pred", pa.string()), ("score", pa.float64())]
    if spans:
        kind.append(("spans", pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("lang", pa.string())]))))

    def run(texts: pa.Array) -> pa.Array:
        names, logs, allowed = model.value
        texts, langs, scores, found = as_large(texts), [], [], []
        for a, b in slices(texts, SLICE):
            words = Words(texts[a:b])
            each, lettered = word_scores(words.distinct, logs, allowed)
            letter = lettered[words.codes]
            labels = viterbi(each[words.codes], words.counts, switch) if names else np.zeros(len(words.codes), np.int32)
            doc = np.repeat(np.arange(b - a), words.counts)
            votes = np.bincount(doc[letter] * logs.shape[1] + labels[letter], minlength=(b - a) * logs.shape[1])
            votes = votes.reshape(b - a, -1)
            n, top = votes.sum(1), votes.argmax(1)
            known = (n > 0) & bool(names)
            langs += [names[j] if ok else UNKNOWN for j, ok in zip(top.tolist(), known.tolist(), strict=True)]
            scores.append(np.where(known, votes.max(1) / np.maximum(n, 1), 0.0))
            if spans:
                for i, ok in enumerate(known.tolist()):
                    own = labels[words.starts[i]:words.starts[i + 1]]
                    cut = np.flatnonzero(np.diff(own, prepend=-1)) if ok else np.zeros(0, np.int64)
                    size = np.diff(cut, append=len(own)) if ok else cut
                    found.append([{"first_word": f, "n_words": s, "lang": names[own[f]]}
                                  for f, s in zip(cut.tolist(), size.tolist(), strict=True)])
        columns = [pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())]
        return pa.StructArray.from_arrays(columns + ([pa.array(found, kind[2][1])] if spans else []),
                                          fields=[pa.field(*k) for k in kind])

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    more = ", spans array<struct<first_word bigint, n_words bigint, lang string>>" if spans else ""
    return F.arrow_udf(run, f"struct<lang_pred string, score double{more}>")


def language_column(spark, model, text: str | Column = "text", switch: float = SWITCH, spans: bool = False) -> Column:
    """A struct column (lang_pred, score, and spans if asked for) for a text column."""
    shared = spark.sparkContext.broadcast(model)
    return _predict(shared, switch, spans)(F.col(text) if isinstance(text, str) else text)


def identify(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", switch: float = SWITCH, spans: bool = False) -> DataFrame:
    """doc_id, lang_pred, score (and the labelled spans of words) of every document."""
    model = train(labelled, text_col, lang_col)
    out = docs.select(F.col(id_col).alias("doc_id"),
                      language_column(docs.sparkSession, model, text_col, switch, spans).alias("r"))
    return out.select("doc_id", "r.*")


def filter_documents(docs: DataFrame, labelled: DataFrame, min_score: float = 0.5, text_col: str = "text",
                     lang_col: str = "lang", switch: float = SWITCH) -> DataFrame:
    """The rows of ``docs`` with a language: not ``und``, and at least ``min_score`` of the words in it."""
    model = train(labelled, text_col, lang_col)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      language_column(docs.sparkSession, model, text_col, switch).alias("r"))
    return row.filter((F.col("r.lang_pred") != UNKNOWN) & (F.col("r.score") >= min_score)).select("row.*")
