"""Prefix trie (11), embedding whitening (12) and toxicity classifier (13)."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import ODD
from pyspark.sql import functions as F

from shardloom.llm import prefixtrie, queries, toxicity, whitening
from shardloom.llm.common import as_large, documents, held_out

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- prefix trie

def _plain_trie(rows):
    """Nodes by walking every prefix of every rebuilt conversation."""
    turns = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            turns.setdefault(c, []).append((t is not None, t or 0, hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest(), (r, x)))
    turns = {c: [x[3] for x in sorted(own)] for c, own in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        rebuilt[c] = turns.get(base, [])[:h] + own[h:]
    members = {}
    for c, own in rebuilt.items():
        for d in range(len(own) + 1):
            members.setdefault(tuple(own[:d]), []).append(c)
    kids = {}
    for key in members:
        if key:
            kids.setdefault(key[:-1], []).append(key)
    out = []

    def walk(key):
        leaves, saved = (0, 0) if kids.get(key) else (1, 0)
        for k in kids.get(key, []):
            a, b = walk(k)
            leaves, saved = leaves + a, saved + b
        saved += (len(members[key]) - 1) * (len(WORD.findall(key[-1][1])) if key else 0)
        ends = ",".join(str(c) for c in sorted(c for c in members[key] if len(rebuilt[c]) == len(key)))
        out.append((min(members[key]), len(key), min(members[key[:-1]]) if key else None, len(members[key]), len(kids.get(key, [])),
                    leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    if members:
        walk(())
    return sorted(out, key=str)


TRIE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
TURNS = "conv_id long, turn long, role string, text string"


def _trie(df, **more):
    return sorted((tuple(r[c] for c in TRIE) for r in prefixtrie.trie(prefixtrie.rebuild(df), **more).collect()), key=str)


def _conversations(seed):
    rnd = random.Random(seed)
    rows = [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["hello there", "same", "", None, "other words here"]))
            for c in rnd.sample(range(-45, 130), 70) for t in rnd.sample([None, *range(5)], rnd.randrange(1, 6))]
    rows += [(200 + k, t, "user", "copy of a turn") for k in range(30) for t in range(6)]  # a large group of copies
    rows += [(7, 1, "user", "tie"), (7, 1, "user", "tie"), (7, 1, "user", "tied"), (None, 0, "user", "nobody's"), (61, 0, None, "alone " * 4000)]
    return rows


@pytest.mark.parametrize("seed,more", [(1, {}), (2, {"load": 1, "most": 1})])
def test_trie_matches_the_plain_walk(spark, seed, more):
    """Also where the sketch has too few counters to prove much: estimates that are too high change nothing."""
    rows = _conversations(seed)
    df = spark.createDataFrame(rows, TURNS).repartition(5).withColumns({c: F.lit("x") for c in ("depth", "g1", "_pid", "n", "lead")})
    assert _trie(df, **more) == _plain_trie(rows)


def test_sketch_is_exact_where_it_says_one(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "CHUNK", 1 << 8)
    rnd = np.random.default_rng(3)
    keys = np.concatenate((rnd.integers(-2**62, 2**62, (400, 2)), np.repeat(rnd.integers(-2**62, 2**62, (50, 2)), 3, axis=0)))
    df = spark.createDataFrame([tuple(map(int, k)) for k in keys], "g1 long, g2 long").repartition(4)
    bits = prefixtrie.sketch(df, len(keys), load=1, most=1 << 9)
    seen = df.withColumn("s", prefixtrie._screen(spark, bits)("g1", "g2", "g1", "g2")).collect()
    singles = {tuple(map(int, k)) for k in keys[:400]}
    assert all(r["s"] == 3 for r in seen if (r["g1"], r["g2"]) not in singles)  # never too low
    assert 50 < sum(r["s"] == 0 for r in seen)


def test_long_conversation_over_many_partitions(spark):
    rows = [(c, t, "u", f"turn {t % 7}") for c in (40, 41, 59) for t in range(300)] + [(60, 0, "u", "x")]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _trie(spark.createDataFrame(rows, TURNS).repartition(6)) == _plain_trie(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_small_conversations(spark):
    assert _trie(spark.createDataFrame([], TURNS)) == []
    one = [(5, 0, "user", "a b")]  # crc32("5") % 4 turns are taken away, no base
    assert _trie(spark.createDataFrame(one, TURNS)) == _plain_trie(one)


# ---- whitening

def test_rank_one_updates_against_eigh():
    rnd = np.random.default_rng(5)
    for d, n in ((1, 9), (2, 30), (7, 90), (24, 120)):
        x = rnd.integers(-200, 200, (n, d)).astype(float)
        x[3:9] = x[2]
        if d > 2:
            x[:, -1] = x[:, 0]  # an eigenvalue that stays zero
        s = whitening.Spectra.empty(3, d)
        for a in range(0, n, 3):
            s.add(x[a:a + 3])
        one = s.joined()
        y = x - x.mean(0)
        want = np.linalg.eigvalsh(y.T @ y)
        assert np.allclose(one.lam[0], want, rtol=0, atol=1e-4 * max(want[-1], 1)) and one.n[0] == n
        assert np.allclose(one.u[0].T @ one.u[0], np.eye(d), atol=1e-10) and np.allclose(one.mean[0], x.mean(0))


def test_rank_one_deflates_equal_and_unmoved_pairs():
    lam = np.array([[0.0, 0.0, 2.0, 2.0, 2.0, 5.0]])
    for v in (np.ones(6), np.array([0, 0, 1.0, 0, 1, 0]), np.eye(6)[5], np.zeros(6), np.array([1e-12, 0, 1, 1, 1, 1e-9])):
        got, u = whitening.rank_one(lam, np.eye(6)[None], v[None], np.array([0.7]), steps=40)
        want = np.diag(lam[0]) + 0.7 * np.outer(v, v)
        assert np.allclose(got[0], np.linalg.eigvalsh(want), atol=1e-12) and np.allclose(u[0] * got[0] @ u[0].T, want, atol=1e-11)


VECTORS = "vec_id long, embedding array<float>"


def _plain_whitening(vectors):
    c = np.array(vectors, dtype=np.float32).astype(float)
    x = np.floor(1024 * c).astype(int) + 100000
    n, sums = len(x), x.sum(0)
    y = x - sums / n
    values, parts = np.linalg.eigh(y.T @ y / n)
    k = min(8, x.shape[1])
    away = n * x.astype(object) - sums.astype(object)
    return (away * away).sum(1), (y @ parts[:, ::-1])[:, :k] / np.sqrt(values[::-1][:k]), (values[::-1] / values.sum())[:k]


@pytest.mark.parametrize("d,n,parts", [(12, 300, 7), (3, 25, 2)])
def test_whitening_matches_eigh(spark, d, n, parts):
    rnd = np.random.default_rng(d)
    data = (rnd.standard_normal((n, d)) * np.linspace(3, 0.5, d) + 40).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(n, data[0].tolist()), (None, data[1].tolist())]
    bad = [(900, None), (901, []), (902, [1.0] * (d - 1)), (903, [None] + [1.0] * (d - 1)), (904, [float("nan")] * d), (905, [float("inf")] * d)]
    df = spark.createDataFrame(rows + bad, VECTORS).repartition(parts).withColumns({c: F.lit(1) for c in ("n", "v", "part", "whitened")})
    deviation, whitened, explained = _plain_whitening([v for _, v in rows])
    got = {r["vec_id"]: r for r in whitening.whiten(df).collect()}
    assert set(got) == {i for i, _ in rows} and all(r["n"] == n + 2 for r in got.values())
    for k, (i, _) in enumerate(rows):
        r = got[i]
        assert r["deviation"] == deviation[k] and np.allclose(r["explained"], explained, rtol=1e-9)
        assert np.allclose(np.abs(r["whitened"]), np.abs(whitened[k]), atol=1e-7) and r["identity_error"] < 1e-9


def test_degenerate_vectors(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], VECTORS)).count() == 0
    same = whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], VECTORS)).collect()
    assert len(same) == 4 and all(r["whitened"] == [0.0, 0.0] and r["deviation"] == 0 and r["explained"] == [0.0, 0.0] for r in same)
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], VECTORS)).collect()
    assert all(r["explained"] == [1.0, 0.0] and r["whitened"][1] == 0.0 and r["identity_error"] < 1e-9 for r in line)
    vast = whitening.whiten(spark.createDataFrame([(0, [1e30, 0.0]), (1, [-1e30, 0.0]), (2, [0.0, 3.0])], VECTORS)).collect()
    assert len(vast) == 3 and all(np.isfinite(r["whitened"]).all() for r in vast)


def test_incremental_basis_is_nearly_the_right_one(spark):
    """The Rayleigh-Ritz step finds the projected covariance all but diagonal."""
    rows, d = whitening._clean(documents(spark, SF, "embeddings"), "vec_id", "embedding")
    assert whitening.fit(rows.repartition(6), d).off_diagonal < 1e-3


def test_registered_whitening(spark):
    got = queries.QUERIES["op12_embedding_whitening"](spark, SF).toPandas()
    vectors = documents(spark, SF, "embeddings").orderBy("vec_id").toPandas()
    deviation, whitened, explained = _plain_whitening(vectors["embedding"].tolist())
    got = got.sort_values(["vec_id", "component"])
    assert (got["deviation"].to_numpy().reshape(-1, 8)[:, 0] == deviation.astype(np.int64)).all()
    w = got["whitened"].to_numpy().reshape(-1, 8)
    assert np.allclose(w * np.sign((w * whitened).sum(0)), whitened, atol=1e-7)
    assert np.allclose(got["explained"].to_numpy().reshape(-1, 8), explained, rtol=1e-9) and (got["identity_error"] < 1e-9).all()


# ---- toxicity

def _plain_subwords(word):
    marked = f" {word} "
    return sum(max(len(marked) - k + 1, 0) for k in (3, 4, 5, 6)) + 1


def test_subwords_and_passages():
    words = ["a", "ab", "idiot", "x" * 40, "日本"]
    at, n = toxicity.subwords(words)
    assert n.tolist() == [_plain_subwords(w) for w in words] and len(at) == n.sum()
    for w in words:  # a word's subwords do not depend on the words beside it
        i = words.index(w)
        assert sorted(toxicity.subwords([w])[0]) == sorted(at[n[:i].sum():n[:i + 1].sum()])
    assert len(set(toxicity.subwords(["idiot"])[0]) & set(toxicity.subwords(["idiots"])[0])) > 3
    sizes, n = toxicity.passages(np.array([0, 1, 4, 5, 9, 17]))
    assert n.tolist() == [1, 1, 1, 2, 3, 5] and sizes.sum() == 36 and sizes.max() <= toxicity.PASSAGE


def _plain_score(text, model):
    """One document, word and subword at a time."""
    table = model.table.astype(float)

    def word(w):
        parts = [w[a:a + toxicity.LONGEST] for a in range(0, len(w), toxicity.LONGEST)]
        return np.mean([table[toxicity.subwords([p])[0]].mean(0) for p in parts], axis=0)

    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    n = max(-(-len(words) // toxicity.PASSAGE), 1)
    best, at = -np.inf, 0
    for k in range(n):
        size = len(words) // n + (k < len(words) % n)
        logits = sum((word(w) for w in words[at:at + size]), np.zeros(2)) / max(size, toxicity.LEAST) + model.bias
        best, at = max(best, logits[1] - logits[0]), at + size
    return 1 / (1 + np.exp(-(model.scale * best + model.shift)))


@pytest.fixture(scope="module")
def model(spark):
    sf = "/root/testdata/sf0.1"
    return toxicity.fit(documents(spark, sf), documents(spark, sf, "labels").filter(~held_out()), sample=1000)


def test_scores_match_the_plain_version(spark, odd, none, model):
    got = [(r["doc_id"], r["s"]) for r in odd.select("doc_id", toxicity.score_column(spark, model).alias("s")).collect()]
    assert len(got) == len(ODD)
    want = sorted((_plain_score(t, model) for _, t in ODD))
    assert np.allclose(sorted(s for _, s in got), want, atol=1e-5)
    assert none.select(toxicity.score_column(spark, model).alias("s")).count() == 0


def test_held_out_toxicity_and_unseen_misspellings(spark, model):
    sf = "/root/testdata/sf0.1"
    docs = documents(spark, sf).join(documents(spark, sf, "labels"), "doc_id").filter(held_out())
    rows = docs.select("text", "toxic", toxicity.score_column(spark, model).alias("s")).toPandas()
    y, s = rows["toxic"].to_numpy(), rows["s"].to_numpy()
    auc = (s[y == 1][:, None] > s[y == 0][None]).mean()
    assert auc > 0.9 and (s[y == 0] >= 0.5).mean() < 0.04
    insults = ["disgusting", "pathetic", "worthless"]
    seen = rows["text"].fillna("").str.lower()
    assert (s[(y == 1) & seen.str.contains("|".join(insults))] >= 0.5).mean() > 0.9
    clean = [t for t, v in zip(rows["text"], y, strict=True) if v == 0 and t and len(t) > 300][:80]
    texts = [clean, *([" ".join([*t.split()[:20], w, *t.split()[20:]]) for t in clean] for w in ("disgussting", "patheticc", "worthles"))]
    scores = [toxicity.score_texts(as_large(pa.array(x)), model.table, model.bias, model.scale, model.shift) for x in texts]
    for x in scores[1:]:  # one misspelt insult, never seen, in a clean text
        assert (x > scores[0]).mean() > 0.75 and x.mean() > 1.5 * scores[0].mean()


def test_labels_of_one_class_or_none(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    labels = spark.createDataFrame([(0, 0), (1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    for some, want in ((labels, 0.0), (labels.limit(0), 0.0), (spark.createDataFrame([(0, 1), (1, 1)], labels.schema), 1.0)):
        m = toxicity.fit(docs, some)
        got = docs.select(toxicity.score_column(spark, m).alias("s")).distinct().collect()
        assert [round(r["s"], 6) for r in got] == [want]
