"""Quality rules (1) and fingerprints (9) against plain versions."""

import re
import brute
import pytest
from conftest import ODD, SF_SMALL, rows
from pyspark.sql import functions as F

from shardloom.llm import imatch, quality
from shardloom.llm.common import documents, held_out

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_counts_of_odd_rows(spark, odd):
    model = quality.fit(odd, odd.filter("doc_id in (1, 2, 3)"), buckets=256)
    got = rows(quality.score(odd, model, buckets=256), "doc_id", *BASE)
    want = [(i, *[brute.base(t)[c] for c in BASE]) for i, t in ODD]
    assert got == sorted(want, key=lambda r: [(x is not None, x) for x in r])


def test_scores_and_verdicts_match_the_plain_version(spark):
    docs = documents(spark, SF_SMALL)
    trusted = documents(spark, SF_SMALL, "labels").filter((F.col("quality") == 1) & ~held_out())
    good = {r[0] for r in trusted.select("doc_id").collect()}
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    model, threshold = brute.ratios(texts, good, quality.BUCKETS, quality.PRIOR), quality.THRESHOLD
    fitted = quality.fit(docs, trusted)
    assert fitted.threshold == threshold
    got = {r["doc_id"]: r for r in quality.score(docs, fitted).collect()}
    assert len(got) == len(texts)
    for i, text in texts:
        want = brute.quality_score(text, model, quality.BUCKETS)
        assert got[i]["score"] == pytest.approx(want, abs=2e-6)
        if abs(want - threshold) > 1e-5:
            assert got[i]["kept"] == (not brute.base(text)["base_failed"] and want >= threshold)


@pytest.mark.parametrize("sf_dir, least", [(SF_SMALL, 10), ("/root/testdata/sf0.01", 50)])
def test_quality_labels_of_held_out_rows(spark, sf_dir, least):
    """Clean labelled documents of fifty words or more are kept; most junk goes."""
    from shardloom.llm import queries
    out = queries.QUERIES["op1_quality_rules"](spark, sf_dir)
    seen = out.join(documents(spark, sf_dir, "labels"), "doc_id").filter(held_out()).collect()
    clean = [r for r in seen if r["quality"] == 1 and not r["base_failed"]]
    junk = [r for r in seen if r["quality"] == 0]
    assert len(clean) > least and all(r["kept"] for r in clean)
    assert sum(not r["kept"] for r in junk) >= 0.9 * len(junk)


def test_verdicts_do_not_move_with_the_size_of_the_corpus(spark):
    """A corpus joined by three copies of itself, under other ids, keeps every score and verdict."""
    docs = documents(spark, SF_SMALL).select("doc_id", "text")
    trusted = documents(spark, SF_SMALL, "labels").filter((F.col("quality") == 1) & ~held_out())
    many = docs
    for k in (1, 2, 3):
        many = many.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1_000_000 * k))
    alone, grown = ({r["doc_id"]: (r["kept"], r["score"]) for r in quality.score(docs, quality.fit(d, trusted)).collect()} for d in (docs, many))
    assert alone == grown and len({k for k, _ in alone.values()}) == 2


def test_nothing_is_kept_without_trusted_documents(spark):
    docs = documents(spark, SF_SMALL)
    model = quality.fit(docs, docs.limit(0))
    got = quality.score(docs, model).collect()
    assert len(got) == docs.count() and not any(r["kept"] for r in got) and {r["score"] for r in got} <= {0.0, None}
    assert quality.filter_documents(docs, model).count() == 0


def test_empty_tables(spark, none):
    assert quality.score(none, quality.fit(none, none)).count() == 0
    assert imatch.fingerprint_edits(none).count() == 0


def _edits(texts):
    """texts in order -> edited texts and the next of each."""
    following = texts[1:] + texts[:1]
    cut = [len(t) // 3 for t in texts]
    return [t[:len(t) - c] + n[:c] for t, n, c in zip(texts, following, cut)], following


def test_fingerprints_match_the_plain_version(spark):
    docs = documents(spark, SF_SMALL)
    low, high = 0.01, 0.2
    ordered = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)
    texts = [t for _, t in ordered]
    df = {}
    for t in texts:
        for x in brute.terms(t):
            df[x] = df.get(x, 0) + 1
    lexicon = {x for x, n in df.items() if low * len(texts) <= n <= high * len(texts)}
    edited, following = _edits(texts)
    got = {r["doc_id"]: r for r in imatch.fingerprint_edits(docs, low=low, high=high).collect()}
    assert len(got) == len(texts)

    def printed(p):
        return ".".join("-" if x is None else f"{x:08x}" for x in p)

    for (i, text), e, n in zip(ordered, edited, following):
        p, q, r = (brute.fingerprint(x, lexicon) for x in (text, e, n))
        g = got[i]
        assert (g["n_chars"], g["edited_sha256"]) == (len(text), brute.sha256(e))
        assert g["fingerprint"] == printed(p) and g["edited_fingerprint"] == printed(q)
        assert g["near_edited"] == pytest.approx(brute.likeness(p, q)) and g["near_next"] == pytest.approx(brute.likeness(p, r))


def test_registered_fingerprints_match_the_plain_version(spark):
    """Two bands, as the registered query has them: document frequency over distinct texts, both likenesses from
    what the fingerprints print."""
    docs = documents(spark, SF_SMALL)
    low, high = 0.01, 0.2
    ordered = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)
    texts = [t for _, t in ordered]
    df = {}
    for t in set(texts):
        for x in brute.terms(t):
            df[x] = df.get(x, 0) + 1
    n = len(set(texts))
    lexicon, common = {x for x, k in df.items() if low * n <= k <= high * n}, {x for x, k in df.items() if k > imatch.WIDE * n}
    assert common
    edited, following = _edits(texts)

    def printed(text):
        mark = "~" if len(brute.terms(text) & lexicon) < imatch.FEW else "|"
        return mark.join(".".join("-" if x is None else f"{x:08x}" for x in brute.fingerprint(text, words))
                         for words in (lexicon, brute.terms(text) - common))

    def like(a, b):  # from the printed texts alone
        band = 1 if "~" in a + b else 0
        return brute.likeness(*([None if x == "-" else x for x in re.split("[|~]", t)[band].split(".")] for t in (a, b)))

    got = {r["doc_id"]: r for r in imatch.fingerprint_edits(docs, low=low, high=high, wide=imatch.WIDE).collect()}
    kinds = set()
    for (i, text), e, f in zip(ordered, edited, following):
        g = got[i]
        p, q, r = (printed(x) for x in (text, e, f))
        assert (g["fingerprint"], g["edited_fingerprint"]) == (p, q)
        assert g["near_edited"] == pytest.approx(like(p, q)) and g["near_next"] == pytest.approx(like(p, r))
        kinds.add(("~" in p, "~" in q))
    assert len(kinds) > 2  # also pairs of which one has too few lexicon terms


def test_fingerprints_beyond_the_broadcast_bounds(spark, monkeypatch):
    docs = documents(spark, SF_SMALL)
    want = sorted(map(tuple, imatch.fingerprint_edits(docs, wide=imatch.WIDE).collect()))
    monkeypatch.setattr(imatch, "BROADCAST_TERMS", 0)
    assert sorted(map(tuple, imatch.fingerprint_edits(docs, wide=imatch.WIDE).collect())) == want


def test_fingerprints_of_odd_rows(spark, odd):
    """Ids in descending order, null ids last; rows that repeat id and text are one place in the order."""
    got = imatch.fingerprint_edits(odd, low=0.05, high=0.9).collect()
    assert len(got) == len(ODD)
    by = {}
    for r in got:
        by.setdefault((r["doc_id"], r["n_chars"]), []).append(r)
    assert len(by[(11, len(ODD[0][1]))]) == 2 and len(by[(None, len(ODD[11][1]))]) == 2
    same = {r["fingerprint"] for r in got if r["n_chars"] == len(ODD[0][1]) and r["doc_id"] in (1, 2, 11)}
    assert len(same) == 1
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    # 17 is the largest id, the next is 15 (one line break)
    last = by[(17, len(ODD[-1][1]))][0]
    text = ODD[-1][1]
    assert last["edited_sha256"] == brute.sha256(text[:len(text) - len(text) // 3] + "\n")
    alone = imatch.fingerprint_edits(odd.filter("doc_id = 8")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0 and alone[0]["edited_sha256"] == brute.sha256("worw")


def test_equal_texts_have_equal_fingerprints(spark):
    docs = documents(spark, SF_SMALL)
    terms = imatch.lexicon(docs).checkpoint()
    twice = docs.union(docs.withColumn("doc_id", F.col("doc_id") + 100_000))
    got = imatch.fingerprint(twice, terms).collect()
    prints = {r["doc_id"]: r["fingerprint"] for r in got}
    assert len(prints) == 2 * docs.count()
    assert all(prints[i] == prints[i + 100_000] for i in prints if i < 100_000)


def test_large_groups_of_copies_keep_evidence(spark):
    """A third of all rows are near copies of one text, and a fifth are exact copies of another one."""
    docs = documents(spark, SF_SMALL).select("doc_id", "text")
    long = [r["text"] for r in docs.orderBy(F.length("text").desc(), "doc_id").limit(2).collect()]
    at = len(long[0]) // 2
    near = [(100_000 + k, f"{long[0][:at]} changed{k} {long[0][at:]}") for k in range(130)]
    copies = [(200_000 + k, long[1]) for k in range(80)]
    many = docs.union(spark.createDataFrame(near + copies, "doc_id long, text string"))
    got = {r["doc_id"]: r for r in imatch.fingerprint_edits(many, wide=imatch.WIDE).collect()}
    assert len(got) == docs.count() + 210
    # the edits share the texts' terms; a group's next document is one of the group, but for the last one's
    assert all(got[i]["near_edited"] > 0.1 for i, _ in near + copies)
    assert all(got[i]["near_next"] > 0.5 for i, _ in near[1:])
    # exact copies do not crowd their terms out of the lexicon
    with_copies, without = (imatch.lexicon(d, wide=imatch.WIDE).filter("not common")
                            for d in (docs.union(spark.createDataFrame(copies, "doc_id long, text string")), docs))
    assert {r["key"] for r in with_copies.collect()} == {r["key"] for r in without.collect()}
    # unrelated documents are not alike by the second band
    others = sorted(r["near_next"] for i, r in got.items() if i < 100_000)
    assert others[len(others) // 2] < 0.2


def test_shuffled_texts_are_gone_when_fingerprints_meet(spark):
    """The texts' shuffle files are removed before the fingerprints are joined."""
    import random
    import time

    from shardloom.llm.common import release

    rnd = random.Random(9)
    texts = ["".join(rnd.choice("abcdefghij     ") for _ in range(10_000)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").checkpoint()
    files = spark._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled():
        found, total = files.getAllFiles().iterator(), 0
        while found.hasNext():
            f = found.next()
            total += f.length() if f.getName().startswith("shuffle_") else 0
        return total

    release(spark)
    time.sleep(3)
    before = shuffled()
    out = imatch.fingerprint_edits(docs, wide=imatch.WIDE)
    for _ in range(20):
        if shuffled() - before < 500_000:
            break
        time.sleep(1)
    assert shuffled() - before < 500_000
    assert out.count() == 300
