"""Registered queries against their SQL, and the pipeline against the plain versions in a row."""

import brute
import corpus_pipeline
import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from shardloom.llm import langid, quality, queries
from shardloom.llm.common import Words, as_large, documents, encoder, held_out, tokenizer_path
from shardloom.plans import check


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, monkeypatch, name):
    monkeypatch.setattr(check, "QUERIES", queries.QUERIES)
    monkeypatch.setattr(check, "ORACLE", queries.ORACLE)
    r = check.compare(spark, SF_SMALL, name)
    assert r["spark_rows"] > 0 and r["status"] == ("match" if name in queries.ORACLE else "rows-only"), r


def test_every_operator_and_the_pipeline_are_registered():
    names = set(queries.QUERIES)
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "line_dedup", "ngram_jaccard_join", "packing"]


def _language(text, model):
    """Viterbi, one document and word at a time."""
    import pyarrow as pa
    names, logs, allowed = model
    words = Words(as_large(pa.array([text or ""])))
    each, lettered = langid.word_scores(words.distinct, logs, allowed)
    scores = [each[c] for c in words.codes]
    if not any(lettered[c] for c in words.codes):
        return "und", 0.0
    best, back = scores[0].astype(float), []
    for s in scores[1:]:
        came = [j if best[j] >= best.max() - langid.SWITCH else int(best.argmax()) for j in range(len(names))]
        best = np.maximum(best, best.max() - langid.SWITCH) + s
        back.append(came)
    path = [int(best.argmax())]
    for came in reversed(back):
        path.append(came[path[-1]])
    labels = path[::-1]
    votes = [sum(1 for x, c in zip(labels, words.codes) if x == j and lettered[c]) for j in range(len(names))]
    return names[int(np.argmax(votes))], max(votes) / sum(votes)


def test_pipeline_matches_the_plain_versions(spark):
    table = documents(spark, SF_SMALL)
    docs = [(r["doc_id"], r["text"]) for r in table.orderBy("doc_id").collect()]
    model = langid.train(table.filter(~held_out()))
    docs = [(i, t) for i, t in docs if (r := _language(t, model))[0] != "und" and r[1] >= 0.5]

    good = {r[0] for r in documents(spark, SF_SMALL, "labels").filter((F.col("quality") == 1) & ~held_out()).select("doc_id").collect()}
    ratio = brute.ratios(docs, good, quality.BUCKETS, quality.PRIOR)
    docs = [(i, t) for i, t in docs if not brute.base(t)["base_failed"] and brute.quality_score(t, ratio, quality.BUCKETS) >= quality.THRESHOLD]

    docs = [(i, x[2]) for (i, _), x in zip(docs, brute.drop_lines([t for _, t in docs], 10))]

    group, sets = brute.groups([t for _, t in docs], 5, 80, 100)
    docs = [d for k, d in enumerate(docs) if group[k] == k or not sets[k]]

    want = sorted((i, *p, len(ids)) for i, t in docs
                  for ids in [encoder(tokenizer_path()).tokenizer.encode(t, add_special_tokens=False).ids + [1]]
                  for p in brute.pieces(ids, 2048))
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted(tuple(r[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")) for r in got) == want
    assert len(docs) > 50


def test_stages_keep_columns_and_stand_odd_rows(spark, odd, none):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = odd.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    empty = none.select("doc_id", "text", "lang", F.lit("s").alias("source"), F.lit(0).cast("long").alias("n_chars"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, SF_SMALL)
        assert out.columns == columns and dict(out.dtypes) == dict(rows.dtypes), name
        out.collect()
        assert stage(spark, empty, SF_SMALL).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SF_SMALL).count() == 0


def test_clean_labelled_documents_pass_the_filters(spark):
    """Of the clean held-out documents of fifty words or more, the two filtering stages keep all."""
    sf = "/root/testdata/sf0.01"
    docs = documents(spark, sf)
    clean = {r["doc_id"] for r in docs.join(documents(spark, sf, "labels"), "doc_id").filter("quality = 1").filter(held_out()).collect()
             if not brute.base(r["text"])["base_failed"]}
    for _, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, sf).checkpoint()
        assert clean <= {r["doc_id"] for r in docs.select("doc_id").collect()}
