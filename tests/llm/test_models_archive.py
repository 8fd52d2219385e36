"""WARC audit (6), neighbour classifier (7) and language identification (10)."""

import itertools
import os
import random
import shutil

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import ODD, SF_SMALL
from pyspark.sql import functions as F

from shardloom.llm import knn, langid, queries, warc
from shardloom.llm.common import as_large, documents, held_out
from shardloom.session import scratch_path

SF = "/root/testdata/sf0.01"


# ---- WARC

def _record(url, body):
    raw = (body or "").encode()
    return (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: {url or ''}\r\nContent-Type: text/html\r\n"
            f"Content-Length: {len(raw)}\r\n\r\n").encode() + raw + b"\r\n\r\n"


def _pages(spark, n):
    rnd = random.Random(n)
    rows = [(i, f"http://h/{i}", "é" * rnd.randrange(5) + "x" * rnd.randrange(90)) for i in range(n)]
    rows += [(n, None, None), (None, "http://null/1", "a"), (None, "http://null/2", "b"), (n + 1, "u", "same"), (n + 1, "u", "same")]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string")


def test_audit_finds_exactly_the_damage(spark):
    rows, pages = _pages(spark, 300)
    hurt = pages.filter("page_id is null or page_id not in (7, 8, 299)").withColumn(
        "html", F.when(F.col("page_id").isin(20, 150), F.lit("changed")).otherwise(F.col("html")))
    hurt = hurt.union(spark.createDataFrame([(900, "http://new", "z")], pages.schema))
    got = {(r["id"], r["status"]): r for r in warc.audit_tables(pages, hurt).collect()}
    assert set(got) == {(7, "missing"), (8, "missing"), (299, "missing"), (20, "altered"), (150, "altered"), (900, "extra")}
    plain = sorted(rows, key=lambda r: (r[0] is not None, r[0], brute.hashlib.sha256(_record(*r[1:])).hexdigest()))
    at = 0
    for k, r in enumerate(plain):
        size = len(_record(*r[1:]))
        if (r[0], "altered") in got:
            g = got[(r[0], "altered")]
            assert (g["seq"], g["offset"], g["length"]) == (k, at, size)
            assert g["primary_sha256"] == brute.hashlib.sha256(_record(*r[1:])).hexdigest()
            assert g["replica_sha256"] == brute.hashlib.sha256(_record(r[1], "changed")).hexdigest()
        at += size


def test_equal_and_empty_replicas(spark):
    _, pages = _pages(spark, 40)
    assert warc.audit_tables(pages, pages).count() == 0
    nothing = pages.limit(0)
    assert warc.audit_tables(nothing, nothing).count() == 0
    assert warc.audit_tables(pages, nothing).count() == 45


def test_files_are_scanned_where_they_lie(spark):
    rows, pages = _pages(spark, 60)
    path = scratch_path(spark, "test-warc")
    manifest = warc.write_warc(pages, path, per_file=16).orderBy("file", "seq").collect()
    names = sorted({r["file"] for r in manifest})
    assert len(names) == 5
    whole = b"".join(open(f"{path}/{n}", "rb").read() for n in names)
    assert len(whole) == sum(r["length"] for r in manifest) and sorted(whole) == sorted(b"".join(_record(*r[1:]) for r in rows))
    leaves = spark.createDataFrame([(r["file"], r["seq"], r["length"], r["digest"]) for r in manifest], warc.LEAF)
    assert warc.audit(leaves, warc.scan_warc(spark, path, names)).count() == 0
    # one byte of one record's body is flipped on the second replica
    hit = next(r for r in manifest if r["file"] == names[2] and r["length"] > 150)
    with open(f"{path}/{names[2]}", "r+b") as f:
        f.seek(hit["offset"] + hit["length"] - 6)
        byte = f.read(1)
        f.seek(-1, 1)
        f.write(bytes([byte[0] ^ 1]))
    bad = warc.audit(leaves, warc.scan_warc(spark, path, names)).collect()
    assert [(r["file"], r["seq"], r["status"]) for r in bad] == [(names[2], hit["seq"], "altered")]


def test_damaged_headers_are_located(spark):
    """A bad header byte, a changed length, a long url and a longer record do not hide the records behind them."""
    pages = spark.createDataFrame([(i, "u" * 70_000 if i == 9 else f"http://x/{i}", "b" * (200 + i)) for i in range(16)],
                                  "page_id long, url string, html string")
    path = scratch_path(spark, "test-warc-headers")
    manifest = warc.write_warc(pages, path, per_file=16)
    at = {r["seq"]: (r["offset"], r["length"]) for r in manifest.collect()}
    name = f"{path.removeprefix('file://').removeprefix('file:')}/00000000.warc"
    with open(name, "rb") as f:
        whole = f.read()
    parts = [whole[a:a + n] for a, n in (at[k] for k in range(16))]
    parts[2] = b"X" + parts[2][1:]
    parts[5] = parts[5].replace(b"Content-Length: 205", b"Content-Length: 905")
    parts[7] = parts[7].replace(b"Content-Length: 207", b"Content-Length: 208").replace(b"\r\n\r\nb", b"\r\n\r\nbb")
    parts[15] = parts[15].replace(b"Content-Length: 215", b"Content-Length: 915")
    with open(name, "wb") as f:
        f.write(b"".join(parts))
    leaves = manifest.select("file", "seq", "length", "digest")
    bad = warc.audit(leaves, warc.scan_warc(spark, path, ["00000000.warc"], manifest)).collect()
    assert sorted((r["seq"], r["status"]) for r in bad) == [(k, "altered") for k in (2, 5, 7, 15)]


@pytest.mark.parametrize("gzip", [False, True])
def test_archives_round_trip_and_replicas_are_audited(spark, gzip):
    rows, pages = _pages(spark, 60)
    primary, replica = scratch_path(spark, "test-primary"), scratch_path(spark, "test-replica")
    manifest = warc.write_warc(pages, primary, per_file=16, gzip=gzip)
    by_seq = {(r["file"], r["seq"]): r for r in manifest.collect()}
    back = warc.read_warc(spark, primary).collect()
    assert sorted(bytes(r["record"]) for r in back) == sorted(_record(*r[1:]) for r in rows)
    assert {(r["file"], r["at"]): brute.hashlib.sha256(r["record"]).hexdigest() for r in back} == {k: r["digest"] for k, r in by_seq.items()}
    assert not [n for n in os.listdir(primary) if n.startswith(".0")]
    # the replica lost three records of one file and has another body in a record behind them
    gone, other = [1, 2, 9], 12
    copied = warc.read_warc(spark, primary).filter(~((F.col("file") == "00000001.warc") & F.col("at").isin(gone))).select(
        "file", F.col("at").alias("seq"), F.when((F.col("file") == "00000001.warc") & (F.col("at") == other),
                                                 F.lit(_record("u", "new").decode()).cast("binary")).otherwise(F.col("record")).alias("record"))
    warc.write_records(copied, replica, gzip=gzip)
    got = {(r["file"], r["seq"]): r for r in warc.audit_archives(spark, primary, replica, manifest).collect()}
    assert {k[1]: r["status"] for k, r in got.items()} == {**{k: "missing" for k in gone}, other: "altered"}
    for k, r in got.items():
        assert (r["id"], r["offset"], r["primary_sha256"]) == tuple(by_seq[k][c] for c in ("id", "offset", "digest"))
    assert got["00000001.warc", other]["replica_sha256"] == brute.hashlib.sha256(_record("u", "new")).hexdigest()
    assert warc.audit_archives(spark, primary, primary, manifest).count() == 0


def test_damaged_members_are_located(spark):
    """A flipped byte, a bad member header, a hole over three members and bytes at the end hide no other record."""
    _, pages = _pages(spark, 40)
    primary, replica = scratch_path(spark, "test-gzip"), scratch_path(spark, "test-gzip-replica")
    manifest = warc.write_warc(pages, primary, per_file=64, gzip=True)
    shutil.copytree(primary, replica)
    starts = [r["start"] for r in warc.catalogue(spark, replica).orderBy("at").collect()]
    name = f"{replica}/00000000.warc"
    raw = bytearray(open(name, "rb").read())
    raw[0] ^= 1
    raw[starts[6] - 12] ^= 4
    raw[starts[20]] ^= 1
    raw[starts[30]:starts[33]] = bytes(starts[33] - starts[30])
    with open(name, "wb") as f:
        f.write(raw + b"tail")
    found = warc.audit_archives(spark, primary, replica, manifest).collect()
    by = {r["seq"]: r["status"] for r in found}
    assert by == {0: "altered", 5: "altered", 20: "altered", 30: "altered", 31: "missing", 32: "missing", None: "extra"}


def test_copies_beyond_one_task_and_odd_archives(spark, monkeypatch):
    """One record's copies fill more than two of the files, one file to a task; every copy has its place."""
    monkeypatch.setattr(warc, "TASKS", 1000)
    rows = [(i, f"http://h/{i}", "x" * i) for i in range(20)] + [(7, "same", "copy")] * 41 + [(None, None, None)] * 9
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("task", F.lit(1)).withColumn("r", F.lit("x")).repartition(5)
    path = scratch_path(spark, "test-copies")
    manifest = warc.write_warc(pages, path, per_file=16, gzip=True)
    listed = {(r["file"], r["seq"]): r["digest"] for r in manifest.collect()}
    back = {(r["file"], r["seq"]): r["digest"] for r in warc.scan_warc(spark, path).collect()}
    assert len(listed) == 70 and back == listed
    few = warc.write_warc(pages, scratch_path(spark, "test-few"), per_file=16)
    assert {(r["file"], r["seq"]): r["digest"] for r in few.collect()} == listed
    empty, nothing = scratch_path(spark, "test-none"), pages.limit(0)
    none = warc.write_warc(nothing, empty, gzip=True)
    assert none.count() == 0 and warc.scan_warc(spark, empty).count() == 0 and warc.read_warc(spark, empty).count() == 0
    assert warc.audit_archives(spark, empty, empty, none).count() == 0
    assert warc.audit_archives(spark, path, empty, manifest).count() == 70


# ---- quality classifier

def test_votes_match_a_plain_search(spark):
    rnd = np.random.default_rng(1)
    texts = [r["text"] for r in documents(spark, SF_SMALL).select("text").collect()]
    counts, shape = knn.features(as_large(pa.array(texts)))
    labels = rnd.integers(0, 2, 120)
    model = knn.Model(counts[:120], shape[:120], labels)
    got = model.score(counts, shape)
    x = model.combined(counts, shape) @ model.projection
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    for i in range(len(texts)):
        sims = [(float(x[i] @ v), j) for j, v in enumerate(model.vectors)]
        top = sorted(sims, reverse=True)[:knn.NEIGHBOURS]
        w = [max(s, 0) ** 3 for s, _ in top]
        want = sum(a * labels[j] for a, (_, j) in zip(w, top)) / sum(w)
        assert got[i] == pytest.approx(want, abs=1e-3), i


def test_held_out_quality(spark):
    out = queries.QUERIES["op7_quality_neighbours"](spark, SF)
    seen = out.join(documents(spark, SF, "labels"), "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in seen) >= 0.95 * len(seen) and len(seen) > 50
    assert all(0 <= r["score"] <= 1 for r in seen)


def test_scores_of_odd_rows_and_without_labels(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (7, 0), (9, 1), (None, 1), (3, None), (1, 1)], "doc_id long, quality int")
    model = knn.fit(odd, labels)
    out = odd.select("doc_id", "text", knn.score_column(spark, model).alias("p")).collect()
    assert len(out) == len(ODD) and all(0 <= r["p"] <= 1 for r in out)
    assert len({r["p"] for r in out if r["text"] == ODD[0][1]}) == 1
    blank = knn.fit(odd, labels.limit(0))
    assert {r[0] for r in odd.select(knn.score_column(spark, blank)).collect()} == {0.5}
    assert none.select(knn.score_column(spark, blank)).count() == 0


# ---- language identification

def test_viterbi_is_the_best_of_all_labellings():
    rnd = np.random.default_rng(4)
    counts = np.array([5, 0, 1, 7, 3, 2])
    scores = -rnd.integers(0, 12, (counts.sum(), 3)).astype(np.float32)
    for switch in (0.0, 3.0, 50.0):
        got, at = langid.viterbi(scores, counts, switch), 0
        for n in counts.tolist():
            own = scores[at:at + n]

            def total(path, own=own):
                return sum(own[i, p] for i, p in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:]))

            best = max((total(p) for p in itertools.product(range(3), repeat=n)), default=0)
            assert total(got[at:at + n].tolist()) == pytest.approx(best)
            at += n


def test_mixed_text_is_labelled_in_spans(spark):
    en = "the cat sat on the mat and the dog ran to the house with the children "
    ru = "кошка сидела на столе а собака бежала домой вместе с детьми "
    fr = "le chat est sur la table et le chien court vers la maison avec les enfants "
    rows = [(i, t * 3, l) for i, (t, l) in enumerate([(en, "en"), (ru, "ru"), (fr, "fr")] * 3)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    n, m = len((en * 2).split()), len(fr.split())
    docs = spark.createDataFrame([(1, en * 2 + fr), (2, ru + "mat"), (3, "1234 !!"), (4, None), (5, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in langid.identify(docs, train, spans=True, switch=4.0).collect()}
    assert [(s["first_word"], s["n_words"], s["lang"]) for s in got[1]["spans"]] == [(0, n, "en"), (n, m, "fr")]
    assert got[1]["lang_pred"] == "en" and got[1]["score"] == pytest.approx(n / (n + m))
    assert got[2]["lang_pred"] == "ru"
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 and not got[i]["spans"] for i in (3, 4, 5))


def test_held_out_language(spark):
    docs = documents(spark, SF)
    out = queries.QUERIES["op10_language_id"](spark, SF)
    seen = out.filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(seen) > 100 and sum(r["lang_pred"] == r["lang"] for r in seen) >= 0.98 * len(seen)


def test_language_of_odd_rows_and_empty_tables(spark, odd, none):
    train = documents(spark, SF_SMALL).filter(~held_out())
    got = langid.identify(odd, train).collect()
    assert len(got) == len(ODD) and sum(r["lang_pred"] == "und" for r in got) == sum(
        not any(c.isalpha() for c in t or "") for _, t in ODD)
    assert langid.identify(none, train).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd, none).collect()} == {"und"}
    kept = langid.filter_documents(odd, train)
    assert kept.columns == odd.columns and kept.filter("doc_id = 7").count() == 0
