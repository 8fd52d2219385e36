"""Near-duplicate join (2) and line dedup (8) against plain versions."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import ODD, rows

from shardloom.llm import jaccard, linededup
from shardloom.llm.common import as_large
from shardloom.llm.components import connected_components


def _check_groups(df, texts, n, num, den):
    """df: near_duplicates of (i, texts[i])."""
    want, sets = brute.groups(texts, n, num, den)
    got = {r["doc_id"]: r for r in df.collect()}
    assert len(got) == len(texts)
    for i in range(len(texts)):
        assert got[i]["n_shingles"] == len(sets[i]), i
        assert got[i]["component_id"] == want[i], i


def _family(rnd, words, copies, edits):
    """A text and copies of it with a few words changed."""
    base = [f"w{rnd.randrange(400)}" for _ in range(words)]
    out = [base]
    for _ in range(copies):
        x = list(rnd.choice(out))
        for _ in range(rnd.randrange(edits + 1)):
            x[rnd.randrange(len(x))] = f"e{rnd.randrange(10_000)}"
        out.append(x)
    return [" ".join(x) for x in out]


@pytest.mark.parametrize("n, num, den", [(3, 90, 100), (5, 80, 100)])
def test_groups_match_all_pairs(spark, n, num, den):
    rnd = random.Random(n)
    texts = []
    for words in (1, 2, 4, 8, 12, 25, 60, 200, 900):
        for _ in range(3):
            texts += _family(rnd, words, 6, max(1, words // 30))
    # one family with a chain of small changes, one around a shared passage
    texts += _family(rnd, 120, 60, 3)
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"q{rnd.randrange(10_000)}" for _ in range(rnd.randrange(14))) for _ in range(80)]
    texts += ["", "  ", "!", "!", "A b C", "a B c"]
    rnd.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    _check_groups(jaccard.near_duplicates(df, n, num, den), texts, n, num, den)


def test_small_blocks_lose_no_link(spark, monkeypatch):
    rnd = random.Random(3)
    texts = _family(rnd, 90, 120, 4)
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _check_groups(jaccard.near_duplicates(df, 3, 90, 100), texts, 3, 90, 100)


def test_odd_rows(spark, odd):
    got = jaccard.near_duplicates(odd, 5, 80, 100)
    assert rows(got, "doc_id", "n_shingles") == sorted(
        [(i, len(brute.shingles(t, 5))) for i, t in ODD], key=lambda r: [(x is not None, x) for x in r])
    of = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in got.collect()}
    n = len(brute.shingles(ODD[0][1], 5))
    assert of[(2, n)] == of[(11, n)] == of[(1, n)] == -16  # copies, linked to the text in capitals
    assert of[(5, 0)] == 5 and of[(4, 0)] == 4 and of[(None, 0)] is None  # empty sets are alone
    kept = jaccard.keep_one(odd, 5, 80, 100)
    assert kept.columns == odd.columns
    want, _ = brute.groups([t for _, t in ODD], 5, 80, 100)
    blank = sum(not brute.shingles(t, 5) for _, t in ODD)
    firsts = len({g for g, (_, t) in zip(want, ODD) if brute.shingles(t, 5)})
    assert kept.count() == blank + firsts
    assert {r["doc_id"] for r in kept.collect()} >= {8, 9, -16}


def test_empty_table(spark, none):
    assert jaccard.near_duplicates(none).count() == 0
    assert jaccard.keep_one(none).count() == 0


def test_bit_counts_never_undercut_the_overlap():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rnd.integers(0, 1 << 63, rnd.integers(1, 400)).astype(np.uint64))
        extra = np.unique(rnd.integers(0, 1 << 63, rnd.integers(1, 60)).astype(np.uint64))
        b = np.unique(np.concatenate((a[rnd.random(len(a)) < 0.9], extra)))
        if not len(b):
            continue
        x, y = (jaccard.bitmaps(s, np.array([0, len(s)]))[0] for s in (a, b))
        words = min(len(x), len(y))
        x, y = jaccard._fold(x, words), jaccard._fold(y, words)
        bound = jaccard.overlap_bound(np.array([len(a)]), np.array([len(b)]), x[None], y[None])[0]
        assert bound >= len(np.intersect1d(a, b))


def test_linked_sets_share_a_segment():
    rnd = np.random.default_rng(2)
    for num in (80, 90, 95):
        bands = jaccard.Bands(num, 100)
        bands.reach(3000)
        for _ in range(150):
            a = np.unique(rnd.integers(0, 1 << 63, rnd.integers(1, 700)).astype(np.uint64) * np.uint64(2))
            keep = a[rnd.random(len(a)) < rnd.uniform(num / 100, 1)]
            more = rnd.integers(0, 1 << 63, rnd.integers(0, max(1, len(a) // 20) + 1)).astype(np.uint64)
            b = np.unique(np.concatenate((keep, more)))
            both = len(np.intersect1d(a, b))
            if not len(b) or 100 * both < num * (len(a) + len(b) - both) or np.array_equal(a, b):
                continue
            keys = []
            for s in (a, b):
                at, own = np.array([0, len(s)]), np.searchsorted(np.array(bands.upper), [len(s)])
                keys.append({k for band in (own, own + 1) for k in jaccard.segment_keys(s, at, band, bands)[0].tolist()})
            assert keys[0] & keys[1]


def test_sets_of_slices_that_end_in_texts_without_words():
    for texts in (["a b c d", "", " "], ["", "a b"], [""], [" ", "x", "a b c a b c"], ["a b c d e", "b"]):
        sets, starts = jaccard.shingle_sets(as_large(pa.array(texts)), 3)
        assert np.diff(starts).tolist() == [len(brute.shingles(t, 3)) for t in texts]
        assert starts[-1] == len(sets)


def test_components(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    to = {}

    def find(x):
        while to.setdefault(x, x) != x:
            x = to[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        to[max(a, b)] = min(a, b)
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got.get(x, x) == find(x) for x in {y for e in edges for y in e})
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_lines_of_odd_rows(spark, odd):
    for min_docs in (1, 2, 3, 4):
        got = linededup.dedup_lines(odd, min_docs=min_docs, batches=3, fanout=2, carry=["key", "row"])
        texts = [t for _, t in ODD]
        want = [(i, *x, f"key{k}") for k, ((i, _), x) in enumerate(zip(ODD, brute.drop_lines(texts, min_docs)))]
        assert rows(got.select("doc_id", "n_lines", "n_dropped", "kept_text", "carried.key"),
                    "doc_id", "n_lines", "n_dropped", "kept_text", "key") == sorted(
            want, key=lambda r: [(x is not None, x) for x in r])


@pytest.mark.parametrize("batches, fanout", [(1, 2), (5, 2), (7, 3)])
def test_line_runs_do_not_depend_on_batches(spark, batches, fanout):
    rnd = random.Random(batches)
    texts = ["\n".join(rnd.choice([f"line {rnd.randrange(40)}", f"Line {rnd.randrange(40)} ", "", f"own {i}"])
                       for _ in range(rnd.randrange(1, 12))) for i in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = rows(linededup.dedup_lines(df, 10, 1, batches, fanout), "doc_id", "n_lines", "n_dropped", "kept_text")
    assert got == [(i, *x) for i, x in enumerate(brute.drop_lines(texts, 10))]


def test_batches_meet_sorted_runs_by_merge(spark, capsys):
    runs = linededup.LineRuns(spark, 3, fanout=3, buckets=8)

    def batch(keys):
        return spark.createDataFrame([(k.encode(),) for k in keys], "key binary")

    runs.add(batch(["a"] * 3 + ["b"] * 2 + ["c"]))
    runs.add(batch(["a"] * 5 + ["b", "d"]))
    runs.unsettled(batch(["a", "b"])).explain()
    plan = capsys.readouterr().out
    # two runs, two merge anti-joins; only the batch is shuffled, to be counted
    assert plan.count("SortMergeJoin") == 2 and "LeftAnti" in plan and "Broadcast" not in plan
    assert plan.count("Exchange") == 1 and plan.count("Bucketed: true") == 2
    runs.merged(runs.levels[0]).explain()
    assert "Exchange" not in capsys.readouterr().out
    assert {r["key"].decode(): r["n"] for r in spark.table(runs.levels[0][1]).collect()} == {"b": 1, "d": 1}
    runs.add(batch(["c"]))
    assert [len(level) for level in runs.levels] == [0, 1]
    assert sorted(r["key"].decode() for r in runs.finish().collect()) == ["a", "b"]


def test_lines_of_an_empty_table(spark, none):
    assert linededup.dedup_lines(none).count() == 0


def test_stars_across_batches():
    """Runs of a tile that span batches keep their centre."""
    pairs = [(1, 5), (1, 5), (1, 7), (2, 4), (3, 1), (3, 2), (3, 2), (3, 9)]
    want = [(1, 5, 7), (3, 1, 2), (3, 1, 9)]
    for size in (1, 2, 3, 8):
        batches = [pa.RecordBatch.from_arrays([pa.array([t for t, _ in pairs[i:i + size]], pa.int64()),
                                               pa.array([x for _, x in pairs[i:i + size]], pa.int64())], names=["tile", "node"])
                   for i in range(0, len(pairs), size)]
        got = [tuple(r.values()) for b in jaccard._stars(iter(batches)) for r in b.to_pylist()]
        assert got == want, size


def test_pairs_across_components_of_whole_batches(monkeypatch):
    """Block pairs that span batches give every possible pair once, compared many at a time; tiles with more
    candidates than were sent are named."""
    rnd = np.random.default_rng(4)
    table = []  # tile, blocks, side, node, size, label, bits
    for tile in range(300):
        blocks = tile % 3
        for node in np.unique(rnd.integers(0, 400, rnd.integers(2, 30))).tolist():
            own = np.random.default_rng(node % 40)  # nodes of one remainder are much alike
            bits = np.array([own.integers(0, 1 << 62, 16)]).ravel()[:16 if node % 3 else 8]
            table.append((tile, blocks, node % 2 if blocks else 0, node, 100 + node % 20, node // 100, bits.tolist()))
    table.sort(key=lambda r: r[:4])
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]

    def run(most_likely, size):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*table[i:i + size]), kinds)], names=list("abcdefg"))
                   for i in range(0, len(table), size)]
        return [tuple(r.values()) for b in jaccard._across(80, 100, most_likely)(iter(batches)) for r in b.to_pylist()]

    want, crowded = set(), set()
    for tile in range(300):
        mine = [r for r in table if r[0] == tile]
        two = any(r[2] for r in mine)
        for k, x in enumerate(mine):
            able = []
            for y in (mine[k + 1:] if not two else mine):
                words = min(len(x[6]), len(y[6]))
                a, b = (jaccard._fold(np.array(r[6], np.uint64), words) for r in (x, y))
                most = int(jaccard.overlap_bound(np.array([x[4]]), np.array([y[4]]), a[None], b[None])[0])
                if (not two or (x[2], y[2]) == (0, 1)) and x[5] != y[5] and 100 * most >= 80 * (x[4] + y[4] - most):
                    able.append((x[3], y[3]))
            want.update(able)
            if len(able) > 1:
                crowded.add(tile)
    assert want and crowded and len(crowded) < 300
    calls, bound = [], jaccard.overlap_bound
    monkeypatch.setattr(jaccard, "overlap_bound", lambda *a: calls.append(len(a[0])) or bound(*a))
    for size in (7, 1000, len(table)):
        calls.clear()
        got = run(None, size)
        assert sorted((u, v) for u, v, _ in got) == sorted(want), size
        if size == len(table):
            assert len(calls) < len(table) / 100
        some = run(1, size)
        assert {t for *_, t in some if t is not None} == crowded, size
        assert {(u, v) for u, v, t in some if t is None} <= want, size


def test_pairs_not_sent_leave_both_nodes_in_their_tile():
    """Every possible pair of a tile is sent or has both nodes among those left to the second round; others are not left."""
    rnd = np.random.default_rng(6)
    table = []
    for tile in range(40):
        for node in np.unique(rnd.integers(0, 60, 12)).tolist():
            bits = np.random.default_rng(node % 12 if node < 40 else node).integers(0, 1 << 62, 8)
            table.append((tile, 0, 0, node, 100, node, bits.tolist()))
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    whole = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*table), kinds)], names=list("abcdefg"))
    some = [tuple(r.values()) for b in jaccard._across(80, 100, 1)(iter([whole])) for r in b.to_pylist()]
    sent, left = {r[:2] for r in some if r[2] is None}, {(t, u) for u, _, t in some if t is not None}
    alike = [(t, u, v) for t, _, _, u, *_ in table for s, _, _, v, *_ in table
             if s == t and u < v < 40 and u % 12 == v % 12]
    assert left and all((u, v) in sent or {(t, u), (t, v)} <= left for t, u, v in alike)
    assert left <= {(t, x) for t, u, v in alike for x in (u, v)}


def test_texts_somewhat_alike_leave_few_pairs(spark, monkeypatch, tmp_path):
    """A family of texts below the ratio, with a few links: the second round gives no pair of most of them."""
    rnd = random.Random(8)
    base, texts = [f"w{i}" for i in range(400)], []
    for i in range(100):
        at = rnd.randrange(380)
        texts.append(base[:at] + [f"o{i}x{k}" for k in range(17)] + base[at + 17:])
    texts += [[*t[:200], f"c{i}", *t[201:]] for i, t in enumerate(texts[:10])]
    monkeypatch.setattr(jaccard, "scratch_path", lambda _, name: str(tmp_path / name))
    df = spark.createDataFrame(list(enumerate(" ".join(t) for t in texts)), "doc_id long, text string")
    _check_groups(jaccard.near_duplicates(df, 3, 90, 100), [" ".join(t) for t in texts], 3, 90, 100)
    assert spark.read.parquet(str(tmp_path / "jaccard" / "likely-found")).filter("more is not null").count() > 100
    assert spark.read.parquet(str(tmp_path / "jaccard" / "rest-found")).count() < 5 * len(texts)
