"""Greedy longest-match encoding (T2) against a plain search over all pieces, and through Spark."""

import random

import pytest
from pyspark.sql import functions as F

from shardloom.functions.text import CLS, PAD, SEP, UNK
from shardloom.operators import subwords as S


def _plain(word, pieces, end_mark, inner_mark, longest):
    """At every place, try every piece and take the longest that fits there."""
    if len(word) > longest:
        return [UNK]
    at, ids = 0, []
    while at < len(word):
        fits = []
        for p, i in pieces.items():
            if end_mark is not None:
                body, closes = (p[:-len(end_mark)], True) if p.endswith(end_mark) else (p, False)
                ok = bool(body) and word.startswith(body, at) and closes == (at + len(body) == len(word))
            else:
                inner = p.startswith(inner_mark)
                body = p[len(inner_mark):] if inner else p
                ok = bool(body) and word.startswith(body, at) and inner == (at > 0)
            if ok:
                fits.append((len(body), i))
        if not fits:
            return [UNK]
        n, i = max(fits)
        at += n
        ids.append(i)
    return ids


@pytest.mark.parametrize("end_mark,inner_mark", [("</w>", None), (None, "##")])
def test_longest_match_against_all_pieces(end_mark, inner_mark):
    rnd = random.Random(3)
    for _ in range(30):
        bodies = {"".join(rnd.choices("abcé", k=rnd.randrange(1, 5))) for _ in range(12)}
        marked = [b + end_mark if end_mark else inner_mark + b for b in bodies if rnd.random() < 0.7] + [b for b in bodies if rnd.random() < 0.7]
        pieces = {p: i + 4 for i, p in enumerate(sorted(marked))}
        match = S.LongestMatch(pieces, end_mark, inner_mark, longest=9)
        for _ in range(60):
            w = "".join(rnd.choices("abcé", k=rnd.randrange(1, 11)))
            assert match.word(w) == _plain(w, pieces, end_mark, inner_mark, 9), (w, pieces)


def test_wordpiece_style_by_hand():
    match = S.LongestMatch({"un": 4, "##aff": 5, "##able": 6, "##a": 7, "unaff": 8}, end_mark=None, inner_mark="##")
    assert match.word("unaffable") == [8, 6] and match.word("una") == [4, 7] and match.word("unx") == [UNK]
    with pytest.raises(ValueError):
        S.LongestMatch({}, "</w>", "##")


def test_encoding_cuts_pads_and_keeps_odd_rows(spark):
    match = S.LongestMatch({"a": 4, "b</w>": 5, "c</w>": 6, "a</w>": 7})
    rows = [(1, "ab C x"), (1, "ab C x"), (2, None), (3, ""), (None, "ab " * 500), (4, "Z" * 300)]
    df = spark.createDataFrame(rows, "k long, text string").withColumns({c: F.lit("x") for c in ("_p", "words", "token")})
    got = sorted(((r["k"], r["input_ids"], r["attention_mask"]) for r in S.encode_subwords(df, match, "k", max_length=8).collect()), key=str)
    full = [CLS, 4, 5, 6, UNK, SEP, PAD, PAD]
    assert got == sorted([(1, full, [1] * 6 + [0] * 2), (1, full, [1] * 6 + [0] * 2), (2, [CLS, SEP] + [PAD] * 6, [1, 1] + [0] * 6),
                          (3, [CLS, SEP] + [PAD] * 6, [1, 1] + [0] * 6), (None, [CLS, 4, 5, 4, 5, 4, 5, SEP], [1] * 8),
                          (4, [CLS, UNK, SEP] + [PAD] * 5, [1] * 3 + [0] * 5)], key=str)
    assert S.encode_subwords(df.limit(0), match, "k").count() == 0
    assert all(r["input_ids"] == [CLS, SEP] for r in S.encode_subwords(df, match, "k", max_length=2).collect())
    whole = df.select(F.size(S.subword_ids(spark, match)).alias("n")).collect()
    assert sorted(r["n"] for r in whole) == [0, 0, 1, 4, 4, 1000]


def test_no_shuffle_and_no_join(spark):
    match = S.LongestMatch({"a</w>": 4})
    plan = S.encode_subwords(spark.range(3).select("id", F.lit("a").alias("text")), match, "id")._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_piece_file_bound(tmp_path, monkeypatch):
    (tmp_path / "t.json").write_text('{"model": {"vocab": {"a": 0, "b</w>": 1}}}')
    assert S.read_pieces(str(tmp_path / "t.json")) == {"a": 4, "b</w>": 5}
    monkeypatch.setattr(S, "MOST_PIECES", 1)
    with pytest.raises(ValueError):
        S.read_pieces(str(tmp_path / "t.json"))
