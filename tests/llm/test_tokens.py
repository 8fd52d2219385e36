"""Word-wise encoding, packing (4), token files (5) and SentencePiece dropout (3)."""

import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import ODD, PROSE, SF_SMALL, rows
from pyspark.sql import functions as F

from shardloom.llm import packing, sentencepieces, tokenfiles
from shardloom.llm.common import WordEncoder, as_large, documents, encoder, slices, tokenizer_path
from shardloom.session import scratch_path

PATH = tokenizer_path()
PIECES = tokenizer_path("piece_bpe_32k.model")
STRANGE = [t or "" for _, t in ODD] + [
    "<|endoftext|>", "x <|startoftext|>y", "a#'s b's#c '#s a≠b ≮c x_y a-'tb é#", "H̱ ẖ İx# İ", "Σας ΣΑΣ",
    "it's we'll I'M don't", "а́б#в 123abc4", "​zero‍", "a b　c", "£€# $x"]


def _ids(text):
    return encoder(PATH).tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoding_by_runs_is_the_library_s(spark):
    texts = STRANGE + [r["text"] for r in documents(spark, SF_SMALL).select("text").collect()]
    own = WordEncoder(PATH)
    own.RUNS = 500  # the cache overflows often
    for a, b in slices(as_large(pa.array(texts)), 20_000):
        ids, at = own.ids(as_large(pa.array(texts[a:b])))
        for i in range(b - a):
            assert ids[at[i]:at[i + 1]].tolist() == _ids(texts[a + i]), texts[a + i][:80]


@pytest.mark.parametrize("most", [1, 8, 2048])
def test_pieces_of_odd_rows(spark, odd, most):
    if most == 1:
        odd = odd.filter("length(text) < 100 or text is null")
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = packing.pack_documents(odd, PATH, max_length=most, with_ids=True).collect()
    assert sorted(r["sequence_id"] for r in got) == list(range(len(got)))
    assert all(r["offset"] == 0 and r["length"] & (r["length"] - 1) == 0 and r["length"] <= most for r in got)
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in got)
    order = sorted(got, key=lambda r: r["sequence_id"])
    assert [r["length"] for r in order] == sorted(r["length"] for r in got)  # equal lengths side by side
    want = [(i, *p, len(ids)) for i, t in texts for ids in [_ids(t) + [1]] for p in brute.pieces(ids, most)]

    def key(r):
        return [(x is not None, x) for x in r]

    assert sorted([tuple(r[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")) for r in got], key=key) == sorted(want, key=key)


def test_packing_an_empty_table(spark, none):
    assert packing.pack_documents(none, PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pieces(none, PATH, max_length=12)


def test_token_files_round_trip(spark, odd):
    path = scratch_path(spark, "test-tokens")
    listed = tokenfiles.write_token_files(odd, path, PATH, partitions=3)
    assert listed.agg(F.sum("n_docs")).first()[0] == len(ODD)
    back = sorted(tokenfiles.read_token_files(spark, path).collect(), key=lambda r: r["start"])
    ordered = [r["doc_id"] for r in back]
    assert ordered == sorted(ordered, key=lambda i: (i is not None, i))  # ascending ids, nulls first
    at = 0
    for r in back:
        assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]
    want = sorted(zlib.crc32(np.array(_ids(t) + [1], "<u4").tobytes()) for _, t in ODD)
    assert sorted(zlib.crc32(bytes(r["ids"])) for r in back) == want


def test_token_shards_are_read_at_random_and_checked(spark):
    path = scratch_path(spark, "test-tokens")
    docs = documents(spark, SF_SMALL)
    listed = tokenfiles.write_token_files(docs, path, PATH, partitions=2, width=4).orderBy("shard").collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    raw = open(f"{path}/dictionary", "rb").read()
    assert len(raw) > 1000
    for s in listed:
        shard = tokenfiles.TokenShard(s["path"], raw)
        for i in random.Random(1).sample(range(len(shard)), min(20, len(shard))):
            assert shard.document(i).tolist() == _ids(texts[shard.ids[i]]) + [1]
        with pytest.raises(ValueError):
            tokenfiles.TokenShard(s["path"], raw[:-1])
    # against the shared dictionary, short documents shrink more than alone
    import zstandard
    short = [np.array(_ids(t) + [1], "<u2").tobytes() for t in texts.values() if 100 < len(t) < 1000]
    alone, shared = zstandard.ZstdCompressor(level=3), zstandard.ZstdCompressor(level=3, dict_data=tokenfiles._dictionary(raw))
    assert sum(len(shared.compress(x)) for x in short) < sum(len(alone.compress(x)) for x in short)


def test_shards_roll_over_by_bytes(spark, odd):
    path = scratch_path(spark, "roll")
    docs = spark.createDataFrame([(i, f"some words {i} " * (1 + i % 7)) for i in range(300)], "doc_id long, text string")
    whole = tokenfiles.write_token_files(docs, f"{path}/a", PATH, partitions=2)
    rolled = tokenfiles.write_token_files(docs, f"{path}/b", PATH, partitions=2, shard_bytes=500)
    assert whole.count() == 2 and rolled.count() > 6
    # frames stop at the first document beyond the limit; the rest of a file is 25 bytes a document and a fixed part
    assert all(r["n_bytes"] - 25 * r["n_docs"] < 500 + 400 for r in rolled.collect())
    a, b = (sorted(map(tuple, tokenfiles.read_token_files(spark, f"{path}/{x}").collect())) for x in "ab")
    assert a == b and len(a) == 300


def test_the_dictionary_is_trained_at_every_size(spark):
    trained = b"\x37\xa4\x30\xec"
    words = ["alpha beta", "gamma", "delta of the road", "a long way home"]
    for n in (1, 3, 30, 3000):
        docs = spark.createDataFrame([(i, " ".join(words[(i + j) % 4] for j in range(12))) for i in range(n)],
                                     "doc_id long, text string")
        raw = tokenfiles.train_dictionary(docs, PATH)
        assert raw.startswith(trained) and len(raw) <= 64 << 10
    # a document longer than a piece takes part, with a piece from somewhere inside it
    long = spark.createDataFrame([(1, "first " * 5000 + "second " * 5000)], "doc_id long, text string")
    assert tokenfiles.train_dictionary(long, PATH).startswith(trained)
    assert tokenfiles.train_dictionary(spark.createDataFrame([(1, None), (2, "")], long.schema), PATH) == b""


def test_token_files_of_an_empty_table(spark, none):
    path = scratch_path(spark, "test-tokens")
    assert tokenfiles.write_token_files(none, path, PATH).count() == 0
    assert tokenfiles.read_token_files(spark, path).count() == 0


# ---- SentencePiece

def _cuts(text, near):
    out = [text[0]]
    for a, b in zip(text, text[1:]):
        if (a, b) in near:
            out[-1] += b
        else:
            out.append(b)
    return out


@pytest.fixture(scope="module")
def sp():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def near(sp):
    plain = [sp.id_to_piece(i).replace("▁", " ") for i in range(sp.get_piece_size())
             if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    return {p for name in plain for p in zip(name, name[1:])}


def _encode(texts, seed, dropout):
    vocabulary, arr = sentencepieces.pieces(PIECES), as_large(pa.array(texts))
    ids, at = sentencepieces.encode_texts(vocabulary, arr, np.arange(len(texts)), seed, dropout)
    return [ids[s:e].tolist() for s, e in zip(at, at[1:])]


def _strings():
    rnd = random.Random(3)
    bits = ["the", "ing", " ", "  ", "a", "▁", "\n", "日", "é", "tion", "s", "😀", ".", "###", "Ab", "9"]
    return STRANGE[:-1] + ["", " ", "▁", "a▁b", "word" * 30] + [
        "".join(rnd.choice(bits) for _ in range(rnd.randint(1, 40))) for _ in range(200)]


def test_without_dropout_ids_are_the_library_s(spark, sp):
    texts = _strings() + [r["text"] for r in documents(spark, SF_SMALL).select("text").collect()]
    for text, ids in zip(texts, _encode(texts, 1, 0.0)):
        if "▁" not in text and "\x00" not in text:
            assert ids == sp.encode(text, num_threads=1), text[:80]


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_dropout_follows_the_agenda_and_is_lossless(near, dropout):
    texts, seed = _strings(), 9
    vocabulary = sentencepieces.pieces(PIECES)
    for i, (text, ids) in enumerate(zip(texts, _encode(texts, seed, dropout))):
        want = []
        for k, chunk in enumerate(_cuts(" " + text, near) if text else []):
            with np.errstate(over="ignore"):
                drawn = sentencepieces._mix(np.array([i], np.uint64) + np.array([k], np.uint64)
                                            * np.uint64(sentencepieces._C) + np.uint64(seed))[0]
            want += sentencepieces.merge_chunk(vocabulary, chunk, int(drawn), dropout)
        assert ids == want, text[:80]
        assert sentencepieces.decode_ids(vocabulary, np.array(ids, np.int64)).decode() == text


def test_seeds_and_occurrences_vary(sp):
    text = "the quick brown foxes jumped over internationalisation " * 40
    a, b, c = (_encode([text], s, 0.2)[0] for s in (1, 1, 2))
    assert a == b and a != c
    assert len({tuple(a[i:i + 3]) for i in range(len(a))}) > len({tuple(x) for x in zip(*[iter(sp.encode(text))] * 3)})
    assert sp.decode(a) == text  # the library reads the ids back as well


def test_every_occurrence_draws_anew(monkeypatch):
    """Of 10,000 occurrences of a chunk of one merge about a tenth is cut otherwise, in every document and block."""
    monkeypatch.setattr(sentencepieces, "OCCURRENCES", 700)
    monkeypatch.setattr(sentencepieces, "KEPT", 50)
    texts = ["a" + " a" * 4999, "a" + " a" * 4999]
    got = _encode(texts, 1, 0.1)
    whole = _encode(["a"], 1, 0.0)[0]
    assert len(whole) == 1
    for ids in got:
        assert 430 <= len(ids) - 5000 <= 570
    cuts = [[i for i, x in enumerate(ids) if x != whole[0]] for ids in got]
    assert cuts[0] != cuts[1]


def test_only_occurrences_that_skip_run_their_own_agenda(monkeypatch):
    """Of a chunk of one merge, those that come out in two pieces; of many distinct chunks, each once and its strays."""
    alone, run = [], sentencepieces.Chunks.merge

    def merge(self, w, column, keys, limit):
        alone.append((len(column), keys is not None))
        return run(self, w, column, keys, limit)

    monkeypatch.setattr(sentencepieces.Chunks, "merge", merge)
    got = _encode(["a" + " a" * 9999], 1, 0.1)[0]
    assert sum(n for n, drawn in alone if not drawn) == 1
    assert sum(n for n, drawn in alone if drawn) == len(got) - 10_000
    alone.clear()
    rnd = random.Random(5)
    _encode([" ".join("".join(rnd.choices("etaoinshrdlu", k=6)) for _ in range(3000)) for _ in range(2)], 1, 0.0)
    assert 3000 < sum(n for n, _ in alone) <= 6000 and not any(drawn for _, drawn in alone)


def test_a_million_joined_letters():
    text = "abcdefghij" * 20_000 + "x" * 800_000
    ids = _encode([text], 1, 0.1)[0]
    assert sentencepieces.decode_ids(sentencepieces.pieces(PIECES), np.array(ids, np.int64)).decode() == text


def test_encoded_columns_of_odd_rows(spark, odd, none):
    out = sentencepieces.encode_documents(odd, PIECES).withColumn("back", sentencepieces.decode_column(PIECES, "ids"))
    assert rows(out, "doc_id", "back") == sorted([(i, t or "") for i, t in ODD], key=lambda r: [(x is not None, x) for x in r])
    assert sentencepieces.encode_documents(none, PIECES).count() == 0
    same = [bytes(r["ids"]) for r in out.filter("doc_id = 11").collect()]
    assert len(same) == 2 and same[0] == same[1] and PROSE
