"""Sub-word encoding with a given, pretrained vocabulary (T2): greedy longest match.

A word (a run of letters or digits, lower-cased, as ``functions.text.tokens`` cuts them) is covered from
its start by the longest piece of the vocabulary that fits, then goes on behind it; pieces that close a word
and pieces inside it are told apart by a mark, either on pieces that do not begin a word (``##``) or on pieces
that end one (``</w>``).  A word that cannot be covered, or is longer than ``LONGEST`` code points, is one [UNK].

Cutting texts into words and all bookkeeping around the ids stay in expressions; the match runs in an Arrow
function over the distinct words of a batch, with the pieces in one broadcast table (at most ``MOST_PIECES``,
checked) probed longest first, so encoding needs no shuffle and no join, whatever the number of distinct words.

Defined results: a null or empty text has no pieces; rows are independent, so repeated rows and keys stay
apart; texts are cut by pieces, after the match; the vocabulary's ids follow the four special tokens.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import CLS, PAD, SEP, SPECIALS, UNK, tokens

MOST_PIECES = 1_000_000
LONGEST = 100


def read_pieces(path: str) -> dict[str, int]:
    """The pieces of a tokenizer file (``model.vocab``) with their ids, numbered behind the special tokens."""
    with open(path, encoding="utf-8") as f:
        pieces = json.load(f)["model"]["vocab"]
    if len(pieces) > MOST_PIECES:
        raise ValueError(f"{len(pieces)} pieces; at most {MOST_PIECES} are broadcast")
    return {p: i + len(SPECIALS) for p, i in pieces.items()}


def _cover_function():
    # a nested function travels to Python workers by value: they need no package on their path
    def cover(word: str, tables: dict, most: dict, longest: int, unknown: int) -> list[int]:
        n, at, ids = len(word), 0, []
        if n > longest:
            return [unknown]
        while at < n:
            i = tables[at == 0, True].get(word[at:])  # the rest of the word, else shorter and shorter pieces
            if i is not None:
                at = n
            else:
                inside, end = tables[at == 0, False], min(n - 1, at + most[at == 0, False])
                while end > at and (i := inside.get(word[at:end])) is None:
                    end -= 1
                if i is None:
                    return [unknown]
                at = end
            ids.append(i)
        return ids

    return cover


_cover = _cover_function()


class LongestMatch:
    """Pieces by their place in a word, ``tables[at its start, up to its end]``; marks tell the places apart."""

    def __init__(self, pieces: dict[str, int], end_mark: str | None = "</w>", inner_mark: str | None = None, longest: int = LONGEST):
        if (end_mark is None) == (inner_mark is None):
            raise ValueError("pieces are marked at the end or inside of words, one of both")
        if end_mark is not None:
            closing = {p[:-len(end_mark)]: i for p, i in pieces.items() if p.endswith(end_mark)}
            opening = {p: i for p, i in pieces.items() if not p.endswith(end_mark)}
            tables = {(first, False): opening for first in (True, False)} | {(first, True): closing for first in (True, False)}
        else:
            inner = {p[len(inner_mark):]: i for p, i in pieces.items() if p.startswith(inner_mark)}
            outer = {p: i for p, i in pieces.items() if not p.startswith(inner_mark)}
            tables = {(True, last): outer for last in (True, False)} | {(False, last): inner for last in (True, False)}
        self.data = (tables, {k: max(map(len, t), default=0) for k, t in tables.items()}, longest, UNK)

    def word(self, word: str) -> list[int]:
        """Ids of a word's pieces, or [UNK]."""
        return _cover(word, *self.data)


def _matched(spark: SparkSession, match: LongestMatch, limit: int | None):
    """Arrow-batched function: words of a text -> ids of their pieces (the first ``limit``)."""
    shared, cover = spark.sparkContext.broadcast(match.data), _cover

    def run(words: pd.Series) -> pd.Series:
        known: dict[str, list[int]] = {}
        out = []
        for row in words:
            ids: list[int] = []
            for w in () if row is None else row:
                if limit is not None and len(ids) >= limit:
                    break
                if w not in known:
                    known[w] = cover(w, *shared.value)
                ids += known[w]
            out.append(ids if limit is None else ids[:limit])
        return pd.Series(out, dtype=object)

    run.__annotations__ = {"words": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "array<int>")


def subword_ids(spark: SparkSession, match: LongestMatch, text: str | Column = "text", limit: int | None = None) -> Column:
    """Ids of a text's pieces, the first ``limit`` of them (every word has one at least, so no more words are read)."""
    words = tokens(text)
    return _matched(spark, match, limit)(words if limit is None else F.slice(words, 1, max(limit, 1)))


def encode_subwords(df: DataFrame, match: LongestMatch, key: str | Sequence[str], text_col: str = "text",
                    max_length: int = 256, keep: Sequence[str] = ()) -> DataFrame:
    """Fixed-length encoding ``[CLS] p1 .. pk [SEP] [PAD]..`` as ``text.encode`` gives it, of sub-word pieces."""
    body = max_length - 2
    if body < 0:
        raise ValueError("max_length must be at least 2")
    carried = list(dict.fromkeys([*([key] if isinstance(key, str) else key), *keep]))
    ids = df.select(*carried, subword_ids(df.sparkSession, match, text_col, body).alias("_p"))
    n, pad_n = F.size("_p"), F.lit(body) - F.size("_p")
    return ids.select(
        *carried,
        F.concat(F.array(F.lit(CLS)), "_p", F.array(F.lit(SEP)), F.array_repeat(F.lit(PAD), pad_n)).alias("input_ids"),
        F.array_repeat(F.lit(0), F.lit(max_length)).alias("token_type_ids"),
        F.concat(F.array_repeat(F.lit(1), n + 2), F.array_repeat(F.lit(0), pad_n)).alias("attention_mask"))


def matched_words(spark: SparkSession, match: LongestMatch, word: str | Column) -> Column:
    """Ids of the pieces of one word a row."""
    word = F.col(word) if isinstance(word, str) else word
    return _matched(spark, match, None)(F.array(word))
