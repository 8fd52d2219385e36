"""Registered text queries (T1, T2, T4, B6, B7 on ``documents``/``labels``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import text as T
from .registry import register, table

# the operator's own default
VOCAB_SIZE = 30000
# Fixed value: the sequence length of the encoded samples.
SEQ_LEN = 256

# DuckDB pieces shared by the oracle SQL below.
def duck_tokens(text: str = "text") -> str:
    return rf"list_filter(regexp_split_to_array(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"


_DUCK_TOKENS = duck_tokens("text")


def duck_encoded(src: str, key: str, text: str, seq_len: int, name: str = "enc") -> str:
    """CTEs ending in ``{name}(key, input_ids, n_real)``; needs ``vocab``."""
    body = seq_len - 2
    return f"""{name}_cut as (select {key} as k, ({duck_tokens(text)})[1:{body}] as toks from {src}),
{name}_tok as (select k, unnest(toks) as token, generate_subscripts(toks, 1) as pos from {name}_cut),
{name}_ids as (select t.k, list(coalesce(v.id, 1) order by t.pos) as ids
               from {name}_tok t left join vocab v using (token) group by t.k),
{name} as (select c.k as {key},
             list_concat([2], coalesce(i.ids, cast([] as integer[])), [3],
                         list_transform(range({body} - len(c.toks)), lambda x: 0)) as input_ids,
             len(c.toks) + 2 as n_real
           from {name}_cut c left join {name}_ids i on c.k = i.k)"""
_DUCK_VOCAB = f"""
vocab as (
  select token, cast(row_number() over (order by cnt desc, token) - 1 + 4 as integer) as id, cnt
  from (select token, count(*) as cnt
        from (select unnest({_DUCK_TOKENS}) as token from documents) w
        group by token) c
  qualify row_number() over (order by cnt desc, token) <= {VOCAB_SIZE}
)"""


def _vocab(spark, sf):
    return T.build_vocab(table(spark, sf, "documents"), "text", VOCAB_SIZE)


def _encoded(spark, sf, max_length=SEQ_LEN):
    docs = table(spark, sf, "documents")
    return T.encode(docs, _vocab(spark, sf), "doc_id", "text", max_length, keep=["lang"])


@register("encode_tokens_by_lang", sql=f"""
with {_DUCK_VOCAB},
tok as (select lang, unnest({_DUCK_TOKENS}) as token from documents),
counted as (select lang, count(*) as n, count(*) filter (where v.id is null) as unk
            from tok left join vocab v using (token) group by lang)
select d.lang, d.n_docs, cast(coalesce(c.n, 0) + 2 * d.n_docs as bigint) as real_tokens,
       cast(coalesce(c.unk, 0) as bigint) as unk_tokens
from (select lang, count(*) as n_docs from documents group by lang) d
left join counted c on d.lang is not distinct from c.lang
""")
def encode_tokens_by_lang(spark, sf):
    """Flagship: vocabulary of the whole corpus, then real tokens (with the
    two markers of each text) and unknown tokens of the whole texts, per
    language."""
    docs = table(spark, sf, "documents")
    c = T.token_counts(docs, _vocab(spark, sf), ["lang"])
    return c.select("lang", "n_docs", (F.col("n_tokens") + 2 * F.col("n_docs")).alias("real_tokens"),
                    F.col("n_unknown").alias("unk_tokens"))


@register("vocab_top_words", sql=f"""
with {_DUCK_VOCAB}
select token, id, cast(cnt as bigint) as count from vocab
""")
def vocab_top_words(spark, sf):
    """The vocabulary entries counted from the corpus (specials left out)."""
    return _vocab(spark, sf).filter(F.col("id") >= 4)


@register("encode_fixed_length", sql=f"""
with {_DUCK_VOCAB},
{duck_encoded("documents", "doc_id", "text", SEQ_LEN)}
select doc_id, array_to_string(input_ids, ' ') as input_ids, cast(n_real as integer) as mask_sum,
       cast(len(input_ids) as integer) as length
from enc
""")
def encode_fixed_length(spark, sf):
    """Every document encoded to a fixed length; ids as text for comparison."""
    enc = _encoded(spark, sf)
    return enc.select(
        "doc_id",
        F.array_join(F.col("input_ids"), " ").alias("input_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"),
        F.size("input_ids").alias("length"))
