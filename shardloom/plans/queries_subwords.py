"""Registered sub-word queries (T2) on ``documents``, with the pieces of a public tokenizer file."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from ..operators import subwords as S
from .queries_text import SEQ_LEN, duck_tokens
from .registry import register, table


def pieces_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@functools.cache
def _match(path: str) -> S.LongestMatch:
    return S.LongestMatch(S.read_pieces(path), end_mark="</w>")


def duck_subwords(where: str) -> str:
    """CTEs ending in ``pieces(word, ids)`` for the words of ``where`` (one column ``word``): the longest piece that
    starts at each place of each word, then a walk from place to place."""
    return f"""vocab as materialized (
  select e.key as piece, e.value + 4 as id
  from (select unnest(map_entries(cast(json_extract(content, '$.model.vocab') as map(varchar, integer)))) as e
        from read_text('{pieces_path()}'))),
longest as (select max(length(replace(piece, '</w>', ''))) as most from vocab),
words as materialized ({where}),
starts as (select word, unnest(range(1, length(word) + 1)) as pos from words where length(word) <= {S.LONGEST}),
cuts as (select word, pos, unnest(range(1, least(most, length(word) - pos + 1) + 1)) as len from starts, longest),
best as materialized (
  select word, pos, max(len) as len, arg_max(v.id, len) as id
  from cuts join vocab v on v.piece = substr(word, pos, len) || case when pos + len > length(word) then '</w>' else '' end
  group by word, pos),
walk(word, pos, n, id) as (
  select word, cast(1 as bigint), cast(0 as bigint), cast(null as integer) from words
  union all
  select w.word, w.pos + b.len, w.n + 1, b.id from walk w join best b using (word, pos)),
pieces as (
  select word, case when bool_or(pos > length(word)) then list(id order by n) filter (where n > 0) else [1] end as ids
  from walk group by word)"""


@register("encode_subwords_fixed_length", sql=f"""
with recursive {duck_subwords(f"select distinct unnest({duck_tokens('text')}) as word from documents")},
toks as (select doc_id, unnest({duck_tokens('text')}) as word, generate_subscripts({duck_tokens('text')}, 1) as k from documents),
flat as (select doc_id, (flatten(list(ids order by k)))[1:{SEQ_LEN - 2}] as ids from toks join pieces using (word) group by doc_id),
enc as (select doc_id, coalesce(ids, cast([] as integer[])) as ids from documents left join flat using (doc_id))
select doc_id, array_to_string(list_concat([2], ids, [3], list_transform(range({SEQ_LEN - 2} - len(ids)), lambda x: 0)), ' ') as input_ids,
       cast(len(ids) + 2 as integer) as mask_sum, {SEQ_LEN} as length
from enc
""")
def encode_subwords_fixed_length(spark, sf):
    """Every document as sub-word pieces of a pretrained vocabulary, to a fixed length."""
    enc = S.encode_subwords(table(spark, sf, "documents"), _match(pieces_path()), "doc_id", "text", SEQ_LEN)
    return enc.select("doc_id", F.array_join("input_ids", " ").alias("input_ids"),
                      F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"), F.size("input_ids").alias("length"))


@register("subword_counts_by_lang", sql=f"""
with recursive {duck_subwords(f"select distinct unnest({duck_tokens('text')}) as word from documents")},
toks as (select lang, unnest({duck_tokens('text')}) as word from documents)
select lang, count(*) as n_words, cast(sum(len(ids)) as bigint) as n_pieces, count(*) filter (where ids = [1]) as n_unknown
from toks join pieces using (word) group by lang
""")
def subword_counts_by_lang(spark, sf):
    """T2 over whole texts: words, pieces and unknown words of each language.  Words are counted first, so each
    distinct word of a language is matched once."""
    from ..functions.text import UNK, tokens
    words = (table(spark, sf, "documents").select("lang", F.explode(tokens("text")).alias("word"))
             .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    ids = words.select("lang", "n", S.matched_words(spark, _match(pieces_path()), "word").alias("ids"))
    return ids.groupBy("lang").agg(F.sum("n").alias("n_words"), F.sum(F.col("n") * F.size("ids")).alias("n_pieces"),
                                   F.sum(F.when(F.col("ids") == F.array(F.lit(UNK)), F.col("n")).otherwise(0)).alias("n_unknown"))
