"""The registered queries of this subpackage: each operator, with its production parameters, over its
whole table.  The digest columns (checksums, counts) are derived here from the operators' outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, scratch_path
from . import (imatch, jaccard, knn, langid, linededup, packing, prefixtrie, quality, sentencepieces, tokenfiles, toxicity,
               warc, whitening)
from .common import documents, held_out, tokenizer_path, workers_find_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            checkpoint_dir(spark)
            workers_find_package(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql.strip()
        return run
    return deco


@register("op1_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surface counts and the n-gram log-likelihood ratio verdict of every document."""
    docs = documents(spark, sf_dir)
    trusted = documents(spark, sf_dir, "labels").filter((F.col("quality") == 1) & ~held_out())
    out = quality.score(docs, quality.fit(docs, trusted))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "score")


@register("op2_ngram_jaccard_join", r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
         else list_distinct([array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)]) end as s from words),
grams as (select doc_id, len(s) as n, unnest(s) as g from sets),
links as (
  select a.doc_id as u, b.doc_id as v from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach(u, v) as (select u, v from links union select r.u, l.v from reach r join links l on r.v = l.u)
select doc_id, len(s)::bigint as n_shingles,
       least(doc_id, coalesce((select min(v) from reach where u = doc_id), doc_id)) as component_id
from sets
""")
def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by a 3-word-shingle similarity of 0.9 or more."""
    out = jaccard.near_duplicates(documents(spark, sf_dir), n=3, num=90, den=100)
    return out.select("doc_id", "n_shingles", "component_id")


@register("op3_sentencepiece_dropout")
def sentencepiece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with seeded merge-dropout, and decoded again from its ids."""
    path = tokenizer_path("piece_bpe_32k.model")
    coded = sentencepieces.encode_documents(documents(spark, sf_dir), path)
    out = coded.withColumn("back", sentencepieces.decode_column(path, "ids"))
    return out.select("doc_id", F.expr("cast(length(ids) div 4 as bigint)").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"),
                      F.sha2("back", 256).alias("decoded_sha256"), (F.col("back") == F.col("text")).alias("lossless"))


@register("op4_pack_power_of_two")
def pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of every document."""
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path())


@register("op5_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written to dictionary-compressed token files and read back from them."""
    path = scratch_path(spark, "token-files")
    tokenfiles.write_token_files(documents(spark, sf_dir), path, tokenizer_path())
    back = tokenfiles.read_token_files(spark, path)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register("op6_warc_merkle_audit", r"""
with records as (
  select page_id, url, row_number() over (order by page_id) - 1 as pos,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: '
         || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
         || 'Content-Length: ' as head, coalesce(html, '') as body from pages),
placed as (
  select *, head || octet_length(encode(body)) || chr(13) || chr(10) || chr(13) || chr(10) || body
            || chr(13) || chr(10) || chr(13) || chr(10) as rec,
         head || octet_length(encode('!' || body)) || chr(13) || chr(10) || chr(13) || chr(10) || '!' || body
            || chr(13) || chr(10) || chr(13) || chr(10) as bad from records)
select page_id, lpad((pos // 4096)::varchar, 8, '0') || '.warc' as file, pos % 4096 as seq,
       "offset", length, sha256(rec) as primary_sha256,
       case when md5(coalesce(url, '')) like '0%' then sha256(bad) end as replica_sha256,
       case when md5(coalesce(url, '')) like '0%' then 'altered' else 'missing' end as status
from (select *, octet_length(encode(rec)) as length,
             (sum(octet_length(encode(rec))) over (partition by pos // 4096 order by pos)
              - octet_length(encode(rec)))::bigint as "offset" from placed)
where md5(coalesce(url, '')) like '0%' or md5(coalesce(url, '')) like '1%'
""")
def warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record, and the archive audited against a replica of its files that lost or
    altered the records of some urls."""
    primary, replica = scratch_path(spark, "warc"), scratch_path(spark, "warc-replica")
    manifest = warc.write_warc(documents(spark, sf_dir, "pages"), primary, gzip=True)
    text = F.col("record").cast("string")
    ends = F.instr(text, "\r\n\r\n")
    url = F.regexp_extract(F.substring(text, F.lit(1), ends), "WARC-Target-URI: ([^\r\n]*)", 1)
    body = F.substring(text, ends + 4, F.length(text) - ends - 7)
    mark = F.substring(F.md5(url), 1, 1)
    copied = warc.read_warc(spark, primary).filter(mark != "1").select(
        "file", F.col("at").alias("seq"), F.when(mark == "0", warc.record(url, F.concat(F.lit("!"), body)).cast("binary"))
        .otherwise(F.col("record")).alias("record"))
    warc.write_records(copied, replica, gzip=True)
    return warc.audit_archives(spark, primary, replica, manifest).withColumnRenamed("id", "page_id")


@register("op7_quality_neighbours")
def quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every document from its nearest labelled neighbours."""
    docs = documents(spark, sf_dir)
    model = knn.fit(docs, documents(spark, sf_dir, "labels").filter(~held_out()))
    out = docs.select("doc_id", held_out().alias("held_out"), knn.score_column(spark, model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@register("op8_line_dedup", r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
settled as (select key from keyed where length(key) >= 1 group by key having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(s.key) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where s.key is null), '')) as kept_sha256
from keyed left join settled s using (key) group by doc_id
""")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more leave every document."""
    out = linededup.dedup_lines(documents(spark, sf_dir), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op9_imatch_fingerprints")
def imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness."""
    return imatch.fingerprint_edits(documents(spark, sf_dir), wide=imatch.WIDE)


@register("op10_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from the rows that are not held out."""
    docs = documents(spark, sf_dir)
    out = langid.identify(docs, docs.filter(~held_out()))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@register("op11_prefix_trie", r"""
with recursive turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 as pos,
         sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as d,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as w
  from conversations where conv_id is not null),
heads as (
  select *, conv_id - conv_id % 20 as base, xor(list_reduce(list_prepend(4294967295::bigint,
           list_transform(string_split(conv_id::varchar, ''), lambda s: ascii(s)::bigint)), lambda c, b:
           list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 4 as h
  from (select distinct conv_id from turns)),
rebuilt as (
  select c.conv_id, t.pos, t.d, t.w from heads c join turns t on t.conv_id = c.base and t.pos < c.h
  union all
  select c.conv_id, t.pos + 10, t.d, t.w from heads c join turns t on t.conv_id = c.conv_id and t.pos >= c.h),
prefixes as (
  select conv_id, row_number() over conv as depth, string_agg(d, '') over conv as key, w,
         count(*) over (partition by conv_id) as n_turns
  from rebuilt window conv as (partition by conv_id order by pos rows unbounded preceding)
  union all
  select h.conv_id, 0, '', 0, (select count(*) from rebuilt r where r.conv_id = h.conv_id) from heads h),
nodes as (
  select depth, key, min(conv_id) as conv_id, count(*) as n_convs, any_value(w) as w,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where n_turns = depth), '')) as ends_sha256
  from prefixes group by depth, key),
kids as (select left(key, (64 * (depth - 1))::bigint) as key, count(*) as n from nodes where depth > 0 group by 1),
sums as (
  select left(n.key, (64 * a.depth)::bigint) as key, sum((n.n_convs - 1) * n.w)::bigint as saved,
         count(*) filter (where k.n is null) as leaves
  from nodes n left join kids k on k.key = n.key, lateral (select unnest(range(n.depth + 1)) as depth) a group by 1)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(k.n, 0) as n_children, s.leaves as n_leaves,
       s.saved as saved_tokens, n.ends_sha256
from nodes n join sums s on s.key = n.key left join kids k on k.key = n.key
left join nodes p on p.depth = n.depth - 1 and p.key = left(n.key, (64 * (n.depth - 1))::bigint)
""")
def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    return prefixtrie.trie(prefixtrie.rebuild(documents(spark, sf_dir, "conversations")))


@register("op12_embedding_whitening")
def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the eight components of largest variance, whitened."""
    out = whitening.whiten(documents(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained"))).select(
        "vec_id", F.expr("cast(pos + 1 as int)").alias("component"), "n", "deviation", "col.whitened", "col.explained", "identity_error")


@register("op13_subword_toxicity")
def subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of every document from its character n-gram vectors."""
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, documents(spark, sf_dir, "labels").filter(~held_out()))
    out = docs.select("doc_id", held_out().alias("held_out"), toxicity.score_column(spark, model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training-corpus pipeline over all documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
