"""Registered queries for positions, splits and batches (B), row operators
(P) and classifier scoring (N)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..operators import model as N
from ..operators import rows as P
from ..operators import splits as B
from ..operators import text as T
from ..operators.index import running_sum, with_row_index
from ..session import scratch_path
from . import fixtures as FX
from .queries_text import _DUCK_TOKENS, _DUCK_VOCAB, SEQ_LEN, VOCAB_SIZE, duck_encoded
from .registry import register, table

# ---------------------------------------------------------------- B: positions


@register("row_index_docs", sql="""
select doc_id, row_number() over (order by doc_id) - 1 as row_idx from documents
""")
def row_index_docs(spark, sf):
    """Distributed 0-based index in key order (no single-partition window)."""
    return with_row_index(table(spark, sf, "documents").select("doc_id"), ["doc_id"])


@register("row_index_by_lang", sql="""
select doc_id, lang, row_number() over (partition by lang order by doc_id) - 1 as row_idx from documents
""")
def row_index_by_lang(spark, sf):
    """Index restarted per group."""
    return with_row_index(table(spark, sf, "documents").select("doc_id", "lang"), ["doc_id"], groups=["lang"])


_NULLED = "case when source in ('src0', 'src1') then null else lang end"


def _nulled(spark, sf):
    lang = F.when(~F.col("source").isin("src0", "src1"), F.col("lang"))
    return table(spark, sf, "documents").select("doc_id", lang.alias("lang"), F.length("text").alias("n"))


@register("row_index_null_groups", sql=f"""
select doc_id, lang, row_number() over (partition by lang order by doc_id) - 1 as row_idx,
       count(*) over (partition by lang) as n
from (select doc_id, {_NULLED} as lang from documents)
""")
def row_index_null_groups(spark, sf):
    """Index per group where null is a group too."""
    return with_row_index(_nulled(spark, sf).select("doc_id", "lang"), ["doc_id"], groups=["lang"], count_name="n")


@register("running_chars_null_groups", sql=f"""
select doc_id, lang, cast(sum(n) over (partition by lang order by doc_id) as bigint) as chars,
       cast(sum(n) over (partition by lang) as bigint) as chars_total
from (select doc_id, {_NULLED} as lang, length(text) as n from documents)
""")
def running_chars_null_groups(spark, sf):
    """Running sum and total per group where null is a group too."""
    r = running_sum(_nulled(spark, sf), ["doc_id"], {"chars": F.col("n")}, groups=["lang"], totals=True)
    return r.select("doc_id", "lang", "chars", "chars_total")


@register("split_ordered_docs", sql="""
select doc_id, case when row_number() over (order by doc_id) - 1 < (count(*) over () * 4) // 5
                    then 'train' else 'test' end as split
from documents
""")
def split_ordered_docs(spark, sf):
    """B2 ordered: the tail fifth is the test set."""
    return B.train_test_split(table(spark, sf, "documents").select("doc_id"), 0.2, "doc_id", "ordered")


@register("split_hashed_docs", sql="""
select doc_id,
       case when ('0x' || substr(md5(cast(doc_id as varchar)), 1, 15))::BIGINT < (1::BIGINT << 60) // 5
            then 'test' else 'train' end as split
from documents
""")
def split_hashed_docs(spark, sf):
    """B2 hash: the key's md5, as a fraction, under the test fraction."""
    return B.train_test_split(table(spark, sf, "documents").select("doc_id"), 0.2, "doc_id", "hash")


@register("split_of_train", sql="""
select doc_id from (
  select doc_id, row_number() over (order by doc_id) - 1 as ri, count(*) over () as n from documents)
where ri < (n * 4) // 5
""")
def split_of_train(spark, sf):
    """B1: rows of the named split."""
    s = B.train_test_split(table(spark, sf, "documents").select("doc_id"), 0.2, "doc_id", "ordered")
    return B.split_of(s, "train").select("doc_id")


@register("groups_docs", sql="""
select doc_id, cast(case when n // 7 = 0 then 6 else least((ri) // greatest(n // 7, 1), 6) end as integer) as "group"
from (select doc_id, row_number() over (order by doc_id) - 1 as ri, count(*) over () as n from documents)
""")
def groups_docs(spark, sf):
    """Seven contiguous groups, the last takes the rest."""
    return B.assign_groups(table(spark, sf, "documents").select("doc_id"), 7, "doc_id")


@register("batches_docs", sql="""
select doc_id, ri // 64 as batch
from (select doc_id, row_number() over (order by doc_id) - 1 as ri, count(*) over () as n from documents)
where ri // 64 < n // 64
""")
def batches_docs(spark, sf):
    """Batches of 64 in key order, short last batch dropped."""
    return B.assign_batches(table(spark, sf, "documents").select("doc_id"), 64, "doc_id", drop_last=True)


@register("batches_capped_docs", sql="""
select doc_id, ri // 16 as batch
from (select doc_id, row_number() over (order by doc_id) - 1 as ri from documents)
where ri // 16 < 10
""")
def batches_capped_docs(spark, sf):
    """Batches of 16, at most 10 batches (the reference's cap of 10)."""
    return B.assign_batches(table(spark, sf, "documents").select("doc_id"), 16, "doc_id", max_batches=10)


@register("batch_count_docs", sql="""
select count(*) as n_rows, cast(ceil(count(*) / 64) as bigint) as n_batches from documents
""")
def batch_count_docs(spark, sf):
    """Number of batches of 64 (keeping the short one)."""
    return B.batch_count(table(spark, sf, "documents"), 64, drop_last=False)


@register("workers_docs", sql="""
select doc_id, cast((row_number() over (order by doc_id) - 1) % 3 as integer) as worker from documents
""")
def workers_docs(spark, sf):
    """Shares for three workers."""
    return B.assign_workers(table(spark, sf, "documents").select("doc_id"), 3, "doc_id")


@register("collate_sentence_batches", sql=f"""
with {_DUCK_VOCAB},
{FX.DUCK["fx_sentences"]},
{duck_encoded("fx_sentences", "idx", "sentence", SEQ_LEN)},
b as (select e.idx, s.label, e.input_ids, (row_number() over (order by e.idx) - 1) // 16 as batch
      from enc e join fx_sentences s using (idx))
select batch, string_agg(cast(label as varchar), ',' order by idx) as labels,
       string_agg(array_to_string(input_ids, ' '), ' ' order by idx) as input_ids, count(*) as n_rows
from b group by batch
""")
def collate_sentence_batches(spark, sf):
    """B6 on encoded sentences (documents with a quality label): one row per
    batch of 16, arrays stacked in row order, labels kept as a list."""
    s = FX.sentences(spark, sf)
    enc = T.encode(s, T.build_vocab(table(spark, sf, "documents"), "text", VOCAB_SIZE), "idx",
                   "sentence", SEQ_LEN, keep=["label"])
    bat = B.assign_batches(enc, 16, "idx")
    col = T.collate(bat, "batch", "idx", ["input_ids"], "label")
    return col.select("batch", F.array_join(F.transform("labels", lambda x: x.cast("string")), ",").alias("labels"),
                      F.array_join(F.flatten("input_ids"), " ").alias("input_ids"),
                      F.size("labels").cast("bigint").alias("n_rows"))


@register("pad_word_lengths", sql=f"""
with t as (select doc_id, list_transform({_DUCK_TOKENS}, lambda x: length(x)) as lens from documents),
b as (select doc_id, lens, (row_number() over (order by doc_id) - 1) // 8 as batch from t)
select doc_id, batch, cast(max(len(lens)) over (partition by batch) as integer) as padded_len,
       cast(len(lens) as integer) as mask_sum, cast(coalesce(list_sum(lens), 0) as bigint) as total
from b
""")
def pad_word_lengths(spark, sf):
    """Per document the word lengths of the whole text, padded to the
    longest in its batch of 8, with a 1/0 mask."""
    docs = table(spark, sf, "documents").select(
        "doc_id", F.transform(tokens("text"), lambda t: F.length(t)).alias("lens"))
    bat = B.assign_batches(docs, 8, "doc_id")
    pad = T.pad_batch(bat, "lens", "batch", 0, "mask")
    return pad.select("doc_id", "batch", F.size("lens").alias("padded_len"),
                      F.aggregate("mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"),
                      F.aggregate("lens", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"))


@register("describe_encoded_docs", sql=f"""
with {_DUCK_VOCAB},
{duck_encoded("documents", "doc_id", "text", SEQ_LEN)}
select doc_id, 'input_ids' as "column", array_to_string(input_ids[1:5], ',') as first_ids,
       cast(len(input_ids) as integer) as length, 'array<int>' as dtype
from enc
""")
def describe_encoded_docs(spark, sf):
    """T4: first five ids, length and element type of each encoded row."""
    enc = T.encode(table(spark, sf, "documents"), T.build_vocab(table(spark, sf, "documents"), "text", VOCAB_SIZE),
                   "doc_id", "text", SEQ_LEN)
    d = T.describe_encoded(enc.select("doc_id", "input_ids"), ["input_ids"], head=5, keys=["doc_id"])
    return d.select("doc_id", "column", F.array_join(F.col("first_ids"), ",").alias("first_ids"), "length", "dtype")


# ---------------------------------------------------------------- P: row operators

BASE_URL = "https://mirror.example.org/resolve/main/"


@register("url_prefix_pages", sql=f"""
select page_id, '{BASE_URL}' || regexp_extract(url, '^[a-z]+://[^/]+/(.*)$', 1) as url from pages
""")
def url_prefix_pages(spark, sf):
    """A literal base before each page's path."""
    pages = table(spark, sf, "pages").select(
        "page_id", F.regexp_extract("url", r"^[a-z]+://[^/]+/(.*)$", 1).alias("path"))
    return P.with_url(pages, BASE_URL, "path", "url", keep=["page_id"])


@register("conform_embeddings", sql="""
select vec_id, cast(label as integer) as label, cast(len(embedding) as integer) as n_dims,
       round(list_sum(list_transform(embedding, lambda x: cast(x as double))), 6) as total
from embeddings
""")
def conform_embeddings(spark, sf):
    """Declared dtype map applied (``int32`` label, float64 arrays)."""
    c = P.conform(table(spark, sf, "embeddings"),
                  {"vec_id": "int64", "label": "int32", "embedding": "ndarray:float64"})
    return c.select("vec_id", "label", F.size("embedding").alias("n_dims"),
                    F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@register("top_orders_by_price", sql="""
select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10
""")
def top_orders_by_price(spark, sf):
    """First ten rows in a stated order (a top-k report)."""
    return P.take_n(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 10,
                    [F.desc("o_totalprice"), F.asc("o_orderkey")])


EXCLUDED_POSITIONS = [3, 10, 17, 42, 99, 500, 777]


@register("exclude_positions_docs", sql=f"""
select doc_id from (select doc_id, row_number() over (order by doc_id) - 1 as ri from documents)
where ri not in ({', '.join(map(str, EXCLUDED_POSITIONS))})
""")
def exclude_positions_docs(spark, sf):
    """P5: drop seven positions (positions, not ids)."""
    idx = with_row_index(table(spark, sf, "documents").select("doc_id"), ["doc_id"])
    return P.exclude_rows(idx, EXCLUDED_POSITIONS).select("doc_id")


@register("pending_after_round_one", sql="""
select page_id, status from (
  select page_id, case when page_id % 50 = 7 then 4 when (page_id + 1) % 3 = 0 then 8 else 0 end as status
  from pages)
where status is null or status <> 0
""")
def pending_after_round_one(spark, sf):
    """Rows still pending after the first attempt."""
    att = FX.attempts(spark, sf).filter(F.col("attempt") == 1).select("page_id", "status")
    return P.pending(att)


@register("profile_lineitem", sql="""
select (select count(*) from lineitem) as n_rows, cast(count(*) as integer) as n_columns,
       string_agg(column_name, ',' order by column_name) as columns
from (describe select * from lineitem)
""")
def profile_lineitem(spark, sf):
    """Row count, column count and the column names of the schema text."""
    p = P.profile(table(spark, sf, "lineitem"))
    names = F.regexp_extract_all("schema", F.lit(r"[<,](\w+):"), 1)
    return p.select("n_rows", F.col("n_columns").cast("int"), F.array_join(F.array_sort(names), ",").alias("columns"))


@register("latest_event_per_user", sql="""
select user_id, event_id from (
  select user_id, event_id, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
  from events) where rn = 1
""")
def latest_event_per_user(spark, sf):
    """Newest id per name (ties by id), ``max_by`` with partial aggregation."""
    return P.latest_by(table(spark, sf, "events"), "event_id", "ts", by=["user_id"])


@register("latest_click_run", sql="""
select event_id from events where event_type = 'click'
order by ts desc, event_id desc limit 1
""")
def latest_click_run(spark, sf):
    """The single newest match for an exact name."""
    ev = table(spark, sf, "events")
    return P.latest_by(ev, "event_id", "ts", pred=F.col("event_type") == "click")


@register("validate_boxes", sql=FX.duck_with("fx_objects") + """
select coalesce(reason, 'ok') as reason, count(*) as n from (
  select case when not (w > 0 and h > 0) then 'empty'
              when x + w > width then 'past_right'
              when y + h > height then 'past_bottom' end as reason
  from fx_objects) group by 1
""")
def validate_boxes(spark, sf):
    """Rows failing a rule set aside with the first failing rule."""
    obj = FX.objects(spark, sf)
    good, bad = P.split_valid(obj, {
        "empty": (F.col("w") > 0) & (F.col("h") > 0),
        "past_right": F.col("x") + F.col("w") <= F.col("width"),
        "past_bottom": F.col("y") + F.col("h") <= F.col("height"),
    })
    return (good.select(F.lit("ok").alias("reason")).unionByName(bad.select("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- N: scoring

CLASS_NAMES = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"]
_DUCK_LOGITS = "logits"


def _logits(spark, sf):
    return FX.logits(spark, sf)


@register("argmax_logits", sql=f"""
{FX.duck_with("fx_logits")}
select vec_id, cast(list_position({_DUCK_LOGITS}, list_max({_DUCK_LOGITS})) - 1 as integer) as pred
from fx_logits
""")
def argmax_logits(spark, sf):
    """Argmax of ten logits of the whole vector."""
    return N.with_argmax(_logits(spark, sf), "logits").select("vec_id", "pred")


@register("decode_class_names", sql=f"""
{FX.duck_with("fx_logits")}
select vec_id,
       {[n for n in CLASS_NAMES]}[list_position({_DUCK_LOGITS}, list_max({_DUCK_LOGITS}))] as pred_name,
       {[n for n in CLASS_NAMES]}[label + 1] as true_name
from fx_logits
""")
def decode_class_names(spark, sf):
    """Class ids decoded by list position, truth beside prediction."""
    df = N.with_argmax(_logits(spark, sf), "logits")
    df = N.decode(df, CLASS_NAMES, "pred", "pred_name")
    df = N.decode(df, CLASS_NAMES, "label", "true_name")
    return df.select("vec_id", "pred_name", "true_name")


_DUCK_LSE = (f"(cast(list_max({_DUCK_LOGITS}) as double) + ln(list_sum(list_transform({_DUCK_LOGITS}, "
             f"lambda x: exp(cast(x as double) - cast(list_max({_DUCK_LOGITS}) as double))))))")


@register("classify_softmax", sql=f"""
{FX.duck_with("fx_logits")}
select vec_id, {[n for n in CLASS_NAMES]}[list_position({_DUCK_LOGITS}, list_max({_DUCK_LOGITS}))] as label,
       round(1.0 / list_sum(list_transform({_DUCK_LOGITS},
             lambda x: exp(cast(x as double) - cast(list_max({_DUCK_LOGITS}) as double)))), 6) as score
from fx_logits
""")
def classify_softmax(spark, sf):
    """Best class name and its softmax probability."""
    c = N.classify(_logits(spark, sf), "logits", CLASS_NAMES)
    return c.select("vec_id", "label", F.round("score", 6).alias("score"))


@register("cross_entropy_by_label", sql=f"""
{FX.duck_with("fx_logits")}
select label, round(avg({_DUCK_LSE} - cast({_DUCK_LOGITS}[label + 1] as double)), 6) as cross_entropy,
       count(*) as n
from fx_logits group by label
""")
def cross_entropy_by_label(spark, sf):
    """Mean cross-entropy per true class."""
    ce = N.cross_entropy(_logits(spark, sf), "logits", "label", by=["label"])
    return ce.select("label", F.round("cross_entropy", 6).alias("cross_entropy"), "n")


@register("accuracy_overall", sql=f"""
{FX.duck_with("fx_logits")}
select round(avg(case when list_position({_DUCK_LOGITS}, list_max({_DUCK_LOGITS})) - 1 = label
                      then 1.0 else 0.0 end), 6) as accuracy, count(*) as n
from fx_logits
""")
def accuracy_overall(spark, sf):
    """Micro-averaged accuracy of the argmax."""
    a = N.accuracy(N.with_argmax(_logits(spark, sf), "logits"), "pred", "label")
    return a.select(F.round("accuracy", 6).alias("accuracy"), "n")


# a fitted model of at most this many numbers is gathered and broadcast
MODEL_CELLS = 4_000_000


def _centroids(emb):
    """Per-class mean vector, computed by Spark: one row per (class, dim),
    bounded by classes x dims."""
    return (emb.select("label", F.posexplode("embedding").alias("d", "x"))
            .groupBy("label", "d").agg(F.avg("x").alias("m")))


@register("predict_centroid_batches", sql="""
with m as (
  select label, d, avg(cast(x as double)) as m
  from (select label, unnest(embedding) as x, generate_subscripts(embedding, 1) as d from embeddings) group by label, d),
c as (select label as k, list(m order by d) as c from m group by label)
select vec_id, label, cast(arg_min(k, (dist, k)) as integer) as prediction
from (select e.vec_id, e.label, c.k,
             list_sum(list_transform(list_zip(e.embedding, c.c), lambda z: (cast(z[1] as double) - z[2]) ** 2)) as dist
      from embeddings e, c)
group by vec_id, label
""")
def predict_centroid_batches(spark, sf):
    """A model built once per worker (nearest class centroid, fitted by a
    Spark aggregation, broadcast) called on full batches of 100 rows inside ``mapInPandas``."""
    emb = table(spark, sf, "embeddings")
    fitted = _centroids(emb).checkpoint()  # classes x dims rows: a small model, if it is one
    if fitted.count() > MODEL_CELLS:
        raise ValueError(f"the centroids have more than {MODEL_CELLS} cells")
    cent = fitted.collect()
    labels = sorted({r["label"] for r in cent})
    dims = 1 + max(r["d"] for r in cent)
    mat = np.zeros((len(labels), dims))
    for r in cent:
        mat[labels.index(r["label"]), r["d"]] = r["m"]

    def make_model(weights):
        m, lab = weights

        def predict(pdf):
            x = np.stack(pdf["embedding"].to_numpy()).astype(float)
            d = ((x[:, None, :] - m[None, :, :]) ** 2).sum(axis=2)
            return lab[d.argmin(axis=1)].astype(int).tolist()
        return predict

    return N.predict_batches(emb, make_model, ["embedding"], "int", batch_size=100, weights=(mat, np.array(labels))).drop("embedding")


@register("isolate_failing_rows", sql="""
select page_id, case when length(url) % 7 <> 0 then length(url) end as result,
       case when length(url) % 7 = 0 then 'ValueError: refused ' || url end as error
from pages
""")
def isolate_failing_rows(spark, sf):
    """A batch function that raises for some rows; the batch is halved until those are alone, all others
    have their result."""
    def measure(pdf):
        n = pdf["url"].str.len()
        if (n % 7 == 0).any():
            raise ValueError(f"refused {pdf['url'][n % 7 == 0].iloc[0]}")
        return n.tolist()

    pages = table(spark, sf, "pages").select("page_id", "url")
    good, failed = N.isolate_failures(pages, measure, ["url"], "bigint", batch_size=64)
    return (good.select("page_id", "result", F.lit(None).cast("string").alias("error"))
            .unionByName(failed.select("page_id", F.lit(None).cast("bigint").alias("result"), "error")))


SYMBOLS = "#*$%&|<>"


@register("predict_text_label_score", sql="""
select doc_id, case when s.n * 20 > length(text) then 'markup' else 'prose' end as label,
       round(abs(least(1.0, s.n * 20.0 / greatest(length(text), 1)) - 0.5) + 0.5, 6) as score
from (select doc_id, text, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n from documents) s
""")
def predict_text_label_score(spark, sf):
    """N1 on whole texts with a struct answer (label, score): a model object
    built once per task, called on batches of 100."""
    def make_model():
        def predict(pdf):
            out = []
            for text in pdf["text"]:
                n = sum(text.count(c) for c in SYMBOLS)
                share = min(1.0, n * 20.0 / max(len(text), 1))
                out.append({"label": "markup" if n * 20 > len(text) else "prose", "score": abs(share - 0.5) + 0.5})
            return out
        return predict

    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = N.predict_batches(docs, make_model, ["text"], "struct<label: string, score: double>", out_col="answer")
    return out.select("doc_id", "answer.label", F.round("answer.score", 6).alias("score"))


def _sentence_split(spark, sf):
    return B.train_test_split(FX.sentences(spark, sf), 0.2, "idx", "hash")


@register("fit_text_classifier")
def fit_text_classifier(spark, sf):
    """N5 (re-aimed): fit a text classifier on the train split of labelled
    documents, score the held-out split."""
    s = _sentence_split(spark, sf)
    model = N.fit_classifier(B.split_of(s, "train"), "sentence", "label")
    out = model.transform(B.split_of(s, "test"))
    from pyspark.ml.functions import vector_to_array
    return out.select("idx", "label", F.col("prediction").cast("int").alias("prediction"),
                      F.round(F.get(vector_to_array("probability"), F.col("prediction").cast("int")), 6)
                      .alias("score"))


@register("score_saved_classifier")
def score_saved_classifier(spark, sf):
    """Save the fitted pipeline to the shared folder, load it, score, and
    hold the scores against those of the fitted model itself."""
    s = _sentence_split(spark, sf)
    model = N.fit_classifier(B.split_of(s, "train"), "sentence", "label")
    path = scratch_path(spark, "text-classifier")
    model.write().overwrite().save(path)
    test = B.split_of(s, "test")
    scored = N.score_saved(test, path)
    from pyspark.ml.functions import vector_to_array
    own = model.transform(test).select("idx", F.array_max(vector_to_array("probability")).alias("_own"))
    return scored.join(own, "idx").select(
        "idx", "label", F.col("prediction").cast("int").alias("prediction"), F.round("score", 6).alias("score"),
        (F.abs(F.col("score") - F.col("_own")) < 1e-9).alias("same_as_fitted"))


@register("keep_drop_columns", sql="""
select l_orderkey, l_quantity, l_extendedprice from lineitem
""")
def keep_drop_columns(spark, sf):
    """Keep named columns, then drop one (pruned at the scan)."""
    li = table(spark, sf, "lineitem")
    kept = P.keep_columns(li, ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount"])
    return P.drop_columns(kept, ["l_discount"])


@register("image_bytes_pages", sql="""
select page_id, cast(octet_length(encode(html)) as integer) as n_bytes from pages
""")
def image_bytes_pages(spark, sf):
    """P10: raw bytes resolved from a ``{bytes: ...}`` struct column (page
    markup stored the way image datasets store their pictures)."""
    pages = table(spark, sf, "pages").select(
        "page_id", F.struct(F.encode("html", "UTF-8").alias("bytes")).alias("image"))
    return P.image_bytes(pages).select("page_id", F.octet_length("image_bytes").alias("n_bytes"))


@register("parallelism_floor_pages", sql="""
select page_id, url from pages
""")
def parallelism_floor_pages(spark, sf):
    """At least 10 x default parallelism partitions for per-row work
    (the rows are unchanged)."""
    pages = spark.read.parquet(f"{sf.rstrip('/')}/pages.parquet").select("page_id", "url")
    return B.with_parallelism(pages, floor_factor=10)


@register("map_columns_docs", sql=f"""
select doc_id, lang, cast(len({_DUCK_TOKENS}) as integer) as n_tokens,
       cast(length(text) as integer) as n_text_chars
from documents
""")
def map_columns_docs(spark, sf):
    """Computed columns added, source columns removed."""
    d = table(spark, sf, "documents").select("doc_id", "lang", "text", "source")
    return T.map_columns(d, {"n_tokens": F.size(tokens("text")), "n_text_chars": F.length("text")},
                         remove=["text", "source"])
