"""Quality rules: surface counts, then a hashed n-gram log-likelihood ratio, all in DataFrame expressions.

Words and word pairs are hashed into ``BUCKETS`` buckets.  Two multinomials over the buckets are
counted: the trusted target (documents labelled good; at most ``TRUSTED_DOCS`` of them, those with the
smallest hashes, so their ids may be broadcast) and the raw corpus (every document).  Were they one
multinomial, the trusted target would hold a bucket's share of the raw corpus times its own number of n-grams.
A document's score is the mean over its n-grams of ``ln((found + PRIOR) / (expected + PRIOR))``, so length does
not matter; it is kept if it passes the base rule and scores ``THRESHOLD`` or more, one value at every size.  The
prior draws a bucket towards the raw corpus that the trusted target is too small to say anything about:
where little is expected, finding nothing weighs little.  A corpus joined by copies of itself keeps every verdict.
Ratios are rounded to integers (millionths) before they are summed, so scores and verdicts do not depend on
the order of rows.

Both passes are scans with a bounded aggregation: counts per bucket (partial in each task), and sums
per document joined to a broadcast model of ``BUCKETS`` rows.  No text is shuffled.

Defined results: a null or empty text has no words, fails the base rule and is not kept, its score is
null; a null id is kept and never trusted; repeated rows are scored one by one; ties with the threshold are kept;
with no trusted document every score is 0 and nothing is kept; an empty table gives no rows.  Very long texts are
arrays of their words inside one row.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import KEY, WS, hashed_sample, key_columns

BUCKETS = 1 << 16
TRUSTED_DOCS = 20_000
PRIOR = 20.0
THRESHOLD = -0.09
#: fixed values of the base rule
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]+"
_BLANKS = " \t\n\x0b\x0c\r"


class Model(NamedTuple):
    ratios: DataFrame  # (bucket, ratio in millionths), at most ``buckets`` rows
    threshold: float


def words_of(text: Column) -> Column:
    """The words of a text as an array (empty without words)."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(_BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WS))


def hashed(words: str) -> Column:
    return F.expr(f"transform({words}, w -> xxhash64(w))")


def gram_buckets(hashes: str, buckets: int) -> Column:
    """Buckets of the words and of the pairs of neighbouring words."""
    return F.expr(f"""concat(transform({hashes}, a -> cast(pmod(a, {buckets}) as int)),
        zip_with(slice({hashes}, 1, greatest(size({hashes}) - 1, 0)), slice({hashes}, 2, greatest(size({hashes}) - 1, 0)),
                 (a, b) -> cast(pmod(xxhash64(a, b), {buckets}) as int)))""")


def repeat_words(hashes: str) -> Column:
    """Words lying in 3-word windows that occur twice or more.  Windows are sorted by hash, those equal
    to a neighbour are kept, and the words their positions cover are counted from left to right."""
    windows = f"transform(sequence(0, size({hashes}) - 3), i -> xxhash64({hashes}[i], {hashes}[i + 1], {hashes}[i + 2]))"
    # transform(array(x), v -> ...)[0] binds x to v, so it is computed once
    covered = """transform(array(sort_array(transform(v, (h, i) -> struct(h, i)))), s ->
        transform(array(sort_array(array_compact(transform(s, (x, k) ->
            if(x.h = get(s, k - 1).h or x.h = get(s, k + 1).h, x.i, null))))), p ->
        aggregate(transform(p, (x, k) -> least(3, x - coalesce(get(p, k - 1), -3))), 0L, (a, x) -> a + x))[0])[0]"""
    return F.expr(f"""if(size({hashes}) < 4, 0L, transform(array({windows}), v ->
        if(size(array_distinct(v)) = size(v), 0L, {covered}))[0])""")


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with words' hashes (_hw) and the surface counts of the base rule."""
    counted = (
        docs.withColumn("_w", words_of(F.col(text)))
        .withColumn("word_chars", F.expr("aggregate(_w, 0L, (s, w) -> s + char_length(w))"))
        .withColumn("n_symbols", F.coalesce(F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, "")), F.lit(0)).cast("long"))
        .withColumn("_l", F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
        .withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
        .withColumn("_hw", hashed("_w")).drop("_w", "_l"))
    return (counted.withColumn("n_words", F.size("_hw").cast("long"))
            .withColumn("n_repeat_words", repeat_words("_hw"))
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))))


def fit(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        buckets: int = BUCKETS, trusted_docs: int = TRUSTED_DOCS) -> Model:
    """The ratio of every bucket that occurs, and the threshold (none can pass without trusted n-grams); ``trusted``
    has the good ids."""
    checkpoint_dir(docs.sparkSession)
    ids = hashed_sample(trusted.select(F.col(id_col).alias("_t")).filter("_t is not null").distinct(), ["_t"], trusted_docs)
    marked = (docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("_w"))
              .join(F.broadcast(ids), F.col("doc_id") == F.col("_t"), "left")
              .select(F.col("_t").isNotNull().cast("int").alias("good"), hashed("_w").alias("_hw"))
              .select("good", F.explode(gram_buckets("_hw", buckets)).alias("bucket")))
    counts = marked.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("good").alias("good")).checkpoint()
    n_good = counts.agg(F.sum("good")).first()[0] or 0
    whole = Window.partitionBy()  # over at most ``buckets`` rows
    expected = n_good * (F.col("raw") / F.sum("raw").over(whole))
    ratios = counts.select("bucket", F.round(1e6 * F.log((F.col("good") + PRIOR) / (expected + PRIOR))).cast("long").alias("ratio"))
    return Model(ratios, THRESHOLD if n_good else float("inf"))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          buckets: int = BUCKETS) -> DataFrame:
    """doc_id, the counts, base_failed, score and kept, and the row's KEY."""
    base = base_counts(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                                   *key_columns(id_col, text_col))).drop("text")
    kept = ["doc_id", *KEY, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    # all n-grams of a row are in one task: its partial sum is one row
    each = (base.select(F.monotonically_increasing_id().alias("_row"), *kept, gram_buckets("_hw", buckets).alias("_g"))
            .select("_row", *kept, F.explode_outer("_g").alias("bucket"))
            .join(F.broadcast(model.ratios), "bucket", "left"))
    out = each.groupBy("_row").agg(*[F.first(c).alias(c) for c in kept], F.sum("ratio").alias("_sum"),
                                   F.count("bucket").alias("_n"))
    mean = F.when(F.col("_n") > 0, F.coalesce("_sum", F.lit(0)) / (1e6 * F.col("_n")))
    return (out.withColumn("score", mean)
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("score") >= model.threshold, F.lit(False)))
            .drop("_row", "_sum", "_n"))


def filter_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                     buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    good = score(docs, model, id_col, text_col, buckets).filter("kept").select(*KEY).distinct()
    row = docs.select(*key_columns(id_col, text_col), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return row.join(good, KEY, "left_semi").select("row.*")
