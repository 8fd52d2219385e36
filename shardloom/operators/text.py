"""Text encoding: vocabulary (T1), fixed-length encoding (T2), column maps (T3),
encoded-sample inspection (T4), batch collation (B6) and padding (B7).

The reference loads a pretrained sub-word vocabulary; we count words in the
corpus instead.  Everything is expressions, a join to the vocabulary (broadcast
when its counted size allows) and grouping by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import CLS, PAD, SEP, SPECIALS, UNK, tokens
from ..session import checkpoint_dir
from .index import with_row_index


def build_vocab(df: DataFrame, text_col: str = "text", size: int = 30000,
                specials: Sequence[str] = SPECIALS) -> DataFrame:
    """Vocabulary ``(token, id, count)``: the ``size`` most frequent words of
    the whole corpus by (count desc, token), numbered after the specials.

    Word counts are aggregated map-side first, so a word holding a third of
    all tokens costs one partial row per task.  The ranking is the
    distributed row index over the count table (a range cut), not a global
    top-k: ``limit`` would merge ``size`` rows from every partition in one
    task, which at tens of thousands of words and thousands of partitions is
    a single-task funnel.  The ranking runs when this is called (its range
    cut is checkpointed); the returned frame reads that checkpoint.
    """
    spark = df.sparkSession
    words = df.select(F.explode(tokens(text_col)).alias("token"))
    counts = words.groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    idx = with_row_index(counts, [F.desc("count"), F.asc("token")], "_r")
    ranked = idx.filter(F.col("_r") < size).select(
        "token", (F.col("_r") + len(specials)).alias("id"), "count")
    sp = spark.createDataFrame([(t, i) for i, t in enumerate(specials)], "token string, id int")
    sp = sp.select("token", F.col("id").cast("int").alias("id"), F.lit(None).cast("bigint").alias("count"))
    return sp.unionByName(ranked.select("token", F.col("id").cast("int").alias("id"), "count"))


# A vocabulary of at most this many counted entries is broadcast (a few tens of MB).
BROADCAST_ENTRIES = 1_000_000


def _vocab_side(vocab: DataFrame) -> DataFrame:
    """(_tok, _id), materialised once; broadcast only if its counted size is
    within the bound, else joined by whatever the planner picks."""
    checkpoint_dir(vocab.sparkSession)
    side = vocab.select(F.col("token").alias("_tok"), F.col("id").alias("_id")).checkpoint()
    return F.broadcast(side) if side.count() <= BROADCAST_ENTRIES else side


def token_counts(df: DataFrame, vocab: DataFrame, by: Sequence[str], text_col: str = "text") -> DataFrame:
    """Rows, tokens and unknown tokens of whole texts per group: ``(*by,
    n_docs, n_tokens, n_unknown)``.  Tokens are counted per (group, token)
    before they meet the vocabulary, so the shuffle holds distinct tokens."""
    words = df.select(*by, F.explode(tokens(text_col)).alias("_w")).groupBy(*by, "_w").agg(
        F.count(F.lit(1)).alias("_n"))
    voc = _vocab_side(vocab)
    counted = (words.join(voc, words["_w"] == voc["_tok"], "left").groupBy(*by).agg(
        F.sum("_n").alias("n_tokens"), F.sum(F.when(F.col("_id").isNull(), F.col("_n")).otherwise(0)).alias("n_unknown")))
    docs = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_docs"))
    right = counted.withColumnsRenamed({c: f"_k{i}" for i, c in enumerate(by)})
    on = F.lit(True)
    for i, c in enumerate(by):
        on = on & docs[c].eqNullSafe(right[f"_k{i}"])
    return docs.join(right, on, "left").select(
        *by, "n_docs", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("n_tokens", "n_unknown")])


def encode(df: DataFrame, vocab: DataFrame, key: str | Sequence[str], text_col: str = "text",
           max_length: int = 256, keep: Sequence[str] = ()) -> DataFrame:
    """Fixed-length encoding: ``[CLS] w1 .. wk [SEP] [PAD]..`` with
    ``k <= max_length - 2`` (truncation), ``attention_mask`` 1 on real tokens,
    ``token_type_ids`` all 0 (single sentence).  Unknown words map to [UNK].

    One output row for each input row, also when ``key`` repeats: rows are
    numbered before they are exploded.  ``key`` and ``keep`` columns are
    carried along.  The token list is cut by position *before* exploding, so
    no row beyond the length is generated.  All tokens of a row stay in one
    task when the vocabulary is broadcast (see ``_vocab_side``), so the
    grouping behind it moves one row for each text.
    """
    keys = [key] if isinstance(key, str) else list(key)
    body = max_length - 2
    if body < 0:
        raise ValueError("max_length must be at least 2")
    cut = F.slice(tokens(text_col), 1, body) if body > 0 else F.array().cast("array<string>")
    carried = list(dict.fromkeys([*keys, *keep]))
    # numbered in a step of its own: beside the generator the number would be the token's
    numbered = df.select(F.monotonically_increasing_id().alias("_row"), *carried, cut.alias("_cut"))
    exploded = numbered.select("_row", *carried, F.posexplode_outer("_cut").alias("pos", "token"))
    voc = _vocab_side(vocab)
    joined = exploded.join(voc, exploded["token"] == voc["_tok"], "left")
    item = F.when(F.col("pos").isNotNull(),
                  F.struct(F.col("pos"), F.coalesce(F.col("_id"), F.lit(UNK)).alias("id")))
    grouped = joined.groupBy("_row").agg(
        *[F.first(c).alias(c) for c in carried],
        F.array_sort(F.collect_list(item)).alias("_p"))
    ids = F.col("_p.id").cast("array<int>")
    n = F.size(F.col("_p"))
    pad_n = F.lit(body) - n
    input_ids = F.concat(F.array(F.lit(CLS)), ids, F.array(F.lit(SEP)),
                         F.array_repeat(F.lit(PAD), pad_n))
    mask = F.concat(F.array_repeat(F.lit(1), n + 2), F.array_repeat(F.lit(0), pad_n))
    return grouped.select(
        *carried,
        input_ids.alias("input_ids"),
        F.array_repeat(F.lit(0), F.lit(max_length)).alias("token_type_ids"),
        mask.alias("attention_mask"))


def map_columns(df: DataFrame, exprs: dict[str, Column], remove: Sequence[str] = ()) -> DataFrame:
    """Add computed columns, then drop the source columns."""
    out = df
    for name, e in exprs.items():
        out = out.withColumn(name, e)
    return out.drop(*remove)


def describe_encoded(df: DataFrame, columns: Sequence[str], head: int = 5,
                     keys: Sequence[str] = ()) -> DataFrame:
    """T4: per row and column, the first ``head`` ids, the array length and
    the element type, as a long frame ``(*keys, column, first_ids, length, dtype)``."""
    types = dict(df.dtypes)
    parts = [df.select(*keys, F.lit(c).alias("column"), F.slice(F.col(c), 1, head).alias("first_ids"),
                       F.size(F.col(c)).alias("length"), F.lit(types[c]).alias("dtype"))
             for c in columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def collate(df: DataFrame, batch_col: str, order_col: str, feature_cols: Sequence[str],
            label_col: str | None = "label", rename_label: str | None = "labels") -> DataFrame:
    """One row per batch; each feature column becomes the list of its
    values in row order (a stacked array), labels stay a list (renamed to
    ``labels`` like the default collator).  Batches are bounded by the batch
    size, so each ``collect_list`` is bounded."""
    carried = [*feature_cols] + ([label_col] if label_col else [])
    agg = df.groupBy(batch_col).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("_o"),
                                             *[F.col(c) for c in carried]))).alias("_rows"))
    def field(name):
        return lambda r: r[name]

    sel = [F.col(batch_col)]
    for c in feature_cols:
        sel.append(F.transform("_rows", field(c)).alias(c))
    if label_col:
        sel.append(F.transform("_rows", lambda r: r[label_col]).alias(rename_label or label_col))
    return agg.select(*sel)


def pad_batch(df: DataFrame, col: str, batch_col: str, pad: int = 0,
              mask_col: str = "pixel_mask") -> DataFrame:
    """Pad each array to the longest in its batch and add a 1/0 mask."""
    m = F.max(F.size(F.col(col))).over(Window.partitionBy(batch_col))
    return (df.withColumn("_m", m)
            .withColumn(mask_col, F.concat(F.array_repeat(F.lit(1), F.size(F.col(col))),
                                           F.array_repeat(F.lit(0), F.col("_m") - F.size(F.col(col)))))
            .withColumn(col, F.concat(F.col(col), F.array_repeat(F.lit(pad).cast(
                df.schema[col].dataType.elementType), F.col("_m") - F.size(F.col(col)))))
            .drop("_m"))
