"""I-Match fingerprints over several randomised lexicon subsets, all in DataFrame expressions.

The lexicon is the set of terms (lower-cased runs of letters and digits) whose document frequency,
counted over all documents, lies in a band of shares of the corpus: neither common words nor rare
ones, which copies lose first.  A share bounds the lexicon whatever the size of the corpus: at most
(mean distinct terms of a document) / ``LOW`` terms.  It is broadcast only if its counted size is within
``BROADCAST_TERMS``; beyond that the same join is shuffled.

The bits of a term's hash assign it to random subsets of the lexicon at three rates (an eighth, a
64th, a 512th; ``PER_RATE`` subsets each), so that short and long texts both have subsets with one or
two of their terms.  A fingerprint is the list of the hashes of a text's sorted distinct terms in
each subset (nothing for a subset without terms), and last the hash of all its lexicon terms, or of
the text itself if it has none.

With ``wide`` (a share; the registered query sets ``WIDE``) document frequency counts distinct texts, so
exact copies count once, and every fingerprint has a second band: all terms of the text but those in more than
``wide`` of the distinct texts (at most mean distinct terms / ``wide`` of them).  It stands behind a bar, or behind
a tilde where the text has fewer than ``FEW`` lexicon terms, such as the texts of a large group of near copies,
whose terms are all too frequent.  Without ``wide`` every row counts and there is one band.

The likeness of two fingerprints is a function of what they print.  It looks at the second bands if either text
has too few lexicon terms, else at the first ones: 1 if they are equal, else the best rate's share of equal subsets among those that either text has terms of (with one added to the
count, so that a single subset proves little).

``fingerprint_edits`` compares each document with an edited text of its own and with the next
document, in descending id order.

Defined results: a null text is the empty text; ids may be null (last in the order); rows that repeat
id and text are one document in the order, each giving an equal row; the only document is its own
next; an empty table gives no rows.  Only the id and the text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.index import with_row_index
from ..session import checkpoint_dir, scratch_path
from .common import KEY, key_columns, release

LOW, HIGH = 0.001, 0.02
BROADCAST_TERMS = 1 << 20
PER_RATE = 16
RATES = 3
FEW, WIDE = 8, 0.5


def term_keys_sql(text: str) -> str:
    return (rf"array_distinct(transform(filter(split(lower({text}), r'[^\p{{L}}\p{{N}}]+'), w -> w <> ''), "
            "w -> xxhash64(w) & -2L))")


def term_keys(text: str) -> Column:
    """Distinct terms of a text as even 64-bit hashes."""
    return F.expr(term_keys_sql(text))


def _distinct_texts(docs: DataFrame, text_col: str) -> tuple[DataFrame, int]:
    """The distinct texts and their number.  Only texts that occur again are shuffled."""
    spark = docs.sparkSession
    path = scratch_path(spark, "repeated-texts")
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("_h", F.xxhash64("text"))
    texts.groupBy("_h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").write.parquet(path)
    repeated = spark.read.schema("_h bigint, n bigint").parquet(path)
    found, more = repeated.agg(F.count("n"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).first()
    keys = F.broadcast(repeated.select("_h")) if found <= BROADCAST_TERMS else repeated.select("_h")
    once = texts.join(keys, "_h", "left_semi").dropDuplicates(["_h"])
    return texts.join(keys, "_h", "left_anti").select("text").union(once.select("text")), docs.count() - more


def lexicon(docs: DataFrame, text_col: str = "text", low: float = LOW, high: float = HIGH,
            wide: float | None = None) -> DataFrame:
    """Keys of the terms with a document frequency between ``low`` and ``high`` of all documents; with
    ``wide``, of all distinct texts, and also (``common``) those above ``wide``."""
    spark = docs.sparkSession
    path = scratch_path(spark, "lexicon")
    if wide is not None:
        texts, n = _distinct_texts(docs, text_col)
        band, common = F.col("df").between(low * n, high * n), F.col("df") > wide * n
        (texts.select(F.explode(term_keys("text")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("df"))
         .filter(band | common).select("key", (~band).alias("common")).write.parquet(path))
        return spark.read.schema("key bigint, common boolean").parquet(path)
    keys = docs.select(F.explode(term_keys(f"coalesce(`{text_col}`, '')")).alias("key"))
    n = docs.count()
    (keys.groupBy("key").agg(F.count(F.lit(1)).alias("df"))
     .filter(F.col("df").between(low * n, high * n)).select("key").write.parquet(path))
    return spark.read.schema("key bigint").parquet(path)


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def subset_hashes(terms: str, text_hash: str) -> Column:
    """The fingerprint (array of 31-bit hashes) of sorted distinct lexicon terms.  Two groups of the
    bits of a term's hash each deal the terms to eight subsets; the next bits deal the first of these
    to eight finer ones, and so on, so finer rates pass over few terms."""
    def eighth(source: str, group: int, rate: int, c: int) -> str:
        return f"filter({source}, t -> (shiftright(t, {2 + 24 * group + 3 * rate}) & 7) = {c})"

    def source(group: int, rate: int) -> str:
        return f"r{rate}g{group}" if rate else "a"

    hashes = [_let("s", eighth(source(g, r), g, r, c), "if(size(s) = 0, null, cast(xxhash64(s) & 2147483647L as int))")
              for r in range(RATES) for g in range(2) for c in range(PER_RATE // 2)]
    body = (f"array({', '.join(hashes)}, "
            f"cast(if(size(a) = 0, {text_hash}, xxhash64(a)) & 2147483647L as int))")
    for r in range(RATES - 1, 0, -1):
        for g in range(2):
            body = _let(source(g, r), eighth(source(g, r - 1), g, r - 1, 0), body)
    return F.expr(_let("a", terms, body))


def printed(prints: str) -> Column:
    """A fingerprint as text: eight hexadecimal digits, or a hyphen, for each subset."""
    return F.expr(f"array_join(transform({prints}, x -> if(x is null, '-', lower(lpad(hex(x), 8, '0')))), '.')")


def printed_bands(first: str, second: str, few: str) -> Column:
    """Both bands as text, with the mark of texts with too few lexicon terms between them."""
    return F.concat(printed(first), F.expr(f"if({few}, '~', '|')"), printed(second))


def likeness(a: str, b: str) -> Column:
    def rate(i: int) -> str:
        x, y = (f"slice({c}, {i * PER_RATE + 1}, {PER_RATE})" for c in (a, b))
        return (f"aggregate(zip_with({x}, {y}, (x, y) -> if(x is null and y is null, 0, if(x <=> y, 1001, 1))), 0, "
                # thousands count equal subsets, units all that either text has terms of
                "(s, p) -> s + p, s -> (s div 1000) / (1.0D + s % 1000))")
    return F.expr(f"if({a} = {b}, 1.0D, greatest({', '.join(rate(i) for i in range(RATES))}))")


def _lexicon_terms(rows: DataFrame, terms: DataFrame, texts: list[str], keep: list[str]) -> DataFrame:
    """The lexicon terms of each text column (one or two) of ``rows``, as _t0 and _t1, by ``keep``."""
    codes = ", ".join(f"transform(_t{i}, t -> t | {i}L)" for i in range(len(texts)))
    for i, text in enumerate(texts):
        rows = rows.withColumn(f"_t{i}", term_keys(text))
    # key 0 stands in every document, so documents without lexicon terms stay
    each = (rows.select(*keep, F.explode(F.expr(f"concat(array(0L), {codes})")).alias("_c"))
            .withColumn("key", F.expr("_c & -2L")))
    if terms.count() <= BROADCAST_TERMS:
        marked = terms.select("key").union(terms.sparkSession.range(1).select(F.lit(0).cast("long").alias("key")))
        each = each.join(F.broadcast(marked), "key")
    else:  # key 0, of every document, takes no part in a shuffle by key
        each = each.filter("key <> 0").join(terms.select("key"), "key", "left_semi").unionByName(each.filter("key = 0").select("key", *keep, "_c"))
    lists = [F.collect_list(F.when((F.col("key") != 0) & (F.expr("_c & 1L") == i), F.col("key"))).alias(f"_t{i}")
             for i in range(len(texts))]
    return each.groupBy(*keep).agg(*lists)


def _wide_hashes(terms: DataFrame):
    """(text, its hash) -> fingerprint by the second band."""
    common = ", ".join(f"{r['key']}L" for r in terms.filter("common").select("key").collect())
    return lambda text, text_hash: subset_hashes(
        f"sort_array(array_except({term_keys_sql(text)}, cast(array({common}) as array<bigint>)))", text_hash)


def fingerprint(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of every document."""
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("_h", F.xxhash64("text"))
    keep = ["_row", "doc_id", "_h"]
    if "common" in terms.columns:
        rows = rows.withColumn("_w", _wide_hashes(terms)("text", "_h"))
        found = _lexicon_terms(rows, terms.filter("not common"), ["text"], [*keep, "_w"])
        found = found.select("doc_id", subset_hashes("sort_array(_t0)", "_h").alias("p"), "_w", (F.size("_t0") < FEW).alias("few"))
        return found.select("doc_id", printed_bands("p", "_w", "few").alias("fingerprint"))
    found = _lexicon_terms(rows, terms, ["text"], keep)
    return (found.select("doc_id", subset_hashes("sort_array(_t0)", "_h").alias("p"))
            .select("doc_id", printed("p").alias("fingerprint")))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      low: float = LOW, high: float = HIGH, wide: float | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    folder = scratch_path(spark, "imatch")
    terms = lexicon(docs, text_col, low, high, wide)
    base = docs.select(*key_columns(id_col, text_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    donor = _donors(base)
    release(spark)  # the shuffles of the lexicon and of the order, before the texts are shuffled

    # both bands in one query, so the texts are shuffled once and that exchange is read again for the second band
    prints = edited_texts(base, donor)
    keep = [*KEY, "_copy", "n_chars", "_e", "edited_sha256"]
    out = (_lexicon_terms(prints, terms.filter("not common") if wide is not None else terms, ["text", "edited"], keep)
           .select(*keep, subset_hashes("sort_array(_t0)", "_h").alias("p"), subset_hashes("sort_array(_t1)", "_e").alias("e"),
                   (F.size("_t0") < FEW).alias("p_few"), (F.size("_t1") < FEW).alias("e_few"), F.lit(1).alias("band")))
    if wide is not None:
        second = _wide_hashes(terms)
        out = out.unionByName(prints.filter("_copy = 1").select(*KEY, second("text", "_h").alias("pw"), second("edited", "_e").alias("ew"),
                                                                F.lit(2).alias("band")), allowMissingColumns=True)
    out.write.partitionBy("band").parquet(f"{folder}/prints")
    del base, prints, out
    release(spark)  # the shuffled texts, before the fingerprints are shuffled
    kinds = "_id long, _null int, _h long, _copy int, n_chars long, _e long, edited_sha256 string, p array<int>, e array<int>, p_few boolean, e_few boolean"
    more = ", pw array<int>, ew array<int>" if wide is not None else ""
    written = spark.read.schema(f"{kinds}{more}, band int").parquet(f"{folder}/prints")
    rows = written.filter("band = 1").select(*keep, "p", "e", "p_few", "e_few")
    to = [F.col(f"to{k}").alias(k) for k in KEY]
    following = (rows.filter("_copy = 1").select(*KEY, F.col("p").alias("q"), F.col("p_few").alias("q_few"))
                 .join(donor.drop("need"), KEY))
    if wide is None:
        return rows.join(following.select(*to, "q"), KEY).select(
            *_edit_columns(), printed("p").alias("fingerprint"), printed("e").alias("edited_fingerprint"),
            likeness("p", "e").alias("near_edited"), likeness("p", "q").alias("near_next"))

    both = written.filter("band = 2").select(*KEY, "pw", "ew")
    following = following.join(both.select(*KEY, F.col("pw").alias("qw")), KEY).select(*to, "q", "q_few", "qw")

    def near(x: str) -> Column:
        return F.when(F.col("p_few") | F.col(f"{x}_few"), likeness("pw", f"{x}w")).otherwise(likeness("p", x))

    return rows.join(following, KEY).join(both, KEY).select(
        *_edit_columns(), printed_bands("p", "pw", "p_few").alias("fingerprint"), printed_bands("e", "ew", "e_few").alias("edited_fingerprint"),
        near("e").alias("near_edited"), near("q").alias("near_next"))


def _donors(base: DataFrame) -> DataFrame:
    """KEY, to KEY and need: the document that each document's beginning goes to, and how many code points of it."""
    # the order, on keys and lengths only: each document's donor is the next one, the last one's the first
    keys = base.select(*KEY, F.length("text").cast("long").alias("n")).distinct().checkpoint()
    placed = with_row_index(keys, [F.col("_null"), F.col("_id").desc(), F.col("_h")], "at", count_name="all")
    order = placed.select(*KEY, "n", "at", "all").checkpoint()
    taker = order.select(((F.col("at") + 1) % F.col("all")).alias("at"), *[F.col(k).alias(f"to{k}") for k in KEY],
                         F.expr("cast(n div 3 as int)").alias("need"))
    return order.select("at", *KEY).join(taker, "at").drop("at").checkpoint()


def _edit_columns() -> list[Column]:
    return [F.when(F.col("_null") == 0, F.col("_id")).alias("doc_id"), F.col("n_chars"), F.col("edited_sha256")]


def edited_texts(base: DataFrame, donor: DataFrame) -> DataFrame:
    """KEY, _copy, text, edited and their figures of the rows of ``base`` that ``donor`` gives a beginning to."""
    # texts meet on one exchange by key, used twice: to give their beginnings and to take them
    # (a running count: row_number() with a filter would be pushed below one of the two exchanges)
    so_far = Window.partitionBy(*KEY).orderBy("_h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    copies = base.withColumn("_copy", F.count(F.lit(1)).over(so_far).cast("int"))
    given = (copies.filter("_copy = 1").drop("_copy").join(donor, KEY)
             .select(*[F.col(f"to{k}").alias(k) for k in KEY], "need", F.expr("substring(text, 1, need)").alias("end")))
    return (copies.join(given, KEY)
            .select(*KEY, "_copy", "text", F.length("text").cast("long").alias("n_chars"),
                    F.expr("concat(substring(text, 1, char_length(text) - need), end)").alias("edited"))
            .withColumn("_e", F.xxhash64("edited")).withColumn("edited_sha256", F.sha2("edited", 256)))
