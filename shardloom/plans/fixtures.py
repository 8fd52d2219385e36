"""Frames derived from the driver's tables (see FIXTURES.md), as Spark
DataFrames and as DuckDB common table expressions for the oracle SQL.

The derivations are arithmetic only, so both engines agree: sentences are
labelled documents, images are orders, boxes are line items, predictions are
shifted boxes with some classes changed, logits and detector outputs are fixed
small-integer projections of the whole embedding, URLs are page addresses.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .registry import table

# The five class names of the box fixtures.
CLASSES = [(0, "person"), (1, "car"), (2, "dog"), (3, "cup"), (4, "tree")]


def sentences(spark, sf):
    d = table(spark, sf, "documents")
    lab = table(spark, sf, "labels")
    return d.join(lab, "doc_id").select(F.col("doc_id").alias("idx"), F.col("text").alias("sentence"),
                                        F.col("quality").alias("label"))


def classes(spark, sf=None):
    return spark.createDataFrame(CLASSES, "category_id int, category_name string")


def images(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    return o.select(k.alias("image_id"),
                    (F.lit(320) + k % 5 * 80).cast("int").alias("width"),
                    (F.lit(240) + k % 4 * 80).cast("int").alias("height"))


def objects(spark, sf):
    """Corner+size boxes, one row per line item, numbered per image."""
    li = table(spark, sf, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity",
        "l_discount", "l_tax")
    li = li.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                   F.row_number().over(w).cast("bigint").alias("bbox_id"))
    im = images(spark, sf)
    j = li.join(im, li["l_orderkey"] == im["image_id"])
    return j.select(
        "image_id", "bbox_id",
        (F.col("l_partkey") % 5).cast("int").alias("category"),
        ((F.col("l_partkey") * 37 + F.col("bbox_id") * 11) % (F.col("width") - 20)).cast("double").alias("x"),
        ((F.col("l_suppkey") * 53 + F.col("bbox_id") * 7) % (F.col("height") - 20)).cast("double").alias("y"),
        (F.lit(2) + F.col("l_quantity") * 2).cast("double").alias("w"),
        (F.lit(4) + F.col("l_partkey") % 90).cast("double").alias("h"),
        "width", "height")


def truth(spark, sf):
    o = objects(spark, sf)
    return o.select("image_id", F.col("bbox_id").alias("gt_id"), F.col("category").alias("label"),
                    F.col("x").alias("x1"), F.col("y").alias("y1"),
                    (F.col("x") + F.col("w")).alias("x2"), (F.col("y") + F.col("h")).alias("y2"))


def pred(spark, sf):
    o = objects(spark, sf).filter((F.col("image_id") * 3 + F.col("bbox_id")) % 9 != 0)
    i, b = F.col("image_id"), F.col("bbox_id")
    dx = (i % 7) * F.col("w") / 20
    dy = (b % 5) * F.col("h") / 20
    return o.select(
        "image_id", b.alias("det_id"),
        F.when((i + b) % 11 == 0, (F.col("category") + 1) % 5).otherwise(F.col("category")).cast("int").alias("label"),
        (F.col("x") + dx).alias("x1"), (F.col("y") + dy).alias("y1"),
        (F.col("x") + dx + F.col("w")).alias("x2"), (F.col("y") + dy + F.col("h")).alias("y2"),
        (((i * 7919 + b * 104729) % 1000003).cast("double") / 1000003).alias("score"))


def _projected(mult, modulus: int, scale: float):
    """sum over the whole vector of ``x[i] * (i * mult mod modulus - modulus // 2)`` / scale."""
    terms = F.transform("embedding", lambda x, i: x.cast("double") * ((i * mult) % modulus - modulus // 2))
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / scale


def _duck_projected(mult: str, modulus: int, scale: float) -> str:
    return (f"list_sum(list_transform(embedding, lambda x, i: cast(x as double) * "
            f"(((i - 1) * {mult}) % {modulus} - {modulus // 2}))) / {scale}")


def logits(spark, sf):
    """Ten logits of every vector, each a projection of all its values."""
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.array(*[_projected(c + 2, 7, 4.0) for c in range(10)]).alias("logits"), "label")


def urls(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url")


def attempt_status(page_id, attempt):
    """Outcome of attempt ``k`` for a page (a deterministic stand-in for a
    download): ids ending in 7 modulo 50 always fail with 4; some fail with
    8 on their first two attempts; the rest succeed (0)."""
    return (F.when(page_id % 50 == 7, F.lit(4))
            .when(((page_id + attempt) % 3 == 0) & (attempt < 3), F.lit(8))
            .otherwise(F.lit(0)))


def attempts(spark, sf):
    p = urls(spark, sf)
    a = p.select("page_id", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("attempt"))
    return a.select("page_id", "attempt", attempt_status(F.col("page_id"), F.col("attempt")).alias("status"))


# ---------------------------------------------------------------- DuckDB forms

DUCK = {
    "fx_sentences": """fx_sentences as (
  select d.doc_id as idx, d.text as sentence, l.quality as label
  from documents d join labels l on d.doc_id = l.doc_id)""",
    "fx_classes": """fx_classes as (
  select * from (values (0, 'person'), (1, 'car'), (2, 'dog'), (3, 'cup'), (4, 'tree')) as t(category_id, category_name))""",
    "fx_images": """fx_images as (
  select o_orderkey as image_id, cast(320 + o_orderkey % 5 * 80 as int) as width,
         cast(240 + o_orderkey % 4 * 80 as int) as height
  from orders)""",
    "fx_objects": """fx_objects as (
  select l.l_orderkey as image_id, l.bbox_id, cast(l.l_partkey % 5 as int) as category,
    cast((l.l_partkey * 37 + l.bbox_id * 11) % (i.width - 20) as double) as x,
    cast((l.l_suppkey * 53 + l.bbox_id * 7) % (i.height - 20) as double) as y,
    cast(2 + l.l_quantity * 2 as double) as w, cast(4 + l.l_partkey % 90 as double) as h, i.width, i.height
  from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey,
          l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax) as bbox_id from lineitem) l
  join fx_images i on l.l_orderkey = i.image_id)""",
    "fx_truth": """fx_truth as (
  select image_id, bbox_id as gt_id, category as label, x as x1, y as y1, x + w as x2, y + h as y2
  from fx_objects)""",
    "fx_pred": """fx_pred as (
  select image_id, bbox_id as det_id,
    cast(case when (image_id + bbox_id) % 11 = 0 then (category + 1) % 5 else category end as int) as label,
    x + (image_id % 7) * w / 20 as x1, y + (bbox_id % 5) * h / 20 as y1,
    x + (image_id % 7) * w / 20 + w as x2, y + (bbox_id % 5) * h / 20 + h as y2,
    cast((image_id * 7919 + bbox_id * 104729) % 1000003 as double) / 1000003 as score
  from fx_objects where (image_id * 3 + bbox_id) % 9 <> 0)""",
    "fx_logits": f"""fx_logits as (
  select vec_id, label, [{", ".join(_duck_projected(str(c + 2), 7, 4.0) for c in range(10))}] as logits
  from embeddings)""",
    "fx_urls": """fx_urls as (select page_id, url from pages)""",
    "fx_det": f"""fx_det_q as (
  select vec_id as image_id, q,
    [{", ".join(_duck_projected(f"(6 * q + {k + 2})", 11, 4.0) for k in range(6))}] as lg,
    list_transform([{", ".join(_duck_projected(f"(4 * q + {j + 3})", 13, 8.0) for j in range(4))}], lambda v: 1.0 / (1.0 + exp(-v))) as bx,
    cast(320 + vec_id % 5 * 80 as int) as width, cast(240 + vec_id % 4 * 80 as int) as height
  from embeddings, (select unnest(range(0, 4)) as q) qs),
fx_det as (
  select image_id, q as query, width, height, bx,
    list_transform(lg[1:5], lambda v: exp(v - list_max(lg)) / list_sum(list_transform(lg, lambda u: exp(u - list_max(lg))))) as p
  from fx_det_q)""",
    "fx_attempts": """fx_attempts as (
  select p.page_id, a.attempt,
    case when p.page_id % 50 = 7 then 4 when (p.page_id + a.attempt) % 3 = 0 and a.attempt < 3 then 8 else 0 end as status
  from pages p, (select unnest(range(1, 5)) as attempt) a)""",
}

_DEPS = {"fx_objects": ["fx_images"], "fx_truth": ["fx_objects"], "fx_pred": ["fx_objects"]}


def duck_with(*names: str) -> str:
    """``with`` clause holding the named fixture CTEs and what they need."""
    order: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    return "with " + ",\n".join(DUCK[n] for n in order)


def objects_nested(spark, sf):
    """The reference's nested form: per image a struct of parallel arrays
    ordered by ``bbox_id``; for images with ``image_id % 10 = 0`` the
    ``area`` list is one shorter (zip must stop at the shortest list)."""
    o = objects(spark, sf)
    g = o.groupBy("image_id", "width", "height").agg(
        F.array_sort(F.collect_list(F.struct(
            "bbox_id", "category", F.array("x", "y", "w", "h").alias("bbox"),
            (F.col("w") * F.col("h")).alias("area")))).alias("_o"))
    area = F.transform("_o", lambda r: r["area"])
    area = F.when(F.col("image_id") % 10 == 0, F.slice(area, 1, F.size("_o") - 1)).otherwise(area)
    return g.select("image_id", "width", "height", F.struct(
        F.transform("_o", lambda r: r["bbox_id"]).alias("bbox_id"),
        F.transform("_o", lambda r: r["category"]).alias("category"),
        F.transform("_o", lambda r: r["bbox"]).alias("bbox"),
        area.alias("area")).alias("objects"))


def detector_outputs(spark, sf):
    """Raw detector outputs derived from ``embeddings``: per row four queries
    of six logits (five classes and "no object") and four normalised centre
    boxes (sigmoids), each value a projection of the whole vector."""
    e = table(spark, sf, "embeddings")
    lg = F.array(*[F.array(*[_projected(6 * q + k + 2, 11, 4.0) for k in range(6)]) for q in range(4)])
    bx = F.array(*[F.array(*[F.lit(1.0) / (F.lit(1.0) + F.exp(-_projected(4 * q + j + 3, 13, 8.0)))
                             for j in range(4)]) for q in range(4)])
    k = F.col("vec_id")
    return e.select(k.alias("image_id"), lg.alias("logits"), bx.alias("pred_boxes"),
                    (F.lit(320) + k % 5 * 80).cast("int").alias("width"),
                    (F.lit(240) + k % 4 * 80).cast("int").alias("height"))
