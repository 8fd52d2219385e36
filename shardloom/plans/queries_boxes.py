"""Registered box and annotation queries (X1-X14) over the derived image,
box and detector-output frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arrays import normalize_channels
from ..operators import boxes as X
from ..operators import splits as B
from ..operators import text as T
from . import fixtures as FX
from .registry import register, table

W = FX.duck_with


@register("explode_objects_nested", sql=W("fx_objects") + """
select image_id, bbox_id - 1 as obj_pos, bbox_id, category, w * h as area, x as bx
from fx_objects o
where not (image_id % 10 = 0 and bbox_id = (select max(bbox_id) from fx_objects m where m.image_id = o.image_id))
""")
def explode_objects_nested(spark, sf):
    """One row per object from the parallel arrays (cut to the shortest)."""
    n = FX.objects_nested(spark, sf)
    e = X.explode_objects(n, "objects", keep=["image_id"])
    return e.select("image_id", F.col("obj_pos").cast("bigint").alias("obj_pos"), "bbox_id", "category",
                    "area", F.get("bbox", 0).alias("bx"))


@register("coco_annotations", sql=W("fx_objects") + """
select image_id, count(*) as n_ann, round(sum(w * h), 6) as total_area, max(bbox_id) as last_id,
       cast(sum(category) as bigint) as cat_sum, max(0) as iscrowd
from fx_objects o
where not (image_id % 10 = 0 and bbox_id = (select max(bbox_id) from fx_objects m where m.image_id = o.image_id))
group by image_id
""")
def coco_annotations(spark, sf):
    """COCO annotation lists per image (``iscrowd`` 0), summarised."""
    a = X.to_annotations(FX.objects_nested(spark, sf))
    e = a.select("image_id", F.explode("annotations").alias("a"))
    return (e.groupBy("image_id").agg(
        F.count(F.lit(1)).alias("n_ann"), F.round(F.sum("a.area"), 6).alias("total_area"),
        F.max("a.id").alias("last_id"), F.sum("a.category_id").cast("bigint").alias("cat_sum"),
        F.max("a.iscrowd").alias("iscrowd")))


@register("drop_runaway_images", sql=W("fx_objects") + """
select image_id from fx_images
where image_id not in (select image_id from fx_objects
                       where x < 0 or y < 0 or x + w > width or y + h > height)
""")
def drop_runaway_images(spark, sf):
    """Images with no box past the edge (computed, not a literal list)."""
    return X.drop_runaway_images(FX.images(spark, sf), FX.objects(spark, sf)).select("image_id")


@register("clip_boxes_training", sql=W("fx_objects") + """
select image_id, bbox_id, x, y, w, h, w * h as area from (
  select image_id, bbox_id, greatest(x, 0.0) as x, greatest(y, 0.0) as y,
         greatest(least(x + w, cast(width as double)) - greatest(x, 0.0), 0.0) as w,
         greatest(least(y + h, cast(height as double)) - greatest(y, 0.0), 0.0) as h
  from fx_objects) t
where w * h >= 25.0
""")
def clip_boxes_training(spark, sf):
    """Boxes clipped to the image, area recomputed, area < 25 dropped."""
    c = X.clip_boxes(FX.objects(spark, sf), 25.0)
    return c.select("image_id", "bbox_id", "x", "y", "w", "h", "area")


@register("corners_px", sql=W("fx_objects") + """
select image_id, bbox_id, false as normalized,
       cast(trunc(x) as int) as px1, cast(trunc(y) as int) as py1,
       cast(trunc(x + w) as int) as px2, cast(trunc(y + h) as int) as py2
from fx_objects
union all
select image_id, bbox_id, true as normalized,
       cast(trunc(nx * width) as int), cast(trunc(ny * height) as int),
       cast(trunc((nx + nw) * width) as int), cast(trunc((ny + nh) * height) as int)
from (select *, x / width as nx, y / height as ny, w / width as nw, h / height as nh from fx_objects)
where greatest(nx, ny, nw, nh) <= 1.0
""")
def corners_px(spark, sf):
    """Integer corners, scaling only boxes given as fractions."""
    o = FX.objects(spark, sf)
    px = X.to_corners_px(o).select("image_id", "bbox_id", F.lit(False).alias("normalized"),
                                   "px1", "py1", "px2", "py2")
    n = o.select("image_id", "bbox_id", "width", "height",
                 (F.col("x") / F.col("width")).alias("x"), (F.col("y") / F.col("height")).alias("y"),
                 (F.col("w") / F.col("width")).alias("w"), (F.col("h") / F.col("height")).alias("h"))
    n = n.filter(F.greatest("x", "y", "w", "h") <= 1.0)
    nx = X.to_corners_px(n).select("image_id", "bbox_id", F.lit(True).alias("normalized"),
                                   "px1", "py1", "px2", "py2")
    return px.unionByName(nx)


@register("center_to_corners", sql=W("fx_objects") + """
select image_id, bbox_id,
       round((cx - bw / 2) * width, 6) as x1, round((cy - bh / 2) * height, 6) as y1,
       round((cx + bw / 2) * width, 6) as x2, round((cy + bh / 2) * height, 6) as y2
from (select *, (x + w / 2) / width as cx, (y + h / 2) / height as cy, w / width as bw, h / height as bh
      from fx_objects)
""")
def center_to_corners(spark, sf):
    """Normalised centre+size boxes back to absolute corners."""
    o = FX.objects(spark, sf)
    n = o.select("image_id", "bbox_id", "width", "height",
                 ((F.col("x") + F.col("w") / 2) / F.col("width")).alias("cx"),
                 ((F.col("y") + F.col("h") / 2) / F.col("height")).alias("cy"),
                 (F.col("w") / F.col("width")).alias("bw"), (F.col("h") / F.col("height")).alias("bh"))
    c = X.center_to_corners(n)
    return c.select("image_id", "bbox_id", *[F.round(k, 6).alias(k) for k in ("x1", "y1", "x2", "y2")])


_DUCK_FLAG = ("('0x' || substr(md5(concat_ws('|', cast(image_id as varchar), '{name}', '0')), 1, 15))::BIGINT "
              "< (1::BIGINT << 60) // {one_in}")


@register("flip_boxes_planned", sql=W("fx_objects") + f"""
select image_id, bbox_id, case when {_DUCK_FLAG.format(name='hflip', one_in=2)} then width - x - w else x end as x
from fx_objects
""")
def flip_boxes_planned(spark, sf):
    """X7 with X9: horizontal flip where the image's reproducible draw says so."""
    o = X.augment_plan(FX.objects(spark, sf), "image_id")
    return X.flip_boxes(o, "aug_hflip").select("image_id", "bbox_id", "x")


@register("resize_boxes_480", sql=W("fx_objects") + """
select image_id, bbox_id, round(x * (480.0 / width), 6) as x, round(y * (480.0 / height), 6) as y,
       round(w * (480.0 / width), 6) as w, round(h * (480.0 / height), 6) as h,
       round((w * (480.0 / width)) * (h * (480.0 / height)), 6) as area
from fx_objects
""")
def resize_boxes_480(spark, sf):
    """Boxes mapped to a 480 x 480 frame."""
    o = FX.objects(spark, sf).withColumn("area", F.col("w") * F.col("h"))
    r = X.resize_boxes(o, 480, 480)
    return r.select("image_id", "bbox_id", *[F.round(k, 6).alias(k) for k in ("x", "y", "w", "h", "area")])


@register("augment_plan_images", sql=W("fx_images") + f"""
select image_id,
       {_DUCK_FLAG.format(name='perspective', one_in=10)} as aug_perspective,
       {_DUCK_FLAG.format(name='hflip', one_in=2)} as aug_hflip,
       {_DUCK_FLAG.format(name='brightness', one_in=2)} as aug_brightness,
       {_DUCK_FLAG.format(name='hue', one_in=10)} as aug_hue
from fx_images
""")
def augment_plan_images(spark, sf):
    """Which augmentations apply to each image (p 0.1, 0.5, 0.5, 0.1)."""
    return X.augment_plan(FX.images(spark, sf).select("image_id"), "image_id")


_DUCK_DRAWS = ", ".join(
    f"cast(('0x' || substr(md5(concat_ws('|', cast(image_id as varchar), 'perspective_corner', '{i}', '0')), 1, 13))::BIGINT "
    f"as double) / 4503599627370496::double * 0.1::double as d{i}" for i in range(8))


def _duck_mapped(axis: str, u: str, v: str) -> str:
    p, size = f"p{axis}", {"x": "width", "y": "height"}[axis]
    return (f"(({p}1 - {p}0 + g * {p}1) * ({u} / width::double) + ({p}3 - {p}0 + hh * {p}3) * ({v} / height::double) + {p}0) "
            f"/ (g * ({u} / width::double) + hh * ({v} / height::double) + 1::double) * {size}::double")


_DUCK_CORNERS = ", ".join(f"{_duck_mapped(axis, u, v)} as m{axis}{i}" for axis in "xy" for i, (u, v) in enumerate(
    [("cx", "cy"), ("(cx + cw)", "cy"), ("(cx + cw)", "(cy + ch)"), ("cx", "(cy + ch)")]))


@register("perspective_boxes_planned", sql=W("fx_objects") + f""",
cut as (
  select *, greatest(x, 0.0) as cx, greatest(y, 0.0) as cy,
         greatest(least(x + w, width::double) - greatest(x, 0.0), 0.0) as cw,
         greatest(least(y + h, height::double) - greatest(y, 0.0), 0.0) as ch from fx_objects),
drawn as (select *, {_DUCK_DRAWS} from cut),
quad as (select *, d0 as px0, 1::double - d2 as px1, 1::double - d4 as px2, d6 as px3,
                d1 as py0, d3 as py1, 1::double - d5 as py2, 1::double - d7 as py3 from drawn),
sums as (select *, px0 - px1 + px2 - px3 as sx, py0 - py1 + py2 - py3 as sy, px1 - px2 as ax, py1 - py2 as ay,
                px3 - px2 as bx, py3 - py2 as "by" from quad),
hom as (select *, (sx * "by" - bx * sy) / (ax * "by" - bx * ay) as g, (ax * sy - sx * ay) / (ax * "by" - bx * ay) as hh from sums),
mapped as (select *, {_DUCK_CORNERS} from hom),
moved as (
  select image_id, bbox_id, category % 2 = 0 as moved, width, height,
         case when category % 2 = 0 then least(mx0, mx1, mx2, mx3) else cx end as x,
         case when category % 2 = 0 then least(my0, my1, my2, my3) else cy end as y,
         case when category % 2 = 0 then greatest(mx0, mx1, mx2, mx3) - least(mx0, mx1, mx2, mx3) else cw end as w,
         case when category % 2 = 0 then greatest(my0, my1, my2, my3) - least(my0, my1, my2, my3) else ch end as h
  from mapped)
select image_id, bbox_id, moved, round(x, 4) as x, round(y, 4) as y, round(w, 4) as w, round(h, 4) as h from moved
""")
def perspective_boxes_planned(spark, sf):
    """Boxes of even categories under their image's perspective, the others cut to the image only."""
    o = FX.objects(spark, sf).withColumn("moved", F.col("category") % 2 == 0)
    m = X.perspective_boxes(o, "image_id", "moved", 0.1)
    return m.select("image_id", "bbox_id", "moved", *[F.round(k, 4).alias(k) for k in ("x", "y", "w", "h")])


@register("boxes_with_class_names", sql=W("fx_objects", "fx_classes") + """
select o.image_id, o.bbox_id, c.category_name, c.category_id
from fx_objects o left join fx_classes c on o.category = c.category_id
""")
def boxes_with_class_names(spark, sf):
    """Class names attached by a broadcast join, and ids back from names."""
    cl = FX.classes(spark, sf)
    named = X.with_class_name(FX.objects(spark, sf).select("image_id", "bbox_id", "category"), cl)
    back = X.class_id_of(named, cl)
    return back.select("image_id", "bbox_id", "category_name", "category_id")


@register("postprocess_detections", sql=W("fx_det") + """
select image_id, cast(query as integer) as query, label, round(score, 6) as score,
       round((bx[1] - bx[3] / 2) * width, 4) as x1, round((bx[2] - bx[4] / 2) * height, 4) as y1,
       round((bx[1] + bx[3] / 2) * width, 4) as x2, round((bx[2] + bx[4] / 2) * height, 4) as y2
from (select *, cast(list_position(p, list_max(p)) - 1 as integer) as label, list_max(p) as score from fx_det)
where score > 0.2
""")
def postprocess_detections(spark, sf):
    """X11: softmax per query, "no object" dropped, best class above 0.2,
    centre boxes to absolute corners."""
    d = X.postprocess_detections(FX.detector_outputs(spark, sf), threshold=0.2)
    return d.select("image_id", F.col("query").cast("integer").alias("query"), "label",
                    F.round("score", 6).alias("score"), *[F.round(k, 4).alias(k) for k in ("x1", "y1", "x2", "y2")])


@register("format_detections", sql=W("fx_det", "fx_classes") + """
select d.image_id, cast(d.query as integer) as query, c.category_name, round(score, 3) as score_r,
       round((bx[1] - bx[3] / 2) * width, 2) as bx1, round((bx[2] - bx[4] / 2) * height, 2) as by1,
       round((bx[1] + bx[3] / 2) * width, 2) as bx2, round((bx[2] + bx[4] / 2) * height, 2) as by2
from (select *, cast(list_position(p, list_max(p)) - 1 as integer) as label, list_max(p) as score from fx_det) d
left join fx_classes c on d.label = c.category_id
where score > 0.2
""")
def format_detections(spark, sf):
    """Report numbers (box to 2 decimals, score to 3) beside the text line."""
    d = X.postprocess_detections(FX.detector_outputs(spark, sf), threshold=0.2)
    d = X.with_class_name(d, FX.classes(spark, sf), id_col="label")
    f = X.format_detections(d)
    return f.select("image_id", F.col("query").cast("integer").alias("query"), "category_name", "score_r",
                    *[F.get("box_r", i).alias(n) for i, n in enumerate(("bx1", "by1", "bx2", "by2"))])


@register("labelled_boxes_all", sql=W("fx_objects", "fx_classes") + """
select o.image_id, o.bbox_id, c.category_name,
       cast(trunc(x) as int) as px1, cast(trunc(y) as int) as py1,
       cast(trunc(x + w) as int) as px2, cast(trunc(y + h) as int) as py2
from fx_objects o left join fx_classes c on o.category = c.category_id
""")
def labelled_boxes_all(spark, sf):
    """Truth boxes as integer corners with names (every image)."""
    lb = X.labelled_boxes(FX.objects(spark, sf), FX.classes(spark, sf))
    return lb.select("image_id", "bbox_id", "category_name", "px1", "py1", "px2", "py2")


# Per-channel image mean and standard deviation.
IMAGE_MEAN = [0.485, 0.456, 0.406]
IMAGE_STD = [0.229, 0.224, 0.225]


@register("normalize_embedding_channels", sql=f"""
select vec_id,
  round(list_sum(list_transform(embedding, lambda x, i:
        (cast(x as double) - {IMAGE_MEAN}[((i - 1) % 3) + 1]) / {IMAGE_STD}[((i - 1) % 3) + 1])), 6) as total,
  round((cast(embedding[2] as double) - {IMAGE_MEAN[1]}) / {IMAGE_STD[1]}, 6) as second
from embeddings
""")
def normalize_embedding_channels(spark, sf):
    """X14 (re-aimed): per-channel normalisation of a flat feature array."""
    e = table(spark, sf, "embeddings")
    n = e.select("vec_id", normalize_channels("embedding", IMAGE_MEAN, IMAGE_STD).alias("n"))
    return n.select("vec_id", F.round(F.aggregate("n", F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
                    F.round(F.get("n", 1), 6).alias("second"))


@register("training_input_batches", sql=W("fx_objects") + f""",
clipped as (
  select image_id, bbox_id, width, height, greatest(x, 0.0) as x, greatest(y, 0.0) as y,
         greatest(least(x + w, cast(width as double)) - greatest(x, 0.0), 0.0) as w,
         greatest(least(y + h, cast(height as double)) - greatest(y, 0.0), 0.0) as h
  from fx_objects),
flipped as (
  select *, case when {_DUCK_FLAG.format(name='hflip', one_in=2)} then width - x - w else x end as fx
  from clipped where w * h >= 25.0),
per as (
  select image_id, count(*) as n, sum(fx * (480.0 / width)) as sx, sum(h * (480.0 / height)) as sh
  from flipped group by image_id),
placed as (select *, row_number() over (order by image_id) - 1 as ri, count(*) over () as n_all from per)
select ri // 8 as batch, cast(count(*) as integer) as n_images, cast(sum(n) as integer) as n_boxes,
       string_agg(cast(image_id as varchar), ' ' order by image_id) as images,
       round(sum(sx), 3) as sum_x, round(sum(sh), 3) as sum_h
from placed where ri < (n_all * 4) // 5 group by ri // 8
""")
def training_input_batches(spark, sf):
    """X4, X9, X7, X8, B2, B5, B6 in a row: clipped, flipped and resized boxes of
    each image, the train split in batches of 8, box lists of any length
    collated side by side."""
    boxes = X.clip_boxes(FX.objects(spark, sf), 25.0)
    boxes = X.resize_boxes(X.flip_boxes(X.augment_plan(boxes, "image_id"), "aug_hflip"), 480, 480)
    images = boxes.groupBy("image_id").agg(F.array_sort(F.collect_list(
        F.struct("bbox_id", "category", "x", "y", "w", "h"))).alias("boxes"))
    train = B.split_of(B.train_test_split(images, 0.2, "image_id", "ordered"), "train").drop("split")
    batches = T.collate(B.assign_batches(train, 8, "image_id").withColumn("image", F.col("image_id")), "batch", "image_id",
                        ["image", "boxes"], label_col=None)
    flat = F.flatten("boxes")

    def total(name):
        return F.round(F.aggregate(flat, F.lit(0.0), lambda a, b: a + b[name]), 3)

    return batches.select("batch", F.size("image").alias("n_images"), F.size(flat).alias("n_boxes"),
                          F.array_join(F.transform("image", lambda i: i.cast("string")), " ").alias("images"),
                          total("x").alias("sum_x"), total("h").alias("sum_h"))
