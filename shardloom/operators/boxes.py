"""Boxes and annotations.

Boxes live one per row as four ``double`` columns: corner+size ``(x, y, w, h)``
or two-corner ``(x1, y1, x2, y2)``; image size is always the named columns
``width`` and ``height``.  The nested form of the reference (a struct of
parallel arrays per image) is read with ``arrays_zip`` and written back with
``transform``.  Everything is expressions; the only joins are a broadcast of
the class list (bounded by the number of classes) and a left anti join on
image ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import argmax, softmax
from .splits import chosen

OBJECT_FIELDS = ("bbox_id", "category", "bbox", "area")


def _least_size(cols: Sequence[Column]) -> Column:
    return F.least(*[F.size(c) for c in cols]) if len(cols) > 1 else F.size(cols[0])


def zipped_objects(objects: str = "objects", fields: Sequence[str] = OBJECT_FIELDS) -> Column:
    """Parallel arrays zipped to an array of structs, cut to the shortest
    array like Python's ``zip`` (``arrays_zip`` alone pads with nulls)."""
    arrs = [F.col(f"{objects}.{f}") for f in fields]
    n = _least_size(arrs)
    return F.arrays_zip(*[F.slice(a, 1, n).alias(f) for a, f in zip(arrs, fields)])


def explode_objects(df: DataFrame, objects: str = "objects", keep: Sequence[str] = ("image_id",),
                    fields: Sequence[str] = OBJECT_FIELDS) -> DataFrame:
    """One row per object with its position in the lists; nested columns
    not used downstream are pruned from the scan."""
    z = zipped_objects(objects, fields)
    out = df.select(*keep, F.posexplode(z).alias("obj_pos", "_o"))
    return out.select(*keep, "obj_pos", *[F.col(f"_o.{f}").alias(f) for f in fields])


def to_annotations(df: DataFrame, image_col: str = "image_id", objects: str = "objects",
                   out: str = "annotations") -> DataFrame:
    """COCO annotation list per image from the parallel arrays
    (``iscrowd`` = 0), zipped to the shortest list."""
    z = zipped_objects(objects, ("bbox_id", "category", "area", "bbox"))
    img = F.col(image_col)
    ann = F.transform(z, lambda o: F.struct(
        o["bbox_id"].alias("id"), img.alias("image_id"), o["category"].alias("category_id"),
        F.lit(0).alias("iscrowd"), o["area"].alias("area"), o["bbox"].alias("bbox")))
    return df.select(image_col, ann.alias(out))


def runaway(x="x", y="y", w="w", h="h", width="width", height="height") -> Column:
    """True when a corner+size box reaches past the image edge."""
    c = F.col
    return (c(x) < 0) | (c(y) < 0) | (c(x) + c(w) > c(width)) | (c(y) + c(h) > c(height))


def drop_runaway_images(images: DataFrame, boxes: DataFrame, key: str = "image_id") -> DataFrame:
    """Remove every image that has a box beyond its edge.  The offending
    ids are computed (distinct after a map-side partial aggregation), not a
    literal list, and removed with a left anti join."""
    bad = boxes.filter(runaway()).select(key).distinct()
    return images.join(bad, key, "left_anti")


def clip_boxes(df: DataFrame, min_area: float | None = 25.0) -> DataFrame:
    """Clip corner+size boxes to the image and recompute the area; with
    ``min_area`` (training) drop boxes whose clipped area is below it."""
    c = F.col
    x1 = F.greatest(c("x"), F.lit(0.0))
    y1 = F.greatest(c("y"), F.lit(0.0))
    x2 = F.least(c("x") + c("w"), c("width").cast("double"))
    y2 = F.least(c("y") + c("h"), c("height").cast("double"))
    out = (df.withColumn("_x2", x2).withColumn("_y2", y2)
           .withColumn("x", x1).withColumn("y", y1)
           .withColumn("w", F.greatest(c("_x2") - c("x"), F.lit(0.0)))
           .withColumn("h", F.greatest(c("_y2") - c("y"), F.lit(0.0)))
           .withColumn("area", c("w") * c("h")).drop("_x2", "_y2"))
    if min_area is not None:
        out = out.filter(c("area") >= F.lit(float(min_area)))
    return out


def to_corners_px(df: DataFrame) -> DataFrame:
    """corner+size to integer two-corner pixels; boxes whose largest
    value is at most 1.0 are normalised and scaled by the image first;
    ``cast`` truncates toward zero."""
    c = F.col
    norm = F.greatest(c("x"), c("y"), c("w"), c("h")) <= 1.0
    sx = F.when(norm, c("width").cast("double")).otherwise(F.lit(1.0))
    sy = F.when(norm, c("height").cast("double")).otherwise(F.lit(1.0))
    return (df.withColumn("px1", (c("x") * sx).cast("int"))
            .withColumn("py1", (c("y") * sy).cast("int"))
            .withColumn("px2", ((c("x") + c("w")) * sx).cast("int"))
            .withColumn("py2", ((c("y") + c("h")) * sy).cast("int")))


def center_to_corners(df: DataFrame, cx="cx", cy="cy", w="bw", h="bh") -> DataFrame:
    """Normalised centre+size to absolute two-corner boxes."""
    c = F.col
    W, H = c("width").cast("double"), c("height").cast("double")
    return (df.withColumn("x1", (c(cx) - c(w) / 2) * W).withColumn("y1", (c(cy) - c(h) / 2) * H)
            .withColumn("x2", (c(cx) + c(w) / 2) * W).withColumn("y2", (c(cy) + c(h) / 2) * H))


def flip_boxes(df: DataFrame, flag_col: str | None = None) -> DataFrame:
    """Horizontal flip of corner+size boxes (all rows, or where the flag is set)."""
    c = F.col
    flipped = c("width") - c("x") - c("w")
    return df.withColumn("x", F.when(c(flag_col), flipped).otherwise(c("x")) if flag_col else flipped)


def resize_boxes(df: DataFrame, tw: int, th: int) -> DataFrame:
    """Map boxes to a ``tw`` x ``th`` frame; area scales with them."""
    c = F.col
    fx = F.lit(float(tw)) / c("width")
    fy = F.lit(float(th)) / c("height")
    out = (df.withColumn("x", c("x") * fx).withColumn("y", c("y") * fy)
           .withColumn("w", c("w") * fx).withColumn("h", c("h") * fy))
    if "area" in df.columns:
        out = out.withColumn("area", c("w") * c("h"))
    return out.withColumn("width", F.lit(tw)).withColumn("height", F.lit(th))


# Augmentation names and probabilities used in training.
AUGMENTATIONS = {"perspective": 0.1, "hflip": 0.5, "brightness": 0.5, "hue": 0.1}


def augment_plan(df: DataFrame, key: str = "image_id", probs: dict[str, float] | None = None,
                 seed: int = 0) -> DataFrame:
    """One boolean column per augmentation, true with its probability.
    The draw is the md5 of (key, name, seed) read as a fraction: the same on
    every retry and under any partitioning, unlike ``rand()``."""
    out = df
    for name, p in (probs or AUGMENTATIONS).items():
        drawn = F.concat_ws("|", F.col(key).cast("string"), F.lit(name), F.lit(str(seed)))
        out = out.withColumn(f"aug_{name}", chosen(drawn, p))
    return out


def _corner_draw(key: str, i: int, seed: int) -> Column:
    """The ``i``-th fraction in [0, 1) of an image: 52 bits of the md5 of (key, name, i, seed)."""
    drawn = F.concat_ws("|", F.col(key).cast("string"), F.lit("perspective_corner"), F.lit(str(i)), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(drawn), 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def perspective_boxes(df: DataFrame, key: str = "image_id", flag_col: str | None = None, strength: float = 0.1,
                      seed: int = 0, min_area: float | None = None) -> DataFrame:
    """The geometry of the perspective augmentation on corner+size boxes.

    Each image's four corners move inwards by reproducible draws below ``strength`` (of width and height; under 0.5,
    so that the quadrilateral stays convex).  The homography that takes the image to it maps the corners of each box,
    cut to the image before, and the box becomes their bounding box.  With ``flag_col`` only rows whose flag is true
    move.  Strength 0 changes nothing but the cut.  Boxes without area, or below ``min_area``, follow X4: they are
    dropped only if ``min_area`` is given."""
    if not 0 <= strength < 0.5:
        raise ValueError("strength must be at least 0 and below 0.5")
    c = F.col
    d = [c(f"_d{i}") for i in range(8)]
    out = clip_boxes(df, None)
    if "area" not in df.columns:
        out = out.drop("area")
    columns = out.columns
    out = out.withColumns({f"_d{i}": _corner_draw(key, i, seed) * F.lit(float(strength)) for i in range(8)})
    # targets of the unit square's corners (0, 0), (1, 0), (1, 1), (0, 1)
    xs, ys = [d[0], 1.0 - d[2], 1.0 - d[4], d[6]], [d[1], d[3], 1.0 - d[5], 1.0 - d[7]]
    out = out.withColumns({**{f"_px{i}": x for i, x in enumerate(xs)}, **{f"_py{i}": y for i, y in enumerate(ys)}})
    px, py = [c(f"_px{i}") for i in range(4)], [c(f"_py{i}") for i in range(4)]
    out = out.withColumns({"_sx": px[0] - px[1] + px[2] - px[3], "_sy": py[0] - py[1] + py[2] - py[3],
                           "_ax": px[1] - px[2], "_ay": py[1] - py[2], "_bx": px[3] - px[2], "_by": py[3] - py[2]})
    det = c("_ax") * c("_by") - c("_bx") * c("_ay")
    out = out.withColumns({"_g": (c("_sx") * c("_by") - c("_bx") * c("_sy")) / det,
                           "_h": (c("_ax") * c("_sy") - c("_sx") * c("_ay")) / det})
    W, H = c("width").cast("double"), c("height").cast("double")
    mapped = {}
    for name, u, v in (("0", c("x"), c("y")), ("1", c("x") + c("w"), c("y")), ("2", c("x") + c("w"), c("y") + c("h")),
                       ("3", c("x"), c("y") + c("h"))):
        u, v = u / W, v / H
        below = c("_g") * u + c("_h") * v + 1.0
        mapped[f"_mx{name}"] = ((px[1] - px[0] + c("_g") * px[1]) * u + (px[3] - px[0] + c("_h") * px[3]) * v + px[0]) / below * W
        mapped[f"_my{name}"] = ((py[1] - py[0] + c("_g") * py[1]) * u + (py[3] - py[0] + c("_h") * py[3]) * v + py[0]) / below * H
    out = out.withColumns(mapped)
    mx, my = [c(f"_mx{i}") for i in range(4)], [c(f"_my{i}") for i in range(4)]
    moved = {"x": F.least(*mx), "y": F.least(*my), "w": F.greatest(*mx) - F.least(*mx), "h": F.greatest(*my) - F.least(*my)}
    if flag_col:
        moved = {k: F.when(c(flag_col), v).otherwise(c(k)) for k, v in moved.items()}
    if "area" in columns:
        moved["area"] = moved["w"] * moved["h"]
    out = out.withColumns(moved).select(*columns)
    return out if min_area is None else clip_boxes(out, min_area).select(*columns)


def with_class_name(df: DataFrame, classes: DataFrame, id_col: str = "category",
                    class_id: str = "category_id", class_name: str = "category_name") -> DataFrame:
    """Attach class names (the class list is bounded by the number of
    classes, so it is broadcast)."""
    cl = F.broadcast(classes.select(F.col(class_id).alias("_cid"), F.col(class_name)))
    return df.join(cl, df[id_col] == cl["_cid"], "left").drop("_cid")


def class_id_of(df: DataFrame, classes: DataFrame, name_col: str = "category_name",
                class_id: str = "category_id", class_name: str = "category_name") -> DataFrame:
    """X10 inverse: class id from the name."""
    cl = F.broadcast(classes.select(F.col(class_name).alias("_cn"), F.col(class_id)))
    return df.join(cl, df[name_col] == cl["_cn"], "left").drop("_cn")


def postprocess_detections(df: DataFrame, logits: str = "logits", boxes: str = "pred_boxes",
                           threshold: float = 0.5, keep: Sequence[str] = ("image_id",)) -> DataFrame:
    """X11: per query, softmax over classes, drop the last ("no object")
    class, best class and score, keep scores above ``threshold``, convert the
    normalised centre boxes to absolute corners (X6)."""
    q = df.select(*keep, "width", "height", F.posexplode(logits).alias("query", "_l"),
                  F.col(boxes).alias("_b"))
    p = softmax("_l")
    q = q.withColumn("_p", F.slice(p, 1, F.size("_l") - 1))
    q = (q.withColumn("label", argmax("_p")).withColumn("score", F.array_max("_p"))
         .filter(F.col("score") > F.lit(float(threshold))))
    b = F.get(F.col("_b"), F.col("query"))
    q = q.select(*keep, "query", "label", "score", "width", "height",
                 F.get(b, 0).alias("cx"), F.get(b, 1).alias("cy"),
                 F.get(b, 2).alias("bw"), F.get(b, 3).alias("bh"))
    return center_to_corners(q).drop("cx", "cy", "bw", "bh")


def format_detections(df: DataFrame, names: str = "category_name") -> DataFrame:
    """Report values (box to 2 decimals, score to 3) and the text line."""
    c = F.col
    out = (df.withColumn("score_r", F.round(c("score"), 3))
           .withColumn("box_r", F.array(*[F.round(c(k), 2) for k in ("x1", "y1", "x2", "y2")])))
    return out.withColumn("text", F.format_string(
        "%s (score %.3f): x %.2f to %.2f, y %.2f to %.2f",
        c(names), c("score"), c("x1"), c("x2"), c("y1"), c("y2")))


def labelled_boxes(objects: DataFrame, classes: DataFrame, image_id: int | None = None) -> DataFrame:
    """Truth boxes as integer corners with class names (for one image,
    or all), without drawing."""
    src = objects if image_id is None else objects.filter(F.col("image_id") == F.lit(image_id))
    return with_class_name(to_corners_px(src), classes)
