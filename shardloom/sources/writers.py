"""Writers (S4, S5, S11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.index import with_row_index
from . import fs


def write_splits(df: DataFrame, split_col: str, prefix: str, base_path: str,
                 splits: Sequence[str] | None = None) -> list[str]:
    """One external table per split (``{prefix}_{split}``), stored under
    ``base_path``.  All splits are written in one pass over ``df``,
    partitioned by split; the tables name the folders.  Without ``splits``
    the names are those of the folders written."""
    spark = df.sparkSession
    base = f"{base_path.rstrip('/')}/{prefix}"
    kept = df if splits is None else df.filter(F.col(split_col).isin(list(splits)))
    kept.write.mode("overwrite").partitionBy(split_col).parquet(base)
    lead = f"{split_col}="
    names = [n[len(lead):] for n in fs.list_names(spark, base) if n.startswith(lead)]
    rest = df.drop(split_col).schema
    out = []
    for s in sorted(set(names) | set(splits or ())):
        t, path = f"{prefix}_{s}", f"{base}/{lead}{s}"
        if s not in names:  # a stated split without rows is an empty table
            spark.createDataFrame([], rest).write.parquet(path)
        spark.sql(f"DROP TABLE IF EXISTS `{t}`")
        spark.catalog.createTable(t, path=path, source="parquet", schema=rest)
        out.append(t)
    return out


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "zstd",
                  partition_by: Sequence[str] = ()) -> None:
    """A parquet folder."""
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def coco_frames(images: DataFrame, objects: DataFrame, classes: DataFrame) -> dict[str, DataFrame]:
    """The three sections of a COCO document as frames: ``images``
    (id, width, height, file_name), ``annotations`` (id, image_id,
    category_id, iscrowd 0, area, bbox) and ``categories`` (id, name,
    supercategory "none").  Annotation ids are unique over all images: the
    box's place in (image, box) order, from 1.  The area is the one given
    with the objects, or width times height without one."""
    img = images.select(F.col("image_id").alias("id"), "width", "height",
                        F.concat(F.col("image_id").cast("string"), F.lit(".png")).alias("file_name"))
    area = F.col("area") if "area" in objects.columns else F.col("w") * F.col("h")
    numbered = with_row_index(objects.select("image_id", "bbox_id", "category", area.alias("area"), "x", "y", "w", "h"),
                              ["image_id", "bbox_id"], "_at")
    ann = numbered.select(
        (F.col("_at") + 1).alias("id"), "image_id", F.col("category").alias("category_id"),
        F.lit(0).alias("iscrowd"), "area", F.array("x", "y", "w", "h").alias("bbox"))
    cat = classes.select(F.col("category_id").alias("id"), F.col("category_name").alias("name"),
                         F.lit("none").alias("supercategory"))
    return {"images": img, "annotations": ann, "categories": cat}


def write_coco(frames: dict[str, DataFrame], path: str) -> None:
    """Each section as a JSON-lines folder; the document is never
    assembled in one process."""
    for name, df in frames.items():
        df.write.mode("overwrite").json(f"{path.rstrip('/')}/{name}")
