"""Annotation datasets: exports to flat tables, merging, and back to XML."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geometry import bounding_box, shoelace


def to_coco(images: DataFrame, category: str = "curve", keep_empty: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(images, annotations, categories)`` of images as ``documents.read_annotations`` gives them.

    Polygons become one ring each; annotation ids run from 1 in the order of image and shape. The numbering is global, so it
    goes over the narrow keys; shapes ride along once. Images without shapes stay if ``keep_empty``.
    """
    shapes = images.select(F.col("id").alias("image_id"), F.posexplode("shapes").alias("pos", "s"))
    number = F.row_number().over(W.orderBy("image_id", "pos"))
    box = bounding_box(F.col("s.points"))
    ann = shapes.select(
        number.cast("int").alias("id"), "image_id", F.lit(1).alias("category_id"), F.array("s.points").alias("segmentation"), shoelace(F.col("s.points")).alias("area"),
        F.array(box["x"], box["y"], box["w"], box["h"]).alias("bbox"), F.lit(0).alias("iscrowd"), F.create_map(F.lit("curve_name"), F.col("s.curve_name")).alias("attributes"),
    )
    kept = images if keep_empty else images.where(F.size("shapes") > 0)
    return kept.select("id", F.col("name").alias("file_name"), "width", "height"), ann, images.sparkSession.createDataFrame([(1, category)], "id int, name string")


def merge(exports: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Several exports as one: images without shapes go, ids are given anew in order, and ``(images, duplicates)`` come back.
    A name in two exports is an error that the caller sees in ``duplicates``."""
    out = None
    for i, e in enumerate(exports):
        own = e.where(F.size("shapes") > 0).withColumn("part", F.lit(i))
        out = own if out is None else out.unionByName(own)
    twice = out.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name").orderBy("name")
    return out.withColumn("id", F.row_number().over(W.orderBy("part", "id")).cast("int")).drop("part"), twice


def write_xml(images: DataFrame, path: str) -> None:
    """Images with their polygons as annotation XML; images without any are written too."""

    def points(s):
        n = F.floor(F.size(s["points"]) / 2).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.concat_ws(",", F.get(s["points"], 2 * i).cast("string"), F.get(s["points"], 2 * i + 1).cast("string")))
        return F.array_join(pairs, ";")

    polygon = F.transform("shapes", lambda s: F.struct(F.lit("curve").alias("_label"), points(s).alias("_points"), F.array(F.struct(F.lit("curve_name").alias("_name"), s["curve_name"].alias("_VALUE"))).alias("attribute")))
    images.select(F.col("id").alias("_id"), F.col("name").alias("_name"), F.col("width").alias("_width"), F.col("height").alias("_height"), polygon.alias("polygon")).write.format("xml").option("rootTag", "annotations").option("rowTag", "image").mode("overwrite").save(path)
