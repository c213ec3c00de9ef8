"""Figure documents (JSON), annotation exports (XML), result files and image headers as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_BOX = "struct<x1:double,y1:double,x2:double,y2:double>"
_LINES = f"array<struct<text:string,bounding_box:{_BOX}>>"
DOCUMENT = f"figures array<struct<index:int,page:int,image_path:string,caption:string,bounding_box:{_BOX},ocr_text:array<string>,ocr_lines:{_LINES},detection_method:string,is_package_outline:boolean,composite_suspect:boolean>>"
RESULT = (
    "device string, curve_type string, source_image string, status string, review_reason string, duplicates_removed int, "
    "calibration struct<plot_bbox:struct<left:double,right:double,top:double,bottom:double>,x_slope:double,x_intercept:double,y_slope:double,y_intercept:double,x_log:boolean,y_log:boolean>, "
    "units string, curves array<struct<curve_name:string,confidence:double,points:array<struct<x:double,y:double>>>>"
)


def read_figures(spark: SparkSession, path: str) -> DataFrame:
    """One row per figure of ``<device>/full_extraction.json`` files: device, page, index, caption, lines. Documents that
    can't be read, or have no ``figures``, come as one row with ``error``; ``path`` may be a glob."""
    raw = spark.read.schema(DOCUMENT + ", _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    raw = raw.select(F.regexp_extract(F.input_file_name(), r"([^/]+)/[^/]+$", 1).alias("device"), "figures", "_corrupt_record")
    out = raw.select("device", F.when(F.col("figures").isNull(), "no figures").alias("error"), F.explode_outer("figures").alias("f"))
    lines = F.transform("f.ocr_lines", lambda x: F.struct(x["text"].alias("text"), x["bounding_box"]["x1"].alias("x1"), x["bounding_box"]["y1"].alias("y1"), x["bounding_box"]["x2"].alias("x2"), x["bounding_box"]["y2"].alias("y2")))
    return out.select("device", "error", F.concat_ws(":", "device", F.col("f.page").cast("string"), F.col("f.index").cast("string")).alias("figure_id"), "f.page", F.col("f.index").alias("figure_index"), "f.image_path", "f.caption", "f.ocr_text", lines.alias("lines"), "f.bounding_box", "f.is_package_outline", "f.composite_suspect")


def discover_devices(spark: SparkSession, root: str) -> DataFrame:
    """Devices that really have a document, sorted."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "full_extraction.json").option("recursiveFileLookup", True).load(root)
    return files.select(F.regexp_extract("path", r"([^/]+)/full_extraction\.json$", 1).alias("device")).distinct().orderBy("device")


def png_size(content: Column) -> Column:
    """struct(width, height) of a PNG from its header; NULL for anything else."""
    head = F.hex(F.substring(content, 1, 24))
    side = lambda at: F.conv(F.substring(head, at, 8), 16, 10).cast("int")
    return F.when(F.startswith(head, F.lit("89504E470D0A1A0A")), F.struct(side(33).alias("width"), side(41).alias("height")))


def pdf_ok(content: Column) -> Column:
    """A downloaded payload is a PDF: its mark, and 100 bytes at least."""
    return F.startswith(F.hex(F.substring(content, 1, 4)), F.lit("25504446")) & (F.octet_length(content) >= 100)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Result documents, found recursively; files that are no result (no curve type or status) are left out."""
    raw = spark.read.schema(RESULT + ", _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
    return raw.where("curve_type IS NOT NULL AND status IS NOT NULL").drop("_corrupt_record")


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """Images of an annotation export with their polylines and polygons; other shapes are dropped.

    ``(id, name, width, height, shapes array<struct(type, points array<double>, curve_name)>, violations)``: shapes whose points or
    curve name can't be read are named in ``violations``, since they make the export unusable.
    """
    shape = "array<struct<_points:string,_label:string,attribute:array<struct<_name:string,_VALUE:string>>>>"
    raw = spark.read.format("xml").option("rowTag", "image").schema(f"_id int, _name string, _width int, _height int, polyline {shape}, polygon {shape}").load(path)

    def shapes(kind: str) -> Column:
        def one(s: Column) -> Column:
            numbers = F.transform(F.flatten(F.transform(F.split(s["_points"], ";"), lambda p: F.split(p, ","))), lambda v: F.trim(v).try_cast("double"))
            name = F.trim(F.get(F.filter(s["attribute"], lambda a: a["_name"] == "curve_name"), 0)["_VALUE"])
            return F.struct(F.lit(kind).alias("type"), numbers.alias("points"), F.nullif(name, F.lit("")).alias("curve_name"))

        return F.coalesce(F.transform(kind, one), F.expr("CAST(array() AS array<struct<type:string,points:array<double>,curve_name:string>>)"))

    out = raw.select(F.col("_id").alias("id"), F.col("_name").alias("name"), F.col("_width").alias("width"), F.col("_height").alias("height"), F.concat(shapes("polyline"), shapes("polygon")).alias("shapes"))
    bad = F.transform(F.filter("shapes", lambda s: s["curve_name"].isNull() | F.exists(s["points"], lambda v: v.isNull()) | (F.size(s["points"]) % 2 == 1)), lambda s: F.concat(s["type"], F.when(s["curve_name"].isNull(), F.lit(": empty curve_name")).otherwise(F.lit(": bad points"))))
    return out.withColumn("violations", bad)


def strip_shapes(images: DataFrame, name: str = "TODO") -> DataFrame:
    """Images without the shapes of exactly that name, and how many went."""
    left = F.filter("shapes", lambda s: ~F.coalesce(s["curve_name"] == name, F.lit(False)))
    return images.withColumn("removed", F.size("shapes") - F.size(left)).withColumn("shapes", left)


def resolve(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """``(name, path)``: the file of each wanted name by priority: its base name, its path's end, or device/figures/file.

    ``files`` has ``path``; folders are ranked by ``rank``, layouts within a folder by the order above.
    """
    base = F.regexp_extract("path", r"([^/]+)$", 1)
    nested = F.concat(F.regexp_extract("path", r"([^/]+)/figures/[^/]+$", 1), F.lit("__"), base)
    keyed = files.select("path", "rank", F.explode(F.array(F.struct(F.lit(0).alias("way"), base.alias("key")), F.struct(F.lit(1).alias("way"), nested.alias("key")))).alias("x")).select("path", "rank", "x.way", "x.key")
    best = wanted.join(keyed, F.col("name") == F.col("key")).groupBy("name").agg(F.min(F.struct("rank", "way", "path")).alias("b"))
    return wanted.join(best, "name", "left").select("name", "b.path")


def write_results(results: DataFrame, path: str) -> None:
    """Results by device and curve type; refuses rows that violate the schema before anything is written.

    Only the partitions of the devices and curve types in ``results`` are replaced, others stay as they are. Two results of
    one device and curve type are a conflict and refused too.
    """
    from ..operators.validate import result_violation

    bad = results.withColumn("violation", result_violation()).where("violation IS NOT NULL").select("device", "curve_type", "violation").take(5)
    if bad:
        raise ValueError(f"invalid results: {bad}")
    twice = results.groupBy("device", "curve_type").count().where("count > 1").take(5)
    if twice:
        raise ValueError(f"more than one result for {[(r.device, r.curve_type) for r in twice]}")
    results.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("device", "curve_type").json(path)
