"""Sparse models in the public text layout: cameras.txt, images.txt, points3D.txt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import camera_to_world, frame_number, rotation_of
from ..operators.pairs import dense_ids


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(~F.trim("value").startswith("#"))


def _num(parts: Column, i: int, kind: str) -> Column:
    return F.get(parts, F.lit(i)).cast(kind)


def read_cameras(spark: SparkSession, path: str) -> DataFrame:
    p = F.split(F.trim("value"), r"\s+")
    rows = _lines(spark, path).where(F.trim("value") != "")
    return rows.select(_num(p, 0, "long").alias("camera_id"), F.get(p, F.lit(1)).alias("model"), _num(p, 2, "int").alias("width"), _num(p, 3, "int").alias("height"), F.transform(F.slice(p, 5, 1_000_000), lambda v: v.cast("double")).alias("params"))


def read_images(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(images, points2d). A record is two lines; a blank second line is an image without points.

    The file is read as one value per file, because a record spans lines and a blank line is
    data; models of many images are written as many files, so files are what is split.
    """
    text = spark.read.text(path, wholetext=True)
    kept = F.filter(F.split("value", "\r?\n"), lambda x: ~F.ltrim(x).startswith("#"))
    pairs = text.select(F.posexplode(kept).alias("i", "line"), F.input_file_name().alias("f"))
    n = F.floor(F.col("i") / 2)
    both = pairs.groupBy("f", n.alias("n")).agg(F.max(F.when(F.col("i") % 2 == 0, F.col("line"))).alias("head"), F.max(F.when(F.col("i") % 2 == 1, F.col("line"))).alias("points")).where(F.trim("head") != "")
    h = F.split(F.trim("head"), r"\s+", 10)
    images = both.select(_num(h, 0, "long").alias("image_id"), *[_num(h, 1 + i, "double").alias(c) for i, c in enumerate(("qw", "qx", "qy", "qz", "tx", "ty", "tz"))], _num(h, 8, "long").alias("camera_id"), F.get(h, F.lit(9)).alias("name"), "points")
    parts = F.filter(F.split(F.trim(F.coalesce("points", F.lit(""))), r"\s+"), lambda x: x != "")
    spread = images.select("image_id", parts.alias("p")).where(F.size("p") >= 3).select("image_id", "p", F.explode(F.sequence(F.lit(0), F.expr("size(p) div 3 - 1").cast("int"))).alias("point2d_idx"))
    at = lambda k: F.get("p", F.col("point2d_idx") * 3 + k)
    pid = at(2).cast("long")
    points = spread.select("image_id", "point2d_idx", at(0).cast("double").alias("x"), at(1).cast("double").alias("y"), F.when(pid >= 0, pid).alias("point3d_id"))
    return images.drop("points"), points


def read_points3d(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(points3d, tracks); a track has any length."""
    p = F.split(F.trim("value"), r"\s+")
    rows = _lines(spark, path).where(F.trim("value") != "").select(p.alias("p"))
    points = rows.select(_num(F.col("p"), 0, "long").alias("point3d_id"), *[_num(F.col("p"), 1 + i, "double").alias(c) for i, c in enumerate("xyz")], *[_num(F.col("p"), 4 + i, "int").alias(c) for i, c in enumerate("rgb")], _num(F.col("p"), 7, "double").alias("error"))
    spread = rows.where(F.size("p") >= 10).select(_num(F.col("p"), 0, "long").alias("point3d_id"), "p", F.explode(F.sequence(F.lit(0), F.expr("(size(p) - 8) div 2 - 1").cast("int"))).alias("k"))
    tracks = spread.select("point3d_id", F.get("p", F.col("k") * 2 + 8).cast("long").alias("image_id"), F.get("p", F.col("k") * 2 + 9).cast("int").alias("point2d_idx"))
    return points, tracks


def read_model(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All five tables of a model folder."""
    images, points2d = read_images(spark, f"{folder}/images.txt")
    points3d, tracks = read_points3d(spark, f"{folder}/points3D.txt")
    return {"cameras": read_cameras(spark, f"{folder}/cameras.txt"), "images": images, "points2d": points2d, "points3d": points3d, "tracks": tracks}


def registered_images(spark: SparkSession, path: str) -> int:
    """Images in a text file: half its data lines."""
    return read_images(spark, path)[0].count()


def _number(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def camera_lines(cameras: DataFrame) -> DataFrame:
    line = F.concat_ws(" ", _number("camera_id"), "model", _number("width"), _number("height"), F.array_join(F.transform("params", lambda v: v.cast("string")), " "))
    return cameras.select("camera_id", line.alias("value")).orderBy("camera_id").select("value")


def image_lines(images: DataFrame, points2d: DataFrame) -> DataFrame:
    """One value per image: its two lines."""
    one = F.struct("point2d_idx", F.concat_ws(" ", _number("x"), _number("y"), F.coalesce(_number("point3d_id"), F.lit("-1"))).alias("s"))
    p = points2d.groupBy("image_id").agg(F.array_sort(F.collect_list(one)).alias("p"))
    head = F.concat_ws(" ", *[_number(c) for c in ("image_id", "qw", "qx", "qy", "qz", "tx", "ty", "tz", "camera_id")], "name")
    tail = F.coalesce(F.array_join(F.transform("p", lambda x: x["s"]), " "), F.lit(""))
    return images.join(p, "image_id", "left").select("image_id", F.concat(head, F.lit("\n"), tail).alias("value")).orderBy("image_id").select("value")


def point_lines(points3d: DataFrame, tracks: DataFrame) -> DataFrame:
    t = tracks.groupBy("point3d_id").agg(F.array_sort(F.collect_list(F.struct("image_id", "point2d_idx"))).alias("t"))
    head = F.concat_ws(" ", *[_number(c) for c in ("point3d_id", "x", "y", "z", "r", "g", "b", "error")])
    tail = F.array_join(F.transform("t", lambda x: F.concat_ws(" ", x["image_id"].cast("string"), x["point2d_idx"].cast("string"))), " ")
    return points3d.join(t, "point3d_id", "left").select("point3d_id", F.concat_ws(" ", head, tail).alias("value")).orderBy("point3d_id").select("value")


def write_model(model: dict[str, DataFrame], folder: str) -> None:
    """Write a model as folders of text parts, sorted by id; a part never cuts a record."""
    camera_lines(model["cameras"]).write.mode("overwrite").text(f"{folder}/cameras.txt")
    image_lines(model["images"], model["points2d"]).write.mode("overwrite").text(f"{folder}/images.txt")
    point_lines(model["points3d"], model["tracks"]).write.mode("overwrite").text(f"{folder}/points3D.txt")


def trajectory(images: DataFrame) -> DataFrame:
    """(frame_id, image_name, R, t, qvec_w2c, tvec_w2c): camera-to-world poses in order of image name."""
    q, t = F.array("qw", "qx", "qy", "qz"), F.array("tx", "ty", "tz")
    posed = images.select("name", q.alias("qvec_w2c"), t.alias("tvec_w2c")).withColumn("__R", rotation_of("qvec_w2c"))
    r, c = camera_to_world("__R", "tvec_w2c")
    return posed.select(frame_number("name").alias("frame_id"), F.col("name").alias("image_name"), r.alias("R"), c.alias("t"), "qvec_w2c", "tvec_w2c").orderBy("image_name")


def read_ply(spark: SparkSession, path: str) -> DataFrame:
    """Points of an ASCII PLY file as points3D: ids from 1 in the order of the file, colours 0 and error -1 where it has none.

    Only the header's lines reach the driver; vertex lines are split by Spark. Files with
    other elements than vertices, and binary ones, are refused.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.trim("value").alias("line")).where("line != ''")
    heads = F.col("line").rlike("^(ply|format|comment|obj_info|element|property|end_header)( |$)")
    header = [r["line"].split() for r in lines.where(heads & ~F.col("line").rlike("^(comment|obj_info)")).orderBy("block", "at").collect()]
    if ["format", "ascii", "1.0"] not in header:
        raise ValueError(f"{path} isn't an ASCII PLY file")
    if any(h[0] == "element" and h[1] != "vertex" and h[2] != "0" for h in header):
        raise ValueError(f"{path} has elements other than vertices")
    first = next(i for i, h in enumerate(header) if h[:2] == ["element", "vertex"])
    names = [h[-1] for h in header[first + 1 : next((i for i in range(first + 1, len(header)) if header[i][0] != "property"), len(header))]]
    parts = F.split("line", r"\s+")
    value = lambda name, kind, default: _num(parts, names.index(name), kind) if name in names else F.lit(default).cast(kind)
    points = dense_ids(lines.where(~heads), ["block", "at"], out="point3d_id")
    return points.select("point3d_id", *[value(c, "double", None).alias(c) for c in "xyz"], *[value(name, "int", 0).alias(c) for c, name in zip("rgb", ("red", "green", "blue"), strict=True)], F.lit(-1.0).alias("error"))
