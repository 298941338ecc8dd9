"""Topics and cameras of recordings, and greedy selections over tracks."""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.scalar import at, path_segments
from ..shipping import ship_package
from .graph import connected_components

# Path segments that name a colour stream, message types that are images.
COLOUR = ("rgb", "color", "colour", "left", "image_color")
IMAGES = ("Image", "CompressedImage")


def classify(topics: DataFrame) -> DataFrame:
    """topics (name, msgtype, ..) with role: camera_info, pointcloud, depth (named anywhere), rgb (by a whole path segment), other."""
    kind = F.element_at(F.split("msgtype", "/"), -1)
    image = kind.isin(*IMAGES)
    colour = F.arrays_overlap(path_segments("name"), F.array(*[F.lit(c) for c in COLOUR]))
    role = F.when(kind == "CameraInfo", "camera_info").when(kind == "PointCloud2", "pointcloud").when(image & F.lower("name").contains("depth"), "depth").when(image & colour, "rgb").otherwise("other")
    return topics.withColumn("role", role)


def best_topics(classified: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """(role, name): the override, else raw before compressed, preferred segments first, then by name.

    The camera info is the one that shares the longest path with the chosen colour topic.
    """
    raw = F.when(F.col("msgtype").contains("Compressed"), 1).otherwise(0)
    colour = F.when(F.arrays_overlap(path_segments("name"), F.array(F.lit("color"), F.lit("rgb"))), 0).otherwise(1)
    w = Window.partitionBy("role").orderBy(raw, colour, "name")
    best = classified.where("role != 'other'").withColumn("k", F.row_number().over(w)).where("k = 1").select("role", "name")
    for role, name in (overrides or {}).items():
        best = best.where(F.col("role") != role).unionByName(classified.sparkSession.createDataFrame([(role, name)], "role string, name string"))
    return best


def camera_problems(width: str, height: str, k: str) -> Column:
    """Array of what is wrong with a camera: size, matrix length, focal length, focal length out of proportion, skew."""
    w, h = F.col(width), F.col(height)
    f = at(k, 0)
    checks = [
        F.when((w <= 0) | (h <= 0), "size is not positive"),
        F.when(F.size(F.coalesce(F.col(k), F.array().cast("array<double>"))) != 9, "K has not nine values"),
        F.when((f <= 0) | (at(k, 4) <= 0), "focal length is not positive"),
        F.when((f > 0) & (f < 0.1 * F.greatest(w, h)), "focal length is below a tenth of the size"),
        F.when(at(k, 1) != 0, "skew is not zero"),
    ]
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def resolve(rows: DataFrame, profiles: DataFrame, *, key: str, value: str, fallback: str) -> DataFrame:
    """value from the message, else from the named profile, else none; with its provenance."""
    joined = rows.join(profiles, key, "left")
    source = F.when(F.col(value).isNotNull(), "message").when(F.col(fallback).isNotNull(), "profile").otherwise("none")
    return joined.withColumn("provenance", source).withColumn(value, F.coalesce(value, fallback))


def _of_model(model: pa.Table, schema: pa.Schema, points: Sequence[int]) -> pa.Table:
    """Points with the keys of the model that the table is of."""
    keys = [pa.array([model.column(f.name)[0].as_py()] * len(points), f.type) for f in schema if f.name != "point"]
    return pa.Table.from_arrays([*keys, pa.array(points, pa.int64())], schema=schema)


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """Values as numbers from 1 in their order; 0 for null."""
    known = column.is_valid().to_numpy()
    out = np.zeros(len(column), np.int32)
    out[known] = np.unique(column.drop_null().to_numpy(), return_inverse=True)[1] + 1
    return out


def _by_point(point: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(points, starts, places, n) of observations: what points[k] is seen at is places[starts[k]:starts[k + 1]], in order, of numbers below n.

    An observation takes some tens of bytes and no Python object.
    """
    names, place = np.unique(place, return_inverse=True)
    place = place.astype(np.int32)
    order = np.lexsort((place, point))
    place, point = place[order], point[order]
    del order
    starts = np.flatnonzero(np.append(True, point[1:] != point[:-1])) if len(point) else np.zeros(0, np.int64)
    return point[starts], np.append(starts, len(point)), place, len(names)


def _selected(rows: DataFrame, by: Sequence[str], select) -> DataFrame:
    """(by, point): the points that select() gives for the table of a model."""
    schema = StructType([*rows.select(*by).schema, StructField("point", LongType())])
    types = to_arrow_schema(schema)
    return rows.groupBy(*by).applyInArrow(lambda model: _of_model(model, types, select(model)), schema)


def _parts(seen: DataFrame, by: Sequence[str], place: Column) -> DataFrame:
    """seen with the connected part of its points and places as __part: what is selected in one changes nothing in another."""
    model = F.concat_ws("\t", *[F.coalesce(F.concat(F.lit("="), F.col(b).cast("string")), F.lit("-")) for b in by]) if by else F.lit("")
    named = seen.withColumn("__node", F.concat(F.lit("p"), F.col("point").cast("string"), F.lit("\n"), model))
    edges = named.select("__node", F.concat(F.lit("i"), place.cast("string"), F.lit("\n"), model).alias("__place"))
    parts = connected_components(edges, "__node", "__place").select(F.col("node").alias("__node"), F.col("component").alias("__part"))
    return named.join(parts, "__node").drop("__node")


def select_tracks(tracks: DataFrame, *, point: str, image: str, budget: int, max_tracks: int | None = None, by: Sequence[str] = (), split: bool = False) -> DataFrame:
    """(by, point): tracks taken longest first, of equals the larger id, while one of their images has at most `budget` of them.

    It ends at max_tracks, or when every image has more than `budget`. A track's length is its
    number of observations, and each of them counts for its image. What is taken depends on
    all before it, so a model (by) is one group; models are dealt over the tasks. With split, a
    group is a connected part of a model's tracks and images, which gives the same; of the parts'
    tracks the first max_tracks then stay.
    """
    ship_package(tracks.sparkSession)
    named = tracks.select(*by, F.col(point).alias("point"), F.col(image).alias("image"))
    inner, taken, models = ["__part"] if split else [], None if split else max_tracks, list(by)
    by = [*by, *inner]
    rows = (_parts(named, models, F.col("image")) if split else named).where("image is not null").select(*by, "point", "image")

    def greedy(model: pa.Table) -> list[int]:
        points, starts, places, n = _by_point(model["point"].to_numpy(), _numbers(model["image"]))
        held, wanting, out = [0] * n, n, []
        for k in np.lexsort((points, np.diff(starts)))[::-1].tolist():
            if not wanting or (taken is not None and len(out) >= taken):
                break
            images = places[starts[k] : starts[k + 1]].tolist()
            if any(held[i] <= budget for i in images):
                out.append(int(points[k]))
                for i in images:
                    wanting -= held[i] == budget
                    held[i] += 1
        return out

    found = _selected(rows, by, greedy).drop(*inner)
    if split and max_tracks is not None:
        lengths = rows.groupBy(*models, "point").agg(F.count("*").alias("__length"))
        order = Window.partitionBy(*models).orderBy(F.col("__length").desc(), F.col("point").desc())
        found = found.join(lengths, [*models, "point"]).withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= max_tracks).select(*models, "point")
    return found


def redundant_points(observations: DataFrame, *, point: str, image: str, x: str, y: str, width: float, height: float, min_gain: float, tiles: int = 8, by: Sequence[str] = (), split: bool = False) -> DataFrame:
    """(by, point): points that add too little to the coverage of images by tiles.

    Each image is cut into tiles * tiles. A point's gain is the sum over its observations of
    1 / sqrt(n + 1) - 1 / sqrt(n + 2) with n selected points in the observation's tile. Points
    are selected by gain, of equals the larger id, while it is above min_gain; the others are
    redundant. Gains only fall, so a queue keeps old gains and renews the one at its head.
    Each selection depends on all before it, so a model (by) is one group; with split, a
    connected part of a model's points and tiles, which gives the same.
    """
    ship_package(observations.sparkSession)
    tile = lambda c, size: F.least(F.greatest((F.col(c) * tiles / size).cast("int"), F.lit(0)), F.lit(tiles - 1))
    named = observations.select(*by, F.col(point).alias("point"), F.col(image).alias("image"), (tile(x, width) * tiles + tile(y, height)).alias("tile"))
    inner, models = ["__part"] if split else [], list(by)
    by = [*by, *inner]
    where = F.concat_ws(":", F.col("image").cast("string"), F.col("tile").cast("string"))
    rows = (_parts(named, models, where) if split else named).select(*by, "point", "image", "tile")

    def prune(model: pa.Table) -> np.ndarray:
        image = _numbers(model["image"])
        if len(image) and (int(image.max()) + 1) * tiles**2 >= 2**31:
            image = image.astype(np.int64)
        points, starts, places, n = _by_point(model["point"].to_numpy(), image * tiles**2 + model["tile"].to_numpy())
        del image
        held, left = [0] * n, np.ones(len(points), bool)

        def gain(k: int) -> float:
            return sum(1 / math.sqrt(m + 1) - 1 / math.sqrt(m + 2) for m in map(held.__getitem__, places[starts[k] : starts[k + 1]].tolist()))

        # of equal gains the larger id, which is the later place
        queue = [(-gain(k), -k) for k in range(len(points))]
        heapq.heapify(queue)
        while queue and -queue[0][0] > min_gain:
            old, minus = queue[0]
            now = gain(-minus)
            if now < -old:
                heapq.heapreplace(queue, (-now, minus))
                continue
            heapq.heappop(queue)
            left[-minus] = False
            for place in places[starts[-minus] : starts[-minus + 1]].tolist():
                held[place] += 1
        return points[left]

    return _selected(rows, by, prune).drop(*inner)
