import sqlite3

import pytest
from pyspark.sql import functions as F

from odometra import schemas
from odometra.functions.scalar import PAIR_BASE
from odometra.sources import binary_model, files, match_database, sinks, tables, text_model, transactional
from odometra.streaming import keyframes


def test_text_model_round_trip(spark, tmp_path):
    (tmp_path / "cameras.txt").write_text("# comment\n1 PINHOLE 640 480 500 501 320 240\n\n")
    (tmp_path / "images.txt").write_text("# two lines each\n7 1 0 0 0 0.5 1 2 1 a b.png\n10.5 20.5 3 1 2 -1\n8 1 0 0 0 0 0 0 1 empty.png\n\n")
    (tmp_path / "points3D.txt").write_text("3 1 2 3 10 20 30 0.25 7 0 8 4\n4 0 0 0 1 1 1 0.5\n")
    m = text_model.read_model(spark, str(tmp_path))
    assert m["cameras"].first().params == [500.0, 501.0, 320.0, 240.0]
    assert {(r.image_id, r.name) for r in m["images"].collect()} == {(7, "a b.png"), (8, "empty.png")}
    assert sorted((r.point2d_idx, r.x, r.point3d_id) for r in m["points2d"].collect()) == [(0, 10.5, 3), (1, 1.0, None)]
    assert sorted((r.point3d_id, r.image_id, r.point2d_idx) for r in m["tracks"].collect()) == [(3, 7, 0), (3, 8, 4)]
    text_model.write_model(m, str(tmp_path / "out"))
    again = text_model.read_model(spark, str(tmp_path / "out"))
    for k in m:
        assert sorted(map(tuple, m[k].select(*sorted(m[k].columns)).collect()), key=str) == sorted(map(tuple, again[k].select(*sorted(m[k].columns)).collect()), key=str), k
    assert text_model.registered_images(spark, str(tmp_path / "images.txt")) == 2


def test_ply_points(spark, tmp_path):
    head = "ply\nformat ascii 1.0\ncomment made by hand\nelement vertex {}\nproperty float x\nproperty float y\nproperty float z\n{}end_header\n"
    (tmp_path / "a.ply").write_text(head.format(300, "property float nx\nproperty uchar red\nproperty uchar green\nproperty uchar blue\n") + "".join(f"{k} {k + 0.5} -{k} 0 {k % 256} 2 3\n" for k in range(300)))
    got = text_model.read_ply(spark, str(tmp_path / "a.ply")).orderBy("point3d_id").collect()
    assert [tuple(r) for r in got] == [(k + 1, float(k), k + 0.5, float(-k), k % 256, 2, 3, -1.0) for k in range(300)]
    (tmp_path / "b.ply").write_text(head.format(1, "") + "1 2 3\n")
    assert [tuple(r) for r in text_model.read_ply(spark, str(tmp_path / "b.ply")).collect()] == [(1, 1.0, 2.0, 3.0, 0, 0, 0, -1.0)]
    for bad in (head.replace("ascii", "binary_little_endian").format(1, ""), head.format(1, "element face 1\nproperty list uchar int i\n")):
        (tmp_path / "c.ply").write_text(bad + "1 2 3\n")
        with pytest.raises(ValueError, match="PLY|elements"):
            text_model.read_ply(spark, str(tmp_path / "c.ply"))


def test_match_database(spark, tmp_path):
    path = str(tmp_path / "database.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE images (image_id INTEGER PRIMARY KEY, name TEXT, camera_id INTEGER)")
        db.executemany("INSERT INTO images VALUES (?, ?, 1)", [(i, f"{i:06d}.png") for i in range(1, 21)])
        db.execute("CREATE TABLE matches (pair_id INTEGER PRIMARY KEY, rows INTEGER, cols INTEGER, data BLOB)")
        db.execute("CREATE TABLE two_view_geometries (pair_id INTEGER PRIMARY KEY, rows INTEGER, cols INTEGER, data BLOB, config INTEGER)")
        db.execute("INSERT INTO matches VALUES (?, 50, 2, ?)", (1 * PAIR_BASE + 2, b"x"))
        db.executemany("INSERT INTO two_view_geometries VALUES (?, ?, 2, NULL, 2)", [(1 * PAIR_BASE + 2, 40), (3 * PAIR_BASE + 9, 12)])
    assert match_database.read_table(spark, path, "images").count() == 20
    counts = match_database.match_counts(match_database.read_table(spark, path, "matches"), match_database.read_table(spark, path, "two_view_geometries"))
    got = {(r.id1, r.id2): (r.matches, r.inliers) for r in match_database.pair_ids(counts).collect()}
    assert got == {(1, 2): (50, 40), (3, 9): (None, 12)}


def test_csv_and_manifest(spark, tmp_path):
    f = spark.createDataFrame([(10, "000015.png"), (5, "000000.png")], "ts_ns long, filename string")
    sinks.timestamps_csv(f, str(tmp_path / "t"))
    assert sorted((r.frame_id, r.ts_ns) for r in tables.read_timestamps(spark, str(tmp_path / "t")).collect()) == [(0, 5), (15, 10)]
    (tmp_path / "m.json").write_text('{\n "bag_path": "x",\n "topics": {"rgb": "/c"}\n}')
    m = tables.read_manifest(spark, str(tmp_path / "m.json")).first()
    assert m.topics == {"rgb": "/c"} and m.settings == {} and m.num_rgb_frames == 0


def test_associations_csv_keeps_zero_unless_told(spark, tmp_path):
    a = spark.createDataFrame([(1, 100, None, None, 0)], "frame_id int, rgb_ts long, depth_ts long, camera_info_ts long, delta long")
    for flag, want in ((False, "1,100,,,0"), (True, "1,100,,,")):
        sinks.associations_csv(a, str(tmp_path / str(flag)), zero_as_empty=flag)
        assert [r.value for r in spark.read.text(str(tmp_path / str(flag))).collect()][1] == want


def vectors():
    return [(0, [1.0, 0.0]), (1, [1.0, 0.01]), (2, [0.0, 1.0]), (3, [0.0, 1.0]), (4, [0.0, 1.0]), (5, [0.0, 1.0])]


RULE = keyframes.Rule(min_similarity=0.75, max_gap=3)


def test_keyframes_batch(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in vectors()], "k string, i int, v array<double>")
    got = keyframes.select_keyframes(df, by=["k"], order="i", vector="v", rule=RULE)
    assert sorted(r.i for r in got.collect()) == [0, 2, 5]


STREAM = "k string, ts timestamp, i int, v array<double>"


def keyframe_rows(n=240, keys=3):
    """Series of turning vectors, one row every 10 seconds; the keys pause for two hours halfway."""
    import datetime
    import math

    start = datetime.datetime(2024, 5, 1)
    out = []
    for k in range(keys):
        for i in range(n):
            angle = 0.07 * i * (k + 1) + (i % 7 == 0) * 0.9
            ts = start + datetime.timedelta(seconds=10 * i + (7200 if i >= n // 2 else 0), microseconds=k)
            out.append((f"k{k}", ts, i, None if i % 61 == 60 else [math.cos(angle), math.sin(angle)]))
    return out


def run_stream(spark, tmp_path, source, name):
    stream = spark.readStream.schema(STREAM).option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
    out = keyframes.stream_keyframes(stream, by=["k"], time="ts", order=["i"], vector="v", rule=RULE, lateness="5 minutes", idle=1800)
    query = out.writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(300)
    assert query.exception() is None


def write_parts(spark, source, parts, first=0):
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, STREAM).coalesce(1).write.parquet(f"{source}/{first + k:03}")


def test_shuffled_stream_equals_batch_after_a_restart_and_leaves_no_state(spark, tmp_path):
    import datetime
    import random

    rows, rng = keyframe_rows(), random.Random(4)
    # every row up to four minutes late, so that files overlap in time; 8 files before the restart and the rest behind
    shuffled = sorted(rows, key=lambda r: r[1] + datetime.timedelta(seconds=rng.uniform(0, 240)))
    parts = [shuffled[j : j + 60] for j in range(0, len(shuffled), 60)]
    source = str(tmp_path / "in")
    write_parts(spark, source, parts[:8])
    run_stream(spark, tmp_path, source, "out")
    before = spark.read.parquet(str(tmp_path / "out")).count()
    end = (max(r[1] for r in rows) + datetime.timedelta(hours=3)).replace(microsecond=0)
    late = [("k0", rows[0][1] - datetime.timedelta(days=1), -1, [1.0, 0.0])]
    write_parts(spark, source, [*parts[8:], [("end", end, 0, [1.0, 0.0])], late], first=8)
    run_stream(spark, tmp_path, source, "out")
    got = sorted((r.k, r.i, r.v) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    want = sorted((r.k, r.i, r.v) for r in keyframes.select_keyframes(spark.createDataFrame(rows, STREAM), by=["k"], order=["ts", "i"], vector="v", rule=RULE, time="ts", idle=1800).collect())
    assert got == want and 0 < before < len(want)
    assert ("k0", 120, want[[x[:2] for x in want].index(("k0", 120))][2]) in want  # the first row behind the pause
    # only the last key's waiting row and its timer are left: the others' states have gone
    states = spark.read.format("statestore").option("path", str(tmp_path / "c")).option("stateVarName", "series").load()
    waiting = spark.read.format("statestore").option("path", str(tmp_path / "c")).option("stateVarName", "waiting").load()
    assert states.count() == 0 and [r.key.k for r in waiting.collect()] == ["end"]


def test_stream_asof(spark, tmp_path):
    left = spark.sql("SELECT * FROM VALUES ('a', 1, TIMESTAMP'2024-01-01 00:00:10'), ('a', 2, TIMESTAMP'2024-01-01 00:01:00'), ('a', 3, TIMESTAMP'2024-01-02 00:00:00') t(k, id, ts)")
    right = spark.sql("SELECT * FROM VALUES ('a', TIMESTAMP'2024-01-01 00:00:08'), ('a', TIMESTAMP'2024-01-01 00:00:13'), ('a', TIMESTAMP'2024-01-02 00:00:00') t(k, ts)")
    left.coalesce(1).write.parquet(str(tmp_path / "l"))
    right.coalesce(1).write.parquet(str(tmp_path / "r"))
    sl, sr = spark.readStream.schema(left.schema).parquet(str(tmp_path / "l")), spark.readStream.schema(right.schema).parquet(str(tmp_path / "r"))
    out = keyframes.stream_nearest_asof(sl, sr, left_ts="ts", right_ts="ts", key=["k"], id_col="id", tolerance="5 SECONDS", lateness="1 SECOND")
    query = out.writeStream.format("memory").queryName("asof").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = {r.id: r.delta_us for r in spark.table("asof").collect()}
    assert got.get(1) == 2_000_000


def test_recording(spark, tmp_path):
    m = spark.createDataFrame([("/a", 1, "X", b"1"), ("/b", 2, "Y", b"2")], "topic string, ts_ns long, msgtype string, payload binary")
    p = spark.createDataFrame([(5, 1.0), (6, 2.0)], "ts_ns long, x double")
    sinks.write_recording(sinks.processed_recording(m, p, topic="/pose", msgtype="Pose", summary_topic="/s"), str(tmp_path / "bag"))
    got = tables.topic_list(tables.read_messages(spark, str(tmp_path / "bag")))
    assert {r.topic: r.msgcount for r in got.collect()} == {"/a": 1, "/b": 1, "/pose": 2, "/s": 1}
    assert tables.read_messages(spark, str(tmp_path / "bag"), "/pose").agg(F.max("ts_ns")).first()[0] == 6


# -- binary models and versioned tables --------------------------------------------------


def small_model(spark):
    cameras = spark.createDataFrame([(1, "PINHOLE", 640, 480, [500.0, 501.0, 320.0, 240.5]), (7, "FULL_OPENCV", 4, 3, [float(i) for i in range(12)])], schemas.CAMERAS)
    images = spark.createDataFrame([(i, 1.0, 0.0, 0.5, -0.25, i / 7, 2.0, 3.0, 1, f"im ä {i}.png") for i in range(1, 60)], schemas.IMAGES)
    points2d = spark.createDataFrame([(i, j, i + j / 3, j / 7, None if j % 3 == 0 else j) for i in range(1, 60) if i != 5 for j in range(i % 11)], schemas.POINTS2D)
    points3d = spark.createDataFrame([(k, k / 3, -1.0, 1e-9, 1, 2, 255, 0.5) for k in range(1, 40)], schemas.POINTS3D)
    tracks = spark.createDataFrame([(k, i, j) for i in range(1, 60) if i != 5 for j, k in ((j, j) for j in range(i % 11)) if j % 3], schemas.TRACKS)
    return {"cameras": cameras, "images": images, "points2d": points2d, "points3d": points3d, "tracks": tracks}


def sorted_rows(df):
    return sorted(map(str, df.collect()))


def test_binary_model_equals_text_model(spark, tmp_path):
    model = small_model(spark)
    text_model.write_model(model, str(tmp_path / "text"))
    binary_model.write_model(model, str(tmp_path / "bin"))
    text, read = text_model.read_model(spark, str(tmp_path / "text")), binary_model.read_model(spark, str(tmp_path / "bin"), records=8)
    for name in binary_model.TABLES:
        assert sorted_rows(read[name]) == sorted_rows(text[name].select(*read[name].columns)), name
        assert read[name].dtypes == text[name].select(*read[name].columns).dtypes
    assert binary_model.registered_images(str(tmp_path / "bin")) == 59


def one_file(spark, tmp_path, name="one"):
    """The images of the small model in one file, as other programs write it."""
    binary_model.write_model({k: v.coalesce(1) for k, v in small_model(spark).items()}, str(tmp_path / name))
    parts = [open(p, "rb").read() for p in binary_model.data_files(f"{tmp_path}/{name}/images.bin/{binary_model.current_version(f'{tmp_path}/{name}/images.bin')}")]
    n = sum(int.from_bytes(p[:8], "little") for p in parts)
    return n.to_bytes(8, "little") + b"".join(p[8:] for p in parts)


def test_one_binary_file_feeds_several_tasks_and_damage_is_an_error(spark, tmp_path):
    whole = one_file(spark, tmp_path)
    path = tmp_path / "images.bin"
    path.write_bytes(whole)
    df = binary_model.read_table(spark, str(path), "points2d", records=10)
    assert df.rdd.getNumPartitions() == 6 and sorted_rows(df) == sorted_rows(small_model(spark)["points2d"])
    assert binary_model.read_table(spark, f"file://{path}", "images", records=10).count() == 59
    assert {r.name for r in binary_model.read_table(spark, str(path), "images", records=10).collect()} == {f"im ä {i}.png" for i in range(1, 60)}
    for damaged in (whole[:-1], whole[:-24], whole + b"\0", (58).to_bytes(8, "little") + whole[8:], (60).to_bytes(8, "little") + whole[8:], b"abc"):
        path.write_bytes(damaged)
        with pytest.raises(Exception, match="ends inside a record|goes on for"):
            binary_model.read_table(spark, str(path), "images").count()
    path.write_bytes((0).to_bytes(8, "little"))
    assert binary_model.read_table(spark, str(path), "images").count() == 0


def test_a_failed_write_leaves_the_version_before(spark, tmp_path):
    path, schema = str(tmp_path / "table"), "k long, v string"
    first = spark.createDataFrame([(i, f"v{i}") for i in range(100)] + [(None, "null")], schema)
    assert transactional.read(spark, path, schema).count() == 0
    transactional.replace(first.repartition(4), path)
    before, version = sorted_rows(transactional.read(spark, path, schema)), transactional.current_version(path)

    @F.udf("string")
    def killed(k):
        import os

        if k == 57:
            os._exit(1)  # the worker dies in the middle of its part
        return str(k)

    with pytest.raises(Exception):
        transactional.replace(spark.range(100).repartition(4).select(F.col("id").alias("k"), killed("id").alias("v")), path)
    assert transactional.current_version(path) == version and sorted_rows(transactional.read(spark, path, schema)) == before
    assert [p.name for p in (tmp_path / "table").iterdir() if p.is_dir()] == [version]  # what was staged has gone
    reader = transactional.read(spark, path, schema)  # opened before the next commit
    left = transactional.delete_keys(spark, path, schema, spark.createDataFrame([(i,) for i in range(0, 100, 2)] * 2, "k long"), ["k"])
    assert left == 51 and sorted_rows(reader) == before
    assert {r.k for r in transactional.read(spark, path, schema).collect()} == {None, *range(1, 100, 2)}
    assert len(files.vacuum(path)) == 1 and transactional.read(spark, path, schema).count() == 51
    transactional.replace(first.limit(0), path)
    assert transactional.read(spark, path, schema).count() == 0


def test_a_group_of_tables_is_emptied(spark, tmp_path):
    folder = str(tmp_path / "db")
    tables = {name: spark.range(5).select(F.lit(name).alias("t"), "id") for name in ("images", "keypoints", "matches", "two_view_geometries")}
    kinds = {name: t.schema for name, t in tables.items()}
    transactional.write_database(tables, folder)
    count = lambda: {name: transactional.read(spark, f"{folder}/{name}", kinds[name]).count() for name in tables}
    version = transactional.current_version(f"{folder}/images")
    with pytest.raises(ValueError):
        transactional.clean_database(spark, folder, "everything", kinds)
    assert transactional.clean_database(spark, folder, "two_view_geometries", kinds) == ["two_view_geometries"] and count() == {"images": 5, "keypoints": 5, "matches": 5, "two_view_geometries": 0}
    assert transactional.clean_database(spark, folder, "features", kinds) == ["keypoints", "matches", "two_view_geometries"]
    assert count() == {"images": 5, "keypoints": 0, "matches": 0, "two_view_geometries": 0} and transactional.current_version(f"{folder}/images") == version
    transactional.clean_database(spark, folder, "all", kinds)
    assert sum(count().values()) == 0


# -- filters of the match database -------------------------------------------------------

CONDITIONS = [
    "image_id = 7", "image_id > 40", "image_id >= 40", "image_id < 5", "image_id <= 5", "image_id <=> 9", "image_id IN (3, 5, 99)", "image_id NOT IN (3, 5)", "NOT (image_id = 7)",
    "camera_id IS NULL", "camera_id IS NOT NULL", "camera_id <=> NULL", "camera_id != 2", "camera_id IN (1, NULL)", "NOT (camera_id > 1)", "name = 'b ä 5.png'", "name LIKE 'a%'", "name LIKE '%7.png'", "name LIKE '%ä%'",
    "NOT (name LIKE 'a%')", "name > 'b'", "image_id > 10 AND name LIKE 'b%' AND camera_id = 1", "image_id % 3 = 1", "image_id = 3 OR name = 'x'", "length(name) > 9 AND image_id < 30", "name = ''", "image_id > 10000000000",
]


@pytest.fixture(scope="module")
def database(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("db") / "m.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE images (image_id INTEGER PRIMARY KEY, name TEXT, camera_id INTEGER)")
        db.executemany("INSERT INTO images VALUES (?, ?, ?)", [(i, None if i == 50 else "" if i == 51 else f"{'ab'[i % 2]} ä {i}.png", None if i % 5 == 0 else i % 4) for i in range(1, 60)])
    return path


def test_filters_give_what_spark_gives(spark, database):
    plain = match_database.read_table(spark, database, "images").collect()
    table = spark.createDataFrame(plain, "image_id long, name string, camera_id long")
    for c in CONDITIONS:
        got, want = match_database.read_table(spark, database, "images").where(c), table.where(c)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), c


def test_filters_are_decided_in_the_source(spark, database):
    def left_source(condition):
        df = match_database.read_table(spark, database, "images").where(condition)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        while not plan.nodeName().startswith("BatchScan"):
            plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan.children().head()
        return plan.metrics().get("numOutputRows").get().value(), df.count()

    for condition in ("image_id = 7", "image_id IN (3, 5, 99)", "name LIKE 'a%'", "camera_id IS NULL", "NOT (camera_id > 1)", "image_id > 10 AND name LIKE 'b%' AND camera_id = 1"):
        out, kept = left_source(condition)
        assert out == kept < 59, condition
    out, kept = left_source("image_id < 30 AND length(name) > 9")  # one part is Spark's
    assert kept < out == 29


def test_lists_are_written_a_batch_of_items_at_a_time(spark, tmp_path):
    """One image of many points, whose row would be one batch of all of them; observations of unknown images are left out."""
    model, n = small_model(spark), 60_000
    more = spark.range(n).select(F.lit(5).cast("long").alias("image_id"), F.col("id").cast("int").alias("point2d_idx"), (F.col("id") / 2).alias("x"), F.lit(1.0).alias("y"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("point3d_id"))
    unknown = spark.createDataFrame([(0, 0, 1.0, 1.0, None), (77, 1, 1.0, 1.0, 3), (None, 1, 1.0, 1.0, 3)], model["points2d"].schema)
    model["points2d"] = model["points2d"].unionByName(more)
    rows = binary_model._flat(model["images"], "images", model["points2d"].unionByName(unknown))
    table = rows.coalesce(1).sortWithinPartitions("id", F.col("item").asc_nulls_first()).toArrow()
    records = binary_model._Records("images")
    for batch in table.to_batches(max_chunksize=1000):
        assert len(records.encoded(batch)) <= 1000 * 100
    assert records.finished() == 59
    binary_model.write_model({**model, "points2d": model["points2d"].unionByName(unknown)}, str(tmp_path / "m"))
    read = binary_model.read_model(spark, str(tmp_path / "m"))["points2d"]
    total = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("image_id", "point2d_idx", "x", "y", "point3d_id").cast("decimal(38,0)"))).first())
    assert total(read) == total(model["points2d"])
    with pytest.raises(Exception, match="there twice"):
        binary_model.write_model({**model, "images": model["images"].unionByName(model["images"].where("image_id = 5"))}, str(tmp_path / "twice"))
    with pytest.raises(Exception, match="doesn't fit"):
        binary_model.write_model({**model, "points2d": more.withColumn("point3d_id", F.lit(-1).cast("long"))}, str(tmp_path / "wide"))


def test_waiting_rows_are_one_value_of_the_state_for_each_batch(spark, tmp_path):
    rows = keyframe_rows(60, 1)
    source = str(tmp_path / "in")
    write_parts(spark, source, [rows])
    run_stream(spark, tmp_path, source, "out")
    write_parts(spark, source, [[(k, ts, i, v) for k, ts, i, v in keyframe_rows(100, 1)[60:]]], first=1)
    run_stream(spark, tmp_path, source, "out")
    waiting = spark.read.format("statestore").option("path", str(tmp_path / "c")).option("stateVarName", "waiting").load()
    assert waiting.count() == 1  # some thirty rows of the last five minutes
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0
