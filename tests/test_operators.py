import math
import os
import sqlite3
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.functions import rotation
from terraloom.operators import components, filters, joins, mesh, raster, spatial, track, voxel
from terraloom.plans import convert
from terraloom.plans import map as map_plan
from terraloom.plans import mesh as mesh_plan
from terraloom.plans import stages
from terraloom.sources import cloud, decode, files, schema_text, sqlite_log


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_asof_ties_duplicates_tolerance(spark):
    poses = spark.createDataFrame([(100, 1), (100, 2), (200, 3), (200, 4), (300, 5)], "t long, p long")
    q = spark.createDataFrame([(1, 150), (2, 100), (3, 250), (4, 50), (5, 49), (6, 350), (7, 351), (8, None)], "id int, t long")
    out = rows(joins.asof_nearest(q, poses, "t", 50, right_seq=["p"], values=["p"]).select("id", "p", "dt"))
    # equally near: the later; first of a group after, last of a group before
    assert out == [(1, 3, 50), (2, 1, 0), (3, 5, 50), (4, 1, 50), (6, 5, -50)]


def test_asof_random(spark):
    rng = np.random.default_rng(5)
    p = [(int(t), i) for i, t in enumerate(sorted(rng.integers(0, 4000, 300)))]
    q = [(i, int(t)) for i, t in enumerate(rng.integers(-50, 4100, 200))]
    got = dict(rows(joins.asof_nearest(spark.createDataFrame(q, "id int, t long"), spark.createDataFrame(p, "t long, p long"), "t", 7, right_seq=["p"], values=["p"]).select("id", "p")))
    for i, t in q:
        after = next(((a, k) for a, k in p if a >= t), None)
        before = next(((a, k) for a, k in reversed(p) if a < t), None)
        best = min((x for x in (after, before) if x), key=lambda x: (abs(x[0] - t), -x[0]), default=None)
        assert got.get(i) == (best[1] if best and abs(best[0] - t) <= 7 else None)


def test_asof_forward_takes_last_beyond_the_end(spark):
    r = spark.createDataFrame([(0.0, 0), (2.0, 1), (5.0, 2)], "k double, v int")
    q = spark.createDataFrame([(0.0,), (0.1,), (5.0,), (9.0,)], "k double")
    assert rows(joins.asof_forward(q, r, "k", ["v"])) == [(0.0, 0), (0.1, 1), (5.0, 2), (9.0, 2)]


def test_filters_handle_nan_and_edges(spark):
    df = spark.createDataFrame([(2.0, 0.0, 0.0), (120.0, 0.0, 0.0), (1.99, 0.0, 0.0), (float("nan"), 3.0, 0.0), (float("inf"), 0.0, 0.0), (None, 9.0, 0.0)], "x float, y float, z float")
    assert df.where(filters.range_ok("x", "y", "z", 2, 120)).count() == 2
    assert filters.parse_box("none") is None and filters.parse_box("-1,1,-2,2,0,3") == (-1, 1, -2, 2, 0, 3)
    with pytest.raises(ValueError):
        filters.parse_box("1,1,0,1,0,1")
    with pytest.raises(ValueError):
        filters.parse_box("1,2")
    topics = spark.createDataFrame([("a",), ("b",)], "topic string")
    got = rows(filters.funnel(spark.createDataFrame([("a", 1), ("a", 5), ("a", None)], "topic string, v int"), "topic", {"big": F.col("v") > 2}, topics))
    assert got == [("a", 3, 1, 33.3333), ("b", 0, 0, 0.0)]


def test_rename_frame_splices_payload(spark):
    def payload(name, rest):
        w = decode.CdrWriter()
        w.scalar("int32", 7)
        w.scalar("uint32", 8)
        w.scalar("string", name)
        w.scalar("uint32", 99)
        return bytes(w.data) + rest

    for old in ("a", "abc", "lidar_primary", ""):
        df = spark.createDataFrame([(bytearray(payload(old, b"tail")),)], "data binary")
        assert bytes(df.select(filters.rename_frame(F.col("data"), "second").alias("d")).first()[0]) == payload("second", b"tail")


def test_voxel_is_invariant_to_order_and_split(spark):
    rng = np.random.default_rng(1)
    pts = [tuple(map(float, r)) for r in rng.normal(0, 3, (500, 4)).astype(np.float32)] + [(0.2, 0.4, -0.2, 1.0), (float(1 << 20) * 0.2, 0.0, 0.0, 1.0)]
    df = spark.createDataFrame(pts, "x float, y float, z float, i float")
    whole = {r["key"]: r["n"] for r in voxel.voxel_mean(df, 0.2).collect()}
    a = np.array(pts, np.float32)
    k = np.floor(a[:, :3] / np.float32(0.2)).astype(np.int64) & 0x1FFFFF
    keys, n = np.unique(k[:, 0] << 42 | k[:, 1] << 21 | k[:, 2], return_counts=True)
    assert whole == dict(zip(keys.tolist(), n.tolist()))
    parts = voxel.merge_sums(voxel.voxel_sums(df.where("x < 0"), 0.2), voxel.voxel_sums(df.where("x >= 0"), 0.2))
    assert {r["key"]: r["n"] for r in parts.collect()} == whole
    with pytest.raises(ValueError):
        voxel.voxel_sums(df, 0)


def test_knn_and_normals_match_brute_force(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(0, 1, (120, 3)) * [5, 5, 0.1]
    a = np.vstack([a, a[:2]])  # exact duplicates
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(a)], "id long, x double, y double, z double")
    got = {}
    for r in spatial.knn(df, 5, cell=0.3).collect():
        got.setdefault(r["id"], {})[r["rank"]] = r["other"]
    for i, p in enumerate(a):
        d = sorted((float(((q - p) ** 2).sum()), j) for j, q in enumerate(a) if j != i)
        assert [got[i][k] for k in range(1, 6)] == [j for _, j in d[:5]]
    for r in spatial.verticality(df, 5).collect():
        nb = a[[got[r["id"]][k] for k in range(1, 6)]]
        w, v = np.linalg.eigh(np.cov(nb.T))
        if w[1] - w[0] > 1e-3:
            assert abs(abs(v[2, 0]) - r["nz"]) < 1e-4
    assert spatial.knn(df.limit(1), 5).count() == 0 and spatial.knn(df.limit(3), 5).count() == 6


def test_decimation(spark):
    pts = [("a", i, float(x), 0.0, 0.0) for i, x in enumerate([0, 1, 2, 2, 3.9, 4, 4.5])] + [("b", 0, 1.0, 1.0, 1.0), ("b", 1, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(pts, "trk string, n int, x double, y double, z double")
    assert rows(track.decimate(df, ["trk"], ["n"], 2.0).select("trk", "n")) == [("a", 0), ("a", 2), ("a", 5), ("b", 0)]
    assert rows(track.decimate(df, ["trk"], ["n"], 2.0, True).select("trk", "n")) == [("a", 0), ("a", 2), ("a", 5), ("a", 6), ("b", 0)]


def test_components_and_small_ones(spark):
    rng = np.random.default_rng(3)
    mask = rng.random((12, 12)) < 0.5
    df = spark.createDataFrame([(int(i), int(j), 1.0) for i, j in zip(*np.nonzero(mask))], "ix long, iy long, val double")
    got = {(r["ix"], r["iy"]): r["label"] for r in raster.components(df).collect()}
    seen = {}
    for c in got:
        if c not in seen:
            todo, own = [c], set()
            while todo:
                i, j = todo.pop()
                if (i, j) in got and (i, j) not in own:
                    own.add((i, j))
                    todo += [(i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)]
            for o in own:
                seen[o] = min(a << 32 | b for a, b in own)
    assert got == seen
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hole_filling_needs_enclosure(spark):
    ring = [(i, j, 2.0) for i in range(5) for j in range(5) if (i, j) != (2, 2) and (i, j) != (0, 3)]
    df = spark.createDataFrame(ring, "ix long, iy long, val double")
    filled = {(r["ix"], r["iy"]) for r in raster.fill_holes(df, 5, 5, 1).collect()}
    assert (2, 2) in filled and (0, 3) not in filled
    assert (0, 3) in {(r["ix"], r["iy"]) for r in raster.thicken(df, 5, 5, 1).collect()}


@pytest.mark.parametrize("pattern", range(16))
def test_quads(spark, pattern):
    cells = [(i, j, 0.0) for k, (i, j) in enumerate(((0, 0), (1, 0), (0, 1), (1, 1))) if pattern >> k & 1]
    df = spark.createDataFrame(cells, "ix long, iy long, val double")
    faces = mesh.triangulate(mesh.number_cells(df)).collect()
    assert len(faces) == {4: 2, 3: 1}.get(len(cells), 0)
    at = {k: c for k, c in enumerate(sorted((i, j) for i, j, _ in cells))}
    for f in faces:
        (ax, ay), (bx, by), (cx, cy) = (at[f[k]] for k in "abc")
        assert (bx - ax) * (cy - ay) - (by - ay) * (cx - ax) > 0


def test_rotations_are_orthonormal(spark):
    r = spark.range(1).select(*rotation.columns(rotation.body_to_enu(F.lit(3.0), F.lit(-7.0), F.lit(100.0)))).first()
    m = np.array(r).reshape(3, 3)
    assert np.allclose(m @ m.T, np.eye(3)) and math.isclose(np.linalg.det(m), 1.0)


def test_cloud_files(spark, tmp_path):
    df = spark.createDataFrame([(k, float(k), 0.5, -1.0, 2.0) for k in range(50)], "key long, x float, y float, z float, i float")
    path = str(tmp_path / "c.pcd")
    assert cloud.write_cloud(df, path) == 50
    with open(path, "ab") as f:
        f.write(b"trailing")
    back = cloud.read_cloud(spark, path, 7)
    assert rows(back.select("x", "y", "z", "i"), "x") == [(float(k), 0.5, -1.0, 2.0) for k in range(50)]
    for bad in (b"FIELDS x y z\nDATA binary\n", cloud.header(0), cloud.header(3).replace(b"DATA binary", b"DATA ascii"), b"FIELDS x\n"):
        with pytest.raises(ValueError):
            cloud.parse_header(bad)


def definitions():
    texts = {"std_msgs/msg/Header": "builtin_interfaces/Time stamp\nstring frame_id", "builtin_interfaces/msg/Time": "int32 sec\nuint32 nanosec", "demo/msg/Scan": "# scan\nuint8 KIND = 3\nstring UNIT = 'm'\nHeader header\nuint32 height\nField[] fields\nfloat64[9] cov\nuint8[<=4] tail", "demo/msg/Field": "string name"}
    return {n: schema_text.parse(n, t) for n, t in texts.items()}


def test_schema_text():
    text = schema_text.schema_text("demo/msg/Scan", definitions())
    head, *blocks = text.split("=" * 80 + "\n")
    assert head == 'uint8 KIND = 3\nstring UNIT = "m"\nstd_msgs/Header header\nuint32 height\nField[] fields\nfloat64[9] cov\nuint8[<=4] tail\n'
    assert [b.split("\n")[0] for b in blocks] == ["MSG: demo/Field", "MSG: std_msgs/Header", "MSG: builtin_interfaces/Time"]
    assert schema_text.ddl("std_msgs/msg/Header", definitions()) == "struct<stamp:struct<sec:int,nanosec:bigint>,frame_id:string>"


def scan_payload(frame, pts):
    w = decode.CdrWriter()
    for kind, v in (("int32", 1), ("uint32", 2), ("string", frame), ("uint32", 1), ("uint32", len(pts)), ("uint32", 0), ("bool", False), ("uint32", 26), ("uint32", 26 * len(pts)), ("uint32", 26 * len(pts))):
        w.scalar(kind, v)
    return bytes(w.data) + b"".join(struct.pack("<4f10x", *p) for p in pts)


def test_log_conversion(spark, tmp_path):
    db = str(tmp_path / "log.db3")
    with sqlite3.connect(db) as con:
        con.execute("CREATE TABLE topics(id INTEGER, name TEXT, type TEXT, serialization_format TEXT, offered_qos_profiles TEXT)")
        con.execute("CREATE TABLE messages(topic_id INTEGER, timestamp INTEGER, data BLOB)")
        con.executemany("INSERT INTO topics VALUES (?,?,?,?,?)", [(1, "/a", "std_msgs/msg/Header", "cdr", None), (2, "/b", "unknown/msg/X", "cdr", ""), (3, "/empty", "demo/msg/Field", "cdr", "")])
        con.executemany("INSERT INTO messages VALUES (?,?,?)", [(1 + k % 2, 1000 + k, scan_payload("old", [])) for k in range(20)])
    out = convert.convert(spark, db, str(tmp_path / "out"), definitions(), [("imu", "lidar", [1, 2, 3], [0, 0, 0, 1])], max_seconds=1e-8, rename={"/a": "new"})
    got = out.groupBy("topic").count().collect()
    assert {r["topic"]: r["count"] for r in got} == {"/a": 6, "/tf_static": 1}
    rec = decode.decode_records(out.where("topic = '/tf_static'"), decode.TRANSFORMS, "struct<transforms: array<struct<header: struct<sec: int, nanosec: bigint, frame_id: string>, child_frame_id: string, tx: double, ty: double, tz: double, qx: double, qy: double, qz: double, qw: double>>>")
    assert rec.selectExpr("rec.transforms[0].child_frame_id", "rec.transforms[0].ty").first() == ("lidar", 2.0)
    assert sqlite_log.bounds(sqlite_log.read_messages(spark, db)).first() == (1000, 1019, 20)
    assert sqlite_log.read_topics(spark, db).count() == 3
    frame = decode.decode_records(out.where("topic = '/a'"), decode.HEADER, "struct<sec: int, nanosec: bigint, frame_id: string>").select("rec.frame_id").distinct().collect()
    assert [r[0] for r in frame] == ["new"]


def test_map_and_mesh_end_to_end(spark, tmp_path):
    n = 40
    poses = spark.createDataFrame([(k * 10_000_000, "NARROW_INT", 45.0 + k * 2e-5, 7.0, 300.0, 0.0, 0.0, 0.0) for k in range(n)], "t_ns long, position_type string, latitude double, longitude double, altitude double, roll double, pitch double, azimuth double")
    rng = np.random.default_rng(0)
    raw = []
    for k in range(n):
        pts = [(float(x), float(y), -1.5, 1.0) for x, y in rng.uniform(-9, 9, (60, 2))] + [(float(x), 8.0, float(z), 1.0) for x, z in rng.uniform(-4, 4, (40, 2))]
        raw.append(("/l", k * 10_000_000 + 3, "lidar", 1, len(pts), 26, bytearray(b"".join(struct.pack("<4f10x", *p) for p in pts))))
    scans = spark.createDataFrame(raw, "topic string, log_time long, frame_id string, height long, width long, point_step long, data binary")
    tf = spark.createDataFrame([("lidar", *np.eye(3).ravel().tolist(), 0.0, 0.0, 0.5)], "child string, " + ", ".join(f"r{i}{j} double" for i in (1, 2, 3) for j in (1, 2, 3)) + ", tx double, ty double, tz double")
    frame = map_plan.origin(poses)
    path = map_plan.trajectory(poses, frame)
    opts = map_plan.MapOptions(every=1)
    placed = map_plan.placed_points(scans, path, tf, opts).cache()
    report = map_plan.report(placed).first()
    assert report["raw"] == n * 100 >= report["after_range"] >= report["after_ego"] >= report["after_z"] > 0
    assert map_plan.rejected(placed).count() == report["after_range"] - report["after_ego"]
    pts = map_plan.cloud(placed, 0.2)
    lane = map_plan.lane_lines(map_plan.lanes(path, frame, opts))
    xml = files.lane_graph(*lane)
    assert xml.count("<node") == 3 * len(lane[0]) and xml.count("<way") == 3 and abs(lane[2][0][0] - 45.0) < 1e-9
    files.write_track(path.select("t_ns", F.col("px").alias("x"), F.col("py").alias("y"), F.col("pz").alias("z")), str(tmp_path / "t.csv"))
    back = files.read_track(spark, str(tmp_path / "t.csv"))
    assert back.count() == n
    mo = mesh_plan.MeshOptions(k=6, ground_min=5, wall_min=3, ground_cell=1.0, ground_fill=1)
    road = mesh_plan.prepare(back, 2.0).cache()
    cl = mesh_plan.classified(pts.withColumnRenamed("key", "id"), road, mo).cache()
    v, f = mesh_plan.ground(cl.where("NOT vertical"), mo)
    files.write_mesh(v, f, str(tmp_path / "ground.obj"))
    lines = open(tmp_path / "ground.obj").read().split("\n")
    assert sum(x.startswith("v ") for x in lines) == sum(x.startswith("vn ") for x in lines) == v.count()
    assert sum(x.startswith("f ") for x in lines) == f.count() > 0
    walls = cl.where("vertical").join(road.select(F.col("idx").cast("int").alias("nearest_idx"), F.col("z").alias("rz")), "nearest_idx").withColumn("h", F.col("z") - F.col("rz"))
    with pytest.raises(mesh_plan.SkippedSide):
        mesh_plan.wall(walls.where("signed_lat > 1e9"), road, "left", mo)
    wv, wf = mesh_plan.wall(walls.drop("rz"), road, "left", mo)
    assert wv.count() > 0
    files.write_manifest(str(tmp_path / "m.yaml"), ["ground.obj"])
    files.write_summary(str(tmp_path / "s.txt"), {"k": 6}, {"ground.obj": {"vertices": v.count()}})
    files.write_origin(str(tmp_path / "o.yaml"), frame.lat0, frame.lon0, frame.alt0)
    assert "ground.obj" in open(tmp_path / "m.yaml").read() and "wall" not in open(tmp_path / "m.yaml").read()


def test_voxel_stream_equals_batch(spark, tmp_path):
    from terraloom.streaming import voxel_stream

    df = spark.createDataFrame([(float(k % 17) / 10, float(k % 5), 0.0, 1.0) for k in range(200)], "x float, y float, z float, i float")
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    q = voxel_stream(src).writeStream.outputMode("complete").format("memory").queryName("vox").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert rows(spark.table("vox")) == rows(voxel.voxel_mean(df))


def payload(*values):
    w = decode.CdrWriter()
    for kind, v in values:
        w.scalar(kind, v)
    return bytes(w.data)


def test_stages_from_log_to_meshes(spark, tmp_path):
    """A SQLite log with poses in a vendor's layout through all three stages; files, numbers and a stale wall."""
    n, rng = 40, np.random.default_rng(0)
    (tmp_path / "types").mkdir()
    (tmp_path / "types" / "Fix.msg").write_text("# a pose\nstd_msgs/Header header\nstring position_type\nfloat64 latitude\nfloat64 longitude\nfloat64 altitude\nfloat64 roll\nfloat64 pitch\nfloat64 azimuth\nuint8[] tail\n")
    known = schema_text.typestore(str(tmp_path / "types"), "vendor")
    db = str(tmp_path / "log.db3")
    with sqlite3.connect(db) as con:
        con.execute("CREATE TABLE topics(id INTEGER, name TEXT, type TEXT, serialization_format TEXT, offered_qos_profiles TEXT)")
        con.execute("CREATE TABLE messages(topic_id INTEGER, timestamp INTEGER, data BLOB)")
        con.executemany("INSERT INTO topics VALUES (?,?,?,?,?)", [(1, "/fix", "vendor/msg/Fix", "cdr", ""), (2, "/l", "sensor_msgs/msg/PointCloud2", "cdr", ""), (3, "/x", "no/msg/Type", "cdr", "")])
        for k in range(n):
            pose = payload(("int32", k), ("uint32", 0), ("string", "imu"), ("string", "NARROW_INT" if k else "NONE"), *(("float64", v) for v in (45.0 + k * 2e-5, 7.0, 300.0, 0.0, 0.0, 0.0)), ("uint32", 1), ("uint8", 7))
            pts = [(float(x), float(y), -1.5, 1.0) for x, y in rng.uniform(-9, 9, (60, 2))] + [(float(x), 8.0, float(z), 1.0) for x, z in rng.uniform(-4, 4, (40, 2))] + [(float("nan"), 1.0, 1.0, 1.0)]
            con.executemany("INSERT INTO messages VALUES (?,?,?)", [(3, k * 10_000_000, b""), (1, k * 10_000_000, pose), (2, k * 10_000_000 + 3, scan_payload("lidar", pts))])
    log = stages.convert_log(spark, db, str(tmp_path / "log"), known, [("imu", "lidar", [9, 9, 9], [0, 0, 0, 1]), ("imu", "lidar", [0, 0, 0.5], [0, 0, 0, 1])])
    got = log.where("topic <> '/tf_static'").orderBy("sequence").select("sequence", "log_time").collect()
    assert [r["sequence"] for r in got] == list(range(2 * n)) and [r["log_time"] for r in got] == sorted(r["log_time"] for r in got)
    tf = decode.static_transforms(log).collect()
    assert [(r["parent"], r["child"], r["tx"], r["tz"]) for r in tf] == [("imu", "lidar", 0.0, 0.5)]
    out = tmp_path / "map"
    report = stages.build_map(spark, str(tmp_path / "log"), str(out), "/fix", ["/l", "/none"], map_plan.MapOptions(every=1), rejected=True).collect()
    report = {r["topic"]: r for r in report}
    one = report["/l"]
    assert report["/none"]["raw"] == 0 and one["raw"] == n * 101 > one["after_range"] >= one["after_ego"] >= one["after_z"] > 0
    assert sorted(os.listdir(out)) == ["ego_returns.pcd", "lanelet2_map.osm", "map_origin.yaml", "pointcloud_map.pcd", "trajectory_enu.csv"]
    assert "latitude: 45.0000200000" in (out / "map_origin.yaml").read_text() and "Map origin: lat=45.0000200000" in (out / "lanelet2_map.osm").read_text()
    assert files.read_track(spark, str(out / "trajectory_enu.csv")).count() == n - 1
    keys = [r["key"] for r in voxel.voxel_sums(cloud.read_cloud(spark, str(out / "pointcloud_map.pcd")), 0.2).collect()]
    assert len(keys) == cloud.read_cloud(spark, str(out / "pointcloud_map.pcd")).count() > 100
    with pytest.raises(ValueError):
        map_plan.origin(spark.createDataFrame([], "t_ns long"), (1.0, None, 2.0))
    made_dir = tmp_path / "meshes"
    made_dir.mkdir()
    for side in ("left", "right"):
        (made_dir / f"wall_{side}.obj").write_text("stale")
    opts = mesh_plan.MeshOptions(k=6, ground_min=5, wall_min=3, ground_cell=1.0, ground_fill=1)
    made = stages.build_meshes(spark, str(out / "pointcloud_map.pcd"), str(out / "trajectory_enu.csv"), str(made_dir), opts)
    assert set(made) >= {"ground.obj"} and len(made) < 3
    assert sorted(os.listdir(made_dir)) == sorted([*made, "meshes_manifest.yaml", "meshes_summary.txt"])
    for name, info in made.items():
        lines = (made_dir / name).read_text().split("\n")
        assert lines[1].startswith("o ") and sum(x.startswith("v ") for x in lines) == sum(x.startswith("vn ") for x in lines) == info["vertices"] and sum(x.startswith("f ") for x in lines) == info["triangles"] > 0


def test_log_bounds_go_to_the_file(spark, tmp_path):
    db = str(tmp_path / "log.db3")
    with sqlite3.connect(db) as con:
        con.execute("CREATE TABLE messages(topic_id INTEGER, timestamp INTEGER, data BLOB)")
        con.executemany("INSERT INTO messages VALUES (?,?,?)", [(1, k, None if k % 3 else b"x") for k in range(100)])
    assert sqlite_log.read_messages(spark, db, 3, t_min=10, t_max=19).count() == 10
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        got = sqlite_log.read_messages(spark, db).where("timestamp > 89 AND topic_id = 1 AND data IS NULL")
        assert sorted(r["timestamp"] for r in got.collect()) == [k for k in range(90, 100) if k % 3]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_points_without_a_place(spark):
    """NaN and null coordinates: no neighbours and no cell, and everything ends."""
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(i, float(i % 5), float(i // 5), 0.1 * i) for i in range(25)] + [(90, nan, 0.0, 0.0), (91, 0.0, None, 0.0), (92, inf, 0.0, 0.0)], "id long, x double, y double, z double")
    found = spatial.knn(df, 4)
    assert found.count() == 100 and found.where("id >= 90 OR other >= 90").count() == 0
    assert raster.rasterise(df, 1.0, (0.0, 4.0, 0.0, 4.0)).count() == 25
    assert spatial.verticality(df, 4).count() == 25
    assert track.decimate(df.withColumn("t", F.lit("a")), ["t"], ["id"], 0.5).where("id >= 90").count() == 0
    with pytest.raises(ValueError):
        filters.z_bounds(df.limit(0), "z", 1.0, 1.0)
    assert filters.z_bounds(df.limit(0), "z", 1.0, 1.0, -3.0, 9.0) == (-3.0, 9.0)


def test_own_columns_of_points_may_clash(spark):
    v = spark.createDataFrame([(7, 0.0, 0.0, 5.0, 0.0, 1.0, 0.0), (8, 4.0, 0.0, 5.0, 4.0, 1.0, 0.0)], "idx long, x double, y double, z double, along double, tx double, ty double")
    p = spark.createDataFrame([(1, 0.5, 0.5, 5.0, 99, 1.0, "k"), (1, 3.9, -0.5, 5.0, 99, 2.0, "k"), (2, 50.0, 0.0, 5.0, 99, 3.0, "k")], "id long, x double, y double, z double, idx int, tx double, k string")
    near = {(r["id"], r["x"]): (r["idx"], r["tx"]) for r in spatial.nearest_vertex(p, v, 2.0, "id").collect()}
    assert near == {(1, 0.5): (7, 1.0), (1, 3.9): (8, 2.0)}  # rows that share an id both stay
    assert {r["nearest_idx"]: r["signed_lat"] for r in spatial.corridor(p, v, 2.0).collect()} == {7: 0.5, 8: -0.5}
    tf = spark.createDataFrame([("k", *np.eye(3).ravel().tolist(), 10.0, 0.0, 0.0)], "k string, " + ", ".join(f"r{i}{j} double" for i in (1, 2, 3) for j in (1, 2, 3)) + ", tx double, ty double, tz double")
    moved = joins.apply_static(p.withColumn("r11", F.lit(3)), tf, "k")
    assert moved.columns == [*p.columns, "r11"] and {(r["x"], r["tx"], r["r11"]) for r in moved.collect()} == {(10.5, 1.0, 3), (13.9, 2.0, 3), (60.0, 3.0, 3)}


def test_asof_forward_by_ranges(spark):
    rng = np.random.default_rng(8)
    r = [(float(k), i) for i, k in enumerate(rng.integers(0, 500, 400))]
    q = [(i, float(k)) for i, k in enumerate(rng.integers(-20, 540, 300))]
    got = dict(rows(joins.asof_forward(spark.createDataFrame(q, "id int, k double"), spark.createDataFrame(r, "k double, v int"), "k", ["v"], (), ["v"]).select("id", "v")))
    for i, k in q:
        after = [x for x in r if x[0] >= k]
        assert got[i] == (min(after) if after else max(r))[1]
    assert rows(joins.running_number(spark.createDataFrame(q, "id int, k double"), "k", ["k", "id"], "n").select("n", "k", "id")) == [(n, k, i) for n, (k, i) in enumerate(sorted((k, i) for i, k in q))]


def test_enclosed_cells_against_flood_fill(spark):
    rng = np.random.default_rng(12)
    for shape, share in (((14, 17), 0.45), ((9, 30), 0.6)):
        full = rng.random(shape) < share
        want, todo = ~full, [(i, j) for i in range(shape[0]) for j in range(shape[1]) if not full[i, j] and (i in (0, shape[0] - 1) or j in (0, shape[1] - 1))]
        while todo:
            i, j = todo.pop()
            if 0 <= i < shape[0] and 0 <= j < shape[1] and want[i, j]:
                want[i, j] = False
                todo += [(i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)]
        g = spark.createDataFrame([(int(i), int(j), 1.0) for i, j in zip(*np.nonzero(full))], "ix long, iy long, val double")
        assert rows(raster.enclosed(g, *shape)) == [(int(i), int(j)) for i, j in zip(*np.nonzero(want))]
    assert raster.enclosed(g.limit(0), 5, 5).count() == 0


def test_transforms_file_and_decimated_stream(spark, tmp_path):
    from terraloom.streaming import decimate_stream

    (tmp_path / "tf.yaml").write_text("reference_frame: base\nsensors:\n  imu: {translation_m: [0, 0, 0], rotation_quat_xyzw: [0, 0, 0, 1]}\n  front: {translation_m: [1, 2, 3], rotation_quat_xyzw: [0, 0, 0, 1], child_frame_id: lidar}\n  back: {parent: front, translation_m: [0, 0, 1], rotation_quat_xyzw: [0, 0, 1, 0]}\n")
    assert rows(files.read_transforms(spark, str(tmp_path / "tf.yaml")).select("parent", "child", "ty", "qz")) == [("base", "lidar", 2.0, 0.0), ("front", "back", 0.0, 1.0)]
    r, t = rotation.compose(rotation.about(2, F.lit(90.0)), (F.lit(1.0), F.lit(0.0), F.lit(0.0)), rotation.about(2, F.lit(-90.0)), (F.lit(0.0), F.lit(2.0), F.lit(0.0)))
    got = spark.range(1).select(*rotation.columns(r), *[c.alias(n) for c, n in zip(t, "xyz")]).first()
    assert np.allclose(list(got), [1, 0, 0, 0, 1, 0, 0, 0, 1, -1, 0, 0])
    df = spark.createDataFrame([("a" if k % 3 else "b", k, k * 0.7, 0.0, 0.0) for k in range(60)], "trk string, n int, x double, y double, z double")
    for part in range(3):
        df.where(f"n >= {20 * part} AND n < {20 * part + 20}").coalesce(1).write.parquet(str(tmp_path / "in" / f"p{part}"))
    src = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in" / "*"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        q = decimate_stream(src, "trk", ["n"], 2.5).writeStream.format("memory").queryName("thin").trigger(availableNow=True).start()
        q.awaitTermination(120)
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert rows(spark.table("thin"), "trk", "n") == rows(track.decimate(df, ["trk"], ["n"], 2.5), "trk", "n")
