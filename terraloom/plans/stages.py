"""The three stages end to end: a log to a Parquet log, a log to a map, a cloud to meshes."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rotation
from ..operators.filters import row_cap
from ..scratch import materialise
from ..sources import cloud, decode, files, schema_text, sqlite_log
from . import map as map_plan
from . import mesh as mesh_plan
from .convert import convert

#: Stage one: see convert.convert().
convert_log = convert


def poses(spark: SparkSession, log: str, topic: str) -> DataFrame:
    """The pose records of a converted log, as its own schema lays them out: t_ns, position_type, latitude, longitude, altitude, roll, pitch, azimuth."""
    row = spark.read.parquet(f"{log}/schemas").where(F.col("topic") == topic).select("type", "schema").first()
    if row is None:
        raise ValueError(f"the log has no topic {topic}")
    known = schema_text.parse_text(row["type"], row["schema"])
    rec = decode.decode_records(sqlite_log.read_log(spark, f"{log}/messages", [topic]), schema_text.layout(row["type"], known), schema_text.ddl(row["type"], known), keep=("log_time",))
    return rec.select(F.col("log_time").alias("t_ns"), *[f"rec.{c}" for c in ("position_type", "latitude", "longitude", "altitude", "roll", "pitch", "azimuth")])


def transforms_table(spark: SparkSession, log: str) -> DataFrame:
    """(child, r11 to r33, tx, ty, tz) of the log's static transforms; an error if it has none."""
    found = materialise(decode.static_transforms(sqlite_log.read_log(spark, f"{log}/messages", ["/tf_static"])))
    if not found.limit(1).count():
        raise ValueError("the log has no static transforms: convert it with them")
    r = rotation.from_quaternion(*(F.col(c) for c in ("qx", "qy", "qz", "qw")))
    return found.select("child", *rotation.columns(r), "tx", "ty", "tz")


def build_map(spark: SparkSession, log: str, out: str, pose_topic: str, scan_topics: Sequence[str], opts: map_plan.MapOptions = map_plan.MapOptions(), origin: Sequence[float | None] = (None, None, None), accept_all: bool = False, lanes: bool = True, rejected: bool = False) -> DataFrame:
    """Writes trajectory_enu.csv, map_origin.yaml, lanelet2_map.osm (unless without lanes), pointcloud_map.pcd and, if asked for,
    ego_returns.pcd under out, and returns the funnel of points by topic. Topics without messages are left out; no pose, no
    transforms and no topics are errors."""
    if not scan_topics:
        raise ValueError("a map takes scan topics")
    os.makedirs(out, exist_ok=True)
    transforms = transforms_table(spark, log)
    pose = materialise(poses(spark, log, pose_topic))
    frame = map_plan.origin(pose, origin, accept_all)
    path = materialise(map_plan.trajectory(pose, frame, accept_all))
    files.write_track(path.select("t_ns", F.col("px").alias("x"), F.col("py").alias("y"), F.col("pz").alias("z")), f"{out}/trajectory_enu.csv")
    files.write_origin(f"{out}/map_origin.yaml", frame.lat0, frame.lon0, frame.alt0)
    if lanes:
        files.write_lane_graph(f"{out}/lanelet2_map.osm", *map_plan.lane_lines(map_plan.lanes(path, frame, opts)), origin=(frame.lat0, frame.lon0, frame.alt0))
    scans = decode.scan_headers(sqlite_log.read_log(spark, f"{log}/messages", list(scan_topics)))
    placed = map_plan.placed_points(scans, path, transforms, opts)
    cloud.write_cloud(map_plan.cloud(placed, opts.voxel), f"{out}/pointcloud_map.pcd")
    if rejected:
        cloud.write_cloud(map_plan.voxel.voxel_mean(map_plan.rejected(placed), opts.voxel), f"{out}/ego_returns.pcd")
    return map_plan.report(placed, spark.createDataFrame([(t,) for t in scan_topics], "topic string"))


def build_meshes(spark: SparkSession, cloud_path: str, track_path: str, out: str, opts: mesh_plan.MeshOptions = mesh_plan.MeshOptions(), normals: bool = True, most_points: int = 0) -> dict[str, dict]:
    """Writes ground.obj, wall_left.obj, wall_right.obj, meshes_manifest.yaml and meshes_summary.txt under out, and returns the meshes'
    counts. A side without a wall is left out, and its file of an earlier run deleted; no corridor points and no ground are errors."""
    os.makedirs(out, exist_ok=True)
    points = row_cap(cloud.read_cloud(spark, cloud_path), most_points, ["idx"]).withColumnRenamed("idx", "id")
    road = materialise(mesh_plan.prepare(files.read_track(spark, track_path), opts.step))
    found = materialise(mesh_plan.classified(points, road, opts))
    if not found.limit(1).count():
        raise ValueError("no point is near the track")
    made: dict[str, dict] = {}

    def write(name: str, title: str, vertices: DataFrame, faces: DataFrame, **more) -> None:
        vertices, faces = materialise(vertices), materialise(faces)
        files.write_mesh(vertices if normals else vertices.drop("nx", "ny", "nz"), faces, f"{out}/{name}", title)
        made[name] = {"vertices": vertices.count(), "triangles": faces.count(), **more}

    write("ground.obj", "Ground", *mesh_plan.ground(found.where("NOT vertical"), opts), cell_size_m=opts.ground_cell)
    walls = materialise(mesh_plan.with_height(found.where("vertical"), road))
    for side in ("left", "right"):
        name = f"wall_{side}.obj"
        try:
            write(name, f"Wall_{side.capitalize()}", *mesh_plan.wall(walls, road, side, opts), arclength_cell_m=opts.wall_cell_s, height_cell_m=opts.wall_cell_h)
        except mesh_plan.SkippedSide:
            if os.path.exists(f"{out}/{name}"):
                os.remove(f"{out}/{name}")
    files.write_manifest(f"{out}/meshes_manifest.yaml", list(made))
    files.write_summary(f"{out}/meshes_summary.txt", {"input cloud": cloud_path, "input trajectory": track_path, "corridor half width": opts.half_width, "vertical threshold": opts.threshold, "k": opts.k}, made)
    return made
