"""Small text files: trajectories, transforms, origins, meshes, lane graphs and manifests."""

from __future__ import annotations

import os
from xml.sax.saxutils import quoteattr

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import mesh
from .parts import lines, write_parts

TRACK = ["t_ns", "x_enu_m", "y_enu_m", "z_enu_m"]


def read_track(spark: SparkSession, path: str) -> DataFrame:
    """(t_ns, x, y, z) by the header's names, or by place where any is missing; an empty file is an error."""
    raw = spark.read.option("header", True).csv(path)
    cols = TRACK if set(TRACK) <= set(raw.columns) else raw.columns[:4]
    if len(cols) < 4 or not raw.limit(1).count():
        raise ValueError(f"no trajectory in {path}")
    return raw.select(F.col(f"`{cols[0]}`").cast("long").alias("t_ns"), *[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(cols[1:], "xyz")])


def write_track(track: DataFrame, path: str) -> None:
    """All poses in order of time, coordinates with four digits."""
    fixed = [F.format_string("%.4f", c).alias(n) for c, n in zip("xyz", TRACK[1:])]
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    write_parts(track.select("t_ns", F.concat_ws(",", F.col("t_ns").cast("string"), *fixed).alias("line")), ["t_ns"], ["line"], path, lines, lambda n: (",".join(TRACK) + "\n").encode())


def read_transforms(spark: SparkSession, path: str, skip: tuple[str, ...] = ("imu", "pp7_odom")) -> DataFrame:
    """(parent, child, tx, ty, tz, qx, qy, qz, qw); the parent defaults to the file's reference frame, the child to its key."""
    with open(path, encoding="utf-8") as f:
        doc = yaml.safe_load(f) or {}
    rows = [(b.get("parent", doc.get("reference_frame", "imu")), b.get("child_frame_id", k), *map(float, b["translation_m"]), *map(float, b["rotation_quat_xyzw"])) for k, b in (doc.get("sensors") or {}).items() if k not in skip]
    return spark.createDataFrame(rows, "parent string, child string, " + ", ".join(f"{c} double" for c in ("tx", "ty", "tz", "qx", "qy", "qz", "qw")))


def write_origin(path: str, lat: float, lon: float, alt: float) -> None:
    with open(path, "w", encoding="utf-8") as f:
        f.write(f"origin:\n  latitude: {lat:.10f}\n  longitude: {lon:.10f}\n  altitude: {alt:.4f}\nframe: ENU\n")


def write_mesh(vertices: DataFrame, faces: DataFrame, path: str, name: str = "mesh") -> None:
    """The object's name, vertices, then normals, then faces from 1. Faces must name vertices that exist."""
    known = vertices.select("vid")
    if faces.select(F.explode(F.array("a", "b", "c")).alias("vid")).join(known, "vid", "left_anti").limit(1).count():
        raise ValueError("a face names a vertex that isn't there")
    normals = "nx" in vertices.columns
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    write_parts(mesh.obj_vertices(vertices), ["ord"], ["line"], path, lines, lambda n: f"# terraloom\no {name}\n".encode())
    write_parts(mesh.obj_faces(faces, normals), ["cls", "ix", "iy"], ["line"], path, lines, append=True)


#: The tags of a lane's relation and ways.
LANE_TAGS = {"type": "lanelet", "subtype": "road", "location": "urban", "one_way": "yes", "speed_limit": "30", "participant:vehicle": "yes"}
LINE_TAGS = {"type": "line_thin", "subtype": "solid"}


def lane_graph(left: list[tuple], right: list[tuple], centre: list[tuple], generator: str = "terraloom", tags: dict | None = None, origin: tuple[float, float, float] | None = None) -> str:
    """The XML of one lane from its three lines of (lat, lon, alt): nodes, ways, relation, numbered in this order; with an
    origin (lat, lon, alt) as a comment."""
    if len(centre) < 2:
        raise ValueError("a lane takes two points at least")
    out, ways_of, n = ["<?xml version='1.0' encoding='utf-8'?>", f"<osm version=\"0.6\" generator={quoteattr(generator)}>"], [], 0
    if origin:
        out.append("  <!-- Map origin: lat={:.10f} lon={:.10f} alt={:.3f} -->".format(*origin))
    for line in (left, right, centre):
        ids = []
        for lat, lon, alt in line:
            n += 1
            ids.append(n)
            out.append(f'  <node id="{n}" visible="true" version="1" lat="{lat:.12f}" lon="{lon:.12f}">\n    <tag k="ele" v="{alt:.3f}" />\n  </node>')
        ways_of.append(ids)
    ways = []
    for ids, own in zip(ways_of, (LINE_TAGS, LINE_TAGS, {"type": "centerline"})):
        n += 1
        ways.append(n)
        refs = "".join(f'\n    <nd ref="{i}" />' for i in ids) + "".join(f"\n    <tag k={quoteattr(k)} v={quoteattr(v)} />" for k, v in own.items())
        out.append(f'  <way id="{n}" visible="true" version="1">{refs}\n  </way>')
    members = "".join(f'\n    <member type="way" ref="{w}" role="{r}" />' for w, r in zip(ways, ("left", "right", "centerline")))
    own = "".join(f"\n    <tag k={quoteattr(k)} v={quoteattr(v)} />" for k, v in {**LANE_TAGS, **(tags or {})}.items())
    out.append(f'  <relation id="{n + 1}" visible="true" version="1">{members}{own}\n  </relation>')
    return "\n".join([*out, "</osm>"]) + "\n"


def write_lane_graph(path: str, left: list[tuple], right: list[tuple], centre: list[tuple], **how) -> None:
    with open(path, "w", encoding="utf-8") as f:
        f.write(lane_graph(left, right, centre, **how))


#: Layer, tag and material of each mesh.
MESHES = {"ground.obj": ("Ground", "asphalt"), "wall_left.obj": ("Wall", "rock"), "wall_right.obj": ("Wall", "metal")}


def write_manifest(path: str, made: list[str], note: str = "Import each mesh with its layer and a mesh collider.") -> None:
    """Entries only for the meshes that were made."""
    entries = [{"file": f, "unity_layer": MESHES[f][0], "unity_tag": MESHES[f][0], "rgl_material": MESHES[f][1], "collider": "MeshCollider", "static": True} for f in MESHES if f in made]
    with open(path, "w", encoding="utf-8") as f:
        yaml.safe_dump({"frame": "ENU", "note": note, "meshes": entries}, f, sort_keys=False)


def write_summary(path: str, params: dict, counts: dict[str, dict]) -> None:
    with open(path, "w", encoding="utf-8") as f:
        for k, v in params.items():
            f.write(f"{k}: {v}\n")
        for name, info in counts.items():
            f.write(f"\n{name}\n" + "".join(f"  {k}: {v}\n" for k, v in info.items()))
