"""Map build: poses and scans to a trajectory, a voxel cloud and a lane graph."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rotation
from ..functions.geodesy import LocalFrame
from ..functions.numeric import finite
from ..operators import filters, joins, track, voxel
from ..sources.decode import explode_scans


@dataclass(frozen=True)
class MapOptions:
    voxel: float = 0.2
    every: int = 5
    near: float = 2.0
    far: float = 120.0
    box: tuple[float, ...] | None = (-3.0, 3.0, -1.2, 1.2, -1.8, 0.5)
    below: float = 10.0
    above: float = 100.0
    tolerance_ns: int = 50_000_000
    half_lane: float = 1.75
    lane_step: float = 5.0
    max_scans: int = 0


def origin(poses: DataFrame, given: Sequence[float | None] = (None, None, None), accept_all: bool = False) -> LocalFrame:
    """The given latitude, longitude and altitude, all or none of them, else the first usable pose; an error if there is none."""
    if any(x is not None for x in given):
        if any(x is None for x in given):
            raise ValueError("an origin takes latitude, longitude and altitude")
        return LocalFrame(*map(float, given))
    row = filters.quality(poses, "position_type", accept_all=accept_all).orderBy("t_ns").select("latitude", "longitude", "altitude").first()
    if row is None:
        raise ValueError("the log has no usable pose")
    return LocalFrame(*row)


def trajectory(poses: DataFrame, frame: LocalFrame, accept_all: bool = False) -> DataFrame:
    """(t_ns, px, py, pz, r11 to r33) of the usable poses."""
    ok = filters.quality(poses, "position_type", accept_all=accept_all)
    p = frame.from_geodetic(*(F.col(c) for c in ("latitude", "longitude", "altitude")))
    r = rotation.body_to_enu(*(F.col(c) for c in ("roll", "pitch", "azimuth")))
    return ok.select("t_ns", *[c.alias(n) for c, n in zip(p, ("px", "py", "pz"))], *rotation.columns(r))


def placed_points(scans: DataFrame, path: DataFrame, transforms: DataFrame, opts: MapOptions) -> DataFrame:
    """World points of the sampled scans with tests in_range, in_box and in_gate; filters that cost least come first,
    and poses are looked up for scans, before points are unpacked."""
    s = filters.systematic_sample(scans, opts.every, ["topic"], ["log_time"])
    names = ["px", "py", "pz", *(f"r{i}{j}" for i in (1, 2, 3) for j in (1, 2, 3))]
    s = joins.asof_nearest(s, path, "log_time", opts.tolerance_ns, "t_ns", ["t_ns"], (), names)
    s = filters.first_per_group(s.where("height * width > 0 AND point_step > 0"), opts.max_scans, ["topic"], ["log_time"])
    pts = explode_scans(s, ["topic", "log_time", "frame_id", *names])
    pts = pts.withColumn("in_range", filters.range_ok("x", "y", "z", opts.near, opts.far))
    pose = [F.col(n).alias(f"p_{n}") for n in names]
    pts = joins.apply_static(pts.select("topic", "log_time", "frame_id", "x", "y", "z", "i", "in_range", *pose), transforms.withColumnRenamed("child", "frame_id"), "frame_id")
    inside = filters.inside_box(("x", "y", "z"), opts.box) if opts.box else F.lit(False)
    world = rotation.apply(rotation.read("p_r"), tuple(F.col(c) for c in "xyz"), tuple(F.col(f"p_p{c}") for c in "xyz"))
    lo, hi = filters.z_bounds(path, "pz", opts.below, opts.above)
    pts = pts.withColumn("in_box", inside).withColumn("__w", F.struct(*[c.alias(n) for c, n in zip(world, "xyz")]))
    pts = pts.select("topic", "log_time", "i", "in_range", "in_box", "__w.*")
    return pts.withColumn("in_gate", F.col("z").between(lo, hi) & finite(F.col("z")))


def cloud(placed: DataFrame, size: float) -> DataFrame:
    return voxel.voxel_mean(placed.where("in_range AND NOT in_box AND in_gate"), size).orderBy("key")


def rejected(placed: DataFrame) -> DataFrame:
    """Points inside the box, whatever their height."""
    return placed.where("in_range AND in_box")


def report(placed: DataFrame, topics: DataFrame | None = None) -> DataFrame:
    return filters.funnel(placed, "topic", {"after_range": F.col("in_range"), "after_ego": ~F.col("in_box"), "after_z": F.col("in_gate")}, topics)


def lanes(path: DataFrame, frame: LocalFrame, opts: MapOptions) -> DataFrame:
    """(idx, and for l, r and c: lat, lon, alt) of the decimated centre line and its borders."""
    t = path.select(F.lit(0).alias("trk"), "t_ns", F.col("px").alias("x"), F.col("py").alias("y"), F.col("pz").alias("z"))
    t = track.decimate(t, ["trk"], ["t_ns"], opts.lane_step, keep_last=True)
    t = track.lane_offsets(t, ["trk"], ["t_ns"], opts.half_lane)
    out: list = ["t_ns"]
    for s, (x, y) in {"l": ("lx", "ly"), "r": ("rx", "ry"), "c": ("x", "y")}.items():
        out += [c.alias(f"{s}_{n}") for c, n in zip(frame.to_geodetic(F.col(x), F.col(y), F.col("z")), ("lat", "lon", "alt"))]
    return t.select(*out).orderBy("t_ns")


def lane_lines(found: DataFrame) -> tuple[Sequence[tuple], ...]:
    """Left, right and centre lines for the lane file: one row for some metres of track."""
    rows = found.collect()
    return tuple([(r[f"{s}_lat"], r[f"{s}_lon"], r[f"{s}_alt"]) for r in rows] for s in "lrc")
