"""Queries over adapter views of the star-schema tables, and their SQL twins.

Each query applies an operator of the library; its twin states the same rows in SQL on the same tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import rotation
from ..functions.geodesy import LocalFrame, ecef_to_geodetic, geodetic_to_ecef
from ..operators import filters, joins, mesh, raster, spatial, track, voxel
from ..scratch import materialise, scratch_dir
from ..sources import cloud as cloud_file_format
from ..sources import decode, files, sqlite_log
from ..streaming import decimate_stream, voxel_stream
from . import map as map_plan
from . import mesh as mesh_plan

BOX = filters.parse_box("-10,10,20,60,2,8")
FRAME = LocalFrame(45.0, 7.0, 300.0)
_Q, _SQL = {}, {}

PTS = """pts AS (SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_quantity - 25 AS FLOAT) AS x, CAST(l_extendedprice / 1000 AS FLOAT) AS y,
  CAST(l_discount * 100 AS FLOAT) AS z, CAST(l_tax * 100 AS FLOAT) AS i FROM lineitem)"""
LOG = "lg AS (SELECT event_type AS topic, epoch_us(ts) AS t, event_id AS seq, user_id AS sensor, value FROM events)"
GEO = "geo AS (SELECT c_custkey AS id, 40.0 + (c_custkey % 1000) / 100.0 AS lat, (c_custkey % 3600) / 10.0 - 180.0 AS lon, c_acctbal AS alt FROM customer)"
TRK = """trk AS (SELECT user_id AS trk, event_id AS seq, sum(value * cos(event_id)) OVER w AS x, sum(value * sin(event_id)) OVER w AS y, CAST(event_id % 7 AS DOUBLE) AS z
  FROM events WHERE value IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
tk AS (SELECT trk, seq, round(x, 4) AS x, round(y, 4) AS y, z FROM trk)"""
CLD = "cld AS (SELECT vec_id AS id, embedding[1]::DOUBLE * 30 AS x, embedding[2]::DOUBLE * 30 AS y, embedding[3]::DOUBLE * 30 AS z FROM embeddings)"
GRID = PTS + """, cells AS (SELECT CAST(floor((x + 25) / 2.5) AS BIGINT) AS ix, CAST(floor(y / 4.0) AS BIGINT) AS iy, avg(z::DOUBLE) AS v FROM pts GROUP BY 1, 2),
grid AS (SELECT ix, iy, floor(v * 10000) / 10000 AS val FROM cells WHERE v >= 4.85)"""
HIGH = "g AS (SELECT ix, iy FROM grid WHERE val >= 5.05)"


def _read(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def points(spark, sf):
    f = lambda e: F.expr(e).cast("float")
    return _read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", f("l_quantity - 25").alias("x"), f("l_extendedprice / 1000").alias("y"), f("l_discount * 100").alias("z"), f("l_tax * 100").alias("i"))


def log(spark, sf):
    return _read(spark, sf, "events").select(F.col("event_type").alias("topic"), F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), F.col("event_id").alias("seq"), F.col("user_id").alias("sensor"), "value")


def geo(spark, sf):
    return _read(spark, sf, "customer").selectExpr("c_custkey AS id", "CAST(40.0 + (c_custkey % 1000) / 100.0 AS DOUBLE) AS lat", "CAST((c_custkey % 3600) / 10.0 - 180.0 AS DOUBLE) AS lon", "c_acctbal AS alt")


def tracks(spark, sf):
    e = _read(spark, sf, "events").where("value IS NOT NULL")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return e.select(F.col("user_id").alias("trk"), F.col("event_id").alias("seq"), F.round(F.sum(F.expr("value * cos(event_id)")).over(w), 4).alias("x"), F.round(F.sum(F.expr("value * sin(event_id)")).over(w), 4).alias("y"), F.expr("CAST(event_id % 7 AS DOUBLE)").alias("z"))


def cloud(spark, sf):
    return _read(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), *[(F.col("embedding")[k].cast("double") * 30).alias(c) for k, c in enumerate("xyz")])


def grid(spark, sf):
    """Cells of all points, heights in whole ten-thousandths; those of a low mean stay empty, so that the raster has holes."""
    p = points(spark, sf).withColumn("ix", F.floor((F.col("x") + 25) / 2.5).cast("long")).withColumn("iy", F.floor(F.col("y") / 4.0).cast("long"))
    cells = p.groupBy("ix", "iy").agg(F.avg(F.col("z").cast("double")).alias("v")).where(F.col("v") >= F.lit(4.85))
    return cells.select("ix", "iy", (F.floor(F.col("v") * 10000) / 10000).alias("val"))


def _rounded(df: DataFrame, n: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, n) + F.lit(0.0) for c in cols})


def query(sql: str | None = None):
    def put(f):
        _Q[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return put


# ---- scans, unions and filters


@query(f"WITH {LOG} SELECT min(t) AS t_min, max(t) AS t_max, count(*) AS n FROM lg")
def log_bounds(spark, sf):
    return sqlite_log.bounds(log(spark, sf), "t")


@query(f"WITH {LOG} SELECT topic, count(*) AS n FROM lg GROUP BY topic")
def topic_counts(spark, sf):
    return sqlite_log.summary(log(spark, sf))


@query(f"WITH {LOG} SELECT topic, t, seq FROM lg WHERE t <= (SELECT min(t) FROM lg) + 86400000000")
def time_slice(spark, sf):
    return filters.time_slice(log(spark, sf), "t", 86_400_000_000).select("topic", "t", "seq")


@query(f"WITH {LOG} SELECT topic, t, seq FROM lg UNION ALL SELECT 'static', min(t), 0 FROM lg")
def inject_union(spark, sf):
    return sqlite_log.inject(log(spark, sf).select("topic", "t", "seq"), {"topic": "static", "seq": 0}, "t")


#: A stamped header and a number behind it, so that the frame's length moves what follows.
_STAMPED = [("header", decode.HEADER), ("seq", "uint32")]


@query(f"WITH {LOG} SELECT seq, t, CASE WHEN topic = 'click' THEN 'secondary' ELSE topic END AS frame FROM lg")
def frame_rename(spark, sf):
    header = F.struct(F.floor(F.col("t") / 1_000_000).cast("int").alias("sec"), (F.col("t") % 1_000_000 * 1000).alias("nanosec"), F.col("topic").alias("frame_id"))
    sent = decode.encode_records(log(spark, sf).withColumn("rec", F.struct(header.alias("header"), "seq")), _STAMPED, keep=("topic",))
    sent = sent.withColumn("data", F.when(F.col("topic") == "click", filters.rename_frame(F.col("data"), "secondary")).otherwise(F.col("data")))
    got = decode.decode_records(sent, _STAMPED, "struct<header: struct<sec: int, nanosec: bigint, frame_id: string>, seq: bigint>")
    return got.selectExpr("rec.seq", "rec.header.sec * 1000000L + rec.header.nanosec div 1000 AS t", "rec.header.frame_id AS frame")


@query(f"WITH {LOG} SELECT topic, t, seq FROM lg WHERE topic IN ('view', 'click')")
def topic_scan(spark, sf):
    return sqlite_log.of_topics(log(spark, sf), ["view", "click"]).select("topic", "t", "seq")


@query("SELECT p_partkey, p_brand FROM part WHERE p_brand IN ('Brand#11', 'Brand#22', 'Brand#33')")
def quality_filter(spark, sf):
    return filters.quality(_read(spark, sf, "part"), "p_brand", ("Brand#11", "Brand#22", "Brand#33")).select("p_partkey", "p_brand")


@query(f"WITH {LOG} SELECT topic, t, seq FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY t, seq) - 1 AS n FROM lg) WHERE n % 5 = 0")
def systematic_sample(spark, sf):
    return filters.systematic_sample(log(spark, sf), 5, ["topic"], ["t", "seq"]).select("topic", "t", "seq")


@query(f"""WITH {LOG}, s AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY t, seq) - 1 AS n FROM lg),
k AS (SELECT topic, t, seq, row_number() OVER (PARTITION BY topic ORDER BY t, seq) AS m FROM s WHERE n % 5 = 0 AND value > 20) SELECT topic, t, seq FROM k WHERE m <= 40""")
def sample_then_cap(spark, sf):
    s = filters.systematic_sample(log(spark, sf), 5, ["topic"], ["t", "seq"]).where("value > 20")
    return filters.first_per_group(s, 40, ["topic"], ["t", "seq"]).select("topic", "t", "seq")


@query("SELECT (SELECT count(*) FROM lineitem) AS n_all, least(1000, count(*)) AS n FROM lineitem")
def row_cap(spark, sf):
    p = points(spark, sf)
    kept = filters.row_cap(p, 1000, ["l_orderkey", "l_linenumber", "x", "y", "z", "i"]).agg(F.count("*").alias("n"))
    return kept.join(F.broadcast(p.agg(F.count("*").alias("n_all"))), F.lit(True)).select("n_all", F.col("n").cast("long").alias("n"))


@query(f"WITH {PTS} SELECT l_orderkey, l_linenumber, x, y, z FROM pts WHERE x * x + y * y + z * z BETWEEN CAST(400 AS FLOAT) AND CAST(2500 AS FLOAT)")
def annulus_f32(spark, sf):
    return points(spark, sf).where(filters.range_ok("x", "y", "z", 20, 50)).select("l_orderkey", "l_linenumber", "x", "y", "z")


_IN = "x BETWEEN -10 AND 10 AND y BETWEEN 20 AND 60 AND z BETWEEN 2 AND 8"


@query(f"WITH {PTS} SELECT l_orderkey, l_linenumber, x, y, z FROM pts WHERE NOT ({_IN})")
def box_exclude(spark, sf):
    return points(spark, sf).where(~filters.inside_box("xyz", BOX)).select("l_orderkey", "l_linenumber", "x", "y", "z")


@query(f"WITH {PTS} SELECT l_orderkey, l_linenumber, x, y, z FROM pts WHERE {_IN}")
def box_rejects(spark, sf):
    return points(spark, sf).where(filters.inside_box("xyz", BOX)).select("l_orderkey", "l_linenumber", "x", "y", "z")


@query(f"WITH {PTS}, {TRK} SELECT l_orderkey, l_linenumber, z FROM pts WHERE z::DOUBLE BETWEEN (SELECT min(z) + 1 FROM tk) AND (SELECT max(z) + 1 FROM tk)")
def z_gate(spark, sf):
    lo, hi = filters.z_bounds(tracks(spark, sf), "z", -1.0, 1.0)
    return points(spark, sf).where(F.col("z").cast("double").between(lo, hi)).select("l_orderkey", "l_linenumber", "z")


@query(f"""WITH {PTS}, f AS (SELECT l_linenumber, x * x + y * y + z * z BETWEEN CAST(400 AS FLOAT) AND CAST(2500 AS FLOAT) AS a, NOT ({_IN}) AS b, z <= 6 AS c FROM pts),
g AS (SELECT l_linenumber, count(*) AS raw, count(*) FILTER (WHERE a) AS after_range, count(*) FILTER (WHERE a AND b) AS after_ego, count(*) FILTER (WHERE a AND b AND c) AS after_z FROM f GROUP BY 1)
SELECT *, round(100.0 * (after_range - after_ego) / greatest(after_range, 1), 4)::DOUBLE AS ego_pct, round(100.0 * after_z / greatest(raw, 1), 4)::DOUBLE AS kept_pct FROM g""")
def filter_funnel(spark, sf):
    return filters.funnel(points(spark, sf), "l_linenumber", {"after_range": filters.range_ok("x", "y", "z", 20, 50), "after_ego": ~filters.inside_box("xyz", BOX), "after_z": F.col("z") <= 6})


@query(f"WITH {LOG} SELECT sensor * 0.25::DOUBLE AS lat, (seq % 180)::DOUBLE AS lon, coalesce(value, 0.0)::DOUBLE AS alt FROM lg WHERE topic IN ('view', 'purchase') ORDER BY seq LIMIT 1")
def origin_first_fix(spark, sf):
    kind = F.when(F.col("topic").isin("view", "purchase"), "NARROW_INT").otherwise("NONE")
    poses = log(spark, sf).select(F.col("seq").alias("t_ns"), kind.alias("position_type"), (F.col("sensor") * 0.25).alias("latitude"), (F.col("seq") % 180).cast("double").alias("longitude"), F.coalesce("value", F.lit(0.0)).cast("double").alias("altitude"))
    frame = map_plan.origin(poses)
    return spark.createDataFrame([(frame.lat0, frame.lon0, frame.alt0)], "lat double, lon double, alt double")


@query(f"WITH {LOG} SELECT topic, arg_min(sensor, (t, seq)) AS sensor, min(t) AS t FROM lg GROUP BY topic")
def first_per_topic(spark, sf):
    return sqlite_log.first_of_topics(log(spark, sf), ["sensor", "t"], ["t", "seq"])


# ---- aggregates


_KEYS = ", ".join(f"CAST(floor({c} / CAST(0.2 AS FLOAT)) AS BIGINT) AS k{c}" for c in "xyz")
_PACK = "((kx & 2097151) << 42) | ((ky & 2097151) << 21) | (kz & 2097151)"


@query(f"""WITH {PTS}, k AS (SELECT *, {_KEYS} FROM pts)
SELECT {_PACK} AS key, round(avg(x::DOUBLE), 4) AS x, round(avg(y::DOUBLE), 4) AS y, round(avg(z::DOUBLE), 4) AS z, round(avg(i::DOUBLE), 4) AS i, count(*) AS n FROM k GROUP BY 1""")
def voxel_mean(spark, sf):
    sums = voxel.voxel_sums(points(spark, sf), 0.2)
    return sums.select("key", *[(F.round(F.col(f"s{c}") / F.col("n"), 4) + F.lit(0.0)).alias(c) for c in "xyzi"], "n")


@query(f"WITH {PTS}, k AS (SELECT *, {_KEYS} FROM pts) SELECT {_PACK} AS key, count(*) AS n FROM k GROUP BY 1")
def voxel_keys(spark, sf):
    return voxel.voxel_sums(points(spark, sf), 0.2).select("key", "n")


@query(f"WITH {PTS}, k AS (SELECT *, {_KEYS} FROM pts) SELECT {_PACK} AS key, round(sum(x::DOUBLE), 3) AS sx, count(*) AS n FROM k GROUP BY 1")
def voxel_merge(spark, sf):
    p = points(spark, sf)
    parts = [voxel.voxel_sums(p.where(F.col("l_linenumber") % 2 == r), 0.2) for r in (0, 1)]
    return voxel.merge_sums(*parts).select("key", F.round("sx", 3).alias("sx"), "n")


def _percentile_sql(q):
    return f"WITH {PTS} SELECT CAST(floor((x + 25) / 2.5) AS BIGINT) AS ix, CAST(floor(y / 10.0) AS BIGINT) AS iy, round(quantile_cont(z::DOUBLE, {q}), 6) AS val FROM pts GROUP BY 1, 2"


def _percentile(spark, sf, q):
    p = points(spark, sf).withColumn("ix", F.floor((F.col("x") + 25) / 2.5).cast("long")).withColumn("iy", F.floor(F.col("y") / 10.0).cast("long"))
    return _rounded(voxel.cell_percentile(p, ["ix", "iy"], "z", q), 6, "val")


@query(_percentile_sql(0.1))
def cell_percentile(spark, sf):
    return _percentile(spark, sf, 0.1)


@query(_percentile_sql(0.5))
def cell_median(spark, sf):
    return _percentile(spark, sf, 0.5)


# ---- joins


def _asof_sql(unit):
    return f"""WITH {LOG}, q AS (SELECT t // {unit} AS t, seq FROM lg WHERE topic = 'click'), p AS (SELECT t // {unit} AS t, seq, sensor FROM lg WHERE topic = 'view'),
a AS (SELECT q.t, q.seq, p.t AS pt, p.seq AS pseq, p.sensor, row_number() OVER (PARTITION BY q.seq ORDER BY p.t, p.seq) AS r FROM q JOIN p ON p.t >= q.t AND p.t <= q.t + 600000000 // {unit}),
b AS (SELECT q.t, q.seq, p.t AS pt, p.seq AS pseq, p.sensor, row_number() OVER (PARTITION BY q.seq ORDER BY p.t DESC, p.seq DESC) AS r FROM q JOIN p ON p.t < q.t AND p.t >= q.t - 600000000 // {unit}),
u AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY abs(pt - t), pt DESC) AS k FROM (SELECT * FROM a WHERE r = 1 UNION ALL SELECT * FROM b WHERE r = 1))
SELECT t, seq, pseq, sensor, pt - t AS dt FROM u WHERE k = 1"""


def _asof(spark, sf, unit):
    df = log(spark, sf).withColumn("t", F.floor(F.col("t") / unit).cast("long"))
    poses = df.where("topic = 'view'").select("t", F.col("seq").alias("pseq"), "sensor")
    return joins.asof_nearest(df.where("topic = 'click'").select("t", "seq"), poses, "t", 600_000_000 // unit, "t", ["pseq"], (), ["pseq", "sensor"])


@query(_asof_sql(1))
def asof_nearest(spark, sf):
    return _asof(spark, sf, 1)


@query(_asof_sql(60_000_000))
def asof_nearest_ties(spark, sf):
    return _asof(spark, sf, 60_000_000)


_TF = """tf AS (SELECT n_nationkey AS k, sin(radians(n_nationkey * 7.0) / 2) AS qz, cos(radians(n_nationkey * 7.0) / 2) AS qw, n_regionkey + 0.5 AS tx, n_nationkey * 0.25 AS ty, -1.0 AS tz FROM nation)"""


@query(f"""WITH {_TF}, s AS (SELECT s_suppkey, s_nationkey + 3 AS k, s_acctbal / 1000 AS x, (s_suppkey % 17) * 1.0 AS y, (s_suppkey % 5) * 1.0 AS z FROM supplier)
SELECT s_suppkey, round(coalesce(1 - 2 * qz * qz, 1) * x - coalesce(2 * qz * qw, 0) * y + coalesce(tx, 0), 6) AS x, round(coalesce(2 * qz * qw, 0) * x + coalesce(1 - 2 * qz * qz, 1) * y + coalesce(ty, 0), 6) AS y, round(z + coalesce(tz, 0), 6) AS z
FROM s LEFT JOIN tf USING (k)""")
def static_transform(spark, sf):
    tf = _read(spark, sf, "nation")  # keys are shifted below: three nations have no transform
    half = F.radians(F.col("n_nationkey") * F.lit(7.0)) / 2
    r = rotation.from_quaternion(F.lit(0.0), F.lit(0.0), F.sin(half), F.cos(half))
    tf = tf.select(F.col("n_nationkey").alias("k"), *rotation.columns(r), (F.col("n_regionkey") + F.lit(0.5)).alias("tx"), (F.col("n_nationkey") * F.lit(0.25)).alias("ty"), F.lit(-1.0).alias("tz"))
    s = _read(spark, sf, "supplier").selectExpr("s_suppkey", "s_nationkey + 3 AS k", "s_acctbal / 1000 AS x", "CAST(s_suppkey % 17 AS DOUBLE) AS y", "CAST(s_suppkey % 5 AS DOUBLE) AS z")
    return _rounded(joins.apply_static(s, tf, "k").select("s_suppkey", "x", "y", "z"), 6, "x", "y", "z")


@query(f"""WITH {LOG}, c AS (SELECT * FROM (VALUES ('click', 1), ('view', 2), ('purchase', 3)) AS v(topic, chan)) SELECT seq, chan FROM lg JOIN c USING (topic)""")
def channel_lookup(spark, sf):
    chans = spark.createDataFrame([("click", 1), ("view", 2), ("purchase", 3)], "topic string, chan int")
    return sqlite_log.with_channel(log(spark, sf), chans, "topic").select("seq", "chan")


_NN = f"""WITH {CLD}, v AS (SELECT s_suppkey AS idx, s_acctbal / 500 - 9.0 AS x, (s_suppkey % 17) * 1.03 - 8.0 AS y, (s_suppkey % 5) - 2.0 AS z FROM supplier),
d AS (SELECT p.*, v.idx, v.x AS vx, v.y AS vy, v.z AS vz, power(p.x - v.x, 2) + power(p.y - v.y, 2) AS d2 FROM cld p JOIN v ON abs(p.x - v.x) <= 3 AND abs(p.y - v.y) <= 3),
n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, idx) AS r FROM d WHERE d2 <= 9)"""


def _vertices(spark, sf):
    return _read(spark, sf, "supplier").selectExpr("s_suppkey AS idx", "s_acctbal / 500 - 9.0D AS x", "(s_suppkey % 17) * 1.03D - 8.0D AS y", "(s_suppkey % 5) - 2.0D AS z", "s_suppkey * 10.0D AS along", "0.6D AS tx", "0.8D AS ty")


@query(_NN + " SELECT id, idx, round(d2, 6) AS d2 FROM n WHERE r = 1")
def nearest_vertex(spark, sf):
    return spatial.nearest_vertex(cloud(spark, sf), _vertices(spark, sf), 3.0, "id").select("id", F.col("idx").cast("long").alias("idx"), F.round("d2", 6).alias("d2"))


@query(_NN + " SELECT id, idx::INTEGER AS nearest_idx, round((0.6 * (y - vy) - 0.8 * (x - vx))::FLOAT::DOUBLE, 4) AS signed_lat, (idx * 10)::DOUBLE AS along FROM n WHERE r = 1 AND z BETWEEN vz - 2 AND vz + 4")
def corridor(spark, sf):
    out = spatial.corridor(cloud(spark, sf), _vertices(spark, sf), 3.0, 4.0, 2.0)
    return out.select("id", "nearest_idx", F.round(F.col("signed_lat").cast("double"), 4).alias("signed_lat"), F.col("along").cast("double").alias("along"))


_KNN = f"""WITH {CLD}, pr AS (SELECT a.id, b.id AS other, b.x - a.x AS dx, b.y - a.y AS dy, b.z - a.z AS dz FROM cld a JOIN cld b ON a.id <> b.id),
nn AS (SELECT *, dx * dx + dy * dy + dz * dz AS d2, row_number() OVER (PARTITION BY id ORDER BY dx * dx + dy * dy + dz * dz, other) AS rank FROM pr),
k AS (SELECT * FROM nn WHERE rank <= 16)"""


@query(_KNN + " SELECT id, rank::INTEGER AS rank, other FROM k")
def knn(spark, sf):
    return spatial.knn(cloud(spark, sf), 16).select("id", "rank", "other")


_COV = ", ".join(f"round(covar_samp(d{a}, d{b}), 6) AS c{a}{b}" for a, b in (("x", "x"), ("y", "y"), ("z", "z"), ("x", "y"), ("x", "z"), ("y", "z")))


@query(_KNN + f" SELECT id, {_COV} FROM k GROUP BY id")
def local_covariance(spark, sf):
    return _rounded(spatial.covariance(spatial.knn(cloud(spark, sf), 16), 16), 6, "cxx", "cyy", "czz", "cxy", "cxz", "cyz")


@query(_KNN + """, c AS (SELECT id, covar_samp(dx, dx) AS a, covar_samp(dy, dy) AS b, covar_samp(dz, dz) AS c, covar_samp(dx, dy) AS d, covar_samp(dx, dz) AS e, covar_samp(dy, dz) AS f FROM k GROUP BY id),
q AS (SELECT *, (a + b + c) / 3 AS q, sqrt((power(a - (a + b + c) / 3, 2) + power(b - (a + b + c) / 3, 2) + power(c - (a + b + c) / 3, 2) + 2 * (d * d + e * e + f * f)) / 6) AS p FROM c),
r AS (SELECT *, acos(greatest(-1, least(1, ((a - q) * ((b - q) * (c - q) - f * f) - d * (d * (c - q) - f * e) + e * (d * f - (b - q) * e)) / 2 / power(p, 3)))) / 3 AS phi FROM q),
l AS (SELECT *, q + 2 * p * cos(phi) AS l3, q + 2 * p * cos(phi + 2 * pi() / 3) AS l1 FROM r),
m AS (SELECT id, sqrt(greatest(0, least(1, (l1 * l1 - l1 * (a + b) + (a * b - d * d)) / ((l1 - (3 * q - l1 - l3)) * (l1 - l3))))) AS nz FROM l)
SELECT id, round(nz, 5) AS nz, nz < 0.4 AS vertical FROM m""")
def verticality(spark, sf):
    return _rounded(spatial.verticality(cloud(spark, sf), 16, 0.4), 5, "nz")


@query(f"""WITH {TRK}, d AS (SELECT trk, seq, x, y, coalesce(sqrt(power(x - lag(x) OVER w, 2) + power(y - lag(y) OVER w, 2)), 0) AS d FROM tk WINDOW w AS (PARTITION BY trk ORDER BY seq)),
a AS (SELECT trk, seq, round(sum(d) OVER (PARTITION BY trk ORDER BY seq ROWS UNBOUNDED PRECEDING), 4) AS along FROM d),
q AS (SELECT t.trk, s.s::DOUBLE AS along FROM (SELECT DISTINCT trk FROM tk) t, (SELECT unnest(range(0, 3000, 125)) AS s) s),
j AS (SELECT q.trk, q.along, a.seq, a.along AS reached, row_number() OVER (PARTITION BY q.trk, q.along ORDER BY CASE WHEN a.along >= q.along THEN 0 ELSE 1 END, CASE WHEN a.along >= q.along THEN a.along ELSE -a.along END, CASE WHEN a.along >= q.along THEN a.seq ELSE -a.seq END) AS r FROM q JOIN a ON q.trk = a.trk)
SELECT trk, along, seq, reached FROM j WHERE r = 1""")
def arclength_lookup(spark, sf):
    a = track.arclength(tracks(spark, sf), ["trk"], ["seq"]).select("trk", "seq", F.round("along", 4).alias("along")).withColumn("reached", F.col("along"))
    q = a.select("trk").distinct().withColumn("along", F.explode(F.sequence(F.lit(0), F.lit(2999), F.lit(125)))).withColumn("along", F.col("along").cast("double"))
    return joins.asof_forward(q, a, "along", ["seq", "reached"], ["trk"], ["seq"])


# ---- geodesy and rotations

_ECEF = """ec AS (SELECT *, radians(lat) AS f, radians(lon) AS l FROM geo), n AS (SELECT *, 6378137.0 / sqrt(1 - e2 * sin(f) * sin(f)) AS n FROM (SELECT *, (1 / 298.257223563::DOUBLE) * (2 - 1 / 298.257223563::DOUBLE) AS e2 FROM ec)),
xyz AS (SELECT id, lat, lon, alt, (n + alt) * cos(f) * cos(l) AS x, (n + alt) * cos(f) * sin(l) AS y, (n * (1 - e2) + alt) * sin(f) AS z FROM n)"""


@query(f"WITH {GEO}, {_ECEF} SELECT id, round(x, 3) + 0.0 AS x, round(y, 3) + 0.0 AS y, round(z, 3) + 0.0 AS z FROM xyz")
def ecef(spark, sf):
    g = geo(spark, sf)
    return g.select("id", *[(F.round(c, 3) + F.lit(0.0)).alias(n) for c, n in zip(geodetic_to_ecef(F.col("lat"), F.col("lon"), F.col("alt")), "xyz")])


_E = ", ".join(f"round({r[0]!r} * (x - {FRAME.centre[0]!r}) + {r[1]!r} * (y - {FRAME.centre[1]!r}) + {r[2]!r} * (z - {FRAME.centre[2]!r}), 3) + 0.0 AS {n}" for r, n in zip(FRAME.axes, ("east", "north", "up")))


@query(f"WITH {GEO}, {_ECEF} SELECT id, {_E} FROM xyz")
def enu(spark, sf):
    g = geo(spark, sf)
    return g.select("id", *[(F.round(c, 3) + F.lit(0.0)).alias(n) for c, n in zip(FRAME.from_geodetic(F.col("lat"), F.col("lon"), F.col("alt")), ("east", "north", "up"))])


@query(f"WITH {GEO} SELECT id, round(lat, 5) AS lat, round(lon, 5) AS lon, round(alt, 2) AS alt FROM geo")
def enu_roundtrip(spark, sf):
    g = geo(spark, sf).withColumn("e", F.struct(*[c.alias(n) for c, n in zip(FRAME.from_geodetic(F.col("lat"), F.col("lon"), F.col("alt")), "xyz")]))
    back = FRAME.to_geodetic(F.col("e.x"), F.col("e.y"), F.col("e.z"))
    out = g.select("id", *[c.alias(n) for c, n in zip(back, ("lat", "lon", "alt"))])
    out = out.withColumn("lon", F.when(F.round("lon", 5) == 180.0, F.lit(-180.0)).otherwise(F.col("lon")))
    return out.select("id", (F.round("lat", 5) + F.lit(0.0)).alias("lat"), (F.round("lon", 5) + F.lit(0.0)).alias("lon"), (F.round("alt", 2) + F.lit(0.0)).alias("alt"))


@query(f"""WITH {GEO}, a AS (SELECT id, radians(id % 50 - 25) AS r, radians(id % 30 - 15) AS p, radians(id % 360) AS z FROM geo)
SELECT id, round(sin(z) * cos(p), 9) + 0.0 AS r11, round(-(sin(z) * sin(p) * sin(r) + cos(z) * cos(r)), 9) + 0.0 AS r12, round(-(sin(z) * sin(p) * cos(r) - cos(z) * sin(r)), 9) + 0.0 AS r13,
round(cos(z) * cos(p), 9) + 0.0 AS r21, round(-(cos(z) * sin(p) * sin(r) - sin(z) * cos(r)), 9) + 0.0 AS r22, round(-(cos(z) * sin(p) * cos(r) + sin(z) * sin(r)), 9) + 0.0 AS r23,
round(sin(p), 9) + 0.0 AS r31, round(cos(p) * sin(r), 9) + 0.0 AS r32, round(cos(p) * cos(r), 9) + 0.0 AS r33 FROM a""")
def attitude_matrix(spark, sf):
    g = geo(spark, sf)
    deg = lambda e: F.expr(e).cast("double")
    out = g.select("id", *rotation.columns(rotation.body_to_enu(deg("id % 50 - 25"), deg("id % 30 - 15"), deg("id % 360"))))
    return _rounded(out, 9, *[f"r{i}{j}" for i in (1, 2, 3) for j in (1, 2, 3)])


@query("SELECT event_id, epoch_us(ts) * 1000 // 1000000000 AS sec, epoch_us(ts) * 1000 % 1000000000 AS nsec FROM events")
def split_time(spark, sf):
    from ..functions.numeric import split_ns

    sec, nsec = split_ns(F.col("t") * 1000)
    return log(spark, sf).select(F.col("seq").alias("event_id"), sec.alias("sec"), nsec.alias("nsec"))


# ---- tracks

_W = "WINDOW w AS (PARTITION BY trk ORDER BY seq)"
_TAN = f"""{TRK}, dd AS (SELECT *, coalesce(lead(x) OVER w, x) - coalesce(lag(x) OVER w, x) AS dx, coalesce(lead(y) OVER w, y) - coalesce(lag(y) OVER w, y) AS dy FROM tk {_W}),
tn AS (SELECT *, CASE WHEN dx = 0 AND dy = 0 THEN 1 ELSE sqrt(dx * dx + dy * dy) END AS n FROM dd)"""


@query(f"""WITH {TRK}, d AS (SELECT trk, seq, coalesce(sqrt(power(x - lag(x) OVER w, 2) + power(y - lag(y) OVER w, 2)), 0) AS d FROM tk {_W})
SELECT trk, seq, round(sum(d) OVER (PARTITION BY trk ORDER BY seq ROWS UNBOUNDED PRECEDING), 4) AS along FROM d""")
def cum_arclength(spark, sf):
    return _rounded(track.arclength(tracks(spark, sf), ["trk"], ["seq"]).select("trk", "seq", "along"), 4, "along")


@query(f"WITH {_TAN} SELECT trk, seq, round(dx / n, 6) AS tx, round(dy / n, 6) AS ty FROM tn")
def tangent_normal(spark, sf):
    return _rounded(track.tangents(tracks(spark, sf), ["trk"], ["seq"]).select("trk", "seq", "tx", "ty"), 6, "tx", "ty")


@query(f"WITH {_TAN} SELECT trk, seq, round(x - 1.75 * dy / n, 5) AS lx, round(y + 1.75 * dx / n, 5) AS ly, round(x + 1.75 * dy / n, 5) AS rx, round(y - 1.75 * dx / n, 5) AS ry FROM tn")
def lane_offsets(spark, sf):
    return _rounded(track.lane_offsets(tracks(spark, sf), ["trk"], ["seq"]).select("trk", "seq", "lx", "ly", "rx", "ry"), 5, "lx", "ly", "rx", "ry")


def _decimate_sql(step, last):
    end = "UNION ALL SELECT g.trk, g.seq FROM (SELECT * FROM g WHERE n = m) g JOIN walk w ON w.trk = g.trk AND w.n = g.n WHERE (g.x, g.y, g.z) <> (w.kx, w.ky, w.kz)" if last else ""
    return f"""WITH RECURSIVE {TRK}, g AS (SELECT *, row_number() OVER (PARTITION BY trk ORDER BY seq) AS n, count(*) OVER (PARTITION BY trk) AS m FROM tk),
walk AS (SELECT trk, n, seq, x AS kx, y AS ky, z AS kz, true AS keep FROM g WHERE n = 1 UNION ALL
SELECT g.trk, g.n, g.seq, CASE WHEN h.k THEN g.x ELSE w.kx END, CASE WHEN h.k THEN g.y ELSE w.ky END, CASE WHEN h.k THEN g.z ELSE w.kz END, h.k
FROM walk w JOIN g ON g.trk = w.trk AND g.n = w.n + 1, LATERAL (SELECT sqrt(power(g.x - w.kx, 2) + power(g.y - w.ky, 2) + power(g.z - w.kz, 2)) >= {step} AS k) h)
SELECT trk, seq FROM walk WHERE keep {end}"""


@query(_decimate_sql(60, True))
def decimate_lane(spark, sf):
    return track.decimate(tracks(spark, sf), ["trk"], ["seq"], 60.0, keep_last=True).select("trk", "seq")


@query(_decimate_sql(40, False))
def decimate_track(spark, sf):
    return track.decimate(tracks(spark, sf), ["trk"], ["seq"], 40.0).select("trk", "seq")


# ---- rasters and meshes

NX, NY = 21, 28


@query(f"""WITH {PTS} SELECT least(greatest(floor((x::DOUBLE + 20) / 2.5), 0), 16)::BIGINT AS ix, least(greatest(floor((y::DOUBLE - 5) / 4.0), 0), 20)::BIGINT AS iy, count(*) AS n FROM pts GROUP BY 1, 2""")
def rasterise(spark, sf):
    p = points(spark, sf)
    r = raster.rasterise(p.withColumn("y", (F.col("y").cast("double") - 5) / 4.0 * 2.5), 2.5, (-20.0, 20.0, 0.0, 50.0))
    return r.groupBy("ix", "iy").agg(F.count("*").alias("n"))


_NEAR = "SELECT {0}.ix + dx AS ix, {0}.iy + dy AS iy, val FROM {0}, (SELECT unnest([-1, 0, 1]) AS dx), (SELECT unnest([-1, 0, 1]) AS dy)"


@query(f"WITH {GRID}, s AS ({_NEAR.format('grid')}) SELECT ix, iy, round(avg(val), 10) AS val FROM s WHERE (ix, iy) IN (SELECT (ix, iy) FROM grid) GROUP BY ix, iy")
def box_smooth(spark, sf):
    return _rounded(raster.box_smooth(grid(spark, sf)), 10, "val")


def _fill_step(src, dst, least, more):
    return f"""{dst}n AS ({_NEAR.format(src)} WHERE dx <> 0 OR dy <> 0), {dst} AS (SELECT ix, iy, val FROM {src} UNION ALL SELECT ix, iy, avg(val) AS val FROM {dst}n WHERE (ix, iy) NOT IN (SELECT (ix, iy) FROM {src}) AND {more} GROUP BY ix, iy HAVING count(*) >= {least})"""


@query(f"WITH {GRID}, {_fill_step('grid', 'g1', 2, f'ix BETWEEN 0 AND {NX - 1} AND iy BETWEEN 0 AND {NY - 1}')}, {_fill_step('g1', 'g2', 3, f'ix BETWEEN 0 AND {NX - 1} AND iy BETWEEN 0 AND {NY - 1}')} SELECT ix, iy, round(val, 10) AS val FROM g2")
def hole_fill_wall(spark, sf):
    return _rounded(raster.thicken(grid(spark, sf), NX, NY), 10, "val")


def _outside(src, name):
    return f"""{name}e AS (SELECT ix, iy FROM (SELECT unnest(range(0, {NX})) AS ix), (SELECT unnest(range(0, {NY})) AS iy) WHERE (ix, iy) NOT IN (SELECT (ix, iy) FROM {src})),
{name} AS (SELECT ix, iy FROM {name}e WHERE ix IN (0, {NX - 1}) OR iy IN (0, {NY - 1}) UNION SELECT e.ix, e.iy FROM {name}e e JOIN {name} o ON abs(e.ix - o.ix) + abs(e.iy - o.iy) = 1)"""


@query(f"WITH RECURSIVE {GRID}, {_outside('grid', 'o1')}, {_fill_step('grid', 'g1', 3, f'ix BETWEEN 0 AND {NX - 1} AND iy BETWEEN 0 AND {NY - 1} AND (ix, iy) NOT IN (SELECT (ix, iy) FROM o1)')}, {_outside('g1', 'o2')}, {_fill_step('g1', 'g2', 3, f'ix BETWEEN 0 AND {NX - 1} AND iy BETWEEN 0 AND {NY - 1} AND (ix, iy) NOT IN (SELECT (ix, iy) FROM o2)')} SELECT ix, iy, round(val, 10) AS val FROM g2")
def hole_fill_ground(spark, sf):
    g = materialise(grid(spark, sf).where(f"ix BETWEEN 0 AND {NX - 1} AND iy BETWEEN 0 AND {NY - 1}"))
    rest = grid(spark, sf).where(f"NOT (ix BETWEEN 0 AND {NX - 1} AND iy BETWEEN 0 AND {NY - 1})")
    for _ in range(2):
        g = materialise(raster.fill_holes(g, NX, NY, 1))
    return _rounded(g.select("ix", "iy", "val").unionByName(rest.select("ix", "iy", "val")), 10, "val")


@query(f"""WITH RECURSIVE {GRID}, {HIGH}, reach AS (SELECT ix, iy, ix AS jx, iy AS jy FROM g UNION SELECT r.ix, r.iy, g.ix, g.iy FROM reach r JOIN g ON abs(r.jx - g.ix) + abs(r.jy - g.iy) = 1)
SELECT ix, iy, min(jx * 4294967296 + jy)::BIGINT AS label FROM reach GROUP BY ix, iy""")
def components(spark, sf):
    return raster.components(grid(spark, sf).where(F.col("val") >= F.lit(5.05)))


@query(f"""WITH RECURSIVE {GRID}, {HIGH}, reach AS (SELECT ix, iy, ix AS jx, iy AS jy FROM g UNION SELECT r.ix, r.iy, g.ix, g.iy FROM reach r JOIN g ON abs(r.jx - g.ix) + abs(r.jy - g.iy) = 1)
SELECT ix, iy FROM reach GROUP BY ix, iy HAVING count(*) >= 3""")
def drop_small(spark, sf):
    return raster.drop_small(grid(spark, sf).where(F.col("val") >= F.lit(5.05)), 3).select("ix", "iy")


_VID = f"{GRID}, v AS (SELECT ix, iy, val, (row_number() OVER (ORDER BY ix, iy) - 1)::INTEGER AS vid FROM grid)"
_QUAD = """q AS (SELECT b.ix, b.iy, a.vid AS a, b1.vid AS b, c.vid AS c, d.vid AS d FROM (SELECT DISTINCT ix + dx AS ix, iy + dy AS iy FROM v, (SELECT unnest([0, -1]) AS dx), (SELECT unnest([0, -1]) AS dy)) b
LEFT JOIN v a ON a.ix = b.ix AND a.iy = b.iy LEFT JOIN v b1 ON b1.ix = b.ix + 1 AND b1.iy = b.iy LEFT JOIN v c ON c.ix = b.ix AND c.iy = b.iy + 1 LEFT JOIN v d ON d.ix = b.ix + 1 AND d.iy = b.iy + 1)"""


def _faces_sql(wind):
    full = "a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL AND d IS NOT NULL"
    tests = [full, full] + [f"{k} IS NULL AND " + " AND ".join(f"{o} IS NOT NULL" for o in "abcd" if o != k) for k in "abcd"]
    return "fc AS (" + " UNION ALL ".join(f"SELECT {n} AS cls, ix, iy, {w[0]} AS a, {w[1]} AS b, {w[2]} AS c FROM q WHERE {t}" for n, (w, t) in enumerate(zip(wind, tests))) + ")"


@query(f"WITH {_VID}, {_QUAD}, {_faces_sql(mesh.CCW)} SELECT * FROM fc")
def triangulate(spark, sf):
    return mesh.triangulate(mesh.number_cells(grid(spark, sf)))


@query(f"WITH {_VID}, {_QUAD}, {_faces_sql(mesh.CW)} SELECT * FROM fc")
def triangulate_left(spark, sf):
    return mesh.triangulate(mesh.number_cells(grid(spark, sf)), clockwise=True)


_P = "p AS (SELECT vid, (ix + 0.5) * 0.5 AS x, (iy + 0.5) * 0.5 AS y, val AS z FROM v)"
_F3 = "t AS (SELECT fc.*, pa.x AS ax, pa.y AS ay, pa.z AS az, pb.x AS bx, pb.y AS yb, pb.z AS bz, pc.x AS cx, pc.y AS cy, pc.z AS cz FROM fc JOIN p pa ON pa.vid = a JOIN p pb ON pb.vid = b JOIN p pc ON pc.vid = c)"


def _mesh(spark, sf):
    cells = mesh.number_cells(grid(spark, sf))
    return mesh.ground_vertices(cells, 0.5, 0.0, 0.0), mesh.triangulate(cells)


@query(f"""WITH {_VID}, {_QUAD}, {_faces_sql(mesh.CCW)}, {_P}, {_F3},
nn AS (SELECT a, b, c, (yb - ay) * (cz - az) - (bz - az) * (cy - ay) AS nx, (bz - az) * (cx - ax) - (bx - ax) * (cz - az) AS ny, (bx - ax) * (cy - ay) - (yb - ay) * (cx - ax) AS nz FROM t),
un AS (SELECT unnest([a, b, c]) AS vid, nx / s AS nx, ny / s AS ny, nz / s AS nz FROM (SELECT *, CASE WHEN nx = 0 AND ny = 0 AND nz = 0 THEN 1 ELSE sqrt(nx * nx + ny * ny + nz * nz) END AS s FROM nn)),
g AS (SELECT vid, sum(nx) AS nx, sum(ny) AS ny, sum(nz) AS nz FROM un GROUP BY vid), h AS (SELECT p.vid, coalesce(nx, 0) AS nx, coalesce(ny, 0) AS ny, coalesce(nz, 0) AS nz FROM p LEFT JOIN g USING (vid))
SELECT vid, round(nx / s, 5) AS nx, round(ny / s, 5) AS ny, round(nz / s, 5) AS nz FROM (SELECT *, CASE WHEN nx = 0 AND ny = 0 AND nz = 0 THEN 1 ELSE sqrt(nx * nx + ny * ny + nz * nz) END AS s FROM h)""")
def vertex_normals(spark, sf):
    return _rounded(mesh.vertex_normals(*_mesh(spark, sf)).select("vid", "nx", "ny", "nz"), 5, "nx", "ny", "nz")


@query(f"""WITH {_VID}, {_QUAD}, {_faces_sql(mesh.CCW)}, {_P}, {_F3}
SELECT cls, ix, iy, a, b, c FROM t WHERE greatest(sqrt(power(bx - ax, 2) + power(yb - ay, 2) + power(bz - az, 2)), sqrt(power(cx - bx, 2) + power(cy - yb, 2) + power(cz - bz, 2)), sqrt(power(ax - cx, 2) + power(ay - cy, 2) + power(az - cz, 2))) <= 1.3""")
def bridge_filter(spark, sf):
    v, f = _mesh(spark, sf)
    return mesh.drop_bridges(f, v, 1.3)


@query(f"WITH {PTS} SELECT l_orderkey, l_linenumber, x, CASE WHEN x > 0 THEN 'left' ELSE 'right' END AS side FROM pts WHERE x <> 0 AND z BETWEEN 1 AND 6")
def side_split_height_band(spark, sf):
    p = points(spark, sf).withColumn("signed_lat", F.col("x")).withColumn("h", F.col("z"))
    return mesh.split_sides(p, 1.0, 6.0).select("l_orderkey", "l_linenumber", "x", "side")


@query(f"""WITH {_VID} SELECT vid, round((ix * 2.0) - abs(val) * 0.8, 5) + 0.0 AS x, round((ix * 3.0) + abs(val) * 0.6, 5) + 0.0 AS y, round((1.0 + -2.0 + (iy + 0.5) * 1.0)::DOUBLE, 5) AS z FROM v""")
def curtain_embed(spark, sf):
    cells = mesh.number_cells(grid(spark, sf)).withColumns({"rx": F.col("ix") * 2.0, "ry": F.col("ix") * 3.0, "rz": F.lit(1.0), "tx": F.lit(0.6), "ty": F.lit(0.8)})
    return _rounded(mesh.curtain_vertices(cells, 1.0, 0.0, -2.0, "left"), 5, "x", "y", "z")


@query(f"""WITH {_VID}, {_QUAD}, {_faces_sql(mesh.CCW)} SELECT 'v' AS kind, printf('v %.6f %.6f %.6f', (ix + 0.5) * 0.5, (iy + 0.5) * 0.5, val) AS line FROM v
UNION ALL SELECT 'f', 'f ' || (a + 1) || ' ' || (b + 1) || ' ' || (c + 1) FROM fc""")
def obj_lines(spark, sf):
    v, f = _mesh(spark, sf)
    return mesh.obj_vertices(v).select(F.lit("v").alias("kind"), "line").unionByName(mesh.obj_faces(f, False).select(F.lit("f").alias("kind"), "line"))


_DEPS = [("Scan", "Header"), ("Scan", "Field"), ("Header", "Time"), ("Pose", "Header"), ("Pose", "Status"), ("Status", "Mask"), ("Field", "Mask"), ("Mask", "Time")]


@query("WITH RECURSIVE d(parent, child) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _DEPS) + "), r AS (SELECT DISTINCT parent AS root, parent AS name FROM d UNION SELECT r.root, d.child FROM r JOIN d ON r.name = d.parent) SELECT root, name FROM r")
def schema_closure(spark, sf):
    from ..sources.schema_text import Definition, closure

    known = {n: Definition(n) for pair in _DEPS for n in pair}
    for a, b in _DEPS:
        known[a].fields.append((b.lower(), b, ""))
    rows = [(root, name) for root in sorted({a for a, _ in _DEPS}) for name in closure(root, known)]
    return spark.createDataFrame(rows, "root string, name string")


# ---- files, payloads and streams, there and back


def _file(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark).removeprefix('file://')}/{uuid.uuid4().hex}-{name}"


@query(f"WITH {CLD} SELECT row_number() OVER (ORDER BY id) - 1 AS idx, x::FLOAT AS x, y::FLOAT AS y, z::FLOAT AS z, (id % 7)::FLOAT AS i FROM cld")
def cloud_file(spark, sf):
    path = _file(spark, "cloud.pcd")
    cloud_file_format.write_cloud(cloud(spark, sf).withColumn("i", F.col("id") % 7), path, "id")
    return cloud_file_format.read_cloud(spark, path, 1 << 16)


@query(f"WITH {TRK} SELECT seq AS t_ns, x + 0.0 AS x, y + 0.0 AS y, z FROM tk")
def track_file(spark, sf):
    path = _file(spark, "track.csv")
    files.write_track(tracks(spark, sf).select(F.col("seq").alias("t_ns"), "x", "y", "z"), path)
    return files.read_track(spark, path).select("t_ns", (F.col("x") + F.lit(0.0)).alias("x"), (F.col("y") + F.lit(0.0)).alias("y"), "z")


@query(f"""WITH {LOG}, n AS (SELECT *, row_number() OVER (ORDER BY t, seq) - 1 AS sequence FROM lg)
SELECT topic, t * 1000 AS log_time, sequence, sensor::VARCHAR AS body FROM n WHERE topic IN ('view', 'click')""")
def log_file(spark, sf):
    path = _file(spark, "log")
    out = joins.running_number(log(spark, sf), "t", ["t", "seq"], "sequence").withColumn("log_time", F.col("t") * 1000)
    sqlite_log.write_log(out.select("topic", "log_time", F.col("log_time").alias("publish_time"), "sequence", F.encode(F.col("sensor").cast("string"), "UTF-8").alias("data")), path)
    return sqlite_log.read_log(spark, path, ["view", "click"]).select("topic", "log_time", "sequence", F.decode("data", "UTF-8").alias("body"))


_RECORD = [("header", decode.HEADER), ("known", "bool"), ("value", "float64"), ("pair", ("int16", 2)), ("marks", ([("k", "uint8"), ("v", "int64")], None))]


@query(f"""WITH {LOG} SELECT seq, t, topic AS frame, value IS NOT NULL AS known, coalesce(value, -1.0)::DOUBLE AS value, (sensor % 100 - 50)::SMALLINT AS pair,
CASE WHEN seq % 3 = 0 THEN 0 ELSE seq * 1000003 END AS mark FROM lg""")
def record_payloads(spark, sf):
    """Records with nested fields, arrays and sequences, empty ones among them, packed and read again."""
    rec = """named_struct('header', named_struct('sec', CAST(t div 1000000 AS INT), 'nanosec', t % 1000000 * 1000, 'frame_id', topic), 'known', value IS NOT NULL, 'value', CAST(coalesce(value, -1.0) AS DOUBLE),
    'pair', array(CAST(0 AS SMALLINT), CAST(sensor % 100 - 50 AS SMALLINT)), 'marks', IF(seq % 3 = 0, array(), array(named_struct('k', CAST(7 AS SMALLINT), 'v', seq * 1000003L))))"""
    sent = decode.encode_records(log(spark, sf).withColumn("rec", F.expr(rec)), _RECORD, keep=("seq",))
    got = decode.decode_records(sent, _RECORD, "struct<header: struct<sec: int, nanosec: bigint, frame_id: string>, known: boolean, value: double, pair: array<smallint>, marks: array<struct<k: smallint, v: bigint>>>", keep=("seq",))
    return got.selectExpr("seq", "rec.header.sec * 1000000L + rec.header.nanosec div 1000 AS t", "rec.header.frame_id AS frame", "rec.known", "rec.value", "rec.pair[1] AS pair", "coalesce(get(rec.marks, 0).v, 0L) AS mark")


@query(f"WITH {PTS} SELECT l_orderkey, (row_number() OVER (PARTITION BY l_orderkey ORDER BY x, y, z, i) - 1)::INTEGER AS pt_idx, x, y, z, i FROM pts")
def scan_points(spark, sf):
    """The points of an order as one scan of records of 20 bytes, unpacked again."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = []
            for pts in batch.column(1).to_pylist():
                raw = np.zeros((len(pts), 5), "<f4")
                raw[:, :4] = [(p["x"], p["y"], p["z"], p["i"]) for p in pts]
                data.append(raw.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(data, pa.binary())], ["l_orderkey", "width", "data"])

    one = points(spark, sf).groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("x", "y", "z", "i"))).alias("pts"))
    key = one.schema["l_orderkey"].dataType.simpleString()
    scans = one.select("l_orderkey", "pts", F.size("pts").alias("width")).mapInArrow(packed, f"l_orderkey {key}, width int, data binary")
    return decode.explode_scans(scans.withColumns({"height": F.lit(1), "point_step": F.lit(20)}), ["l_orderkey"])


_NATIONS = "m AS (SELECT n_name AS parent, 'c' || (n_nationkey % 20) AS child, n_nationkey AS k, n_regionkey + 0.5::DOUBLE AS tx, n_nationkey * 0.25::DOUBLE AS ty, n_nationkey * 0.001::DOUBLE AS qz FROM nation)"


def _nations(spark, sf) -> list[tuple]:
    """A transform for each of the 25 nations."""
    return [(r["n_name"], f"c{r['n_nationkey'] % 20}", (r["n_regionkey"] + 0.5, r["n_nationkey"] * 0.25, -1.0), (0.0, 0.0, r["n_nationkey"] * 0.001, 1.0)) for r in _read(spark, sf, "nation").orderBy("n_nationkey").collect()]


@query(f"WITH {_NATIONS} SELECT parent, child, tx, ty, -1.0::DOUBLE AS tz, 0.0::DOUBLE AS qx, 0.0::DOUBLE AS qy, qz, 1.0::DOUBLE AS qw FROM m QUALIFY row_number() OVER (PARTITION BY child ORDER BY k DESC) = 1")
def first_transforms(spark, sf):
    """The log's first transform message; five children stand in it twice, and a later message plays no part."""
    sent = _nations(spark, sf)
    rows = [("/tf_static", t, n, bytearray(decode.transforms_message(t, some))) for n, (t, some) in enumerate([(20, sent[:3]), (10, sent)])]
    return decode.static_transforms(spark.createDataFrame(rows, "topic string, log_time long, sequence long, data binary"))


@query(f"WITH {_NATIONS} SELECT parent, 's' || k AS child, tx, ty, -1.0::DOUBLE AS tz, 0.0::DOUBLE AS qx, 0.0::DOUBLE AS qy, qz, 1.0::DOUBLE AS qw FROM m WHERE k <> 4")
def transforms_file(spark, sf):
    import yaml

    path = _file(spark, "transforms.yaml")
    sensors = {f"s{n}": {"parent": p, "translation_m": list(t), "rotation_quat_xyzw": list(q)} for n, (p, _, t, q) in enumerate(_nations(spark, sf))}
    with open(path, "w", encoding="utf-8") as f:
        yaml.safe_dump({"reference_frame": "base", "sensors": sensors}, f)
    return files.read_transforms(spark, path, skip=("s4",))


@query("""WITH l AS (SELECT n_nationkey AS k, 45.0::DOUBLE + n_nationkey * 0.01::DOUBLE AS lat, 7.0::DOUBLE + n_nationkey * 0.02::DOUBLE AS lon, n_nationkey * 0.5::DOUBLE AS alt, row_number() OVER (ORDER BY n_nationkey) AS n, count(*) OVER () AS m FROM nation)
SELECT s * m + n AS id, printf('%.12f', lat + (1 - s) * 0.001::DOUBLE) AS lat, printf('%.12f', lon) AS lon, printf('%.3f', alt) AS ele FROM l, (SELECT unnest([0, 1, 2]) AS s) WHERE s < 2
UNION ALL SELECT 2 * m + n, printf('%.12f', lat - 0.001::DOUBLE), printf('%.12f', lon), printf('%.3f', alt) FROM l""")
def osm_nodes(spark, sf):
    path = _file(spark, "lanes.osm")
    rows = _read(spark, sf, "nation").selectExpr("45.0D + n_nationkey * 0.01D AS lat", "7.0D + n_nationkey * 0.02D AS lon", "n_nationkey * 0.5D AS alt").orderBy("lon").collect()
    files.write_lane_graph(path, *([(r["lat"] + d, r["lon"], r["alt"]) for r in rows] for d in (0.001, 0.0, -0.001)))
    node = r'<node id="(\d+)" [^>]*lat="([^"]*)" lon="([^"]*)">\s*<tag k="ele" v="([^"]*)"'
    found = spark.read.text(path, wholetext=True).select(F.explode(F.regexp_extract_all("value", F.lit(node), F.lit(0))).alias("n"))
    part = lambda k: F.regexp_extract("n", node, k)
    return found.select(part(1).cast("long").alias("id"), part(2).alias("lat"), part(3).alias("lon"), part(4).alias("ele"))


@query(f"""WITH {_VID}, {_QUAD}, {_faces_sql(mesh.CCW)} SELECT printf('v %.6f %.6f %.6f', (ix + 0.5) * 0.5, (iy + 0.5) * 0.5, val) AS line FROM v
UNION ALL SELECT 'f ' || (a + 1) || ' ' || (b + 1) || ' ' || (c + 1) FROM fc UNION ALL VALUES ('# terraloom'), ('o Grid')""")
def mesh_file(spark, sf):
    path = _file(spark, "grid.obj")
    v, f = (materialise(x) for x in _mesh(spark, sf))
    files.write_mesh(v, f, path, "Grid")
    return spark.read.text(path).withColumnRenamed("value", "line")


@query(f"""WITH {GEO}, a AS (SELECT *, radians(id % 360) AS a, radians(id % 50 - 25) AS b FROM geo)
SELECT id, round(cos(a + b), 9) + 0.0 AS r11, round(-sin(a + b), 9) + 0.0 AS r12, round(sin(a + b), 9) + 0.0 AS r21, round(cos(a + b), 9) + 0.0 AS r22, 1.0::DOUBLE AS r33,
round(cos(a) - 2 * sin(a) + lat, 7) + 0.0 AS x, round(sin(a) + 2 * cos(a) + lon, 7) + 0.0 AS y, round(3 + alt, 7) + 0.0 AS z FROM a""")
def composed_rotation(spark, sf):
    g = geo(spark, sf)
    deg = lambda e: F.expr(e).cast("double")
    r, t = rotation.compose(rotation.about(2, deg("id % 360")), (F.col("lat"), F.col("lon"), F.col("alt")), rotation.about(2, deg("id % 50 - 25")), (F.lit(1.0), F.lit(2.0), F.lit(3.0)))
    out = g.select("id", *rotation.columns(r), *[c.alias(n) for c, n in zip(t, ("sx", "sy", "sz"))])
    out = out.select("id", "r11", "r12", "r21", "r22", "r33", *[F.col(f"s{c}").alias(c) for c in "xyz"])
    return _rounded(_rounded(out, 9, "r11", "r12", "r21", "r22", "r33"), 7, "x", "y", "z")


@query(_NN + """, h AS (SELECT id, idx::INTEGER AS nearest_idx, (0.6 * (y - vy) - 0.8 * (x - vx))::FLOAT AS lat, z - vz AS h FROM n WHERE r = 1 AND z BETWEEN vz - 2 AND vz + 4)
SELECT id, nearest_idx, round(h, 6) + 0.0 AS h, CASE WHEN lat > 0 THEN 'left' ELSE 'right' END AS side FROM h WHERE lat <> 0 AND h BETWEEN -1.05 AND 2.05""")
def sides_above_track(spark, sf):
    road = _vertices(spark, sf)
    near = mesh_plan.with_height(spatial.corridor(cloud(spark, sf), road, 3.0, 4.0, 2.0), road)
    return _rounded(mesh.split_sides(near, -1.05, 2.05).select("id", "nearest_idx", "h", "side"), 6, "h")


@query(f"""WITH {PTS}, k AS (SELECT *, {_KEYS} FROM pts)
SELECT {_PACK} AS key, {", ".join(f"round(avg({c}::DOUBLE)::FLOAT::DOUBLE, 4) + 0.0 AS {c}" for c in "xyzi")}, count(*) AS n FROM k GROUP BY 1""")
def voxel_means_stream(spark, sf):
    """The voxel means of the point table read as a stream: the last state that the stream wrote."""
    path, state = _file(spark, "voxels"), _file(spark, "state")
    table = spark.readStream.schema(_read(spark, sf, "lineitem").schema).parquet(f"{sf}/lineitem.parquet*")
    f = lambda e: F.expr(e).cast("float")
    moving = table.select(f("l_quantity - 25").alias("x"), f("l_extendedprice / 1000").alias("y"), f("l_discount * 100").alias("z"), f("l_tax * 100").alias("i"))
    put = lambda batch, _: batch.write.mode("overwrite").parquet(path)
    voxel_stream(moving).writeStream.outputMode("complete").foreachBatch(put).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return _rounded(spark.read.parquet(path).select("key", *[F.col(c).cast("double").alias(c) for c in "xyzi"], "n"), 4, *"xyzi")


@query(_SQL["decimate_track"])
def decimate_track_stream(spark, sf):
    """The tracks as a stream, decimated with state."""
    came, path, state = _file(spark, "tracks"), _file(spark, "kept"), _file(spark, "state")
    tracks(spark, sf).write.parquet(came)
    store, rocks = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(store)
    spark.conf.set(store, rocks)
    try:
        moving = spark.readStream.schema(spark.read.parquet(came).schema).parquet(came)
        decimate_stream(moving, "trk", ["seq"], 40.0).writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(path).awaitTermination()
    finally:
        spark.conf.set(store, before)
    return spark.read.parquet(path).select("trk", "seq")


def queries():
    return dict(_Q)


def oracle_sql():
    return dict(_SQL)
