"""Binary payloads: little-endian CDR records and packed point scans."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

_SIZES = {"bool": ("?", 1), "byte": ("B", 1), "char": ("b", 1), "int8": ("b", 1), "uint8": ("B", 1), "int16": ("h", 2), "uint16": ("H", 2), "int32": ("i", 4), "uint32": ("I", 4), "int64": ("q", 8), "uint64": ("Q", 8), "float32": ("f", 4), "float64": ("d", 8)}


class CdrReader:
    """Values one after another, each aligned to its size from the payload's start at byte 4."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 4

    def scalar(self, kind: str):
        if kind == "string":
            n = self.scalar("uint32")
            raw = self.data[self.at : self.at + max(n - 1, 0)]
            self.at += n
            return raw.decode("utf-8", "replace")
        code, size = _SIZES[kind]
        self.at += -(self.at - 4) % size
        value = struct.unpack_from("<" + code, self.data, self.at)[0]
        self.at += size
        return value

    def record(self, fields: Sequence[tuple]) -> dict:
        """fields: (name, kind) with kind a scalar's name, a list of fields, or (kind, n) for an array; n None: a sequence."""
        return {name: self.value(kind) for name, kind in fields}

    def value(self, kind):
        if isinstance(kind, list):
            return self.record(kind)
        if isinstance(kind, tuple):
            inner, n = kind
            n = self.scalar("uint32") if n is None else n
            return [self.value(inner) for _ in range(n)]
        return self.scalar(kind)


class CdrWriter:
    def __init__(self):
        self.data = bytearray(b"\0\1\0\0")

    def scalar(self, kind: str, value) -> None:
        if kind == "string":
            raw = value.encode() + b"\0"
            self.scalar("uint32", len(raw))
            self.data += raw
            return
        code, size = _SIZES[kind]
        self.data += b"\0" * (-(len(self.data) - 4) % size)
        self.data += struct.pack("<" + code, value)

    def record(self, fields: Sequence[tuple], row: dict) -> None:
        """Values by name, for fields as CdrReader.record() takes them."""
        for name, kind in fields:
            self.value(kind, row[name])

    def value(self, kind, value) -> None:
        if isinstance(kind, list):
            self.record(kind, value)
        elif isinstance(kind, tuple):
            inner, n = kind
            if n is None:
                self.scalar("uint32", len(value))
            elif len(value) != n:
                raise ValueError(f"{len(value)} values for an array of {n}")
            for x in value:
                self.value(inner, x)
        else:
            self.scalar(kind, value)


def transforms_message(t_ns: int, transforms: Sequence[tuple]) -> bytes:
    """The static-transform message of (parent, child, translation, quaternion) entries."""
    w = CdrWriter()
    w.scalar("uint32", len(transforms))
    for parent, child, t, q in transforms:
        w.scalar("int32", t_ns // 1_000_000_000)
        w.scalar("uint32", t_ns % 1_000_000_000)
        w.scalar("string", parent)
        w.scalar("string", child)
        for v in (*t, *q):
            w.scalar("float64", float(v))
    return bytes(w.data)


#: The layouts of a stamped header, of transforms and of a scan.
HEADER = [("sec", "int32"), ("nanosec", "uint32"), ("frame_id", "string")]
TRANSFORMS = [("transforms", ([("header", HEADER), ("child_frame_id", "string"), *[(k, "float64") for k in ("tx", "ty", "tz", "qx", "qy", "qz", "qw")]], None))]
SCAN = [("header", HEADER), ("height", "uint32"), ("width", "uint32"), ("fields", ([("name", "string"), ("offset", "uint32"), ("datatype", "uint8"), ("count", "uint32")], None)), ("big", "bool"), ("point_step", "uint32"), ("row_step", "uint32")]


def decode_records(messages: DataFrame, fields: Sequence[tuple], schema: str, data: str = "data", keep: Sequence[str] = ()) -> DataFrame:
    """The kept columns and one struct `rec` of the given schema for each CDR payload; null payloads give null."""
    kinds = ", ".join(f"{c} {messages.schema[c].dataType.simpleString()}" for c in keep)
    full = f"{kinds}, rec {schema}" if kinds else f"rec {schema}"
    kind = to_arrow_type(StructType.fromDDL(f"rec {schema}")["rec"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rec = [None if x is None else CdrReader(x).record(fields) for x in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(rec, kind)], [*keep, "rec"])

    return messages.select(*keep, data).mapInArrow(run, full)


def encode_records(rows: DataFrame, fields: Sequence[tuple], rec: str = "rec", keep: Sequence[str] = ()) -> DataFrame:
    """The kept columns and `data`, the CDR payload of each row's struct: what decode_records() reads. A null struct gives null; nulls
    in it are an error, as the layout has none."""
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)

    def one(row: dict | None) -> bytes | None:
        if row is None:
            return None
        w = CdrWriter()
        w.record(fields, row)
        return bytes(w.data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = pa.array([one(x) for x in batch.column(len(keep)).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], data], [*keep, "data"])

    return rows.select(*keep, rec).mapInArrow(run, f"{kinds}, data binary" if kinds else "data binary")


def scan_points(payload: bytes | None, n: int | None, step: int | None) -> np.ndarray:
    """(n, 4) of x, y, z, intensity: single floats at bytes 0, 4, 8 and 12 of each record."""
    if not payload or not n or not step:
        return np.zeros((0, 4), np.float32)
    return np.ndarray((n, 4), "<f4", payload, 0, (step, 4)).copy()


def explode_scans(scans: DataFrame, keep: Sequence[str] = ("topic", "log_time")) -> DataFrame:
    """scans(..., height, width, point_step, data) -> a row for each point: the kept columns, pt_idx, x, y, z, i."""
    kinds = ", ".join(f"{c} {scans.schema[c].dataType.simpleString()}" for c in keep)
    k = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns[k:]]
            for row, (h, w, step, data) in enumerate(zip(*cols)):
                xyzi = scan_points(data, (h or 0) * (w or 0), step)
                if len(xyzi):
                    idx = pa.array(np.full(len(xyzi), row))
                    yield pa.RecordBatch.from_arrays([*(batch.column(i).take(idx) for i in range(k)), pa.array(np.arange(len(xyzi), dtype=np.int32)), *(pa.array(np.ascontiguousarray(xyzi[:, j])) for j in range(4))], [*keep, "pt_idx", "x", "y", "z", "i"])

    return scans.select(*keep, *[F.col(c).cast("int") for c in ("height", "width", "point_step")], "data").mapInArrow(run, f"{kinds}, pt_idx int, x float, y float, z float, i float")


def scan_headers(messages: DataFrame, keep: Sequence[str] = ("topic", "log_time")) -> DataFrame:
    """The kept columns, frame_id, height, width, point_step and data (the points' bytes) of scan messages; null and broken payloads go."""
    kinds = ", ".join(f"{c} {messages.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        for batch in batches:
            rows = []
            for i, raw in enumerate(batch.column(len(keep)).to_pylist()):
                try:
                    r = CdrReader(raw)
                    head = r.record(SCAN)
                    n = r.scalar("uint32")
                except (struct.error, TypeError):
                    continue
                rows.append((i, head["header"]["frame_id"], head["height"], head["width"], head["point_step"], raw[r.at : r.at + n]))
            at, *cols = (pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, kind))
            yield pa.RecordBatch.from_arrays([*(c.take(at) for c in batch.columns[: len(keep)]), *cols], [*keep, "frame_id", "height", "width", "point_step", "data"])

    return messages.select(*keep, "data").mapInArrow(run, f"{kinds}, frame_id string, height long, width long, point_step long, data binary")


def static_transforms(messages: DataFrame, topic: str = "/tf_static") -> DataFrame:
    """(parent, child, tx, ty, tz, qx, qy, qz, qw) of the first transform message in the log: that topic's is latched, so one is
    enough. Of a child that stands twice the last counts; no message gives an empty table."""
    schema = "struct<transforms: array<struct<header: struct<sec: int, nanosec: bigint, frame_id: string>, child_frame_id: string, tx: double, ty: double, tz: double, qx: double, qy: double, qz: double, qw: double>>>"
    first = messages.where(F.col("topic") == topic).orderBy("log_time", "sequence").limit(1)
    each = decode_records(first, TRANSFORMS, schema).select(F.posexplode("rec.transforms").alias("pos", "t"))
    last = each.groupBy(F.col("t.child_frame_id").alias("child")).agg(F.max_by("t", "pos").alias("t"))
    return last.select(F.col("t.header.frame_id").alias("parent"), "child", *[f"t.{c}" for c in ("tx", "ty", "tz", "qx", "qy", "qz", "qw")])
