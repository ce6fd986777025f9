"""Message definitions: parsing, dependency closure, and the text that names a message with all it depends on."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field

BASES = {"bool", "byte", "char", "int8", "uint8", "int16", "uint16", "int32", "uint32", "int64", "uint64", "float32", "float64", "string", "wstring"}
_SPARK = {"bool": "boolean", "byte": "smallint", "char": "tinyint", "int8": "tinyint", "uint8": "smallint", "int16": "smallint", "uint16": "int", "int32": "int", "uint32": "bigint", "int64": "bigint", "uint64": "decimal(20,0)", "float32": "float", "float64": "double", "string": "string", "wstring": "string"}
RULE = "=" * 80


@dataclass
class Definition:
    """Constants (name, kind, value) and fields (name, kind, bound); a bound is '', '[n]', '[]' or '[<=n]'."""

    name: str
    constants: list[tuple[str, str, str]] = field(default_factory=list)
    fields: list[tuple[str, str, str]] = field(default_factory=list)


def full_name(kind: str, package: str) -> str:
    """package/msg/Name of a type as written within a package."""
    parts = kind.split("/")
    if kind in BASES or len(parts) == 3:
        return kind
    return f"{parts[0]}/msg/{parts[1]}" if len(parts) == 2 else ("std_msgs/msg/Header" if kind == "Header" else f"{package}/msg/{kind}")


def short_name(kind: str, package: str = "") -> str:
    """package/Name, or Name alone within its own package."""
    parts = [p for p in kind.split("/") if p != "msg"]
    return kind if len(parts) != 2 else parts[1] if parts[0] == package else "/".join(parts)


def parse(name: str, text: str) -> Definition:
    """A definition file: comments go, constants have '=', defaults are dropped."""
    out, package = Definition(name), name.split("/")[0]
    for line in text.splitlines():
        line = line if re.match(r"\s*string\s+\w+\s*=", line) else line.split("#")[0]
        if not (m := re.match(r"\s*([\w/]+)(?:<=\d+)?((?:\[[^\]]*\])?)\s+(\w+)\s*(=?)\s*(.*?)\s*$", line)):
            continue
        kind, bound, field_name, sign, value = m.groups()
        if sign:
            out.constants.append((field_name, kind, value.strip("\"'") if kind == "string" else value))
        else:
            out.fields.append((field_name, full_name(kind, package), bound))
    return out


def closure(root: str, known: dict[str, Definition]) -> list[str]:
    """The root, then what it depends on, level by level, names of a level's parent in order; unknown names are left out."""
    order, queue = [], [root]
    while queue:
        name = queue.pop(0)
        if name in order or name not in known:
            continue
        order.append(name)
        queue += [d for d in sorted({k for _, k, _ in known[name].fields if k not in BASES}) if d not in order]
    return order


def body(d: Definition) -> str:
    package = d.name.split("/")[0]
    lines = [f'{k} {n} = "{v}"' if k == "string" else f"{k} {n} = {v}" for n, k, v in d.constants]
    return "\n".join(lines + [f"{short_name(k, package)}{b} {n}" for n, k, b in d.fields])


def schema_text(root: str, known: dict[str, Definition]) -> str:
    """The root's body, then a ruled block for each dependency. KeyError if the root isn't known."""
    order = closure(root, known)
    if not order:
        raise KeyError(root)
    parts = [body(known[order[0]])]
    for name in order[1:]:
        parts += [RULE, f"MSG: {short_name(name)}", body(known[name])]
    return "\n".join(parts) + "\n"


def ddl(root: str, known: dict[str, Definition]) -> str:
    """The definition as a Spark type; unsigned types widen."""
    def one(kind: str, bound: str) -> str:
        inner = _SPARK.get(kind) or ddl(kind, known)
        return f"array<{inner}>" if bound else inner

    return "struct<" + ",".join(f"{n}:{one(k, b)}" for n, k, b in known[root].fields) + ">"


def parse_text(name: str, text: str) -> dict[str, Definition]:
    """All definitions of a schema text, the named one first."""
    first, *rest = re.split(rf"^{RULE}\n", text, flags=re.M)
    out = {name: parse(name, first)}
    for block in rest:
        head, _, own = block.partition("\n")
        package, _, short = head.removeprefix("MSG:").strip().partition("/")
        full = f"{package}/msg/{short}"
        out[full] = parse(full, own)
    return out


def layout(root: str, known: dict[str, Definition]) -> list[tuple]:
    """The definition's fields as decode.CdrReader reads them."""
    def one(kind: str, bound: str):
        inner = kind if kind in BASES else layout(kind, known)
        return (inner, int(bound[1:-1]) if bound[1:-1].isdigit() else None) if bound else inner

    return [(n, one(k, b)) for n, k, b in known[root].fields]


#: The common message types that logs of this kind use.
STOCK = {
    "builtin_interfaces/msg/Time": "int32 sec\nuint32 nanosec",
    "std_msgs/msg/Header": "builtin_interfaces/Time stamp\nstring frame_id",
    "geometry_msgs/msg/Vector3": "float64 x\nfloat64 y\nfloat64 z",
    "geometry_msgs/msg/Quaternion": "float64 x\nfloat64 y\nfloat64 z\nfloat64 w",
    "geometry_msgs/msg/Transform": "Vector3 translation\nQuaternion rotation",
    "geometry_msgs/msg/TransformStamped": "std_msgs/Header header\nstring child_frame_id\nTransform transform",
    "tf2_msgs/msg/TFMessage": "geometry_msgs/TransformStamped[] transforms",
    "sensor_msgs/msg/PointField": "string name\nuint32 offset\nuint8 datatype\nuint32 count",
    "sensor_msgs/msg/PointCloud2": "std_msgs/Header header\nuint32 height\nuint32 width\nPointField[] fields\nbool is_bigendian\nuint32 point_step\nuint32 row_step\nuint8[] data\nbool is_dense",
    "sensor_msgs/msg/Imu": "std_msgs/Header header\ngeometry_msgs/Quaternion orientation\nfloat64[9] orientation_covariance\ngeometry_msgs/Vector3 angular_velocity\nfloat64[9] angular_velocity_covariance\ngeometry_msgs/Vector3 linear_acceleration\nfloat64[9] linear_acceleration_covariance",
}


def typestore(folder: str | None = None, package: str = "") -> dict[str, Definition]:
    """The stock types, and those of a folder of Name.msg files as package/msg/Name: vendors' layouts are the user's files."""
    known = {name: parse(name, text) for name, text in STOCK.items()}
    for file in sorted(os.listdir(folder)) if folder else ():
        if file.endswith(".msg"):
            name = f"{package}/msg/{file[:-4]}"
            with open(os.path.join(folder, file), encoding="utf-8") as f:
                known[name] = parse(name, f.read())
    return known
