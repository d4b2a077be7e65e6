"""Declared record schemas (JSON record definitions) -> Spark StructType."""

from __future__ import annotations

from pyspark.sql import types as T

# Primitive type names of the record format -> Spark types.
_PRIMITIVES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
    "bytes": T.BinaryType(),
}


def _to_type(t) -> T.DataType:
    if isinstance(t, str):
        if t not in _PRIMITIVES:
            raise ValueError(f"unsupported type {t!r}")
        return _PRIMITIVES[t]
    if isinstance(t, list):  # union with null -> nullable of the other branch
        rest = [x for x in t if x != "null"]
        if len(rest) != 1:
            raise ValueError(f"unsupported union {t!r}")
        return _to_type(rest[0])
    kind = t.get("type")
    if kind == "array":
        return T.ArrayType(_to_type(t["items"]))
    if kind == "map":
        return T.MapType(T.StringType(), _to_type(t["values"]))
    if kind == "record":
        return record_to_struct(t)
    return _to_type(kind)


def record_to_struct(record: dict) -> T.StructType:
    """A JSON record definition (``{"type": "record", "fields": [...]}``) as a StructType."""
    if record.get("type") != "record":
        raise ValueError("expected a record definition")
    return T.StructType([T.StructField(f["name"], _to_type(f["type"]), True)
                         for f in record["fields"]])
