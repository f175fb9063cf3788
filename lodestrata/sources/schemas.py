"""Schemas from type lists and from Avro schema documents."""

from __future__ import annotations

import json
import re

from pyspark.sql import types as T

# Warehouse type names that Spark spells differently.
WAREHOUSE_TYPES = {
    "bit": "boolean",
    "bytea": "binary",
    "double precision": "double",
    "int2": "smallint",
    "int4": "int",
    "int8": "bigint",
    "numeric": "decimal",
    "str": "string",
    "text": "string",
    "time": "string",
    "varchar": "string",
    "char": "string",
    "character varying": "string",
    "timestamptz": "timestamp",
}

_AVRO_PRIMITIVES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bytes": T.BinaryType(),
    "null": T.NullType(),
}


def _spark_type(name: str, bare_decimal: str) -> str:
    base, _, arguments = name.strip().lower().partition("(")
    base = base.strip()
    spark = WAREHOUSE_TYPES.get(base, base)
    if spark != "decimal":
        return spark if base in WAREHOUSE_TYPES or not arguments else f"{spark}({arguments}"
    return f"decimal({arguments}" if arguments else bare_decimal


def name_type_pairs(spec: str, bare_decimal: str = "decimal(38,10)") -> list[tuple[str, str]]:
    """``name type`` or ``name:type`` entries; commas inside parentheses do not separate."""
    entries = [e.strip() for e in re.split(r",(?![^(]*\))", spec) if e.strip()]
    pairs = []
    for entry in entries:
        name, type_name = re.split(r"[:\s]\s*", entry, maxsplit=1)
        pairs.append((name.strip('`"'), _spark_type(type_name, bare_decimal)))
    return pairs


def schema_from_ddl(spec: str, bare_decimal: str = "decimal(38,10)") -> T.StructType:
    """A column list as warehouses write it. A bare ``decimal`` gets an explicit scale."""
    columns = ", ".join(f"`{n}` {t}" for n, t in name_type_pairs(spec, bare_decimal))
    return T.StructType.fromDDL(columns)


def schema_from_avsc(document: str | dict) -> T.StructType:
    """The Spark form of an Avro record schema.

    Field names are kept as written, also those that Avro itself would refuse.
    """
    node = json.loads(document) if isinstance(document, str) else document
    found = _avro_type(node, {})
    if not isinstance(found, T.StructType):
        raise ValueError("the top of the schema must be a record")
    return found


def _avro_type(node: object, named: dict[str, T.DataType]) -> T.DataType:
    if isinstance(node, list):
        choices = [c for c in node if c != "null"]
        if len(choices) > 1:
            raise ValueError(f"a union of several types has no column type: {node}")
        return _avro_type(choices[0], named) if choices else T.NullType()
    if isinstance(node, str):
        return named[node] if node in named else _AVRO_PRIMITIVES[node]
    kind = node["type"]
    if kind == "record":
        record = T.StructType([T.StructField(f["name"], _avro_type(f["type"], named)) for f in node["fields"]])
        named[node["name"]] = record
        return record
    if kind == "array":
        return T.ArrayType(_avro_type(node["items"], named))
    if kind == "map":
        return T.MapType(T.StringType(), _avro_type(node["values"], named))
    if kind in ("enum", "fixed"):
        named[node["name"]] = T.StringType() if kind == "enum" else T.BinaryType()
        return named[node["name"]]
    logical = node.get("logicalType")
    if logical == "date" and kind == "int":
        return T.DateType()
    if kind == "long" and logical in ("timestamp-millis", "timestamp-micros"):
        return T.TimestampType()
    if kind == "long" and logical in ("local-timestamp-millis", "local-timestamp-micros"):
        return T.TimestampNTZType()
    if logical == "decimal" and kind == "bytes":
        return T.DecimalType(node["precision"], node.get("scale", 0))
    return _avro_type(kind, named)
