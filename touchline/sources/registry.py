"""Schema registry: one JSON file per table, read at every run."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession, types as T

# The type names the registry uses, with their older spellings.
SCALARS = {
    "STRING": T.StringType(),
    "INT64": T.LongType(),
    "INTEGER": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "FLOAT": T.DoubleType(),
    "BOOL": T.BooleanType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
}
RECORDS = {"RECORD", "STRUCT"}
STAMP = "ingestion_timestamp"


def struct_type(fields: list[dict]) -> T.StructType:
    return T.StructType([_field(f) for f in fields])


def _field(spec: dict) -> T.StructField:
    kind = spec["type"].upper()
    mode = spec.get("mode", "NULLABLE").upper()
    if kind in RECORDS:
        dtype = struct_type(spec["fields"])
    elif kind in SCALARS:
        dtype = SCALARS[kind]
    else:
        raise ValueError(f"registry field {spec['name']!r} has unsupported type {spec['type']!r}")
    if mode == "REPEATED":
        dtype = T.ArrayType(dtype)
    return T.StructField(spec["name"], dtype, nullable=mode != "REQUIRED")


def load_schema(spark: SparkSession, root: str, table: str) -> T.StructType:
    """Schema of ``table``. The file is one small document, read on the driver."""
    text = spark.read.text(f"{root}/{table}.json", wholetext=True).first()[0]
    return struct_type(json.loads(text))


def record_fields(schema: T.StructType) -> list[T.StructField]:
    """The fields a record is expected to carry: all but the load stamp."""
    return [f for f in schema.fields if f.name != STAMP]
