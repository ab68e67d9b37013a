"""Per-table field rewrites applied while records are conformed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from touchline.functions.json_text import with_fields
from touchline.operators.drift import Rewrite

# Sub-fields of ``overrides``; those in JSON_TEXT are stored as JSON text.
OVERRIDE_FIELDS = ("pick_multiplier", "rules", "scoring", "element_types")
JSON_TEXT = ("rules", "scoring", "element_types")


def overrides_as_text(df: DataFrame, name: str, field: T.StructField) -> DataFrame:
    """``overrides`` with three sub-objects as JSON text.

    An absent sub-object of a non-empty ``overrides`` is the text ``null``; other sub-fields are
    dropped. An absent or NULL ``overrides`` stays NULL and an empty one keeps all sub-fields NULL.
    """
    body, parts, found = F.col(name), F.col("_parts"), F.col("_found")

    def part(sub):
        if sub not in OVERRIDE_FIELDS:
            return F.lit(None).cast("string")
        if sub in JSON_TEXT:
            return F.when(F.size(found) > 0, F.coalesce(parts[sub], F.lit("null")))
        return parts[sub]

    rewritten = F.struct(*[part(f.name).alias(f.name) for f in field.dataType.fields])
    return (
        df.withColumns(
            {
                "_found": F.json_object_keys(body),
                "_parts": F.from_json(body, ", ".join(f"{n} string" for n in OVERRIDE_FIELDS)),
            }
        )
        .withColumn(
            name,
            F.when(body.isNull(), None)
            .when(found.isNull(), F.raise_error(F.lit("overrides is not a JSON object")))
            .otherwise(rewritten),
        )
        .drop("_found", "_parts")
    )


REWRITES: dict[str, dict[str, Rewrite]] = {"matches": {"overrides": overrides_as_text}}


def rewrites_for(table: str) -> dict[str, Rewrite]:
    return REWRITES.get(table, {})


def rewritten_record(table: str, record: Column) -> Column:
    """JSON text of a loaded record with its rewritten fields, taken from their loaded columns.

    A rewritten field without any value was absent or empty and stays as it came.
    """
    for name in rewrites_for(table):
        has_values = F.to_json(F.col(name)) != "{}"
        replaced = with_fields(record, {name: F.to_variant_object(F.col(name))})
        record = F.when(has_values, replaced).otherwise(record)
    return record
