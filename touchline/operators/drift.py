"""Schema drift on raw JSON records: detect, conform, quarantine.

A record is a row with its JSON text in ``record``. Only top-level field names are compared. A
field outside the schema is drift and is stripped; a missing field becomes NULL and is not drift by
itself. A drifting record is quarantined and its conformed form is still loaded.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from touchline.functions.json_text import STRICT

# Turns column ``name``, the JSON text of a field, into its final fields held as text.
Rewrite = Callable[[DataFrame, str, T.StructField], DataFrame]


def with_drift(records: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Add ``drift``: sorted new and missing field names, NULL for a record without new fields."""
    known = F.array(*[F.lit(f) for f in fields]).cast("array<string>")
    found = F.coalesce(
        F.json_object_keys("record"), F.raise_error(F.lit("record is not a JSON object"))
    )
    return (
        records.withColumn("_found", found)
        .withColumn("_new", F.array_except("_found", known))
        .withColumn(
            "drift",
            F.when(
                F.size("_new") > 0,
                F.struct(
                    F.array_sort("_new").alias("new_fields"),
                    F.array_sort(F.array_except(known, F.col("_found"))).alias("missing_fields"),
                ),
            ),
        )
        .drop("_found", "_new")
    )


def conform(
    records: DataFrame, fields: Sequence[T.StructField], rewrites: Mapping[str, Rewrite] | None = None
) -> DataFrame:
    """Typed columns ``fields`` of every record; other columns of ``records`` are kept in front.

    Values convert as in a warehouse load: ``"5"`` is a fine integer and ``0.5`` a fine string. A
    value that does not fit its type fails the job, as does a broken record.
    """
    rewrites = rewrites or {}
    kept = [c for c in records.columns if c != "record"]
    rows = _read(records, T.StructType([_as_read(f, f.name in rewrites) for f in fields]))
    raw = {f.name: F.col("_row")[f.name] for f in fields}
    for f in fields:
        if f.name in rewrites:
            name = f"_rewritten_{f.name}"
            rows = rewrites[f.name](rows.withColumn(name, raw[f.name]), name, f)
            raw[f.name] = F.col(name)

    def column(f: T.StructField) -> Column:
        value = raw[f.name] if _is_scalar(f) else _cast(raw[f.name], f.dataType, f.name)
        return _present(value, f).alias(f.name)

    return rows.select(*kept, *[column(f) for f in fields])


# Types the JSON reader converts itself. Other values are read as text and cast afterwards.
READ_DIRECTLY = (T.LongType, T.DoubleType, T.BooleanType, T.StringType)


def _as_read(field: T.StructField, rewritten: bool) -> T.StructField:
    if rewritten:
        return T.StructField(field.name, T.StringType())
    if isinstance(field.dataType, READ_DIRECTLY):
        return T.StructField(field.name, field.dataType)
    return T.StructField(field.name, _text(field.dataType))


def _read(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Add ``_row``, the record read as ``schema``.

    The typed read takes a number only where JSON has a number. The few records it cannot take are
    read again as text and cast field by field. That second path sits in a higher-order function,
    which keeps the generated code of the usual path small enough to be compiled.
    """
    misread = T.StructField("_misread", T.StringType())
    options = {**STRICT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_misread"}
    quick = F.from_json("record", T.StructType([*schema.fields, misread]), options)
    texts = T.StructType([T.StructField(f.name, _text(f.dataType)) for f in schema.fields])

    def cast(row):
        return F.struct(
            *[
                (_cast(row[f.name], f.dataType, f.name) if _is_scalar(f) else row[f.name]).alias(f.name)
                for f in schema.fields
            ]
        )

    missed = F.col("_quick").isNull() | F.col("_quick._misread").isNotNull()
    again = F.when(missed & F.col("record").isNotNull(), F.array("record"))
    strict = F.transform(again, lambda r: F.from_json(r, texts, STRICT))
    taken = F.struct(*[F.col("_quick")[f.name].alias(f.name) for f in schema.fields])
    return records.withColumn("_quick", quick).withColumn(
        "_row", F.coalesce(F.transform(strict, cast)[0], taken)
    )


def _is_scalar(field: T.StructField) -> bool:
    return isinstance(field.dataType, READ_DIRECTLY)


def _text(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _text(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_text(dtype.elementType))
    return T.StringType()


def _present(value: Column, field: T.StructField) -> Column:
    if field.nullable:
        return value
    return F.coalesce(value, F.raise_error(F.lit(f"required field {field.name} is missing")))


def _cast(raw: Column, dtype: T.DataType, name: str) -> Column:
    """Text (or nested text) as ``dtype``; raises on a misfit, whether or not ANSI mode is on."""
    if isinstance(dtype, T.StringType):
        return raw
    if isinstance(dtype, T.StructType):
        parts = [
            _present(_cast(raw[f.name], f.dataType, f.name), f).alias(f.name) for f in dtype.fields
        ]
        return F.when(raw.isNotNull(), F.struct(*parts))
    if isinstance(dtype, T.ArrayType):
        return F.transform(raw, lambda item: _cast(item, dtype.elementType, name))
    misfit = F.concat(F.lit(f"{name} is not a {dtype.simpleString()}: "), raw)
    return F.when(raw.isNotNull(), F.coalesce(raw.try_cast(dtype), F.raise_error(misfit)))


def quarantine_payload(drifting: DataFrame, table: str, run: Column | str, detected_at: Column) -> DataFrame:
    """Dead-letter rows of the records that drift."""
    return drifting.where(F.col("drift").isNotNull()).select(
        F.col("record").alias("raw_record"),
        "drift",
        F.lit(table).alias("table"),
        (run if isinstance(run, Column) else F.lit(run)).alias("run_timestamp"),
        detected_at.alias("detected_at"),
    )


def drift_counts(drifting: DataFrame) -> DataFrame:
    """How often each new or missing field name occurs among drifting records."""
    def names(kind):
        return F.transform(
            F.col(f"drift.{kind}s"), lambda n: F.struct(F.lit(kind).alias("kind"), n.alias("field"))
        )

    return (
        drifting.where(F.col("drift").isNotNull())
        .select(F.inline(F.concat(names("new_field"), names("missing_field"))))
        .groupBy("kind", "field")
        .agg(F.count(F.lit(1)).alias("records"))
    )
