"""Bronze run -> silver tables, with drifting records copied to the quarantine."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from touchline.operators.completeness import missing_snapshots
from touchline.operators.drift import conform, quarantine_payload, with_drift
from touchline.operators.transforms import rewrites_for, rewritten_record
from touchline.sources import bronze, tables
from touchline.sources.registry import STAMP, load_schema, record_fields

# Physical layout of the silver tables.
PARTITIONED = {"element_summary": ["round"]}
CLUSTERED = {"element_summary": ["element"], "fixtures": ["team_h", "team_a"], "players": ["team"]}
SILVER_TABLES = (*bronze.BOOTSTRAP_ARRAYS, "fixtures", "element_summary")


Reader = Callable[[SparkSession, str, str, str], DataFrame]


def run_records(
    spark: SparkSession,
    bronze_root: str,
    run: str,
    table: str,
    read: Reader = bronze.read_documents,
) -> DataFrame:
    """The raw records of one silver table in one run."""
    if table in bronze.BOOTSTRAP_ARRAYS:
        return bronze.bootstrap_records(read(spark, bronze_root, bronze.BOOTSTRAP, run), table)
    if table == "fixtures":
        return bronze.array_records(read(spark, bronze_root, bronze.FIXTURES, run))
    if table == "element_summary":
        return bronze.history_records(read(spark, bronze_root, bronze.SUMMARIES, run))
    raise ValueError(f"unknown silver table {table!r}")


def silver_rows(records: DataFrame, table: str, schema: T.StructType, loaded_at) -> DataFrame:
    """Conformed rows plus the load stamp; other columns of ``records`` follow."""
    rows = conform(records, record_fields(schema), rewrites_for(table))
    stamp_type = schema[STAMP].dataType if STAMP in schema.names else T.TimestampType()
    rows = rows.withColumn(STAMP, loaded_at.cast(stamp_type))
    named = _stamped(schema)
    return rows.select(*named, *[c for c in rows.columns if c not in named])


def _stamped(schema):
    return schema.names if STAMP in schema.names else [*schema.names, STAMP]


def quarantine_path(root: str, table: str, run: str) -> str:
    return f"{root}/table={table}/run_timestamp={quote(run, safe='')}"


def write_quarantine(payload: DataFrame, root: str, table: str, run: str) -> None:
    """Write the dead letters of a table and run, in few files, in place of any earlier ones.

    So a repeated run leaves each letter once, and one without drift leaves none. ``raw_record`` is
    nested JSON; a record that is no JSON value with distinct keys stays as text. Nothing is written
    where there is no letter and never was one.
    """
    path = quarantine_path(root, table, run)
    if payload.isEmpty() and not _is_written(payload.sparkSession, path):
        return
    nested = F.coalesce(F.try_parse_json("raw_record"), F.col("raw_record").cast("variant"))
    letters = payload.withColumn("raw_record", nested).drop("table", "run_timestamp")
    letters.hint("rebalance").write.mode("overwrite").json(path)


def _is_written(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def load_table(
    spark: SparkSession,
    records: DataFrame,
    table: str,
    schema: T.StructType,
    run: str,
    db: str,
    quarantine_root: str,
    show: bool = True,
) -> bool:
    """Load ``table`` and quarantine its drifting records; False when there were no records.

    Without ``show`` only the quarantine is written. A step that fails removes the new load.

    Bronze is parsed once: the stored load also carries the drift and, for drifting records only,
    their text. The quarantine is filled from there, and the table's view leaves both out.
    """
    now = _now()
    marked = (
        with_drift(records, [f.name for f in record_fields(schema)])
        .withColumn("_raw", F.when(F.col("drift").isNotNull(), F.col("record")))
        .withColumnRenamed("drift", "_drift")
    )
    load = tables.write_load(
        spark,
        silver_rows(marked, table, schema, now),
        db,
        table,
        partition_by=PARTITIONED.get(table, ()),
        cluster_by=CLUSTERED.get(table, ()),
    )
    try:
        raw = F.col("_raw")
        rewritten = F.when(F.try_parse_json(raw).isNull(), raw).otherwise(rewritten_record(table, raw))
        drifting = spark.table(f"`{db}`.`{load}`").where(raw.isNotNull()).select(
            rewritten.alias("record"), F.col("_drift").alias("drift")
        )
        write_quarantine(quarantine_payload(drifting, table, run, now), quarantine_root, table, run)
        if tables.discard_if_empty(spark, db, load):
            return False
        if show:
            properties = {"run_timestamp": run}
            tables.publish(spark, db, table, load, columns=_stamped(schema), properties=properties)
        else:
            tables.drop_load(spark, db, load)
    except Exception:
        if tables.view_property(spark, db, table, "load_table") != load:
            tables.drop_load(spark, db, load)
        raise
    return True


def load_run(
    spark: SparkSession,
    run: str,
    *,
    bronze_root: str,
    registry_root: str,
    quarantine_root: str,
    db: str = "silver",
    read: Reader = bronze.read_documents,
    show: bool = True,
) -> Mapping[str, bool]:
    """Load every silver table of one run; tells which had records. ``show=False``: dead letters only."""
    if not run:
        raise ValueError("run_timestamp is missing")
    schemas = {table: load_schema(spark, registry_root, table) for table in SILVER_TABLES}
    # The bootstrap document is parsed once, for all of its tables.
    tagged = bronze.tagged_records(read(spark, bronze_root, bronze.BOOTSTRAP, run))
    split = tables.write_load(spark, tagged, db, "bootstrap_records", partition_by=["table"])
    try:
        return {
            table: load_table(
                spark,
                spark.table(f"`{db}`.`{split}`").where(F.col("table") == table).select("record")
                if table in bronze.BOOTSTRAP_ARRAYS
                else run_records(spark, bronze_root, run, table, read),
                table,
                schema,
                run,
                db,
                quarantine_root,
                show,
            )
            for table, schema in schemas.items()
        }
    finally:
        tables.drop_load(spark, db, split)


def load_player_history(
    spark: SparkSession,
    run: str,
    *,
    bronze_root: str,
    registry_root: str,
    db: str = "silver",
    read: Reader = bronze.read_documents,
) -> bool:
    """Backfill ``player_history`` with every player's history rows and the owning player's id.

    This table has no quarantine: a field outside the schema fails the load.
    """
    if not run:
        raise ValueError("run_timestamp is missing")
    schema = load_schema(spark, registry_root, "player_history")
    own = T.StructType([f for f in schema.fields if f.name != "player_id"])
    documents = read(spark, bronze_root, bronze.SUMMARIES, run)
    records = bronze.history_records(documents, player_id="element_id")
    checked = with_drift(records, [f.name for f in record_fields(own)]).select(
        "player_id",
        F.when(F.col("drift").isNull(), F.col("record"))
        .otherwise(F.raise_error(F.concat(F.lit("unexpected fields: "), F.array_join("drift.new_fields", ","))))
        .alias("record"),
    )
    rows = silver_rows(checked, "player_history", own, _now())
    load = tables.write_load(spark, rows, db, "player_history")
    if tables.discard_if_empty(spark, db, load):
        return False
    tables.publish(
        spark, db, "player_history", load, columns=_stamped(schema), properties={"run_timestamp": run}
    )
    return True


def missing_summaries(
    spark: SparkSession, bronze_root: str, run: str, read: Reader = bronze.read_documents
) -> DataFrame:
    """Players the bootstrap document names whose summary did not land in the run."""
    expected = bronze.element_ids(read(spark, bronze_root, bronze.BOOTSTRAP, run))
    landed = bronze.landed_ids(read(spark, bronze_root, bronze.SUMMARIES, run))
    return missing_snapshots(expected, landed, ["element_id"])


def _now():
    """One fixed instant for a whole load, also across the jobs it runs."""
    return F.lit(datetime.now(timezone.utc))
