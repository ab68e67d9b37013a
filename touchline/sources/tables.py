"""Catalog tables with full-refresh loads.

``<db>.<table>`` is a view over the latest complete load. A refresh writes a new table next to it
and repoints the view when that write has finished, so a failed job leaves the old contents in
place and readers never see half a load. The view names its load and the one before it; these two
are kept, and publishing drops only the load before those, so refreshes that overlap leave each
other's loads alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F


def ensure_database(spark: SparkSession, db: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")


def lay_out(df: DataFrame, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()) -> DataFrame:
    """Arrange rows for writing: together by partition (or cluster) columns, sorted inside files.

    ``rebalance`` splits an oversized group over several tasks and merges small ones, so a hot
    value neither lands in one task nor scatters into tiny files.
    """
    together = list(partition_by) or list(cluster_by)
    if not together:
        return df
    placed = df.hint("rebalance", *[F.col(c) for c in together])
    return placed.sortWithinPartitions(*partition_by, *cluster_by)


def write_load(
    spark: SparkSession,
    df: DataFrame,
    db: str,
    table: str,
    *,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> str:
    """Write ``df`` as a new, not yet visible load of ``db.table``; returns its name."""
    ensure_database(spark, db)
    load = f"{table}__load_{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}"
    writer = lay_out(df, partition_by, cluster_by).write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(f"`{db}`.`{load}`")
    return load


def publish(
    spark: SparkSession,
    db: str,
    table: str,
    load: str,
    *,
    columns: Sequence[str] = (),
    properties: Mapping[str, str] | None = None,
) -> None:
    """Make ``load`` the contents of ``db.table`` (only ``columns``, if given)."""
    shown_before = view_property(spark, db, table, "load_table")
    older = view_property(spark, db, table, "previous_load")
    described = {"load_table": load, **(properties or {})}
    if shown_before and shown_before != load:
        described["previous_load"] = shown_before
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in described.items())
    shown = ", ".join(f"`{c}`" for c in columns) or "*"
    spark.sql(
        f"CREATE OR REPLACE VIEW `{db}`.`{table}` TBLPROPERTIES ({listed}) "
        f"AS SELECT {shown} FROM `{db}`.`{load}`"
    )
    if older and older not in (load, shown_before):
        drop_load(spark, db, older)


def drop_load(spark: SparkSession, db: str, load: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS `{db}`.`{load}`")


def discard_if_empty(spark: SparkSession, db: str, load: str) -> bool:
    """Drop a load without rows, so that the previous contents stay."""
    empty = spark.table(f"`{db}`.`{load}`").isEmpty()
    if empty:
        drop_load(spark, db, load)
    return empty


def replace(spark: SparkSession, df: DataFrame, db: str, table: str) -> None:
    """Replace the contents of ``db.table``, also by nothing."""
    publish(spark, db, table, write_load(spark, df, db, table))


def view_property(spark: SparkSession, db: str, table: str, key: str) -> str | None:
    """A property set by the last refresh, or None when there is no such table or property."""
    if not spark.catalog.tableExists(f"`{db}`.`{table}`"):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES `{db}`.`{table}`").collect()
    return {r["key"]: r["value"] for r in rows}.get(key)
