"""Incremental loading: follow landed runs and refresh silver with each.

    spark-submit --py-files touchline.zip touchline/streaming/runs.py \
        --bronze <dir> --registry <dir> --quarantine <dir> \
        [--layout lines|files] [--checkpoint <dir>] [--unannounced]

``--unannounced`` finds runs by their files instead of by the marks of ``announce_run``.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline.plans.load import SILVER_TABLES, Reader, load_run, missing_summaries
from touchline.plans.nightly import LAYOUTS
from touchline.sources import bronze, tables
from touchline.sources.bronze import RUNS

log = logging.getLogger(__name__)


def follow_runs(
    spark: SparkSession,
    *,
    bronze_root: str,
    registry_root: str,
    quarantine_root: str,
    checkpoint: str | None = None,
    db: str = "silver",
    trigger: dict | None = None,
    read: Reader = bronze.read_documents,
) -> StreamingQuery:
    """Start the loader. By default it handles all runs announced so far and stops.

    The stream reads the marks written by ``announce_run``, which follow a complete snapshot, so a
    run is never loaded in part whatever the number of its files. The runs of a batch are loaded one
    after the other, oldest first; of a run older than what silver holds only the dead letters are
    written. A repeated batch after a failure loads the same runs again, with the same result. Progress is kept in ``checkpoint``, by
    default a folder below the session's ``spark.checkpoint.dir``.
    """
    checkpoint = checkpoint or f"{spark.conf.get('spark.checkpoint.dir')}/follow_runs/{db}"

    def load_runs(batch: DataFrame, _: int) -> None:
        # One row per announced run, not per document.
        announced = batch.filter("run_timestamp != ''").select("run_timestamp").distinct().collect()
        for run in sorted(row["run_timestamp"] for row in announced):
            load_run(
                spark,
                run,
                bronze_root=bronze_root,
                registry_root=registry_root,
                quarantine_root=quarantine_root,
                db=db,
                read=read,
                show=run >= loaded_run(spark, db),
            )

    marks = spark.readStream.schema("run_timestamp string").json(f"{bronze_root}/{RUNS}")
    return (
        marks.writeStream.foreachBatch(load_runs)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def load_landed(
    spark: SparkSession,
    *,
    bronze_root: str,
    registry_root: str,
    quarantine_root: str,
    db: str = "silver",
    read: Reader = bronze.read_documents,
) -> list[str]:
    """Load the landed runs that are newer than what silver holds, oldest first, and return them.

    For landings without marks: runs are found by their files. The newest may still be landing, so it
    waits until every player it names has a summary, or until a newer run follows it.
    """
    fresh = bronze.landed_runs(spark, bronze_root).filter(F.col("run_timestamp") > loaded_run(spark, db))
    # One row per run, not per document.
    runs = sorted(row["run_timestamp"] for row in fresh.collect())
    if runs and not missing_summaries(spark, bronze_root, runs[-1], read).isEmpty():
        log.warning("run %s has players without a summary: left for later", runs.pop())
    for run in runs:
        load_run(
            spark,
            run,
            bronze_root=bronze_root,
            registry_root=registry_root,
            quarantine_root=quarantine_root,
            db=db,
            read=read,
        )
    return runs


def loaded_run(spark: SparkSession, db: str) -> str:
    """The newest run any silver table was refreshed from; empty before the first load."""
    runs = [tables.view_property(spark, db, t, "run_timestamp") for t in SILVER_TABLES]
    return max((r for r in runs if r), default="")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Load the runs that have landed since the last call.")
    for root in ("bronze", "registry", "quarantine"):
        parser.add_argument(f"--{root}", required=True, dest=f"{root}_root")
    parser.add_argument("--silver-db", default="silver", dest="db")
    parser.add_argument("--layout", choices=sorted(LAYOUTS), default="lines")
    parser.add_argument("--checkpoint", default=None)
    parser.add_argument("--unannounced", action="store_true")
    options = vars(parser.parse_args(arguments))
    spark, read, checkpoint = SparkSession.builder.getOrCreate(), LAYOUTS[options.pop("layout")], options.pop("checkpoint")
    if options.pop("unannounced"):
        load_landed(spark, read=read, **options)
    else:
        follow_runs(spark, read=read, checkpoint=checkpoint, **options).awaitTermination()


if __name__ == "__main__":
    main()
