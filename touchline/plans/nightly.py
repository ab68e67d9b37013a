"""The whole refresh for one landed run: silver, quarantine, gold.

    spark-submit --py-files touchline.zip touchline/plans/nightly.py \
        --run 2025-08-15T03:00:00Z --bronze <dir> --registry <dir> --quarantine <dir> \
        [--layout lines|files] [--as-of <time>] [--backfill]

``--backfill`` loads ``player_history`` instead.
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Mapping

from pyspark.sql import SparkSession

from touchline.plans.gold import build_gold
from touchline.plans.load import Reader, load_player_history, load_run, missing_summaries
from touchline.sources import bronze

LAYOUTS = {"lines": bronze.read_documents, "files": bronze.read_files}

MISSING_SHOWN = 20

log = logging.getLogger(__name__)


def refresh(
    spark: SparkSession,
    run: str,
    *,
    bronze_root: str,
    registry_root: str,
    quarantine_root: str,
    silver_db: str = "silver",
    gold_db: str = "gold",
    as_of=None,
    read: Reader = bronze.read_documents,
) -> Mapping[str, bool]:
    """Load ``run`` and rebuild gold. Any failure stops before the next stage."""
    replaced = load_run(
        spark,
        run,
        bronze_root=bronze_root,
        registry_root=registry_root,
        quarantine_root=quarantine_root,
        db=silver_db,
        read=read,
    )
    for table, done in replaced.items():
        if not done:
            log.warning("no records for %s in run %s: kept the old contents", table, run)
    missing = missing_summaries(spark, bronze_root, run, read)
    shown = [r["element_id"] for r in missing.orderBy("element_id").limit(MISSING_SHOWN).collect()]
    if shown:
        log.warning("%d players of run %s have no summary, first ids %s", missing.count(), run, shown)
    build_gold(spark, silver_db=silver_db, gold_db=gold_db, as_of=as_of)
    return replaced


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Refresh silver and gold from one landed run.")
    parser.add_argument("--run", required=True)
    for root in ("bronze", "registry", "quarantine"):
        parser.add_argument(f"--{root}", required=True, dest=f"{root}_root")
    parser.add_argument("--silver-db", default="silver")
    parser.add_argument("--gold-db", default="gold")
    parser.add_argument("--layout", choices=sorted(LAYOUTS), default="lines")
    parser.add_argument("--as-of", default=None)
    parser.add_argument("--backfill", action="store_true")
    options = vars(parser.parse_args(arguments))
    spark, run, read = SparkSession.builder.getOrCreate(), options.pop("run"), LAYOUTS[options.pop("layout")]
    if options.pop("backfill"):
        roots = {k: options[k] for k in ("bronze_root", "registry_root")}
        load_player_history(spark, run, **roots, db=options["silver_db"], read=read)
    else:
        refresh(spark, run, read=read, **options)


if __name__ == "__main__":
    main()
