"""Which expected documents did not land."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def missing_snapshots(expected: DataFrame, landed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``expected`` without a landed counterpart.

    Landed ids are reduced to one row each before the join: that combines on the map side, so an id
    that landed over and over does not pile up in one join task.
    """
    return expected.join(landed.select(*on).distinct(), list(on), "left_anti")
