"""First or last rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rn"
) -> DataFrame:
    """The first ``n`` rows of every key, with their rank.

    Written as ``row_number() <= n`` so that Spark plans a group limit before the shuffle: a task
    ships at most ``n`` rows per key, and a key holding a third of the input shuffles ``n`` rows
    per task. ``order`` must be total within a key for a repeatable answer.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return first_n_per_key(df, keys, order, 1, "_rank").drop("_rank")
