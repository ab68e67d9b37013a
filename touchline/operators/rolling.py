"""Row-frame statistics per key, safe for keys that hold a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

Stats = Mapping[str, Callable[[WindowSpec], Column]]

#: Pieces per shuffle partition, and sampled rows per piece.
PIECES, SAMPLED = 8, 8


def rolling_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, stats: Stats, *, pieces: int | None = None
) -> DataFrame:
    """Every row of ``df`` plus ``stats`` over the current and the ``rows - 1`` preceding rows.

    ``order`` lists ascending columns and must be total within a key. NULL keys are a key as others,
    NULLs in the order come first. The result is that of one window per key, but no task gets a whole
    key: all rows, in the order of key and ``order``, are cut at ``pieces`` places (eight per shuffle
    partition by default) that an even sample of rows gives, so a key is cut in proportion to its
    rows, and windows run per key and block between cuts.

    The last ``rows - 1`` rows of a block are handed over to what follows: only the first and last rows
    of blocks (at most ``2 * rows * pieces`` rows in all) are windowed by key, for the rows that open a
    block. The cuts depend on nothing but the rows, so retries and second readings agree.
    """
    spark = df.sparkSession
    pieces = pieces or PIECES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = df.columns
    cuts = _cuts(df, keys, order, pieces)
    same_key = [F.col(f"d.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    place = F.struct(*[F.col(f"d.{c}") for c in order])
    # One shuffle of the rows; the windows below all read it.
    dealt = (
        df.alias("d")
        .join(F.broadcast(cuts.alias("c")), same_key, "left")
        .select("d.*", _passed(F.col("c._cuts"), place, pieces).alias("_block"))
        .repartition(*keys, "_block")
    )
    block = Window.partitionBy(*keys, "_block").orderBy(*order)
    numbered = dealt.withColumn("_rn", F.row_number().over(block)).withColumn(
        "_last", F.lead(F.lit(1), rows - 1).over(block).isNull() if rows > 1 else F.lit(False)
    )
    frame = lambda w: w.rowsBetween(1 - rows, 0)
    inner = numbered.select(*own, "_block", "_rn", *[stat(frame(block)).alias(name) for name, stat in stats.items()])
    opens = (F.col("_block") > 0) & (F.col("_rn") < rows)
    # One condition that names a column of the window: it stays above the shuffle, which is then shared.
    edges = numbered.where(F.when(F.col("_block").isNotNull(), (F.col("_rn") < rows) | F.col("_last")))
    along = Window.partitionBy(*keys).orderBy(*order)
    joints = edges.select(*own, "_block", "_rn", *[stat(frame(along)).alias(name) for name, stat in stats.items()])
    names = [*own, *stats]
    return inner.where(~F.coalesce(opens, F.lit(False))).select(names).unionByName(joints.where(opens).select(names))


def _cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], pieces: int) -> DataFrame:
    """Keys that are cut, each with the sorted places where its blocks begin: ``pieces`` places in all.

    About ``SAMPLED`` rows per piece, those of the lowest hashes, are put in order, and every
    ``SAMPLED``-th of them is a cut.
    """
    count = df.agg(F.greatest(F.count(F.lit(1)), F.lit(1))).scalar()
    share = F.pmod(F.xxhash64(*keys, *order), F.lit(1 << 40)) / float(1 << 40)
    sample = df.select(*keys, *order).where(share < F.lit(float(pieces * SAMPLED)) / count)
    in_order = Window.orderBy(*keys, *order)
    thinned = sample.withColumn("_at", F.row_number().over(in_order)).where(F.col("_at") % SAMPLED == 0)
    return thinned.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*order))).alias("_cuts"))


def _passed(cuts: Column, place: Column, pieces: int) -> Column:
    """How many of the sorted ``cuts`` are at or before ``place``, by halving; NULL for keys without cuts."""
    # The sample may hold somewhat more rows than asked for, never twice as many and 64.
    turns = F.array(*[F.lit(i) for i in range(math.ceil(math.log2(2 * pieces + 64)) + 1)])

    def halve(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        middle = F.floor((low + high) / 2).cast("int")
        before = F.get(cuts, middle) <= place
        return F.struct(
            F.when((low < high) & before, middle + 1).otherwise(low).alias("low"),
            F.when((low < high) & ~before, middle).otherwise(high).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high"))
    return F.when(cuts.isNotNull(), F.aggregate(turns, start, halve, lambda s: s["low"]))
