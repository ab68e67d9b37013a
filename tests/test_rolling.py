import random

import pytest
from pyspark.sql import Window, functions as F

from touchline.operators.keyed import first_n_per_key, first_per_key
from touchline.operators.rolling import _cuts, rolling_rows

STATS = {
    "total": lambda w: F.sum("v").over(w),
    "rows": lambda w: F.count(F.lit(1)).over(w),
    "lowest": lambda w: F.min("v").over(w),
}


def rows(seed):
    """One key with most rows, single-row keys, a NULL key, and a block with many rows."""
    rng = random.Random(seed)
    made = []
    for i in range(400):
        key = None if i % 50 == 0 else (1 if i % 3 else rng.randint(2, 30))
        block = rng.choice([1, 1, 1, 2, 3, 5, 8, 13, 21, None])
        made.append((key, block, i, rng.randint(-5, 5) if i % 7 else None))
    return made


def plain(df, keys, order, n):
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(1 - n, 0)
    return df.select("*", *[stat(w).alias(name) for name, stat in STATS.items()])


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("n", [1, 2, 5])
@pytest.mark.parametrize("pieces", [1, 7, 60, 2000])
def test_pieces_give_the_plain_window(spark, seed, n, pieces):
    df = spark.createDataFrame(rows(seed), "k int, b int, i int, v int")
    split = rolling_rows(df, ["k"], ["b", "i"], n, STATS, pieces=pieces)
    expected = plain(df, ["k"], ["b", "i"], n)
    assert split.dtypes == expected.dtypes
    assert sorted(map(repr, split.collect())) == sorted(map(repr, expected.collect()))


def test_empty_and_two_keys(spark):
    df = spark.createDataFrame([(i % 2, None if i % 5 else i % 3, i, 1) for i in range(90)], "a int, k int, i int, v int")
    split = rolling_rows(df, ["a", "k"], ["i"], 4, STATS, pieces=12)
    assert sorted(map(repr, split.collect())) == sorted(map(repr, plain(df, ["a", "k"], ["i"], 4).collect()))
    assert rolling_rows(df.limit(0), ["k"], ["i"], 4, STATS).count() == 0


def test_cuts_of_a_key_follow_its_share(spark):
    """Two thirds of the rows on one key, kickoffs all different and unevenly spread."""
    df = spark.range(60_000).selectExpr("if(id % 3 = 0, id, -1) AS k", "pow(id, 3) AS t")
    cuts = {r.k: r._cuts for r in _cuts(df, ["k"], ["t"], 64).collect()}
    assert 32 <= len(cuts[-1]) <= 56 and sum(map(len, cuts.values())) <= 90
    ends = [0, *sorted(round(c.t ** (1 / 3)) for c in cuts[-1]), 60_000]
    sizes = [b - a for a, b in zip(ends, ends[1:], strict=False)]
    assert max(sizes) <= 3 * sorted(sizes)[len(sizes) // 2]


def test_no_task_holds_a_hot_key(spark):
    """One key has a third of the rows, all with different times: no task has over twice the median."""
    df = spark.range(200_000).selectExpr("if(id % 3 = 0, -1, id % 5000) AS k", "id AS t", "1 AS v")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rolled = rolling_rows(df, ["k"], ["t"], 5, {**STATS, "task": lambda w: F.spark_partition_id()})
        sizes = [r["count"] for r in rolled.groupBy("task").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    sizes = sorted(sizes, reverse=True)[: int(spark.conf.get("spark.sql.shuffle.partitions"))]
    assert sum(sizes) > 190_000 and sizes[0] <= 2 * sizes[len(sizes) // 2]


def test_first_rows(spark):
    df = spark.createDataFrame([(1, 3), (1, 1), (1, 2), (2, 9), (None, 4)], "k int, o int")
    top = first_n_per_key(df, ["k"], [F.col("o")], 2)
    assert sorted((r.k or 0, r.o, r.rn) for r in top.collect()) == [
        (0, 4, 1), (1, 1, 1), (1, 2, 2), (2, 9, 1),
    ]
    last = first_per_key(df, ["k"], [F.col("o").desc()])
    assert sorted((r.k or 0, r.o) for r in last.collect()) == [(0, 4), (1, 3), (2, 9)]
