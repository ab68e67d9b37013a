"""What each filter of a set removes under every order of applying them.

A document's failures are one bit each of a mask. All orders are judged on the counts of (part, mask)
cells alone: a cell folds across the array of orders, which gives a struct for every step of every
order, and the cells of a part are merged by adding their arrays element by element. A part has at
most 2**5 cells, so the merge is bounded whatever the number of documents.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
MIN_WORDS = 200
SPACES = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows without an id are spread over so many groups in the join with the labels.
SALTS = 256


def own_failures(text: Column) -> Column:
    """Mask of the filters A to D, which judge a text by itself."""
    found = F.filter(F.split(text, SPACES), lambda w: w != "")
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    fails = [
        F.size(found) < MIN_WORDS,
        100 * F.size(F.array_distinct(found)) < 50 * F.size(found),
        100 * capitals > 3 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]
    return reduce(Column.bitwiseOR, [F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)])


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by ``lang`` and failed filters.

    Equal rows are counted before anything is shuffled, a text stands as its SHA-256, and only the
    first id of each text travels, so neither a common text nor a common id is a hot key.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        F.coalesce("lang", F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("text_hash"),
        own_failures(text).alias("mask"),
    )
    rows = rows.groupBy("text_hash", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    first = rows.groupBy("text_hash").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marked = rows.join(first, ["text_hash", "doc_id"], "left").select(
        "doc_id",
        "part",
        F.when(F.col("first") | F.col("doc_id").isNull(), F.col("mask"))
        .otherwise(F.col("mask").bitwiseOR(F.lit(1 << FILTERS.index("E"))))
        .alias("mask"),
        "n",
        F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text_hash"), F.lit(SALTS))).otherwise(F.lit(0)).alias("salt"),
    )
    marked = marked.groupBy("doc_id", "salt", "part", "mask").agg(F.sum("n").alias("n"))
    judged = (
        labels.filter("doc_id is not null and (quality = 1 or toxic = 1)")
        .groupBy("doc_id")
        .agg(F.max(F.expr("quality <=> 1")).alias("is_good"), F.max(F.expr("toxic <=> 1")).alias("is_toxic"))
        .withColumn("salt", F.lit(0).cast("long"))
    )
    return (
        marked.join(judged, ["doc_id", "salt"], "left")
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("is_good"), F.col("n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("is_toxic"), F.col("n")).otherwise(0)).alias("toxic"),
        )
    )


def _steps(order: Column) -> Column:
    """A struct of counts for each step of one order, for the cell of the row."""
    n, good, toxic, mask = (F.col(c) for c in ("n", "good", "toxic", "mask"))
    count = lambda when, what=n: F.when(when, what).otherwise(F.lit(0).cast("long"))

    def step(done: Column, bit: Column) -> Column:
        fails = mask.bitwiseAND(bit) != 0
        alive = mask.bitwiseAND(done["before"]) == 0
        removed = fails & alive
        counts = F.struct(
            count(alive & ~fails).alias("kept"),
            count(removed).alias("removed"),
            count(fails & ~alive).alias("redundant"),
            count(mask == bit).alias("unique_fails"),
            count(removed, good).alias("good_lost"),
            count(removed, toxic).alias("toxic_lost"),
        )
        return F.struct(
            done["before"].bitwiseOR(bit).alias("before"), F.concat(done["steps"], F.array(counts)).alias("steps")
        )

    kind = f"array<struct<{','.join(f'{c}:bigint' for c in COUNTS)}>>"
    start = F.struct(F.lit(0).alias("before"), F.array().cast(kind).alias("steps"))
    return F.aggregate(order, start, step, lambda done: done["steps"])


def _added(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct(*[(x[c] + y[c]).alias(c) for c in COUNTS]))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of each filter at each step of all 120 orders, per value of ``lang``.

    A: under 200 words. B: under 50 % different words. C: over 3 % capitals. D: holds one of
    ``#$%&*|``. E: identical to the text of a smaller ``doc_id``. NULL texts are empty; a NULL
    ``lang`` and an empty one are the same part. A row without an id fails E never, and makes no other
    row fail it; rows that repeat an id and a text are counted each. A document is good (toxic) if one
    of its labels says so. ``shapley`` adds up what its filter removes over all orders. An empty table
    gives no rows; very long texts are judged whole; other columns are not read.
    """
    orders = F.array(*[F.array(*[F.lit(1 << FILTERS.index(f)) for f in o]) for o in ORDERS])
    folded = cells(docs, labels).select("part", F.flatten(F.transform(orders, _steps)).alias("steps"))
    merged = folded.groupBy("part").agg(F.collect_list("steps").alias("cells"))
    total = F.aggregate(F.slice("cells", 2, 1 << len(FILTERS)), F.element_at("cells", 1), _added)
    names = F.array(*[F.lit(o) for o in ORDERS])
    width = len(FILTERS)
    rows = merged.select("part", total.alias("steps")).select("part", F.posexplode("steps").alias("at", "s"), "steps")
    rows = rows.select(
        "part",
        F.element_at(names, F.floor(F.col("at") / width).cast("int") + 1).alias("filter_order"),
        (F.col("at") % width + 1).alias("step"),
        "s",
    )
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    removed = rows.groupBy("part", letter.alias("letter")).agg(F.sum("s.removed").alias("shapley"))
    return (
        rows.withColumn("letter", letter)
        .join(removed, ["part", "letter"])
        .select("part", "filter_order", "step", *[F.col(f"s.{c}").alias(c) for c in COUNTS], "shapley")
    )
