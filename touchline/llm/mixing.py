"""Mix sources to target weights: hash thresholds from histograms, refined where the budget ends.

Every row has a pseudo-random place in its source, the digits of a hash and then of a row number.
A source's budget ends somewhere in the order of places. A histogram of words by the first digit
finds the bucket that holds this threshold; only the rows of that bucket are counted by the next
digit, and so on until one row is left. Nothing is sorted; the mix is a filter by threshold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.llm.shared import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
WORD = r"[^\x20\x09-\x0D]+"
#: Digits of 12 bits: five of the hash, six of the row number.
BITS, HASH_DIGITS, ROW_DIGITS = 12, 5, 6
#: Tables of sources are broadcast up to so many rows and characters, else joined.
BROADCAST_ROWS, BROADCAST_CHARS = 50_000, 4_000_000


def sized(docs: DataFrame) -> DataFrame:
    """Stored rows ``doc_id, source, size, place, row`` without their texts; ``place`` has 60 bits."""
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    rows = docs.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long").alias("place"),
        F.monotonically_increasing_id().alias("row"),
    )
    return stored(rows, "sized")


def _numbered(sources: DataFrame) -> DataFrame:
    """``rank`` of each source by code point from 0, NULL last: by ranges, each numbered by itself."""
    key = [F.col("source").isNull(), F.col("source")]
    dealt = stored(
        sources.repartitionByRange(*key).withColumn("range", F.spark_partition_id()), "dealt"
    )
    each = dealt.withColumn("at", F.row_number().over(Window.partitionBy("range").orderBy(*key)) - 1)
    held = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    # One row for each partition of the range shuffle.
    before = held.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    return each.join(F.broadcast(before), "range").select(
        "source", "source_size", (F.col("before") + F.col("at")).alias("rank")
    )


def targets(rows: DataFrame) -> DataFrame:
    """``source, source_size, target``: shares of 150 % of all words by weight, at most twice a source.

    Weights 5, 2, 1 repeat over the sources by code point, NULL last. What a source cannot take is
    shared again among the others by weight until none is above its limit; every turn is one
    aggregation over the sources, of which only three totals reach the driver.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    shares = stored(_numbered(sources).withColumn("weight", weight), "shares")
    limit = MOST * F.col("source_size")
    budget = SHARE * (shares.agg(F.sum("source_size")).first()[0] or 0)
    rate, full = 0.0, -1
    while True:
        capped = limit <= rate * F.col("weight")
        found = shares.agg(
            F.count_if(capped).alias("full"),
            F.sum(F.when(capped, limit).otherwise(0)).alias("held"),
            F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("weights"),
        ).first()
        if found["full"] == full or not found["weights"]:
            break
        full, rate = found["full"], (budget - found["held"]) / found["weights"]
    target = F.least(limit.cast("double"), rate * F.col("weight"))
    return shares.select("source", "source_size", target.alias("target"))


def _by_source(rows: DataFrame, sources: DataFrame, how: str = "inner") -> DataFrame:
    """Join with a table of one row per source: broadcast below a checked size, else by shuffle."""
    n = sources.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("source")).alias("chars")).first()
    if n["n"] <= BROADCAST_ROWS and (n["chars"] or 0) <= BROADCAST_CHARS:
        sources = F.broadcast(sources)
    other = sources.withColumnRenamed("source", "_source")
    return rows.join(other, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def _digit(level: int) -> Column:
    if level < HASH_DIGITS:
        return F.shiftright("place", BITS * (HASH_DIGITS - 1 - level)).bitwiseAND(F.lit((1 << BITS) - 1))
    left = ROW_DIGITS - 1 - (level - HASH_DIGITS)
    return F.shiftright("row", BITS * left).bitwiseAND(F.lit((1 << BITS) - 1))


def thresholds(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per source the place where its budget ends: ``copies`` of all rows, and one more below the end.

    Budgets are nested: the first copy of all rows comes before any second one. ``end`` is an array of
    digits; a row is below if its own digits come before, and the row at the end itself is below if
    ``takes``, which is when taking it brings the words nearer to the target than leaving it.
    Sources whose budget ends between two rows, or that hold no words, have an end that no row is at.
    """
    size, target = F.col("source_size"), F.col("target")
    whole = (target >= size) & (size > 0)
    state = stored(
        wanted.select(
            "source",
            whole.cast("int").alias("copies"),
            F.when(whole, target - size).otherwise(target).alias("budget"),
            F.lit(0).cast("long").alias("before"),
            F.array().cast("array<bigint>").alias("end"),
            F.lit(False).alias("closed"),
            F.lit(False).alias("takes"),
        ),
        "state",
    )
    for level in range(HASH_DIGITS + ROW_DIGITS):
        here = [_digit(i) == F.get("end", F.lit(i)) for i in range(level)]
        inside = _by_source(rows.filter("size > 0"), state.filter("not closed").select("source", "budget", "before", "end"))
        counted = (
            inside.filter(reduce(Column.__and__, here, F.lit(True)))
            .groupBy("source", "budget", "before", _digit(level).alias("digit"))
            .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        )
        # At most 4,096 buckets of a source are in a window, whatever the number of its rows.
        along = Window.partitionBy("source").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        lower = F.col("before") + F.coalesce(F.sum("words").over(along), F.lit(0))
        bucket = counted.withColumn("lower", lower).filter(F.col("lower") + F.col("words") > F.col("budget"))
        first = bucket.groupBy("source").agg(F.min_by(F.struct("digit", "lower", "words", "n"), "digit").alias("b"))
        nearer = 2 * F.col("b.lower") + F.col("b.words") <= 2 * F.col("budget")
        single = F.col("b.n") == 1
        open_, closed = state.filter("not closed"), state.filter("closed")
        found = _by_source(open_, first, "left")
        state = stored(
            found.select(
                "source",
                "copies",
                "budget",
                F.coalesce("b.lower", "before").alias("before"),
                # Without a bucket the budget covers all rows of the prefix: an end after every digit.
                F.concat("end", F.array(F.coalesce("b.digit", F.lit(1 << BITS)))).alias("end"),
                (F.col("b").isNull() | single).alias("closed"),
                F.coalesce(single & nearer, F.lit(False)).alias("takes"),
            ).unionByName(closed),
            "state",
        )
        if state.filter("not closed").isEmpty():
            break
    return state


def mix(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row of (``doc_id``, ``text``, ``source``).

    ``taken`` is the row's words times the copies the mix takes of it, 0 to 2. A source's taken words
    differ from its target by half of one document at most. The place of a row depends on its id and
    text alone, so reruns agree; of rows equal in both it does not matter which are taken. NULL texts,
    empty ones and those without a word have size 0; a NULL source is a source of its own; NULL and
    repeated ids are rows as others, very long texts are taken whole or not at all; an empty table
    gives no rows; other columns are not read.
    """
    rows = sized(docs)
    wanted = stored(targets(rows), "targets")
    ends = thresholds(rows, wanted).select("source", "copies", "end", "takes")
    placed = _by_source(_by_source(rows, wanted), ends)
    below, equal = F.lit(False), F.lit(True)
    for level in range(HASH_DIGITS + ROW_DIGITS):
        digit, at = _digit(level), F.get("end", F.lit(level))
        below = below | (equal & at.isNotNull() & (digit < at))
        equal = equal & (at.isNull() | (digit == at))
    extra = F.when(below | (equal & F.col("takes")), 1).otherwise(0)
    return placed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * (F.col("copies") + extra)).alias("taken")
    )
