"""Shards that each carry the mixture of sources: proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from touchline.llm.shared import stored

SHARDS = 24
BUCKETS = 1024


def _offsets(counts: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Rows before each bucket within its key, and rows of the key, from counts per (key, bucket).

    There are at most BUCKETS rows per key here, whatever the number of documents.
    """
    ahead = W.partitionBy(*keys).orderBy(by).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*keys)
    return counts.select(
        *keys,
        by,
        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("of"),
    )


def _ranked(rows: DataFrame, keys: list[str], bucket: str, order: list[str]) -> DataFrame:
    """Rank from 0 within each key: within a bucket by a window, plus the rows of earlier buckets.

    No task holds more than one bucket of one key at a time, so a key with a third of all rows is
    sorted by ``BUCKETS`` tasks.
    """
    counts = rows.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(W.partitionBy(*keys, bucket).orderBy(*order)) - 1
    offsets = _offsets(counts, keys, bucket)
    ranked = rows.withColumn("_place", place.cast("long"))
    on = [ranked[k].eqNullSafe(offsets[k]) for k in [*keys, bucket]]
    joined = ranked.join(offsets, on, "left")
    return joined.select(
        *[ranked[c] for c in rows.columns],
        (F.col("_place") + F.col("before")).alias("rank"),
        F.col("of").alias("of"),
    )


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = 0, stratum: Column | None = None) -> DataFrame:
    """Assign every row to a shard so that shards differ by at most one row and share the mixture.

    Rows are shuffled by a seeded hash and ranked within their stratum (``source``; NULL is a stratum
    of its own). All rows are then put in the order of their fractional rank, (rank + 1/2) / rows of
    the stratum, and this order is cut into ``shards`` equal runs: each holds every stratum's share
    to within a row. ``slot`` counts from 0 within a shard. Ties are broken by the hash, the id and
    the text's checksum; rows equal in all of these are interchangeable. ``size`` is the UTF-8 length
    plus 8; a NULL text counts as empty. Other columns of the input are not read; fewer rows than
    shards leave shards empty, and an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    picked = docs.select(
        "doc_id",
        (stratum if stratum is not None else F.col("source")).alias("stratum"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    shuffled = stored(
        picked.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size")), "shuffled"
    ).withColumn("_bucket", F.shiftrightunsigned("_h", 54).cast("int"))
    order = ["_h", "doc_id", "text_crc32"]
    within = _ranked(shuffled, ["stratum"], "_bucket", order).drop("_bucket")
    # (2 rank + 1) / (2 of): the fraction as whole numbers, so that all engines order it alike.
    fraction = (2 * F.col("rank") + 1) / (2 * F.col("of"))
    mixed = within.withColumns(
        {"_f": fraction, "_part": F.floor(fraction * BUCKETS).cast("int"), "_all": F.lit(0)}
    ).drop("rank", "of")
    placed = _ranked(mixed, ["_all"], "_part", ["_f", *order])
    shard = F.expr(f"(rank * {shards}) div of").cast("int")
    first = F.expr(f"((rank * {shards} div of) * of + {shards} - 1) div {shards}")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        shard.alias("shard"),
        (F.col("rank") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("stratum").alias("source"),
    )
