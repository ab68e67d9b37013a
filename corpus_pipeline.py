"""Corpus pipeline: toxicity, quality, near duplicates, benchmark contamination, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline.llm import bpe, decontaminate, jaccard, quality, toxicity
from touchline.llm.shared import remainder, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None


def _keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a key ``_row`` each, and the same for an operator, with the key as ``doc_id``.

    Decisions are about rows: ids may be NULL or repeat with other texts. A stage reads files, and the
    key is a row's place in them, the same at every reading.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), *COLUMNS)
    return rows, rows.select(F.col("_row").alias("doc_id"), *COLUMNS[1:])


def _keys(judged: DataFrame) -> DataFrame:
    """The different ``doc_id`` of a stored table as ``_row``.

    They are broadcast below a checked number, so that texts are not shuffled; else joined.
    """
    keys = judged.select(F.col("doc_id").alias("_row")).distinct()
    return F.broadcast(keys) if judged.count() <= jaccard.BROADCAST_IDS else keys


def _without(rows: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows whose key is not a ``doc_id`` of ``rejected``, a stored table."""
    return rows.join(_keys(rejected), "_row", "left_anti").select(COLUMNS)


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic. Labels are learned as in the query, from remainder 1 to 4."""
    labels = table(spark, sf_dir, "labels").filter(remainder(F.col("doc_id"), 5) != 0)
    model = toxicity.train(docs, labels)
    rows, judged = _keyed(docs)
    return _without(rows, stored(toxicity.score(judged, model).filter("predicted = 1").select("doc_id"), "toxic"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    rows, judged = _keyed(docs)
    return _without(rows, stored(quality.rate(judged).filter("not kept").select("doc_id"), "poor"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each group of near duplicates.

    Rows without an id are compared as all others, and come last in a group. Texts without a word are
    near copies of nothing: of these only rows that repeat an id and its text go.
    """
    rows, judged = _keyed(docs)
    found = stored(jaccard.near_duplicates(judged), "groups")
    ids = rows.select(F.col("_row").alias("doc_id"), F.col("doc_id").alias("_id"))
    grouped = stored(found.filter("n_shingles > 0").join(ids, "doc_id"), "grouped")
    rank = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("doc_id").alias("row"))
    first = grouped.groupBy("component_id").agg(F.min(rank)["row"].alias("_first"))
    copies = grouped.join(first, "component_id").filter("doc_id != _first").select("doc_id")
    blank = _keys(found.filter("n_shingles = 0"))
    blank = stored(rows.filter("doc_id is not null").join(blank, "_row", "left_semi").select("_row", "doc_id", "text"), "blank")
    lowest = blank.groupBy("doc_id", "text").agg(F.min("_row").alias("_row")).select("_row")
    repeated = blank.join(lowest, "_row", "left_anti").select(F.col("_row").alias("doc_id"))
    return _without(rows, stored(copies.unionAll(repeated), "copies"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    rows, judged = _keyed(docs)
    pairs = decontaminate.contaminated(judged, table(spark, sf_dir, "benchmark"))
    return _without(rows, stored(pairs.select("doc_id"), "contaminated"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return bpe.encode_documents(docs, bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("toxicity", keep_civil),
    ("quality rules", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
