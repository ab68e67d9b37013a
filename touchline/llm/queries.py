"""One query per operator over its whole table."""

from __future__ import annotations

import base64
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline.llm import (
    alignment,
    bpe,
    decontaminate,
    filter_audit,
    jaccard,
    language,
    licences,
    lm_scoring,
    mixing,
    quality,
    sharding,
    token_rollup,
    toxicity,
)
from touchline.llm.oracles import ORACLES  # noqa: F401
from touchline.llm.shared import remainder, shared_folder, stored, table

BPE_NAME = "byte_bpe_50k"
PIECE_NAME = "piece_bpe_32k.model"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def read_ranks(name: str) -> dict[bytes, int]:
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@query
def op1_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return lm_scoring.score(docs, lm_scoring.train(docs, table(spark, sf_dir, "labels")))


@query
def op2_bpe(spark, sf_dir):
    vocabulary = bpe.read_vocabulary(public_tokenizers.path(f"{BPE_NAME}.json"))
    return bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary)


@query
def op3_decontamination(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_quality_rules(spark, sf_dir):
    return quality.rate(table(spark, sf_dir, "documents"))


@query
def op5_ngram_jaccard(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_token_counts(spark, sf_dir):
    """Load all documents, take out exact copies, revise counts for removed repeated lines, retry a batch."""
    ranks = read_ranks(BPE_NAME)
    docs = table(spark, sf_dir, "documents")
    counted = stored(token_rollup.count_tokens(docs, BPE_NAME, public_tokenizers.PATTERN, ranks), "counts")
    ledger = token_rollup.Rollup(spark, f"{shared_folder(spark)}/touchline-{uuid.uuid4().hex}/ledger")
    ledger.commit("1-load", token_rollup.inserts(counted))
    known = stored(token_rollup.with_first_ids(counted), "known")
    taken = token_rollup.deletes(known.filter(token_rollup.copies(known)))
    ledger.commit("2-copies", taken)
    left = known.filter(~F.coalesce(token_rollup.copies(known), F.lit(False)) & (F.col("tokens") != F.col("revised")))
    ledger.commit("3-lines", token_rollup.revisions(left, left.withColumn("tokens", F.col("revised"))))
    ledger.commit("2-copies", taken)
    return ledger.totals()


@query
def op7_licence_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return licences.scan(docs, licences.train(docs))


@query
def op8_sharding(spark, sf_dir):
    return sharding.interleave(table(spark, sf_dir, "documents"))


@query
def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = language.train(docs.filter(remainder(F.col("doc_id"), 4) != 2))
    return language.identify(docs, model, held_out).drop("cross_entropy")


@query
def op10_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    model = toxicity.train(docs, labels.filter(remainder(F.col("doc_id"), 5) != 0))
    return toxicity.score(docs, model, held_out)


@query
def op11_tokenizer_alignment(spark, sf_dir):
    pair = alignment.read_pair(public_tokenizers.path(f"{BPE_NAME}.json"), public_tokenizers.path(PIECE_NAME))
    return alignment.measure(table(spark, sf_dir, "documents"), pair)


@query
def op12_source_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
