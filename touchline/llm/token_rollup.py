"""Token totals by source, language and tokenizer version, kept up to date by signed deltas."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline.llm import words
from touchline.llm.shared import in_pieces, send, ship, text_bytes, unpack

KEYS = ["source", "lang", "tokenizer"]
WORDS = "words_v1"
PIECE = 4_000_000
TOTALS = "source string, lang string, tokenizer string, documents long, tokens long"


def without_repeats(text: str) -> str:
    """The text without lines that equal an earlier line of it."""
    lines = text.split("\n")
    return "\n".join(dict.fromkeys(lines)) if len(set(lines)) < len(lines) else text


def count_tokens(docs: DataFrame, bpe_name: str, pattern: str, ranks: dict[bytes, int]) -> DataFrame:
    """Tokens of every whole text under two tokenizer versions: ``bpe_name`` and plain words.

    One row per input row and version: ``doc_id, source, lang, tokenizer, tokens, revised, text_hash``.
    ``revised`` is the count once repeated lines are gone. A NULL text has no tokens.
    """
    sent = send(docs.sparkSession, (pattern, ranks))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, ranks = unpack(sent)
        encoding = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for batch in in_pieces(batches, PIECE):
            column = batch.column(1)
            texts = [t or "" for t in column.to_pylist()]
            cleaned = [without_repeats(t) for t in texts]
            plain = [len(encoding.encode_ordinary(t)) for t in texts]
            clean = [
                n if t is c or t == c else len(encoding.encode_ordinary(c))
                for n, t, c in zip(plain, texts, cleaned, strict=True)
            ]
            data, offsets = text_bytes(column)
            plain_words = words.segments(data, offsets, words.SPACE)[0].counts()
            clean_words = words.segments(*text_bytes(pa.array(cleaned, pa.string())), words.SPACE)[0].counts()
            whole, _ = words.segments(data, offsets, np.zeros(256, bool))
            text_hash = np.zeros(len(batch), np.int64)
            text_hash[whole.owner()] = whole.hash.view(np.int64)
            for name, n, m in ((bpe_name, plain, clean), (WORDS, plain_words, clean_words)):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(2),
                        batch.column(3),
                        pa.array([name] * len(batch), pa.string()),
                        pa.array(np.asarray(n, np.int64)),
                        pa.array(np.asarray(m, np.int64)),
                        pa.array(text_hash),
                    ],
                    ["doc_id", "source", "lang", "tokenizer", "tokens", "revised", "text_hash"],
                )

    return docs.select("doc_id", "text", "source", "lang").mapInArrow(
        count,
        "doc_id long, source string, lang string, tokenizer string, tokens long, revised long, text_hash long",
    )


def _signed(rows: DataFrame, sign: int, tokens: str) -> DataFrame:
    return rows.select(*KEYS, F.lit(sign).cast("long").alias("documents"), (sign * F.col(tokens)).alias("tokens"))


def inserts(rows: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Deltas of new counts: rows of the keys and a count."""
    return _signed(rows, 1, tokens)


def deletes(rows: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Deltas that take counts back: what was inserted, with its sign turned."""
    return _signed(rows, -1, tokens)


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Deltas of revised counts: the old ones go, the new ones come, perhaps under other keys."""
    return deletes(before).unionAll(inserts(after))


class Rollup:
    """Additive totals under ``root``, one folder per committed batch of deltas.

    A batch is summed by key before it is written, so its folder has as many rows as there are keys.
    It counts once it is complete; committing a batch id again changes nothing, so a retry after a
    failure or a lost reply is safe, and one that died half-way is written anew. The first content
    committed under an id stands.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def _exists(self, path: str) -> bool:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def committed(self) -> list[str]:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(self.root)
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(where):
            return []
        names = [s.getPath().getName() for s in files.listStatus(where) if s.isDirectory()]
        return sorted(n for n in names if self._exists(f"{self.root}/{n}/_SUCCESS"))

    def commit(self, batch_id: str, deltas: DataFrame) -> bool:
        """Add a batch; false if it had been committed before."""
        if self._exists(f"{self.root}/{batch_id}/_SUCCESS"):
            return False
        summed = deltas.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        summed.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{batch_id}")
        return True

    def totals(self) -> DataFrame:
        """Documents and tokens by key; keys whose documents are all gone are left out."""
        paths = [f"{self.root}/{b}" for b in self.committed()]
        rows = self.spark.read.schema(TOTALS).parquet(*paths) if paths else self.spark.createDataFrame([], TOTALS)
        summed = rows.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return summed.filter("documents != 0 or tokens != 0")


def copies(rows: DataFrame) -> Column:
    """Marks rows whose text equals that of a row with a smaller id (see ``first_ids``)."""
    return F.col("doc_id") > F.col("first_id")


def with_first_ids(rows: DataFrame) -> DataFrame:
    """``first_id``: the smallest id with the same text."""
    first = rows.groupBy("text_hash").agg(F.min("doc_id").alias("first_id"))
    return rows.join(first, "text_hash", "left")


ship(__name__)
