"""Alignment of two tokenizations of each text, and how often the corpus links each pair of ids.

Both tokenizations of a text cover the same bytes, so each is a rising array of byte offsets where its
tokens end, and offsets in both arrays cut the text into groups. Most groups hold one token of each
side. Over such stretches the arrays are equal at the current index shift, and are compared there in
runs that double in length, back to one where they differ. Only the groups in between are walked token by token, which links
what overlaps and moves the shift.

Counts of pairs are kept as rows. Pairs that are common in the corpus, of which there can only be a
fixed number, are looked up by broadcast, all others by a join, so no pair is a hot key.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from touchline.llm.bpe import Encoder, Vocabulary, read_vocabulary
from touchline.llm.shared import in_pieces, send, ship, stored, text_bytes, unpack

PIECE = 1_000_000
#: A pair with more than this share of all links is looked up by broadcast: at most so many pairs have it.
COMMON_PAIRS = 1 << 18
FIRST_PROBE = 4
#: A linked pair is ``id of A * ids of B + id of B``.
PAIR_BITS = 31
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def aligned(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links and groups of two rising lists of ends with the same last end.

    Returns the index in ``a`` and in ``b`` of every link, and how many tokens of ``a`` and of ``b`` lie
    in or before each group, all in order.
    """
    i = j = 0
    n, m = len(a), len(b)
    runs: list[tuple[int, int, int]] = []  # stretches of groups of one token each: begins, length
    odd_a: list[int] = []
    odd_b: list[int] = []
    closes: list[tuple[int, int]] = []
    while i < n and j < m:
        if a[i] == b[j]:
            at, width = i, FIRST_PROBE
            while (probe := a[i : i + width]) and probe == b[j : j + width]:
                i, j, width = i + len(probe), j + len(probe), 2 * width
            while width > 1:
                width //= 2
                if (probe := a[i : i + width]) and probe == b[j : j + width]:
                    i, j = i + len(probe), j + len(probe)
            runs.append((at, at + j - i, i - at))
            continue
        while True:
            odd_a.append(i)
            odd_b.append(j)
            if a[i] < b[j]:
                i += 1
            elif a[i] > b[j]:
                j += 1
            else:
                i, j = i + 1, j + 1
                break
        closes.append((i, j))
    run, done = np.array(runs, np.int64).reshape(-1, 3), np.array(closes, np.int64).reshape(-1, 2)
    length = run[:, 2]
    step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    even_a, even_b = np.repeat(run[:, 0], length) + step, np.repeat(run[:, 1], length) + step
    link_a, link_b = np.concatenate([even_a, np.array(odd_a, np.int64)]), np.concatenate([even_b, np.array(odd_b, np.int64)])
    # Each next link is one further in a, in b or in both.
    order = np.argsort(link_a + link_b, kind="stable")
    ends_a, ends_b = np.concatenate([even_a + 1, done[:, 0]]), np.concatenate([even_b + 1, done[:, 1]])
    by_end = np.argsort(ends_a, kind="stable")
    return link_a[order], link_b[order], ends_a[by_end], ends_b[by_end]


@dataclass
class TokenizerPair:
    """A byte-level BPE vocabulary, a sentencepiece model, and the bytes of each of their ids."""

    vocabulary: Vocabulary
    piece_model: bytes
    bytes_a: list[bytes]
    bytes_b: list[bytes]


def read_pair(bpe_path: str, piece_path: str) -> TokenizerPair:
    """Both tokenizers, read on the driver; their size does not depend on the corpus.

    Special strings of the first are plain text here.
    """
    with open(piece_path, "rb") as f:
        model = f.read()
    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    single = [re.fullmatch("<0x([0-9A-F]{2})>", p) for p in pieces]
    bytes_b = [bytes.fromhex(x[1]) if x else p.replace("\u2581", " ").encode() for p, x in zip(pieces, single, strict=True)]
    vocabulary = read_vocabulary(bpe_path)
    if len(vocabulary.bytes_of) * len(pieces) >= 1 << 31:
        raise ValueError("vocabularies are too large for pairs of 31 bits")
    return TokenizerPair(replace(vocabulary, special={}), model, vocabulary.bytes_of, bytes_b)


class TokenBytes:
    """The bytes of all ids of a tokenizer, end to end."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def give_back(self, ids: np.ndarray, bounds: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Whether the ids of each text join to its bytes."""
        size = self.size[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        own = ends[bounds]
        same = np.diff(own) == np.diff(offsets)
        where = np.arange(ends[-1]) + np.repeat(self.first[ids] - ends[:-1], size)
        joined = self.data[where]
        if same.all():
            wrong = np.flatnonzero(joined != data)
            same[np.searchsorted(offsets, wrong, "right") - 1] = False
        else:
            for i in np.flatnonzero(same):
                same[i] = np.array_equal(joined[own[i] : own[i + 1]], data[offsets[i] : offsets[i + 1]])
        return same


class Aligner:
    """Encodes texts twice and aligns the tokens; lives in a task."""

    def __init__(self, pair: TokenizerPair):
        self.encoder = Encoder(pair.vocabulary)
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=pair.piece_model)
        self.bytes_a, self.bytes_b = TokenBytes(pair.bytes_a), TokenBytes(pair.bytes_b)
        self.width = max(len(pair.bytes_a), len(pair.bytes_b))
        self.written = np.array([f"{i}{mark}" for mark in ",|;" for i in range(self.width)], object)

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both end to end, and how many each text has: none where a text is empty or one side
        does not give back its bytes."""
        data, offsets = text_bytes(pa.array([f" {t}" for t in texts], pa.string()))
        a, bounds_a = self.encoder.encode(data, offsets)
        lists = self.pieces.encode(texts, num_threads=1)
        n_b = np.array([len(x) for x in lists], np.int64)
        bounds_b = np.concatenate([[0], np.cumsum(n_b)])
        b = np.fromiter(chain.from_iterable(lists), np.int64, int(bounds_b[-1]))
        a, n_a = a.astype(np.int64), np.diff(bounds_a)
        good = self.bytes_a.give_back(a, bounds_a, data, offsets) & self.bytes_b.give_back(b, bounds_b, data, offsets)
        good &= np.diff(offsets) > 1
        return a[np.repeat(good, n_a)], b[np.repeat(good, n_b)], n_a * good, n_b * good

    def align(self, texts: list[str]) -> dict[str, list | np.ndarray]:
        """Counts, groups, and different linked id pairs with how often, by text."""
        a, b, n_a, n_b = self.encoded(texts)
        # The texts lie end to end; where one ends, both sides have an end.
        ends = [np.cumsum(side.size[ids]).tolist() for side, ids in ((self.bytes_a, a), (self.bytes_b, b))]
        link_a, link_b, ends_a, ends_b = aligned(*ends)
        texts_a = np.concatenate([[0], np.cumsum(n_a)])
        group_at = np.concatenate([[0], np.searchsorted(ends_a, texts_a[1:], "right")])
        owner = np.repeat(np.arange(len(texts)), n_a)[link_a]
        code = a[link_a] * len(self.bytes_b.size) + b[link_b]
        key = np.sort(owner << PAIR_BITS | code)
        first = np.flatnonzero(np.diff(key, prepend=-1))
        owner, code = key[first] >> PAIR_BITS, key[first] & ((1 << PAIR_BITS) - 1)
        pair_at = np.searchsorted(owner, np.arange(len(texts) + 1))
        times = np.diff(np.append(first, len(key)))
        cut = lambda x: pa.ListArray.from_arrays(pa.array(pair_at.astype(np.int32)), pa.array(x.astype(np.int32)))
        return {
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": np.diff(group_at),
            "n_links": np.diff(np.searchsorted(link_a, texts_a)),
            "groups": self._groups(a, b, ends_a, ends_b, group_at),
            "pairs": cut(code),
            "times": cut(times),
        }

    def _groups(self, a, b, ends_a, ends_b, group_at) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        size_a, size_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[ends_a - 1], last_b[ends_b - 1] = self.width, 2 * self.width
        every = np.zeros(len(a) + len(b), np.int64)
        every[np.arange(len(a)) + np.repeat(ends_b - size_b, size_a)] = a + last_a
        every[np.arange(len(b)) + np.repeat(ends_a, size_b)] = b + last_b
        written = self.written[every]
        at = np.concatenate([[0], ends_a + ends_b])[group_at].tolist()
        return ["".join(written[s:e].tolist())[:-1] for s, e in zip(at, at[1:], strict=False)]


def align_documents(docs: DataFrame, pair: TokenizerPair, with_groups: bool = False) -> DataFrame:
    """Stored rows ``row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times``.

    ``pairs`` are the text's different linked pairs, ``id of A * ids of B + id of B``, and ``times`` how
    often it links them; ``groups`` follow on request.
    """
    sent = send(docs.sparkSession, pair)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(unpack(sent))
        for batch in in_pieces(batches, PIECE):
            found = aligner.align(batch.column(2).fill_null("").to_pylist())
            digest = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found["groups"]]
            columns = [
                batch.column(0),
                batch.column(1).cast(pa.int64()),
                *(pa.array(found[c].astype(np.int64)) for c in COUNTS),
                pa.array(digest, pa.string()),
                found["pairs"],
                found["times"],
            ]
            names = ["row", "doc_id", *COUNTS, "groups_sha256", "pairs", "times"]
            if with_groups:
                columns.append(pa.array(found["groups"], pa.string()))
                names.append("groups")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"row long, doc_id long, {' long, '.join(COUNTS)} long, groups_sha256 string, pairs array<int>, times array<int>"
    schema += ", groups string" if with_groups else ""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return stored(rows.mapInArrow(align, schema), "aligned")


def _held_pairs(rows: DataFrame, *columns: str) -> DataFrame:
    held = rows.select(*columns, F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    return held.select(*columns, F.col("x.pairs").alias("pair"), F.col("x.times").cast("long").alias("times"))


def pair_counts(rows: DataFrame, pair: TokenizerPair) -> DataFrame:
    """``pair, n, best``: links of each id pair in the corpus; whether its id of B has no higher count.

    An id of B is in at most as many pairs as A has ids.
    """
    counts = stored(_held_pairs(rows).groupBy("pair").agg(F.sum("times").alias("n")), "pairs")
    id_b = (F.col("pair") % len(pair.bytes_b)).alias("b")
    highest = counts.groupBy(id_b).agg(F.max("n").alias("highest"))
    marked = counts.withColumn("b", id_b).join(highest, "b")
    return stored(marked.select("pair", "n", (F.col("n") == F.col("highest")).alias("best")), "counts")


def measure(docs: DataFrame, pair: TokenizerPair, common_pairs: int = COMMON_PAIRS) -> DataFrame:
    """Per row of (``doc_id``, ``text``) its alignment, and what the corpus-wide counts say of its links.

    ``n_best`` counts links whose pair is the most frequent one of its id of B (ties included), and
    ``count_sum`` adds up the corpus-wide counts of all links. Texts that are NULL or empty, or that
    one of the tokenizers does not give back byte by byte, have zeros and an empty ``groups_sha256``.
    One row per input row, repeated rows, repeated ids and NULL ids included; very long texts are
    aligned whole; an empty table gives no rows; other columns are not read.
    """
    rows = align_documents(docs, pair)
    counts = pair_counts(rows, pair)
    total = counts.agg(F.sum("n")).first()[0] or 0
    common = F.col("n") * common_pairs >= total
    held = _held_pairs(rows, "row")
    seen = held.join(F.broadcast(counts.filter(common)), "pair", "left")
    rest = seen.filter("n is null").select("row", "pair", "times").join(counts.filter(~common), "pair")
    worth = [
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("times")).alias("count_sum"),
    ]
    parts = seen.filter("n is not null").groupBy("row").agg(*worth).unionByName(rest.groupBy("row").agg(*worth))
    sums = parts.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    none = F.lit(0).cast("long")
    return rows.join(sums, "row", "left").select(
        "doc_id", *COUNTS, F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256"
    )


ship(__name__)
