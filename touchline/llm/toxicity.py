"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm import words
from touchline.llm.shared import in_pieces, lean, release, send, ship, stored, text_bytes, unpack

BITS = 18
PREFIXES = (3, 4, 5, 6)
TOXIC_ROWS = 2_000
CLEAN_ROWS = 3_000
LEAST_G = 20.0
STEPS = 200
RATE = 0.1
DECAY = 1e-4
PIECE = 500_000
OFFENDING = 0.5

#: Bytes between words: ASCII that is neither letter nor digit.
BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
STOPS = np.zeros(256, bool)
STOPS[[10, 33, 46, 63]] = True


@dataclass
class SentenceModel:
    """Weights of hashed features of a sentence; its logit is their sum plus ``bias``."""

    weight: np.ndarray
    bias: float


@dataclass
class Sentences:
    """Features (word and its prefixes, hashed) by sentence, and sentences by text."""

    feature: np.ndarray  # one row per kind of feature, one column per word
    sentence: np.ndarray  # of each word
    start: np.ndarray
    stop: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.start)


def sentences(column: pa.Array) -> Sentences:
    """Sentences end at a stop, a question or exclamation mark or a line break; those without a word don't count."""
    data, offsets = text_bytes(column)
    found, heads = words.segments(words.LOWER[data], offsets, BETWEEN, PREFIXES)
    runs, _ = words.segments(data, offsets, STOPS)
    first = np.searchsorted(found.start, runs.start)
    after = np.searchsorted(found.start, runs.stop)
    full = after > first
    sentence = np.repeat(np.arange(full.sum()), (after - first)[full])
    feature = np.stack([h >> np.uint64(64 - BITS) for h in (found.hash, *heads)]).astype(np.int32)
    owner_bounds = np.concatenate([[0], np.cumsum(full)])[runs.bounds]
    return Sentences(feature, sentence, runs.start[full], runs.stop[full], owner_bounds)


def noisy_or(logit: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Log of the chance that no sentence of a text is toxic."""
    log_clean = -np.logaddexp(0.0, logit)
    total = np.concatenate([[0.0], np.cumsum(log_clean)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _logits(model: SentenceModel, found: Sentences) -> np.ndarray:
    per_word = model.weight[found.feature].sum(axis=0)
    return np.bincount(found.sentence, weights=per_word, minlength=len(found)) + model.bias


def _association(with_toxic: np.ndarray, with_clean: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """G statistic of each feature: how far its documents depart from the share of toxic ones."""
    seen, n = with_toxic + with_clean, toxic + clean
    g = np.zeros(len(seen))
    for part, rate in ((with_toxic, toxic / n), (with_clean, clean / n)):
        at = part > 0
        g[at] += 2 * part[at] * np.log(part[at] / (seen[at] * rate))
    return g


def _pieces(texts: pa.Array) -> Iterator[pa.Array]:
    for batch in in_pieces(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), PIECE):
        yield batch.column(0)


def _distinct(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The first of each group of equal texts, without those that are empty, and their places."""
    hashes, rows, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    for piece in _pieces(texts):
        whole, _ = words.segments(*text_bytes(piece), np.zeros(256, bool))
        hashes.append(whole.hash)
        rows.append(whole.owner() + at)
        at += len(piece)
    _, first = np.unique(np.concatenate(hashes), return_index=True)
    kept = np.sort(np.concatenate(rows)[first])
    return texts.take(pa.array(kept)), kept


def _features(texts: pa.Array) -> Iterator[tuple[Sentences, np.ndarray, np.ndarray]]:
    """Sentences of a piece of the texts after the other, with each sentence's text and each word's sentence, counted over all."""
    at = n = 0
    for piece in _pieces(texts):
        found = sentences(piece)
        yield found, np.repeat(np.arange(len(piece)), np.diff(found.bounds)) + at, found.sentence + n
        at, n = at + len(piece), n + len(found)


def fit(texts: pa.Array, toxic: np.ndarray) -> SentenceModel:
    """Maximise the likelihood of document labels under the noisy-or of sentence scores.

    Equal texts count once. Features whose documents are no more or less often toxic than others
    (G below ``LEAST_G``) are left out. Full-batch Adam from zero weights; the gradient of a toxic
    document goes to its sentences in proportion to their own scores.
    """
    size = 1 << BITS
    nothing = SentenceModel(np.zeros(size, np.float32), -30.0)
    if not (toxic == 1).any():
        return nothing
    texts, kept = _distinct(texts)
    toxic = toxic[kept]
    # The features of all texts take several times their space, so they are made twice, piece by piece.
    with_kind, owners = np.zeros((2, size), np.int64), []
    for found, owner, _ in _features(texts):
        owners.append(owner)
        for kind in found.feature:
            pair = np.unique(kind.astype(np.int64) * len(toxic) + owner[found.sentence])
            for label in (0, 1):
                with_kind[label] += np.bincount(pair[toxic[pair % len(toxic)] == label] // len(toxic), minlength=size)
    owner = np.concatenate([np.zeros(0, np.int64), *owners])
    if not len(owner) or not (toxic == 1).any():
        return nothing
    bounds = np.searchsorted(owner, np.arange(len(toxic) + 1))
    y = toxic.astype(float)
    strong = _association(with_kind[1], with_kind[0], int(y.sum()), int((1 - y).sum())) >= LEAST_G
    pairs = [np.zeros(0, np.int64)]
    for found, _, at in _features(texts):
        own = [kind[strong[kind]].astype(np.int64) * len(owner) + at[strong[kind]] for kind in found.feature]
        pairs.append(np.unique(np.concatenate(own)))
    pair = np.sort(np.concatenate(pairs))
    del pairs
    feature, sentence = pair // len(owner), pair % len(owner)
    used, feature = np.unique(feature, return_inverse=True)
    # Each kind of document weighs half, however many there are.
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    w, bias = np.zeros(len(used)), -5.0
    mean, square = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(sentence, weights=w[feature], minlength=len(owner)) + bias
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        clean = np.exp(noisy_or(z, bounds))
        pull = np.where(y == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0) * share
        g = p * pull[owner]
        grad = np.append(np.bincount(feature, weights=g[sentence], minlength=len(used)), g.sum()) / len(y)
        grad[:-1] += DECAY * w
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad**2
        move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-7)
        w -= move[:-1]
        bias -= move[-1]
    weight = np.zeros(size, np.float32)
    weight[used] = w
    return SentenceModel(weight, float(bias))


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> SentenceModel:
    """Fit on at most ``toxic_rows`` and ``clean_rows`` labelled texts, the first by hash of id.

    These two bounds are the only sample; the texts of an id that repeats count each, equal ones once.
    Labels that are NULL teach nothing; a document with
    several labels is toxic if one says so. Without a toxic example nothing is toxic.
    """
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = None
    for kind, rows in ((1, toxic_rows), (0, clean_rows)):
        part = known.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        chosen = part if chosen is None else chosen.unionAll(part)
    # At most toxic_rows + clean_rows rows of numbers are broadcast, here and below.
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    held = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "hash", "toxic").distinct()
    kept = None
    for kind, rows in ((1, toxic_rows), (0, clean_rows)):
        part = held.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id", "hash").limit(rows)
        kept = part if kept is None else kept.unionAll(part)
    kept = stored(kept, "examples")
    seen = texts.join(F.broadcast(kept), ["doc_id", "hash"]).dropDuplicates(["doc_id", "hash"])
    seen = seen.sort("doc_id", "hash").select("doc_id", "text", "toxic").toArrow()
    order = np.argsort(seen.column("doc_id").to_numpy(), kind="stable")
    seen = seen.take(pa.array(order))
    texts = seen.column("text").combine_chunks() if len(seen) else pa.array([], pa.string())
    toxic = np.array(seen.column("toxic").to_pylist(), np.int64)
    del seen
    release()
    model = fit(texts, toxic)
    del texts
    release()
    return model


def score(docs: DataFrame, model: SentenceModel, held_out: Column | None = None, spans: bool = False) -> DataFrame:
    """Toxicity of every whole text: the noisy-or of its sentence scores.

    ``n_sentences``, ``n_offending`` (sentences with a score of 0.5 or more), ``worst_start`` and
    ``worst_stop`` (byte range of the highest sentence, the first on a tie; NULL without sentences),
    and with ``spans`` the ranges and scores of all offending sentences. A NULL text, or one without
    a word, has no sentence and score 0. One row per input row, repeated rows and NULL ids included;
    other columns of the input are not read.
    """
    sent = send(docs.sparkSession, model)
    rows = docs.select("doc_id", "text", (held_out if held_out is not None else F.lit(False)).alias("held_out"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = unpack(sent)
        for batch in in_pieces(batches, PIECE):
            _, offsets = text_bytes(batch.column(1))
            found = sentences(batch.column(1))
            logit = _logits(known, found)
            chance = -np.expm1(noisy_or(logit, found.bounds))
            n = np.diff(found.bounds)
            begin = np.repeat(offsets[:-1], n)
            start, stop = found.start - begin, found.stop - begin
            bad = logit >= np.log(OFFENDING / (1 - OFFENDING))
            # Highest logit first within a text, then the earlier sentence.
            owner = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((np.arange(len(logit)), -logit, owner))
            top = np.append(order, 0)[found.bounds[:-1]]
            none = n == 0
            columns = [
                batch.column(0),
                batch.column(2),
                pa.array(np.clip(chance, 0.0, 1.0) + 0.0),
                pa.array((chance >= 0.5).astype(np.int32)),
                pa.array(n.astype(np.int64)),
                pa.array(words.sums(bad, found.bounds)),
                pa.array(np.append(start, 0)[top], mask=none),
                pa.array(np.append(stop, 0)[top], mask=none),
            ]
            names = ["doc_id", "held_out", "score", "predicted", "n_sentences", "n_offending", "worst_start", "worst_stop"]
            if spans:
                cut = np.concatenate([[0], np.cumsum(words.sums(bad, found.bounds))]).astype(np.int32)
                p = 1 / (1 + np.exp(-np.clip(logit[bad], -30, 30)))
                items = pa.StructArray.from_arrays(
                    [pa.array(start[bad]), pa.array(stop[bad]), pa.array(p)], ["start", "stop", "score"]
                )
                columns.append(pa.ListArray.from_arrays(pa.array(cut), items))
                names.append("offending")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = (
        "doc_id long, held_out boolean, score double, predicted int, n_sentences long, "
        "n_offending long, worst_start long, worst_stop long"
    )
    schema += ", offending array<struct<start: long, stop: long, score: double>>" if spans else ""
    return rows.mapInArrow(lean(judge), schema)


ship(__name__)
