"""Language identification by interpolated Kneser-Ney character models, one per language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm import charlm
from touchline.llm.shared import in_pieces, send, ship, unpack

UNDETERMINED = "und"
CALIBRATION_ROWS = 20_000
CALIBRATION_SHARE = 0.1
ACCEPT_PRECISION = 0.99
RESULT = "lang_pred string, score double, cross_entropy double, margin double, accepted boolean"


@dataclass
class LanguageModel:
    """Models in the order of ``langs``; ``scale`` turns a lead in nats into a probability."""

    langs: list[str]
    models: list[charlm.CharModel]
    scale: tuple[float, float] = (0.0, 1.0)
    floor: float = 0.0


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a one-variable logistic regression, by damped Newton steps.

    Two pseudo-rows, one of each kind at the middle, keep it finite where all rows agree.
    """
    x, y = np.append(x, [0.0, 0.0]), np.append(y, [0.0, 1.0])
    w = np.zeros(2)
    design = np.stack([np.ones_like(x), x])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(w @ design, -30, 30)))
        grad = design @ (y - p) - 1e-3 * w
        hess = (design * (p * (1 - p) + 1e-9)) @ design.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w + step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
    return float(w[0]), float(w[1])


def _lead(gap: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What calibration sees: the lead of the winner over the next language, in root nats."""
    return np.sqrt(np.maximum(gap * n, 0.0))


def _measures(scorer: charlm.Scorer, column: pa.Array):
    """Winner, cross-entropies, lead per character and length of each text (in windows), and letters."""
    symbols, offsets = charlm.symbols_of(column, "letters")
    letters = np.concatenate([[0], np.cumsum(symbols > 1)])[offsets]
    letters = np.diff(letters)
    codes, bounds = charlm.packed(symbols, offsets)
    n = np.maximum(np.diff(bounds), 1)
    entropy = -scorer.totals(codes, bounds) / n
    best = entropy.argmin(axis=0)
    ranked = np.sort(entropy, axis=0)
    gap = ranked[1] - ranked[0] if len(ranked) > 1 else np.full(len(n), 1.0)
    return best, ranked[0], gap, n, letters


def train(rows: DataFrame, calibration_rows: int = CALIBRATION_ROWS) -> LanguageModel:
    """Models and calibration from rows of (``doc_id``, ``text``, ``lang``), all of them used.

    Rows without a language teach nothing. Scores are calibrated on different rows that are left out
    of the models: a tenth of all by hash, but about ``calibration_rows`` at most; this bound is the
    only sample. They are judged where they are read, and only four values of each are gathered.
    Without any usable row the model knows no language; an empty table is such a case.
    """
    rows = rows.select("doc_id", "text", "lang").filter("lang is not null and text is not null")
    n = rows.count()
    share = min(CALIBRATION_SHARE, calibration_rows / max(n, 1))
    # Equal rows have one hash: they are calibrated on once, or taught by all of them.
    mark = F.xxhash64("doc_id", "text", "lang")
    chosen = F.pmod(mark, F.lit(1 << 40)) < int(share * (1 << 40))
    fitted = charlm.fit_all(charlm.count_windows(rows.filter(~chosen), "letters"), charlm.single_discount)
    found = LanguageModel(list(fitted), list(fitted.values()))
    if not found.langs:
        return found
    sample = rows.filter(chosen).select("lang", "text", mark.alias("mark"))
    judged = _apply(sample, found, ["lang", "mark"]).filter(F.col("lang_pred") != UNDETERMINED)
    seen = judged.groupBy("mark").agg(*[F.first(c).alias(c) for c in ("lang", "lang_pred", "margin")]).toPandas()
    if len(seen):
        right = (seen["lang"] == seen["lang_pred"]).to_numpy().astype(float)
        lead = seen["margin"].to_numpy()
        found.scale = _logistic(lead, right)
        p = _probability(found, lead)
        order = np.argsort(-p)
        precision = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(precision >= ACCEPT_PRECISION)
        found.floor = float(p[order][good[-1]]) if len(good) else 1.0
    return found


def _probability(model: LanguageModel, lead: np.ndarray) -> np.ndarray:
    a, b = model.scale
    return 1 / (1 + np.exp(-np.clip(a + b * lead, -30, 30)))


def _apply(docs: DataFrame, model: LanguageModel, carry: list[str]) -> DataFrame:
    sent = send(docs.sparkSession, model)
    rows = docs.select(*carry, "text")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    names = [f.name for f in rows.schema.fields[:-1]]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = unpack(sent)
        scorer = charlm.Scorer(known.models) if known.langs else None
        labels = np.array([*known.langs, UNDETERMINED], object)
        for batch in in_pieces(batches, charlm.PIECE):
            size = len(batch)
            if scorer is None:
                none, zero = np.full(size, len(known.langs)), np.zeros(size)
                best, entropy, lead, p, und = none, zero, zero, zero, np.ones(size, bool)
            else:
                best, entropy, gap, n, letters = _measures(scorer, batch.column(len(names)))
                lead = _lead(gap, n)
                p = _probability(known, lead)
                und = letters == 0
            best = np.where(und, len(known.langs), best)
            p = np.where(und, 0.0, p)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(labels[best], pa.string()),
                    pa.array(p),
                    pa.array(np.where(und, 0.0, entropy)),
                    pa.array(np.where(und, 0.0, lead)),
                    pa.array(~und & (p >= known.floor)),
                ],
                [*names, "lang_pred", "score", "cross_entropy", "margin", "accepted"],
            )

    return rows.mapInArrow(predict, ", ".join([*fields, RESULT]))


def identify(docs: DataFrame, model: LanguageModel, held_out: Column | None = None) -> DataFrame:
    """The language of every whole text.

    ``lang_pred`` is the learned language with the lowest cross-entropy per character, the first by
    name on a tie; it is ``und`` for texts that are NULL or have no letter, with score 0. ``score``
    is the calibrated chance that it is right. ``accepted`` is false where the score is below the
    level at which 99 % of the calibration rows were right: the rejection. One row per input row,
    repeated rows and NULL ids included; other columns of the input are not read.
    """
    marked = docs.select("doc_id", "text", (held_out if held_out is not None else F.lit(False)).alias("held_out"))
    return _apply(marked, model, ["doc_id", "held_out"])


ship(__name__)
