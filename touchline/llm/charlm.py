"""Kneser-Ney character language models in sorted hash arrays, one per language.

Characters are mapped to a fixed alphabet of 48 symbols, so a window of four packs into one integer
below 48**4: the hash of an n-gram is that packing, which has no collisions. A model therefore never
holds more than 48**4 windows of the highest order, whatever the size of the corpus; this is the
proven bound of everything gathered on the driver and broadcast here (5.3 million entries of 8 bytes
per language in the worst case, some ten thousands in practice).

Windows are counted by Spark over all rows: each piece of a task is counted by sorting, and the counts
are summed by (language, window) before and after one shuffle; no task holds a table per language. Discounts, continuation counts and back-off weights follow from those counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from touchline.llm.shared import in_pieces, lean, release, ship, text_bytes

ORDER = 4
SYMBOLS = 48
PAD = 0
PIECE = 500_000


def _alphabet(kind: str) -> np.ndarray:
    """Symbol of every code point: 1 space, 2-27 a to z, then what ``kind`` distinguishes.

    ``letters`` folds case and turns all that is no letter into a space. ``full`` keeps capitals
    (28), digits (29) and marks (30-37) apart from letters beyond a to z (38-47).
    """
    table = np.ones(0x110000, np.uint8)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000:
            continue
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()[0]
            if kind == "full" and ch != low:
                table[c] = 28
            elif "a" <= low <= "z":
                table[c] = ord(low) - 95
            elif kind == "letters":
                table[c] = 28 + (ord(low) * 2654435761 % 2**32 >> 8) % 20
            else:
                table[c] = 38 + (ord(low) * 2654435761 % 2**32 >> 8) % 10
        elif kind == "full" and not ch.isspace():
            table[c] = 29 if ch.isdigit() else 30 + c % 8
    return table


_TABLES: dict[str, np.ndarray] = {}


def symbols_of(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all characters of the texts, and the places where the texts meet."""
    if kind not in _TABLES:
        _TABLES[kind] = _alphabet(kind)
    data, offsets = text_bytes(column)
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    return _TABLES[kind][points], starts[offsets]


def packed(symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Window of every character with the three before it; a space after a space is left out.

    Returns the windows and the places where the texts meet. Texts begin after three pads.
    """
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != 1) | (symbols[:-1] != 1)
    keep[offsets[:-1][offsets[:-1] < len(symbols)]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])[offsets]
    symbols = symbols[keep].astype(np.int32)
    codes = symbols.copy()
    begin = np.repeat(kept[:-1], np.diff(kept))
    depth = np.arange(len(symbols)) - begin
    for back in range(1, ORDER):
        before = np.zeros(len(symbols), np.int32)
        before[back:] = symbols[:-back]
        before[depth < back] = PAD
        codes += before * SYMBOLS**back
    return codes, kept


def count_windows(rows: DataFrame, kind: str) -> DataFrame:
    """``lang, code, n`` over all rows of (``lang``, ``text``); NULL lang is the empty string."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, PIECE):
            langs = batch.column(0).fill_null("").dictionary_encode()
            codes, bounds = packed(*symbols_of(batch.column(1), kind))
            key = np.repeat(langs.indices.to_numpy().astype(np.int64), np.diff(bounds)) * SYMBOLS**ORDER + codes
            key.sort()
            first = np.flatnonzero(np.diff(key, prepend=-1))
            own = key[first]
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(own // SYMBOLS**ORDER)),
                    pa.array((own % SYMBOLS**ORDER).astype(np.int32)),
                    pa.array(np.diff(np.append(first, len(key)))),
                ],
                ["lang", "code", "n"],
            )

    counted = rows.select("lang", "text").mapInArrow(lean(count), "lang string, code int, n long")
    return counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def modified_discounts(adjusted: np.ndarray) -> np.ndarray:
    """Discounts for counts of 1, 2 and 3 or more, from the counts of counts."""
    n1, n2, n3, n4 = (max(1, int((adjusted == i).sum())) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *(min(max(d, 0.05), i - 0.05) for i, d in enumerate(raw, 1))])


def single_discount(adjusted: np.ndarray) -> np.ndarray:
    """One discount for all counts."""
    n1, n2 = max(1, int((adjusted == 1).sum())), max(1, int((adjusted == 2).sum()))
    d = min(max(n1 / (n1 + 2 * n2), 0.05), 0.95)
    return np.array([0.0, d, d, d])


@dataclass
class CharModel:
    """Per order: sorted windows with log probabilities, sorted contexts with log back-off weights."""

    codes: list[np.ndarray]
    logp: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]

    def score(self, codes: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Natural log probability of the last symbol of each window given those before it."""
        if order == 0:
            return np.full(len(codes), -np.log(SYMBOLS - 1))
        known, values = self.codes[order - 1], self.logp[order - 1]
        at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        hit = known[at] == codes
        out = values[at].astype(np.float64)
        if not hit.all():
            rest = codes[~hit]
            out[~hit] = self._backoff(rest // SYMBOLS, order) + self.score(rest % SYMBOLS ** (order - 1), order - 1)
        return out

    def _backoff(self, context: np.ndarray, order: int) -> np.ndarray:
        known = self.contexts[order - 1]
        at = np.minimum(np.searchsorted(known, context), len(known) - 1)
        return np.where(known[at] == context, self.backoff[order - 1][at], 0.0)


def fit(code: np.ndarray, n: np.ndarray, discounts: Callable[[np.ndarray], np.ndarray]) -> CharModel:
    """Interpolated Kneser-Ney model from the counts of the windows of the highest order."""
    by_code = np.argsort(code)
    code, raw = code[by_code].astype(np.int64), n[by_code].astype(np.int64)
    levels = [(code, raw, raw)]
    for order in range(ORDER - 1, 0, -1):
        wider, wider_raw, _ = levels[0]
        suffix, where = np.unique(wider % SYMBOLS**order, return_inverse=True)
        total = np.bincount(where, weights=wider_raw).astype(np.int64)
        kinds = np.bincount(where)
        # Windows that open a text have no wider context: their own counts stand.
        opens = (suffix // SYMBOLS ** (order - 1) == PAD) if order > 1 else np.zeros(len(suffix), bool)
        levels.insert(0, (suffix, total, np.where(opens, total, kinds)))
    model = CharModel([], [], [], [])
    for order, (codes, _, adjusted) in enumerate(levels, 1):
        by_count = discounts(adjusted)
        cut = by_count[np.minimum(adjusted, 3)]
        contexts, first = np.unique(codes // SYMBOLS, return_index=True)
        total, left = np.add.reduceat(adjusted, first), np.add.reduceat(cut, first)
        width = np.diff(np.append(first, len(codes)))
        gamma = left / total
        lower = np.exp(model.score(codes % SYMBOLS ** (order - 1), order - 1))
        p = (adjusted - cut) / np.repeat(total, width) + np.repeat(gamma, width) * lower
        model.codes.append(codes.astype(np.int32))
        model.logp.append(np.log(p).astype(np.float32))
        model.contexts.append(contexts.astype(np.int32))
        model.backoff.append(np.log(gamma).astype(np.float32))
    return model


def fit_all(counted: DataFrame, discounts: Callable[[np.ndarray], np.ndarray]) -> dict[str, CharModel]:
    """A model per language. What arrives here is bounded by the alphabet, not by the corpus."""
    seen = counted.select("lang", "code", "n").toArrow().combine_chunks()
    kinds = seen.column("lang").combine_chunks().dictionary_encode()
    own, names = kinds.indices.to_numpy(), kinds.dictionary.to_pylist()
    code, n = seen.column("code").to_numpy(), seen.column("n").to_numpy()
    models = {lang: fit(code[own == i], n[own == i], discounts) for lang, i in sorted(zip(names, range(len(names)), strict=True))}
    del seen, kinds, own, code, n
    release()
    return models


class Scorer:
    """Log probabilities of windows under some models."""

    def __init__(self, models: list[CharModel]):
        self.models = models

    def totals(self, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Sum of log probabilities, by model and text. Each different window is looked up once."""
        out = np.zeros((len(self.models), len(bounds) - 1))
        if not len(codes):
            return out
        kinds, where = np.unique(codes, return_inverse=True)
        for i, model in enumerate(self.models):
            total = np.concatenate([[0.0], np.cumsum(model.score(kinds)[where])])
            out[i] = total[bounds[1:]] - total[bounds[:-1]]
        return out


ship(__name__)
