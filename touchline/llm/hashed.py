"""Counts in hash buckets over a whole corpus: tables of fixed size, added up as they stream in."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from touchline.llm.shared import lean, ship

SEGMENT_BITS = 14
WIDTH = 1 << SEGMENT_BITS
PACKED = "segment int, pack binary"


def packed(held: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The buckets that a task has met, by segment of 2**14: places, then the counts of each row."""
    met = np.flatnonzero(held.any(axis=0))
    cut = np.searchsorted(met, np.arange(0, held.shape[1] + 1, WIDTH))
    segments, packs = [], []
    for s in range(len(cut) - 1):
        own = met[cut[s] : cut[s + 1]]
        if len(own):
            low = (own & (WIDTH - 1)).astype("<u2")
            packs.append(low.tobytes() + b"".join(row[own].astype("<u4").tobytes() for row in held))
            segments.append(s)
    if segments:
        yield pa.RecordBatch.from_arrays(
            [pa.array(segments, pa.int32()), pa.array(packs, pa.binary())], ["segment", "pack"]
        )


def collected(packs: DataFrame, rows: int, size: int) -> np.ndarray:
    """The sum of all packs. No task holds more than the table, and the driver holds it once."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, pack in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = pack.as_buffer()
                n = raw.size // (2 + 4 * rows)
                counts = np.frombuffer(raw, "<u4", rows * n, 2 * n).reshape(rows, n)
                if segment not in held:
                    held[segment] = np.zeros((rows, WIDTH), np.int64)
                held[segment][:, np.frombuffer(raw, "<u2", n)] += counts
        for segment, counts in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([segment], pa.int32()), pa.array([counts.astype("<f4").tobytes()], pa.binary())],
                ["segment", "pack"],
            )

    seen = packs.repartition("segment").mapInArrow(lean(add), PACKED).toArrow()
    out = np.zeros((rows, size), np.float32)
    for segment, raw in zip(seen.column(0).to_pylist(), seen.column(1).to_pylist(), strict=True):
        out[:, segment * WIDTH : (segment + 1) * WIDTH] = np.frombuffer(raw, "<f4").reshape(rows, WIDTH)
    return out


ship(__name__)
