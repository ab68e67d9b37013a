"""Byte-level BPE by a pair occurrence index over all distinct pieces of a batch of texts.

The pieces of a batch lie end to end in one array of tokens. For each pair of neighbours the index
holds all positions where it occurs. The ranks that are active are taken in ascending order; the
pair's positions are merged at once, left to right where they overlap, and the positions of the
pairs that arise next to them are added to the index. Each distinct piece is merged once per task
(the memory for known pieces is bounded: it is dropped when full), and texts are put together from
their pieces.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from touchline.llm import words
from touchline.llm.shared import in_pieces, lean, release, send, ship, text_bytes, unpack

PIECE = 1_000_000
KNOWN_TOKENS = 8_000_000
#: Fixed value: how the vocabulary's byte-level pre-tokenizer splits text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WHITE, LETTER, NUMBER, OTHER = range(4)


@dataclass
class Vocabulary:
    """``bytes_of[id]``, ids of single bytes, merges ``left << 32 | right -> (rank, id)``, special
    strings, and whether each code point is white, a letter, a number or something else."""

    bytes_of: list[bytes]
    byte_ids: np.ndarray
    merges: dict[int, tuple[int, int]]
    special: dict[str, int]
    kinds: np.ndarray


def _byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _kinds() -> np.ndarray:
    """White, letter, number or other, by the Unicode properties that the pattern names."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((WHITE, r"\s"), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        kinds[[ord(c) for c in regex.findall(pattern, every)]] = kind
    return kinds


def read_vocabulary(path: str) -> Vocabulary:
    """A byte-level BPE vocabulary from a tokenizers file, read on the driver."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec["pre_tokenizer"]
    plain = split["type"] == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
    if model["type"] != "BPE" or not plain or spec["normalizer"] or model.get("ignore_merges"):
        raise ValueError("only plain byte-level BPE without normalizer is supported")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError("added tokens that take in their surroundings are not supported")
    value = _byte_characters()
    ids = model["vocab"]
    bytes_of = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for token, i in ids.items():
        bytes_of[i] = token.encode() if token in special else bytes(value[c] for c in token)
    for token, i in special.items():
        bytes_of[i] = token.encode()
    byte_ids = np.zeros(256, np.int64)
    for c, b in value.items():
        byte_ids[b] = ids[c]
    merges = {}
    for rank, pair in enumerate(model["merges"]):
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        merges.setdefault(ids[left] << 32 | ids[right], (rank, ids[left + right]))
    return Vocabulary(bytes_of, byte_ids, merges, special, _kinds())


class PairIndex:
    """Merges all pieces of a batch together."""

    def __init__(self, vocabulary: Vocabulary):
        self.byte_ids = vocabulary.byte_ids
        keys = np.array(list(vocabulary.merges), np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.array([r for r, _ in vocabulary.merges.values()], np.int64)[order]
        self.by_rank = {r: (k >> 32, k & 0xFFFFFFFF, i) for k, (r, i) in vocabulary.merges.items()}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def merge(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all pieces (their bytes end to end), and the places where the pieces meet."""
        n = len(data)
        token = self.byte_ids[data]
        after = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        after[bounds[1:] - 1] = n  # n: no neighbour
        before[bounds[:-1]] = n
        alive = np.ones(n + 1, bool)
        alive[n] = False
        token = np.append(token, -1)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(at: np.ndarray) -> None:
            rank = self._rank(token[at], token[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cut = np.flatnonzero(np.diff(rank)) + 1
            for r, part in zip(rank[np.append(0, cut)].tolist(), np.split(at, cut), strict=True):
                if r in index:
                    index[r].append(part)
                else:
                    index[r] = [part]
                    heapq.heappush(active, r)

        add(np.flatnonzero(after < n))
        while active:
            rank = heapq.heappop(active)
            left, right, merged = self.by_rank[rank]
            parts = index.pop(rank)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            nxt = after[at]
            at = at[alive[at] & (token[at] == left) & (token[nxt] == right)]
            if left == right and len(at) > 1:
                at = self._apart(at, after[at])
            if not len(at):
                continue
            nxt = after[at]
            far = after[nxt]
            token[at] = merged
            alive[nxt] = False
            after[at] = far
            inner = far < n
            before[far[inner]] = at[inner]
            near = before[at]
            fresh = np.concatenate([at[inner], near[near < n]])
            if len(fresh):
                add(np.unique(fresh))
        kept = np.concatenate([[0], np.cumsum(alive[:n])])
        return token[:n][alive[:n]], kept[bounds]

    @staticmethod
    def _apart(at: np.ndarray, nxt: np.ndarray) -> np.ndarray:
        """Of a run of overlapping positions every second one, from its left end."""
        joined = np.append(False, nxt[:-1] == at[1:])
        place = np.arange(len(at))
        run = np.maximum.accumulate(np.where(joined, 0, place))
        return at[(place - run) % 2 == 0]


def piece_starts(points: np.ndarray, kinds: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Where pieces begin, as the pattern ``SPLIT`` cuts; ``opens`` marks where texts begin.

    Letters, numbers and other marks form runs; the last blank of a white run joins the run after
    it, another last white character stands alone; a contraction that opens a run of marks is a
    piece of its own.
    """
    n = len(points)
    begins = opens[:n].copy()
    begins[1:] |= kinds[1:] != kinds[:-1]
    white = kinds == WHITE
    last = np.flatnonzero(white[:-1] & ~white[1:] & ~opens[1:n])  # and something follows in the text
    begins[last] = True
    begins[last[points[last] == 32] + 1] = False
    quote = np.flatnonzero((points == 39) & begins)
    if len(quote):
        ahead = np.concatenate([points, [0, 0, 0]])
        one, two = ahead[quote + 1], ahead[quote + 2]
        closed = np.concatenate([opens, [True, True]])
        short = np.isin(one, [ord(c) for c in "stmd"]) & ~closed[quote + 1]
        long = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        long &= ~closed[quote + 1] & ~closed[quote + 2]
        for at, length in ((quote[short], 2), (quote[long], 3)):
            for j in range(1, length):
                begins[at + j] = False
            begins[(at + length)[at + length < n]] = True
    return begins


class Encoder:
    """Encodes and decodes batches of texts; remembers the tokens of the pieces it has met.

    Pieces are told apart by 64 bits of hash. ``hashes`` is sorted; ``first`` and ``size`` say where
    the tokens of each piece lie in ``tokens``.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.index = PairIndex(vocabulary)
        self.kinds = vocabulary.kinds
        self.special = vocabulary.special
        longest = sorted(vocabulary.special, key=len, reverse=True)
        self.find_special = regex.compile("|".join(map(regex.escape, longest)) or r"(?!)")
        self.token_size = np.array([len(b) for b in vocabulary.bytes_of], np.int64)
        self.token_first = np.cumsum(self.token_size) - self.token_size
        self.token_bytes = np.frombuffer(b"".join(vocabulary.bytes_of), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.tokens = np.zeros(0, np.int32)

    def _specials(self, text: str, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First characters and ids of the special strings that lie within one text."""
        found = [(m.start(), m.end(), self.special[m[0]]) for m in self.find_special.finditer(text)]
        found = [(a, b, i) for a, b, i in found if np.searchsorted(chars, a, "right") == np.searchsorted(chars, b, "left")]
        table = np.array(found, np.int64).reshape(-1, 3)
        return table[:, :2], table[:, 2]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts (their bytes end to end), and the places where the texts meet."""
        if len(self.tokens) > KNOWN_TOKENS:
            self._forget()
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        text = data.tobytes().decode("utf-8")
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        byte_of = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        chars = np.searchsorted(byte_of, offsets)
        spans, special_ids = self._specials(text, chars)
        opens = np.zeros(len(points) + 1, bool)
        opens[chars] = True
        opens[spans.ravel()] = True
        opens[-1] = True
        begins = piece_starts(points, self.kinds[points], opens)
        for a, b in spans:
            begins[a + 1 : b] = False
        piece = np.flatnonzero(begins)
        start = byte_of[piece]
        del text, points, byte_of, opens, begins
        hashes = words.run_hashes(data, start)
        is_special = np.searchsorted(piece, spans[:, 0])
        hashes[is_special] = words.mix(special_ids.astype(np.uint64) ^ np.uint64(words.GOLDEN))
        self._learn(data, start, hashes, is_special, special_ids)
        at = np.searchsorted(self.hashes, hashes)
        size = self.size[at]
        ends = np.cumsum(size)
        where = np.arange(int(ends[-1]))
        where += np.repeat(self.first[at] - (ends - size), size)
        meet = np.searchsorted(piece, chars)
        return self.tokens[where], np.concatenate([[0], ends])[meet]

    def _learn(self, data, start, hashes, is_special, special_ids) -> None:
        kinds, sample = np.unique(hashes, return_index=True)
        at = np.minimum(np.searchsorted(self.hashes, kinds), max(len(self.hashes) - 1, 0))
        new = self.hashes[at] != kinds if len(self.hashes) else np.ones(len(kinds), bool)
        kinds, sample = kinds[new], sample[new]
        if not len(kinds):
            return
        stop = np.append(start[1:], len(data))
        length = (stop - start)[sample]
        ends = np.cumsum(length)
        own = data[np.arange(int(ends[-1])) + np.repeat(start[sample] - (ends - length), length)]
        tokens, meet = self.index.merge(own, np.concatenate([[0], ends]))
        size = np.diff(meet)
        first = meet[:-1]
        if len(is_special):
            # A special string has one token, whatever its bytes would merge to.
            which = np.searchsorted(is_special, sample)
            hit = np.append(is_special, -1)[which] == sample
            first, size = first.copy(), size.copy()
            first[hit], size[hit] = len(tokens) + np.arange(hit.sum()), 1
            tokens = np.append(tokens, special_ids[which[hit]])
        self.first = np.append(self.first, first + len(self.tokens))
        self.size = np.append(self.size, size)
        self.tokens = np.append(self.tokens, tokens.astype(np.int32))
        self.hashes = np.append(self.hashes, kinds)
        order = np.argsort(self.hashes)
        self.hashes, self.first, self.size = self.hashes[order], self.first[order], self.size[order]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of the ids; bytes that are no UTF-8 become the replacement character."""
        size = self.token_size[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        where = np.arange(int(ends[-1]))
        where += np.repeat(self.token_first[ids] - ends[:-1], size)
        data, places = self.token_bytes[where].tobytes(), ends[bounds].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(places, places[1:], strict=False)]


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, with_ids: bool = False) -> DataFrame:
    """Encode every whole text and decode it again.

    ``n_tokens``, ``ids_sha256`` (of the ids as little-endian unsigned 32-bit integers) and
    ``decoded_sha256`` (of the decoded text in UTF-8) per input row, with ``ids`` and ``decoded`` on
    request. NULL and empty texts have no tokens. Special strings in a text become their special
    token. One row per input row, repeated rows and NULL ids included; other columns are not read.
    """
    sent = send(docs.sparkSession, vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(unpack(sent))
        for batch in in_pieces(batches, PIECE):
            ids, bounds = encoder.encode(*text_bytes(batch.column(1)))
            ids = ids.astype("<u4")
            places = bounds.tolist()
            own = [ids[a:b] for a, b in zip(places, places[1:], strict=False)]
            decoded = encoder.decode(ids, bounds)
            columns = [
                batch.column(0),
                pa.array(np.diff(bounds)),
                pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in own], pa.string()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                lists = [x.astype(np.int32) for x in own]
                columns += [pa.array(lists, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)
            del ids, own, decoded, columns
            release()

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if with_ids else ""
    return docs.select("doc_id", "text").mapInArrow(lean(encode), schema)


ship(__name__)
