"""Cross-entropy difference of documents under matched target and background bigram models.

Counts are exact: a word is known by the 64 bits of its hash, a pair of neighbouring words by those of
both of its words, and no two share a count. The loss of a word after another is the log of what the
previous word was followed by, less the log of a sum that depends on the pair and its second word. The
first belongs to a word as context, the second to a word and what stands before it, so all that the tokens
of one word need is counted where they meet. Texts are shuffled once as tokens, dealt by word, and only
sums per document come back; no table of pairs is stored.

Words with more than a fixed share of all tokens are dealt by pair, with their own counts broadcast, and
pairs with more than such a share are scored where they are read, so no key gathers in one task. Neither
set can be larger than that share allows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from touchline.llm import words
from touchline.llm.shared import in_pieces, send, ship, stored, text_bytes, unpack

MASS = 20.0
PIECE = 1_000_000
#: A word with this share of all tokens or more is common: at most so many words are.
COMMON_WORDS = (1 << 16) - 2
#: At most so many pairs are common, among them every pair with twice this share of all tokens.
COMMON_PAIRS = 1 << 14
#: Tokens that meet in one group of tokens.
GROUP_TOKENS = 2_000_000
#: Tokens of a group whose losses are worked out at once.
TURN_TOKENS = 250_000
#: Sums come back by blocks of so many rows (a power of 2 below 2**15).
BLOCK_BITS = 12
#: Ids of the target are broadcast up to this number, else joined.
BROADCAST_IDS = 2_000_000
#: Rows of a piece are numbered by 16 bits.
PIECE_ROWS = 30_000
#: Stands before the first word of a text; no word has it as its hash.
OPENING = 0
#: Number of all words that are not common.
RARE = (1 << 16) - 1
COUNTS = ["target", "total", "context_target", "context_total"]
TOKENS = "rows array<long>, target array<boolean>, at array<smallint>, word array<long>, before array<smallint>, prev array<long>, n array<int>, last array<int>"
SUMS = "doc_id array<long>, tokens array<long>, loss array<double>, background_loss array<double>"


@dataclass
class Common:
    """What tasks know beforehand: sizes, counts of common words (rows of COUNTS), and of common pairs."""

    mass: tuple[int, int]
    kinds: int
    words: np.ndarray
    word_counts: np.ndarray
    pairs: np.ndarray
    pair_counts: np.ndarray
    groups: int = 1

    def word_places(self, word: np.ndarray) -> np.ndarray:
        return _places(self.words, word)

    def numbers(self, prev: np.ndarray) -> np.ndarray:
        """16 bits for each word: 0 for the opening, RARE for a word that is not common."""
        at = self.word_places(prev)
        return np.where(prev == OPENING, 0, np.where(at >= 0, at + 1, RARE)).astype(np.uint16)

    def hashes(self, before: np.ndarray, rare: np.ndarray) -> np.ndarray:
        """The words of ``numbers``; those that are not common stand in ``rare``, in order."""
        prev = np.concatenate([[OPENING], self.words, np.zeros(RARE - len(self.words), np.int64)])[before]
        prev[before == RARE] = rare
        return prev

    def pair_places(self, prev: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Place of each pair among the common ones, or -1. Both words are compared."""
        keys = _pair_keys(self.pairs[0], self.pairs[1])
        at = _places(keys, _pair_keys(prev, word))
        held = np.flatnonzero(at >= 0)
        wrong = (self.pairs[0][at[held]] != prev[held]) | (self.pairs[1][at[held]] != word[held])
        at[held[wrong]] = -1
        return at

    def losses(self, prev, n, last, pair, word) -> list[np.ndarray]:
        """Loss in nats under both models of ``n`` tokens each, of which ``last`` end their text.

        ``pair`` and ``word`` hold their counts. Both models share the vocabulary (all words, and one
        for those never seen), order and smoothing; the background's counts are scaled to the target's
        mass. A text's first word has no context; a word that ends its text is none.
        """
        scale = self.mass[0] / self.mass[1] if self.mass[1] else 0.0
        out = []
        for i, x in enumerate((1.0, scale)):
            alone = (word[i] * x + 1.0 / (self.kinds + 1)) / (self.mass[0] + 1.0)
            joint = np.where(prev == OPENING, alone, pair[i] * x + MASS * alone)
            out.append((n - last) * np.log(word[i + 2] * x + MASS) - n * np.log(joint))
        return out


@dataclass
class MatchedModels:
    """The documents learned from, with ``target``; counts of all words; and what tasks know beforehand.

    ``words`` counts each word in the target and in all documents, and as context of another.
    """

    docs: DataFrame
    marked: DataFrame
    words: DataFrame
    common: Common

    @property
    def kinds(self) -> int:
        return self.common.kinds


def _places(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in a sorted table, or -1."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def _pair_keys(prev: np.ndarray, word: np.ndarray) -> np.ndarray:
    return words.mix(prev.view(np.uint64) * np.uint64(words.GOLDEN) + word.view(np.uint64))


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each lower-cased word and of the one before it, whether it ends its text, and where texts meet."""
    data, offsets = text_bytes(column)
    found, _ = words.segments(words.LOWER[data], offsets, words.SPACE)
    word = np.where(found.hash == OPENING, np.uint64(1), found.hash).view(np.int64)
    prev = np.concatenate([[OPENING], word])[:-1].astype(np.int64)
    held = np.diff(found.bounds) > 0
    prev[found.bounds[:-1][held]] = OPENING
    last = np.zeros(len(word), np.int64)
    last[found.bounds[1:][held] - 1] = 1
    return word, prev, last, found.bounds


def _runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts rows by ``columns``, the last one first, and where in it each different row begins."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for column in columns:
        held = column[order]
        new[1:] |= held[1:] != held[:-1]
    return order, np.flatnonzero(new)


def _added(at: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, at) if len(at) else np.zeros(0, np.int64)


def _sizes(at: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(at, n))


def _flags(column: pa.Array, bounds: np.ndarray) -> np.ndarray:
    return np.repeat(column.to_numpy(zero_copy_only=False).astype(np.int64), np.diff(bounds))


def _word_rows(marked: DataFrame) -> DataFrame:
    """Counts of words by piece; rows with a ``prev`` are pairs that are common in a piece instead."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, PIECE):
            word, prev, last, bounds = _tokens(batch.column(0))
            if not len(word):
                continue
            target = _flags(batch.column(1), bounds)
            order, at = _runs(word)
            sums = [_added(at, x[order]) for x in (target, np.ones_like(target), target * (1 - last), 1 - last)]
            # Only pairs of words that are as common themselves can be: few tokens are sorted again.
            often = np.zeros(len(word), bool)
            often[order] = np.repeat(sums[1] * COMMON_PAIRS >= len(word), sums[1])
            own = np.flatnonzero(often & (prev != OPENING))
            by_pair, first = _runs(prev[own], word[own])
            n = _sizes(first, len(own))
            met = n * COMMON_PAIRS >= len(word)
            kept, n = own[by_pair[first[met]]], n[met]
            none = np.zeros(len(n), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.nulls(len(at), pa.int64()), pa.array(prev[kept])]),
                    pa.array(np.concatenate([word[order[at]], word[kept]])),
                    *(pa.array(np.concatenate(x)) for x in zip(sums, (none, n, none, none), strict=True)),
                ],
                ["prev", "word", *COUNTS],
            )

    return marked.select("text", "target").mapInArrow(count, f"prev long, word long, {' long, '.join(COUNTS)} long")


def _columns(rows: DataFrame, names: list[str]) -> np.ndarray:
    """A bounded table on the driver, by column."""
    held = rows.select(*names).toArrow()
    return np.stack([held.column(c).to_numpy().astype(np.int64) for c in names])


def _count_pairs(marked: DataFrame, common: Common) -> DataFrame:
    """How often each of the common pairs occurs in the targets and in all rows."""
    sent = send(marked.sparkSession, common)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = unpack(sent)
        sums = np.zeros((2, known.pairs.shape[1]), np.int64)
        for batch in in_pieces(batches, PIECE):
            word, prev, _, bounds = _tokens(batch.column(0))
            at = known.pair_places(prev, word)
            target = _flags(batch.column(1), bounds)[at >= 0]
            at = at[at >= 0]
            sums[0] += np.bincount(at[target == 1], minlength=sums.shape[1])
            sums[1] += np.bincount(at, minlength=sums.shape[1])
        met = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays([pa.array(met), *map(pa.array, sums[:, met])], ["place", "target", "total"])

    found = marked.select("text", "target").mapInArrow(count, "place long, target long, total long")
    return found.groupBy("place").agg(F.sum("target").alias("target"), F.sum("total").alias("total"))


def train(docs: DataFrame, labels: DataFrame) -> MatchedModels:
    """Models over all documents: target are those labelled of good quality, background is all.

    Labels that are NULL say nothing; a document with several labels is a target if one says so.
    Without a target both models are the uniform one. Only totals, common words and common pairs reach
    the driver. A pair is common if the pieces of text where it has its share hold that share of all
    tokens of it: a pair with twice the share always does.
    """
    good = labels.filter("quality = 1 and doc_id is not null").select("doc_id").distinct()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    good = stored(good, "good")
    if good.count() <= BROADCAST_IDS:
        good = F.broadcast(good)
    marked = rows.join(good.withColumn("target", F.lit(True)), "doc_id", "left").select(
        "row", "doc_id", "text", F.coalesce("target", F.lit(False)).alias("target")
    )
    counted = _word_rows(marked).groupBy("prev", "word").agg(*[F.sum(c).alias(c) for c in COUNTS])
    counted = stored(counted, "words")
    single = counted.filter("prev is null").drop("prev")
    n = single.agg(F.sum("target").alias("target"), F.sum("total").alias("total"), F.count(F.lit(1)).alias("kinds")).first()
    mass = (n["target"] or 0, n["total"] or 0)
    held = _columns(single.filter(F.col("total") * COMMON_WORDS >= mass[1]), ["word", *COUNTS])
    held = held[:, np.argsort(held[0])]
    pairs = _columns(counted.filter(F.col("prev").isNotNull() & (F.col("total") * COMMON_PAIRS >= mass[1])), ["prev", "word"])
    pairs = pairs[:, np.argsort(_pair_keys(pairs[0], pairs[1]))]
    common = Common(mass, n["kinds"], held[0], held[1:], pairs, np.zeros(pairs.shape, np.int64))
    if pairs.shape[1]:
        found = _columns(_count_pairs(marked, common), ["place", "target", "total"])
        common.pair_counts[:, found[0]] = found[1:]
    return MatchedModels(docs, marked, single, common)


def _lists(values: np.ndarray, cuts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values))


def _dealt(rows: DataFrame, common: Common, counts: bool, scored: bool) -> DataFrame:
    """Tokens of all rows by group, a record per piece and group; and per piece what is known of its rows.

    A group's record holds its rows once and, sorted by word, each different token of a row.
    """
    sent = send(rows.sparkSession, common)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, PIECE):
            for at in range(0, len(batch), PIECE_ROWS):
                yield batch.slice(at, PIECE_ROWS)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = unpack(sent)
        for batch in pieces(batches):
            row = batch.column(0).to_numpy()
            word, prev, last, bounds = _tokens(batch.column(2))
            owner = np.repeat(np.arange(len(row)), np.diff(bounds))
            alone = known.word_places(word)
            place = np.full(len(word), -1)
            often = np.flatnonzero(alone >= 0)
            place[often] = known.pair_places(prev[often], word[often])
            at = np.flatnonzero(place >= 0)
            if scored:
                held = known.losses(prev[at], 1, last[at], known.pair_counts[:, place[at]], known.word_counts[:, alone[at]])
                direct = [np.bincount(owner[at], x, len(row)).astype(np.float64) for x in held]
                whole = np.array([0, len(row)])
                yield _record(
                    [int(row[0]) % known.groups],
                    {
                        "rows": _lists(_steps(row, whole), whole),
                        "doc_id": pa.ListArray.from_arrays(pa.array(whole.astype(np.int32)), batch.column(1).cast(pa.int64())),
                        "tokens": _lists(np.diff(bounds).astype(np.int64), whole),
                        "loss": _lists(direct[0], whole),
                        "background_loss": _lists(direct[1], whole),
                    },
                    counts,
                    scored,
                )
            rest = np.flatnonzero(place < 0)
            if not len(rest):
                continue
            word, prev, last, owner, alone = word[rest], prev[rest], last[rest], owner[rest], alone[rest]
            mixed = words.mix(word.view(np.uint64) ^ np.where(alone >= 0, _pair_keys(prev, word), np.uint64(0)))
            group = (mixed % np.uint64(known.groups)).astype(np.int64)
            order, first = _runs(owner, prev, word, group)
            n, last, kept = _sizes(first, len(order)), _added(first, last[order]), order[first]
            group, owner = group[kept], owner[kept]
            before = known.numbers(prev[kept])
            rare = np.flatnonzero(before == RARE)
            code, local = np.unique(group * len(row) + owner, return_inverse=True)
            met = np.unique(group)
            row_cuts = np.append(np.searchsorted(code // len(row), met), len(code))
            cuts = np.append(np.searchsorted(group, met), len(group))
            local = local - np.repeat(row_cuts[:-1], np.diff(cuts))
            target = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
            yield _record(
                met,
                {
                    "rows": _lists(_steps(row[code % len(row)], row_cuts), row_cuts),
                    "target": _lists(target[code % len(row)], row_cuts),
                    "at": _lists(local.astype(np.int16), cuts),
                    "word": _lists(word[kept], cuts),
                    "before": _lists(before.view(np.int16), cuts),
                    "prev": _lists(prev[kept][rare], np.searchsorted(rare, cuts)),
                    "n": _lists(n.astype(np.int32), cuts),
                    "last": _lists(last.astype(np.int32), cuts),
                },
                counts,
                scored,
            )

    return rows.select("row", "doc_id", "text", "target").mapInArrow(
        deal, f"grp long, counts boolean, scored boolean, {TOKENS}, {SUMS}"
    )


#: Arrays of the records, by element type; ``place`` is in those of sums only.
ARRAYS = {
    "rows": pa.int64(), "target": pa.bool_(), "at": pa.int16(), "word": pa.int64(), "before": pa.int16(), "prev": pa.int64(), "n": pa.int32(),
    "last": pa.int32(), "doc_id": pa.int64(), "place": pa.int16(), "tokens": pa.int64(), "loss": pa.float64(), "background_loss": pa.float64(),
}


BLOCK_NAMES = ["block", "place", "doc_id", "tokens", "loss", "background_loss"]


def _steps(row: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """In each list the first row, then the difference of each to the one before: mostly 1."""
    steps = np.diff(row, prepend=0)
    steps[cuts[:-1]] = row[cuts[:-1]]
    return steps


def _rows(table: pa.Table) -> np.ndarray:
    """The rows of all lists of ``_steps``."""
    steps, n = _flat(table, "rows"), _lengths(table, "rows")
    total = np.concatenate([[0], np.cumsum(steps)])
    return total[1:] - np.repeat(total[np.cumsum(n) - n], n)


def _lengths(table: pa.Table, name: str) -> np.ndarray:
    return pa.compute.list_value_length(table.column(name)).to_numpy().astype(np.int64)


def _record(group, held: dict[str, pa.Array], counts: bool, scored: bool) -> pa.RecordBatch:
    n = len(group)
    lists = [held.get(name, pa.nulls(n, pa.list_(kind))) for name, kind in ARRAYS.items() if name != "place"]
    flags = [pa.array([x] * n, pa.bool_()) for x in (counts, scored)]
    return pa.RecordBatch.from_arrays([pa.array(np.array(group, np.int64)), *flags, *lists], ["grp", "counts", "scored", *(x for x in ARRAYS if x != "place")])


def _flat(table: pa.Table, name: str) -> np.ndarray:
    chunks = [c.flatten() for c in table.column(name).chunks]
    parts = [c.to_numpy(zero_copy_only=False) for c in chunks]
    return np.concatenate(parts) if parts else np.zeros(0, ARRAYS[name].to_pandas_dtype())


def _scored(table: pa.Table, known: Common) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows of a group that are to be scored, and the losses of their tokens in it under both models.

    All tokens of a word fall into one turn, a range of hashes.
    """
    rows_of, n_of = _lengths(table, "rows"), _lengths(table, "at")
    row, target = _rows(table), _flat(table, "target")
    word, before, rare = _flat(table, "word"), _flat(table, "before").view(np.uint16), _flat(table, "prev")
    n, last = _flat(table, "n"), _flat(table, "last")
    owner = (_flat(table, "at") + np.repeat(np.cumsum(rows_of) - rows_of, n_of)).astype(np.int32)
    counted = np.repeat(table.column("counts").to_numpy(), n_of)
    sums = [np.zeros(len(row)), np.zeros(len(row))]
    turns = -(-len(word) // TURN_TOKENS)
    turn = (words.mix(word.view(np.uint64) + np.uint64(1)) % np.uint64(max(turns, 1))).astype(np.int16)
    rare_at = np.cumsum(before == RARE, dtype=np.int32)
    for i in range(turns):
        own = np.flatnonzero(turn == i)
        prev = known.hashes(before[own], rare[rare_at[own][before[own] == RARE] - 1])
        at = owner[own]
        found = _losses(known, word[own], prev, n[own].astype(np.int64), last[own].astype(np.int64), counted[own], target[at])
        for total, (order, loss) in zip(sums, found, strict=True):
            total += np.bincount(at[order], loss, len(row))
    asked = np.repeat(table.column("scored").to_numpy(), rows_of)
    return row[asked], [x[asked] for x in sums]


def _losses(known: Common, word, prev, n, last, counted, good) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Under both models, an order of the tokens and their losses in it, from the counts of these tokens."""
    order, first = _runs(prev, word)
    word, prev, n, last, counted, good = (x[order] for x in (word, prev, n, last, counted, good))
    size = _sizes(first, len(order))
    held = [n * (counted & good), n * counted]
    pair = [np.repeat(_added(first, x), size) for x in held]
    begins = np.flatnonzero(np.diff(word, prepend=~word[:1]) != 0)
    held += [(n - last) * (counted & good), (n - last) * counted]
    sums = np.stack([_added(begins, x) for x in held])
    place = known.word_places(word[begins])
    sums[:, place >= 0] = known.word_counts[:, place[place >= 0]]
    size = _sizes(begins, len(word))
    for loss in known.losses(prev, n, last, pair, [np.repeat(x, size) for x in sums]):
        yield order, loss


def _blocks(row: np.ndarray, sums: dict[str, pa.Array]) -> pa.Table:
    """Sums of rows, a record per block of rows."""
    order = np.argsort(row, kind="stable")
    block = row[order] >> BLOCK_BITS
    met = np.flatnonzero(np.diff(block, prepend=-1))
    cuts = pa.array(np.append(met, len(row)).astype(np.int32))
    place = pa.array((row[order] & ((1 << BLOCK_BITS) - 1)).astype(np.int16))
    lists = [pa.ListArray.from_arrays(cuts, x.take(pa.array(order))) for x in sums.values()]
    return pa.Table.from_arrays([pa.array(block[met]), pa.ListArray.from_arrays(cuts, place), *lists], BLOCK_NAMES)


def _judge(table: pa.Table, known: Common) -> pa.Table:
    """What a group knows of its rows, by block."""
    heads = table.filter(pa.compute.is_valid(table.column("tokens")))
    dealt = table.filter(pa.compute.is_null(table.column("tokens")))
    known_of = {c: pa.concat_arrays([x.flatten() for x in heads.column(c).chunks] or [pa.nulls(0, ARRAYS[c])]) for c in BLOCK_NAMES[2:]}
    out = [_blocks(_rows(heads), known_of)]
    if len(dealt):
        row, losses = _scored(dealt, known)
        none = [pa.nulls(len(row), pa.int64())] * 2
        out.append(_blocks(row, dict(zip(BLOCK_NAMES[2:], [*none, *map(pa.array, losses)], strict=True))))
    return pa.concat_tables(out)


def _total(table: pa.Table) -> pa.Table:
    """Sums per row of a block."""
    place = _flat(table, "place").astype(np.int64)
    sums = [np.bincount(place, _flat(table, c), 1 << BLOCK_BITS) for c in ("loss", "background_loss")]
    tokens = pa.concat_arrays([x.flatten() for x in table.column("tokens").chunks])
    ids = pa.concat_arrays([x.flatten() for x in table.column("doc_id").chunks])
    heads = np.flatnonzero(tokens.is_valid().to_numpy(zero_copy_only=False))
    at = place[heads]
    return pa.Table.from_arrays(
        [ids.take(pa.array(heads)), tokens.take(pa.array(heads)), *(pa.array(x[at]) for x in sums)],
        ["doc_id", "n_tokens", "loss", "background_loss"],
    )


def score(docs: DataFrame, models: MatchedModels) -> DataFrame:
    """Per document: tokens, mean loss under both models, and the mean difference per token.

    ``score`` is the target's cross-entropy less the background's: the lower, the more the text
    resembles the target. A NULL or empty text has no tokens and scores 0. One row per input row,
    repeated rows and NULL ids included; very long texts are scored whole; an empty table gives no
    rows; other columns of the input are not read.

    Documents the models were trained on are counted and scored in one reading; with others, those of
    the models are read again to be counted.
    """
    tokens = models.common.mass[1]
    own = docs.sameSemantics(models.docs)
    if not own:
        tokens += (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 4
    common = replace(models.common, groups=max(1, math.ceil(tokens / GROUP_TOKENS)))
    dealt = _dealt(models.marked, common, True, own)
    if not own:
        rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", F.lit(False).alias("target"))
        dealt = dealt.unionAll(_dealt(rows, common, False, True))
    sent = send(docs.sparkSession, common)

    def judge(table: pa.Table) -> pa.Table:
        return _judge(table, unpack(sent))

    # About one group a task: several would be sorted together in memory.
    blocks = dealt.repartition(common.groups, "grp").groupBy("grp").applyInArrow(judge, f"block long, place array<smallint>, {SUMS}")
    out = blocks.groupBy("block").applyInArrow(_total, "doc_id long, n_tokens long, loss double, background_loss double")
    per_token = lambda x: x / F.greatest("n_tokens", F.lit(1))
    return out.select(
        "doc_id",
        "n_tokens",
        per_token(F.col("loss")).alias("target_entropy"),
        per_token(F.col("background_loss")).alias("background_entropy"),
        per_token(F.col("loss") - F.col("background_loss")).alias("score"),
    )


ship(__name__)
