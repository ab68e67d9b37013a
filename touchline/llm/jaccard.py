"""Documents joined by the Jaccard similarity of their word shingles: T-occurrence search.

Two sets of sizes n and m link when they share at least T = ceil(85 (n + m) / 185) shingles. All
shingles have one global order, rare ones first (by how many sets hold them, counted over all
documents in hashed buckets; any order gives the same links). A set's short lists are those of its
first n - ceil(0.85 n) + c shingles: linked sets meet in at least c of them (c is 1). Spark groups
these lists; candidates that meet often enough, and whose parity sketches allow a link, are then
searched block by block with DivideSkip, which merges the shortest inverted lists of a block with a heap and probes
the longest by binary search.

Equal sets are one class and searched once. In a list that many near copies share, pairs of documents
known to be connected are not formed again: some leaders are compared with all of the list first, and
only what stays unconnected is paired, once for a run of common lists, which leaves the components
exact.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.llm import hashed, words
from touchline.llm.shared import in_pieces, lean, send, ship, stored, text_bytes, unpack

SHINGLE = 4
PERCENT = 85
HEAT_BITS = 20
MEETINGS = 1
#: A list of so many sets or more goes through turns of so many leaders before its pairs are formed. The last
#: turn is repeated, ``TURNS`` in all at most, while more than ``LEFT`` pairs a row are left in such lists and
#: the turn before took away a share of ``GAIN`` of those it met.
LONG, LEADERS, TURNS, LEFT, GAIN = 4, (2, 8), 4, 16, 0.25
#: Lists before a meeting that are looked at for an earlier one of the same pair.
BEFORE = 4
SKETCH = ["s0", "s1", "s2", "s3"]
BROADCAST_IDS = 1_000_000
#: Ids or edges, of a known number, for which one more task writes a small table.
A_TASK = 100_000
#: Sets, and shingles, that a task of the search holds.
BLOCK, HELD = 512, 1 << 17
PIECE = 500_000
MU = 0.01


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, sorted. ASCII case is folded."""
    data, offsets = text_bytes(column)
    found, _ = words.segments(words.LOWER[data], offsets, words.SPACE)
    hashes, bounds = words.windows(found, SHINGLE)
    sets = [np.unique(hashes[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
    counts = found.counts()
    for size in range(1, SHINGLE):
        short = np.flatnonzero(counts == size)
        if len(short):
            own, at = words.windows(found, size)
            for i in short:
                sets[i] = own[at[i] : at[i] + 1]
    return sets


def needed(n: int, m: int) -> int:
    """Least overlap of linked sets of these sizes."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def divide_skip(query: np.ndarray, members: list[np.ndarray]) -> list[int]:
    """Places of the members that link with the query set.

    Inverted lists of the query's shingles over the block are cut into long ones, at most T - 1, and
    short ones. Members that occur in the short lists often enough are looked up in the long lists
    until the overlap is reached or out of reach.
    """
    if not len(query) or not members:
        return []
    owner = np.repeat(np.arange(len(members)), [len(m) for m in members])
    every = np.concatenate(members)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    lo, hi = np.searchsorted(every, query, "left"), np.searchsorted(every, query, "right")
    lists = [owner[a:b].tolist() for a, b in zip(lo.tolist(), hi.tolist(), strict=True) if b > a]
    lists.sort(key=len)
    need = [needed(len(query), len(m)) for m in members]
    least = min(need)
    longest = len(lists[-1]) if lists else 1
    n_long = min(least - 1, int(least / (MU * np.log2(longest + 1) + 1)), len(lists))
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    found, run, last = [], 0, -1

    def close(member: int, count: int) -> None:
        for i, row in enumerate(long):
            if count >= need[member] or count + len(long) - i < need[member]:
                break
            at = bisect_left(row, member)
            count += at < len(row) and row[at] == member
        if count >= need[member]:
            found.append(member)

    for member in heapq.merge(*short):
        if member != last:
            if run and run >= need[last] - n_long:
                close(last, run)
            last, run = member, 0
        run += 1
    if run and run >= need[last] - n_long:
        close(last, run)
    return found


def heat(docs: DataFrame) -> np.ndarray:
    """How many sets hold shingles of each of 2**20 hash buckets, over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((1, 1 << HEAT_BITS), np.int64)
        for batch in in_pieces(batches, PIECE):
            sets = shingle_sets(batch.column(0))
            bucket = (np.concatenate(sets) >> np.uint64(64 - HEAT_BITS)).astype(np.int64)
            held[0] += np.bincount(bucket, minlength=held.shape[1])
        yield from hashed.packed(held)

    return hashed.collected(docs.select("text").mapInArrow(lean(count), hashed.PACKED), 1, 1 << HEAT_BITS)[0]


def prefixes(docs: DataFrame, heats: np.ndarray) -> DataFrame:
    """Per row of (``doc_id``, ``text_hash``, ``text``): set size, 128-bit digest, two sketches, and its
    short lists' shingles in global order.

    A sketch has a bit for each of 256 hash buckets: whether an odd number of shingles falls there.
    Two sets differ in at least as many shingles as their sketches differ in bits. ``wide`` is such a
    sketch of twice as many buckets as shingles, or more: a power of two, 64 at least.
    """
    sent = send(docs.sparkSession, heats)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heats = unpack(sent)
        for batch in in_pieces(batches, PIECE):
            sizes, first, second, tokens, sketches, wide = [], [], [], [], [], []
            for own in shingle_sets(batch.column(2)):
                n = len(own)
                mixed = words.mix(own)
                sizes.append(n)
                first.append(mixed.sum(dtype=np.uint64))
                second.append(words.mix(mixed + np.uint64(words.GOLDEN)).sum(dtype=np.uint64))
                odd = np.bincount((mixed >> np.uint64(56)).astype(np.int64), minlength=256) & 1
                sketches.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
                buckets = max(64, 1 << max(2 * n - 1, 1).bit_length())
                odd = np.bincount((mixed & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets) & 1
                wide.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
                least = -(-PERCENT * n // 100)
                keep = n - least + min(MEETINGS, least)
                order = np.argsort(heats[(own >> np.uint64(64 - HEAT_BITS)).astype(np.int64)], kind="stable")
                tokens.append(own[order[:keep]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(np.array(sizes, np.int64)),
                    pa.array(np.array(first, np.uint64).view(np.int64)),
                    pa.array(np.array(second, np.uint64).view(np.int64)),
                    *map(pa.array, np.stack(sketches, axis=1)),
                    pa.array(wide, pa.list_(pa.int64())),
                    pa.array(tokens, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "n", "d1", "d2", *SKETCH, "wide", "tokens"],
            )

    return docs.select("doc_id", "text_hash", "text").mapInArrow(
        lean(cut),
        f"doc_id long, text_hash long, n long, d1 long, d2 long, {' long, '.join(SKETCH)} long, "
        "wide array<long>, tokens array<long>",
    )


def search(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of candidate pairs (a, b), those that link. Each a is a query over the inverted lists of its b.

    The partners of a query are one partition of the corpus, or several of about ``BLOCK`` sets if they
    are more; they stream past the query in blocks of that many sets, or ``HELD`` shingles, so no task
    holds more than a block.
    """
    asked = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > BLOCK)
    parts = F.ceil(F.coalesce("m", F.lit(1)) / BLOCK)
    salted = pairs.join(asked, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), parts).cast("int").alias("salt"))
    left, right = texts.toDF("a", "text"), texts.toDF("b", "text")
    members = salted.join(right, "b").select("a", "salt", "b", "text")
    queries = salted.select("a", "salt").distinct().join(left, "a")
    rows = queries.select("a", "salt", F.lit(None).cast("long").alias("b"), "text").unionAll(members)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, asked, block, ids, held = None, [], [], [], 0

        def flush() -> list[tuple[int, int]]:
            nonlocal held
            held = 0
            hits = {(key[0], ids[i]) for q in asked for i in divide_skip(q, block)} if block else set()
            block.clear()
            ids.clear()
            return sorted(hits)

        for batch in in_pieces(batches, PIECE):
            out = []
            sets = shingle_sets(batch.column(3))
            a, salt, b = (batch.column(i).to_pylist() for i in range(3))
            for i, own in enumerate(sets):
                if key != (a[i], salt[i]):
                    out += flush()
                    key, asked = (a[i], salt[i]), []
                if b[i] is None:
                    asked.append(own)
                    continue
                block.append(own)
                ids.append(b[i])
                held += len(own)
                if len(block) >= BLOCK or held >= HELD:
                    out += flush()
            yield _pairs_batch(out)
        yield _pairs_batch(flush())

    placed = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return placed.mapInArrow(lean(judge), "a long, b long")


def _pairs_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"]
    )


def _few(rows: int) -> int:
    """Tasks that write so many small rows."""
    return max(1, -(-rows // A_TASK))


def components(edges: DataFrame) -> DataFrame:
    """``doc, label`` for every vertex: the smallest vertex of its component.

    In each round every vertex moves to the neighbour (or itself) of least rank and edges are renamed;
    ends when no edge is left. The first round ranks by edges, most first, which takes the leaves of a
    hub at once. The others rank at random, which shrinks the graph by a constant share on average.
    """
    edges = stored(edges.filter("a != b").select("a", "b").distinct(), "edges")
    left = edges.count()
    most = _few(2 * left)
    names = edges.select(F.explode(F.array("a", "b")).alias("doc")).distinct().withColumn("name", F.col("doc"))
    names = stored(names.coalesce(most), "names")
    turn = 0
    while left:
        turn += 1
        rank = lambda n, v: F.struct((-n).alias("n"), F.xxhash64(v, F.lit(turn)).alias("h"), F.col(v).alias("v"))  # noqa: B023, E731
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        count = F.count(F.lit(1))
        if turn == 1:
            both = both.join(both.groupBy(F.col("a").alias("b")).agg(count.alias("n")), "b")
        else:
            both, count = both.withColumn("n", F.lit(0).cast("long")), F.lit(0).cast("long")
        least = both.groupBy("a").agg(F.min(rank(F.col("n"), "b")).alias("m"), count.alias("n"))
        nearest = F.least("m", rank(F.col("n"), "a")).getField("v")
        moved = stored(least.select(F.col("a").alias("old"), nearest.alias("new")).coalesce(_few(2 * left)), "moved")
        half = edges.join(moved, edges["a"] == moved["old"]).select(F.col("new").alias("a"), "b")
        whole = half.join(moved, half["b"] == moved["old"]).select("a", F.col("new").alias("b"))
        edges = stored(whole.filter("a != b").distinct().coalesce(_few(left)), "edges")
        renamed = names.join(moved, names["name"] == moved["old"], "left")
        names = stored(renamed.select("doc", F.coalesce("new", "name").alias("name")).coalesce(most), "names")
        left = edges.count()
    lowest = names.groupBy("name").agg(F.min("doc").alias("label"))
    return names.join(lowest, "name").select("doc", "label")


def _labelled(lists: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return lists.withColumn("label", F.col("doc"))
    return lists.join(labels, "doc", "left").select(*lists.columns, F.coalesce("label", "doc").alias("label"))


def _often_enough(met: DataFrame) -> DataFrame:
    """Pairs whose lists meet as often as those of linked sets must, and whose sizes allow a link."""
    pairs = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("k"), F.min("size").alias("size"))
    return pairs.filter(F.col("k") >= F.least(F.lit(MEETINGS), F.ceil(F.col("size") * PERCENT / 100))).select("a", "b")


def _met(x: DataFrame, y: DataFrame) -> DataFrame:
    """Rows of two lists that meet, are not known to be connected, and may be of linked sets.

    Sizes must be close, sketches must not differ by more than linked sets can, and the meeting must
    be early: one among the first c of a pair leaves T - c shingles or more behind it in both sets.
    """
    both = x.alias("x").join(y.alias("y"), F.col("x.token") == F.col("y.token"))
    smaller, larger = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    behind = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) - 1
    early = (100 + PERCENT) * (behind + MEETINGS) >= PERCENT * (smaller + larger)
    differ = reduce(Column.__add__, [F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in SKETCH])
    close = (100 + PERCENT) * (smaller + larger - differ) >= 2 * PERCENT * (smaller + larger)
    apart = F.col("x.label") != F.col("y.label")
    return both.filter(apart & (100 * smaller >= PERCENT * larger) & early & close).withColumn("size", smaller)


def _led_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """Every document of a list with each of the list's leaders, unless they are connected."""
    row = F.struct("doc", "n", "pos", "label", *SKETCH)
    seeds = [1000 * turn + i for i in range(LEADERS[min(turn, len(LEADERS) - 1)])]
    chosen = [F.min(F.struct(F.xxhash64("doc", F.lit(seed)).alias("h"), row.alias("r"))) for seed in seeds]
    leaders = rows.groupBy("token").agg(F.array(*chosen).alias("all")).select("token", F.explode("all").alias("x"))
    leaders = leaders.select("token", "x.r.*").distinct()
    met = _met(leaders, rows).select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b"), "size")
    return _often_enough(met)


def _left(rows: DataFrame) -> tuple[float, int]:
    """Pairs of the lists outside their largest label, and rows of the lists."""
    per_label = rows.groupBy("token", "label").agg(F.count(F.lit(1)).alias("m"))
    per_list = per_label.groupBy("token").agg(F.sum("m").alias("m"), F.max("m").alias("main"))
    pairs = F.sum(F.col("m").cast("double") * (F.col("m") - F.col("main")))
    return tuple(per_list.agg(F.coalesce(pairs, F.lit(0.0)), F.coalesce(F.sum("m"), F.lit(0))).first())


def _another_turn(turn: int, lefts: list[tuple[float, int]]) -> bool:
    """Whether leaders are worth another turn. ``lefts`` is what was left after each turn but the first ones."""
    if turn < len(LEADERS) or turn >= TURNS:
        return turn < len(LEADERS)
    (before, _), (pairs, rows) = lefts[-2:]
    return pairs > LEFT * rows and pairs <= (1 - GAIN) * before


def _near(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of candidate pairs (a, b), those whose wide sketches differ by no more bits than linked sets can.

    Sizes are close, so one sketch is at most twice as long as the other; folded by XOR of its halves
    it is the sketch of fewer buckets.
    """
    ids = pairs.select(F.col("a").alias("doc")).unionAll(pairs.select("b")).distinct()
    ids = stored(ids.coalesce(_few(2 * pairs.count())), "asked")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    known = stored(sets.select("doc", "n", "wide").join(ids, "doc"), "sketches")
    x, y = known.toDF("a", "n", "x"), known.toDF("b", "m", "y")
    xor = lambda p, q: p.bitwiseXOR(q)

    def folded(long: str, short: str) -> Column:
        half = (F.size(long) / 2).cast("int")
        return F.when(
            F.size(long) > F.size(short), F.zip_with(F.slice(long, F.lit(1), half), F.slice(long, half + 1, half), xor)
        ).otherwise(F.col(long))

    bits = F.transform(F.zip_with(folded("x", "y"), folded("y", "x"), xor), F.bit_count)
    differ = F.aggregate(bits, F.lit(0), lambda total, b: total + b)
    sizes = F.col("n") + F.col("m")
    close = (100 + PERCENT) * (sizes - differ) >= 2 * PERCENT * sizes
    return stored(pairs.join(x, "a").join(y, "b").filter(close).select("a", "b"), "near")


def _left_pairs(rows: DataFrame) -> DataFrame:
    """All pairs that are not known to be connected and may link.

    Only documents outside a list's largest label are paired with the others of the list, so lists of
    one label are left out. A pair that meets in many lists is formed in the first of them, as far as
    the ``BEFORE`` lists before each meeting show it.
    """
    per_label = rows.groupBy("token", "label").agg(F.count(F.lit(1)).alias("m"))
    largest = per_label.groupBy("token").agg(
        F.max_by("label", F.struct("m", "label")).alias("main"), F.count(F.lit(1)).alias("labels")
    )
    mixed = rows.join(largest.filter("labels > 1"), "token").withColumn("minor", F.col("label") != F.col("main"))
    earlier = Window.partitionBy("doc").orderBy("pos").rowsBetween(-BEFORE, -1)
    marked = stored(mixed.drop("labels", "main").withColumn("before", F.collect_list("token").over(earlier)), "mixed")
    once = (~F.col("y.minor") | (F.col("x.doc") < F.col("y.doc"))) & ~F.arrays_overlap("x.before", "y.before")
    met = _met(marked.filter("minor"), marked).filter(once)
    return _often_enough(met.select(F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b"), "size"))


def _texts(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``cls`` and the text of its set, for the classes of the pairs.

    Classes are broadcast below a checked number, else joined. Equal rows are one text.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    wanted = stored(classes.join(ids, "cls").select("cls", "rep.*"), "ids")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    found = docs.join(wanted, ["doc_id", "text_hash"]).select("cls", "text")
    return stored(found.groupBy("cls").agg(F.first("text").alias("text")), "texts")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: components of links of 85 % or more.

    Texts without a word, and NULL texts, have no shingle and link with nothing. Rows with the same id
    are one document: what links with one of their texts is in their component. A NULL id links with
    nothing and its component is NULL. Very long texts are compared whole. Shingles are told apart by
    64 bits of hash. Other columns of the input are not read; an empty table gives no rows.

    Vertices are classes of equal sets. Links between documents that are already connected are not
    looked for, so links are not counted.
    """
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    sets = stored(prefixes(docs, heat(docs)), "prefixes")
    usable = sets.filter("doc_id is not null and n > 0")
    # Equal sets have equal rows but for their ids.
    same = [F.first(c).alias(c) for c in ("n", *SKETCH, "wide", "tokens")]
    merged = usable.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "text_hash")).alias("rep"), *same)
    chosen = stored(merged.withColumn("doc", F.monotonically_increasing_id()), "sets")
    classes = chosen.select("d1", "d2", "rep", F.col("doc").alias("cls"))
    spread = chosen.select("doc", F.posexplode("tokens").alias("pos", "token"))
    shared = chosen.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    # Sizes and sketches join what is left: most shingles are in one set only.
    sizes = chosen.select("doc", F.col("n").cast("int").alias("n"), *SKETCH)
    lists = stored(spread.join(shared, "token").join(sizes, "doc"), "lists")
    links, labelled, turn, lefts = None, _labelled(lists, None), 0, []
    while _another_turn(turn, lefts):
        pairs = _near(stored(_led_pairs(labelled.filter(F.col("k") >= LONG), turn), "pairs"), chosen)
        fresh = stored(search(pairs, _texts(docs, classes, pairs)), "links")
        links = fresh if links is None else links.unionAll(fresh)
        labelled = stored(_labelled(lists, components(links)), "labelled")
        turn += 1
        if len(LEADERS) - 1 <= turn < TURNS:
            lefts.append(_left(labelled.filter(F.col("k") >= LONG)))
    pairs = _near(stored(_left_pairs(labelled), "pairs"), chosen)
    links = links.unionAll(stored(search(pairs, _texts(docs, classes, pairs)), "links"))
    # Rows of one id with different texts are one document, so their classes are linked.
    owned = usable.select("doc_id", "d1", "d2").join(classes.select("cls", "d1", "d2"), ["d1", "d2"])
    several = owned.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("z")).filter("a != z")
    same_id = owned.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("cls").alias("b")).distinct()
    labels = components(links.unionAll(same_id))
    known = classes.join(labels, classes["cls"] == labels["doc"], "left").select(
        "d1", "d2", F.col("rep.doc_id").alias("first"), F.coalesce("label", "cls").alias("label")
    )
    lowest = known.groupBy("label").agg(F.min("first").alias("component"))
    known = stored(known.join(lowest, "label").select("d1", "d2", "component"), "components")
    linked = sets.join(known, ["d1", "d2"], "left")
    component = F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("component")).otherwise(F.col("doc_id"))
    return linked.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


ship(__name__)
