"""Alignment of tokenizers, mixing and the filter audit against brute force, and on awkward tables."""

import hashlib
import re
import string
from collections import Counter
from itertools import permutations

import duckdb
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from touchline.checks.compare import difference, duck
from touchline.llm import alignment, bpe, filter_audit, mixing, oracles, queries
from touchline.llm.shared import table

SF_DIR = "/root/testdata/sf0.001"
BPE_FILE, PIECE_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 997} the of" for i in range(20_000))
SCHEMA = (
    "doc_id long, text string, lang string, source string, row long, size long, place long, target double, mask int, n long, "
    "part string, pairs string, times string, best boolean, end string, range int"
)
AWKWARD = [
    (1, None, None, None), (2, "", "en", "s"), (3, " \n\t ", "", None), (4, "one", "en", "s"), (5, "!!! ???", "fr", "s"),
    (6, "same text here for all of us and you " * 3, "en", "s"), (7, "same text here for all of us and you " * 3, "en", "s"),
    (7, "same text here for all of us and you " * 3, "en", "s"), (None, "a text without an id but with words", "de", None),
    (None, "a text without an id but with words", "de", None), (None, None, None, None), (8, LONG, "en", "t"), (9, LONG + " end", "en", "t"),
    (10, "日本語 テキスト 🙂 é", None, "t"), (11, "x" * 5000, "en", "u"), (12, "A B C\n$", "en", "\U0001f642"),
    (13, "<|endoftext|> <s> <0x41> in text", "en", "t"), (14, "under▁score  two  blanks ", "en", "￮"),
]
ROWS = [(*r, 1, 2, 3, 1.0, 4, 5, "p", "q", "r", True, "e", 0) for r in AWKWARD]
LABELS = [(4, 1, 0), (6, 0, 1), (6, 1, 0), (8, 1, 0), (99, 1, 1), (None, 1, 1), (5, None, None), (7, None, 1)]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def pair():
    return alignment.read_pair(BPE_FILE, PIECE_FILE)


def tables(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", [list(r) for r in rows])
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", [list(r) for r in LABELS])
    return con


# ---- alignment of tokenizers


def plain_links(a, b):
    """Overlaps of two lists of ends, and the groups, by comparing everything with everything."""
    spans = lambda ends: list(zip([0, *ends], ends, strict=False))
    links = [(i, j) for i, (s, e) in enumerate(spans(a)) for j, (t, f) in enumerate(spans(b)) if s < f and t < e]
    common = sorted(set(a) & set(b))
    return links, [(a.index(c) + 1, b.index(c) + 1) for c in common]


@given(st.lists(st.tuples(st.integers(1, 3), st.sampled_from("abcccccccc")), max_size=60))
@settings(max_examples=300, deadline=None)
def test_diagonal_runs_equal_brute_force(steps):
    a, b, at = [], [], 0
    for size, side in steps:
        at += size
        a += [at] if side in "ac" else []
        b += [at] if side in "bc" else []
    a, b = sorted({*a, at + 1}), sorted({*b, at + 1})
    link_a, link_b, ends_a, ends_b = alignment.aligned(a, b)
    links, groups = plain_links(a, b)
    assert list(zip(link_a.tolist(), link_b.tolist(), strict=True)) == links
    assert list(zip(ends_a.tolist(), ends_b.tolist(), strict=True)) == groups


def test_long_runs_are_skipped_whole():
    a = list(range(1, 5001))
    assert [len(x) for x in alignment.aligned(a, a)] == [5000] * 4
    assert [len(x) for x in alignment.aligned([], [])] == [0] * 4


def brute_alignment(rows):
    first = Tokenizer.from_file(BPE_FILE)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECE_FILE)
    bytes_a = bpe.read_vocabulary(BPE_FILE).bytes_of
    found, counts = [], Counter()
    for doc_id, text in rows:
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids
        b = second.encode(text or "")
        own_a = [bytes_a[i] for i in a]
        own_b = []
        for i in b:
            p = second.id_to_piece(i)
            m = re.fullmatch("<0x(..)>", p)
            own_b.append(bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode())
        whole = (" " + (text or "")).encode()
        if not text or b"".join(own_a) != whole or b"".join(own_b) != whole:
            found.append((doc_id, [], [], [], []))
            continue
        i = j = at_a = at_b = 0
        links, groups, start = [], [], (0, 0)
        while i < len(a):
            links.append((a[i], b[j]))
            stop_a, stop_b = at_a + len(own_a[i]), at_b + len(own_b[j])
            if stop_a <= stop_b:
                i, at_a = i + 1, stop_a
            if stop_b <= stop_a:
                j, at_b = j + 1, stop_b
            if stop_a == stop_b:
                groups.append((a[start[0] : i], b[start[1] : j]))
                start = (i, j)
        found.append((doc_id, a, b, groups, links))
        counts.update(links)
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for doc_id, a, b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            doc_id, len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
            sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return sorted(out, key=str)


@pytest.mark.parametrize("common", [1, 50, 1 << 18])
def test_alignment_equals_brute_force(spark, awkward, pair, common):
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text").unionByName(awkward.select("doc_id", "text"))
    got = alignment.measure(docs, pair, common).select(columns).collect()
    assert sorted(map(tuple, got), key=str) == brute_alignment([(r.doc_id, r.text) for r in docs.collect()])


def test_alignment_query(spark):
    rows = queries.QUERIES["op11_tokenizer_alignment"](spark, SF_DIR)
    got = sorted(map(tuple, rows.collect()), key=str)
    assert got == brute_alignment([(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()])


def test_groups_are_given_as_text(spark, pair):
    docs = spark.createDataFrame([(1, "abc def")], "doc_id long, text string")
    row = alignment.align_documents(docs, pair, with_groups=True).first()
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256 and row.groups.count(";") == row.n_groups - 1


# ---- mixing


def plain_targets(sizes):
    """Shares by weight, cut at twice a source, the rest shared again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            target.update({s: left * weight[s] / total for s in free})
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
        left -= sum(2 * sizes[s] for s in over)
        free -= over
    return target


def check_mix(rows, got):
    sizes, largest, taken = Counter(), Counter(), Counter()
    for _, text, _, source in rows:
        n = len(WORD.findall(text or ""))
        sizes[source] += n
        largest[source] = max(largest[source], n)
    target = plain_targets(sizes)
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((i, s, len(WORD.findall(t or ""))) for i, t, _, s in rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source], rel=1e-12)
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6


def test_mix_of_documents(spark):
    docs = table(spark, SF_DIR, "documents")
    source = {r.doc_id: r.source for r in docs.collect()}
    out = mixing.mix(docs).collect()
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    got = [type("R", (), {**r.asDict(), "source": source[r.doc_id]}) for r in out]
    check_mix(rows, got)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


def test_mix_of_awkward_rows(spark, awkward):
    con = tables(AWKWARD)
    assert difference(mixing.mix(awkward), con, oracles.MIXING) is None
    empty = mixing.mix(awkward.limit(0))
    assert empty.count() == 0 and empty.dtypes == mixing.mix(awkward).dtypes


def test_mix_splits_equal_rows(spark):
    """A third of the rows and more are equal in id and text: some of them are taken, as many as needed."""
    text = "five words are in here"
    rows = [(None, text, "en", "a")] * 400 + [(i, f"{text} {i}", "en", "b") for i in range(300)] + [(3, "x " * 50, "en", "c")] * 100
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    target = plain_targets({"a": 2000, "b": 1800, "c": 5000})
    taken = {r["size"]: r.taken for r in mixing.mix(docs).groupBy("size").agg(F.sum("taken").alias("taken")).collect()}
    assert abs(taken[5] - target["a"]) <= 2.5 and abs(taken[6] - target["b"]) <= 3 and abs(taken[50] - target["c"]) <= 25


def test_mix_of_many_sources(spark):
    rows = [(i, " ".join(["w"] * (1 + i * i % 97)), "en", f"s{i % 211}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert difference(mixing.mix(docs), tables(rows), oracles.MIXING) is None


def test_mix_without_broadcast(spark, monkeypatch):
    expected = sorted(map(tuple, mixing.mix(table(spark, SF_DIR, "documents")).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, mixing.mix(table(spark, SF_DIR, "documents")).collect())) == expected


@pytest.mark.parametrize("name", ["op12_source_mixing", "op13_filter_audit"])
def test_queries_equal_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF_DIR), duck(SF_DIR), oracles.ORACLES[name]) is None


def test_mixing_runs_no_python(spark):
    plan = mixing.mix(table(spark, SF_DIR, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# ---- filter audit


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails, out = [], Counter()
    for doc_id, text, lang, _ in rows:
        text = text or ""
        words = WORD.findall(text)
        smaller = any(doc_id is not None and o is not None and o < doc_id and (t or "") == text for o, t, _, _ in rows)
        own = [
            len(words) < 200, 100 * len(set(words)) < 50 * len(words),
            100 * sum(c in string.ascii_uppercase for c in text) > 3 * len(text), bool(re.search("[#$%&*|]", text)), smaller,
        ]
        fails.append((lang or "", doc_id, {f for f, bad in zip("ABCDE", own, strict=True) if bad}))
    for part in {p for p, _, _ in fails}:
        for order in map("".join, permutations("ABCDE")):
            for k, f in enumerate(order):
                key, before = (part, order, k + 1), set(order[:k])
                here = [(i, x) for p, i, x in fails if p == part]
                gone = [i for i, x in here if f in x and not x & before]
                out[key, "kept"] += sum(not x & {f, *before} for _, x in here)
                out[key, "removed"] += len(gone)
                out[key, "redundant"] += sum(f in x and bool(x & before) for _, x in here)
                out[key, "unique_fails"] += sum(x == {f} for _, x in here)
                out[key, "good_lost"] += sum(i in good for i in gone)
                out[key, "toxic_lost"] += sum(i in toxic for i in gone)
                out[(part, f), "shapley"] += len(gone)
    return out


def test_audit_equals_brute_force_and_sql(spark, awkward, labels):
    got = filter_audit.audit(awkward, labels)
    expected = plain_audit(AWKWARD, LABELS)
    rows = got.collect()
    assert len(rows) == 600 * len({r[2] or "" for r in AWKWARD})
    for r in rows:
        key = (r.part, r.filter_order, r.step)
        assert [r[c] for c in filter_audit.COUNTS] == [expected[key, c] for c in filter_audit.COUNTS]
        assert r.shapley == expected[(r.part, r.filter_order[r.step - 1]), "shapley"]
    assert difference(got, tables(AWKWARD), oracles.AUDIT) is None


def test_audit_of_empty_tables(spark, awkward, labels):
    empty = filter_audit.audit(awkward.limit(0), labels)
    assert empty.count() == 0 and empty.dtypes == filter_audit.audit(awkward, labels).dtypes
    none = filter_audit.audit(awkward, labels.limit(0)).agg(F.sum(F.col("good_lost") + F.col("toxic_lost"))).first()[0]
    assert none == 0


def test_alignment_of_an_empty_table(awkward, pair):
    empty = alignment.measure(awkward.limit(0), pair)
    assert empty.count() == 0 and empty.dtypes == alignment.measure(awkward, pair).dtypes
