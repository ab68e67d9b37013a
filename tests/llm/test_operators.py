"""Each operator against a brute-force version, and on awkward and empty tables."""

import binascii
import hashlib
import json
import math
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from touchline.llm import (
    bpe, charlm, decontaminate, jaccard, language, licences, lm_scoring, quality, queries, shared, sharding, token_rollup,
    toxicity, words,
)
from touchline.llm.shared import in_pieces, remainder, table, text_bytes

SF_DIR = "/root/testdata/sf0.001"
BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 997} the of" for i in range(20_000))
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, n int, label string, "
    "token long, rank int, a long, kept boolean, target boolean, size long"
)
AWKWARD = [
    (1, None, None, None), (2, "", "en", "s"), (3, " \n\t ", "en", None), (4, "one", "en", "s"), (5, "!!! ???", "fr", "s"),
    (6, "same text here for all of us and you " * 3, "en", "s"), (7, "same text here for all of us and you " * 3, "en", "s"),
    (7, "same text here for all of us and you " * 3, "en", "s"), (None, "a text without an id but with words", "de", None),
    (None, None, None, None), (8, LONG, "en", "t"), (9, LONG + " end", "en", "t"), (10, "日本語 テキスト 🙂 é", None, "t"),
    (11, "x" * 5000, "en", "t"), (12, "a\nb\na\nb\n\n", "en", "t"), (13, "<|endoftext|> in text", "en", "t"),
    (14, "Licensed under the Apache License, Version 2.0.\n\nMore", "en", "t"),
]
ROWS = [(*r, len(r[1] or ""), 1.0, 1, "x", 5, 6, 7, True, False, 3) for r in AWKWARD]
LABELS = [(4, 1, 0), (6, 0, 1), (6, 1, 0), (8, 1, 0), (99, 1, 1), (None, 1, 1), (5, None, None)]
BENCH = [(1, "one two three"), (2, None), (3, ""), (4, "Ann has 3 apples and Bob gives Ann 5 km more apples today"), (None, "x y z w v")]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(BENCH, "item_id long, text string")


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF_DIR, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def every_operator(labels, bench):
    ranks = queries.read_ranks("byte_bpe_50k")
    return {
        "op1": lambda d: lm_scoring.score(d, lm_scoring.train(d, labels)),
        "op2": lambda d: bpe.encode_documents(d, bpe.read_vocabulary(BPE_FILE), with_ids=True),
        "op3": lambda d: decontaminate.contaminated(d, bench),
        "op4": quality.rate,
        "op5": jaccard.near_duplicates,
        "op6": lambda d: token_rollup.count_tokens(d, "bpe", public_tokenizers.PATTERN, ranks),
        "op7": lambda d: licences.scan(d, licences.train(d)),
        "op8": sharding.interleave,
        "op9": lambda d: language.identify(d, language.train(d)),
        "op10": lambda d: toxicity.score(d, toxicity.train(d, labels), spans=True),
    }


@pytest.mark.parametrize("name", [f"op{n}" for n in range(1, 11)])
def test_awkward_and_empty_tables(spark, awkward, labels, bench, name):
    run = every_operator(labels, bench)[name]
    rows = run(awkward).collect()
    per_row = {"op1": 1, "op2": 1, "op4": 1, "op5": 1, "op6": 2, "op8": 1, "op9": 1, "op10": 1}
    if name in per_row:
        assert len(rows) == per_row[name] * len(AWKWARD)
    assert run(awkward.limit(0)).count() == 0
    assert [tuple(f) for f in run(awkward.limit(0)).dtypes] == [tuple(f) for f in run(awkward).dtypes]


def test_empty_side_tables(awkward, labels, bench):
    assert decontaminate.contaminated(awkward, bench.limit(0)).count() == 0
    assert toxicity.score(awkward, toxicity.train(awkward, labels.limit(0))).agg(F.max("score")).first()[0] < 1e-6
    scored = lm_scoring.score(awkward, lm_scoring.train(awkward, labels.limit(0)))
    assert scored.filter("score is null or isnan(score)").count() == 0


def test_lm_scoring_prefers_the_target(spark):
    good, bad = "the good words come in this order", "some other tokens stand here instead"
    rows = [(i, (good if i % 2 else bad) + f" n{i}") for i in range(40)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1) for i in range(1, 30, 2)], "doc_id long, quality int")
    model = lm_scoring.train(d, marks)
    got = {r.doc_id: r for r in lm_scoring.score(d, model).collect()}
    assert max(got[i].score for i in range(1, 40, 2)) < min(got[i].score for i in range(0, 40, 2))
    assert all(math.isclose(r.score, r.target_entropy - r.background_entropy, abs_tol=1e-9) for r in got.values())


def brute_entropies(rows, targets, scored):
    """Mean losses of texts under exact bigram models."""
    def pairs(text):
        found = [w.lower() for w in WORD.findall(text)]
        return list(zip([None, *found], found))

    both = [[p for i, t in rows if i in targets for p in pairs(t)], [p for _, t in rows for p in pairs(t)]]
    mass, kinds, out = len(both[0]), len({w for _, w in both[1]}) + 1, {}
    counts = [(Counter(b), Counter(w for _, w in b), Counter(v for v, _ in b if v), mass / len(b)) for b in both]
    for i, text in scored:
        means = []
        for pair, word, context, x in counts:
            loss = 0.0
            for v, w in pairs(text):
                alone = (word[w] * x + 1 / kinds) / (mass + 1)
                loss -= math.log(alone if v is None else (pair[v, w] * x + 20 * alone) / (context[v] * x + 20))
            means.append(loss / max(len(pairs(text)), 1))
        out[i] = means
    return out


def test_lm_counts_are_exact_beyond_any_table(spark):
    # More words than the 2**18 buckets of a fixed table.
    wide = [(100 + i, " ".join(f"w{i}x{j}" for j in range(3_000))) for i in range(100)]
    rows = [(1, "the first of the words"), (2, "The other one of the words"), *wide]
    new = [(7, "the words never seen of w3x5 w3x6"), (8, "")]
    model = lm_scoring.train(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, 1), (103, 1)], "doc_id long, quality int")
    )
    assert model.kinds == model.words.count() == 300_006
    for scored in (rows, new):
        got = lm_scoring.score(spark.createDataFrame(scored, "doc_id long, text string"), model).collect()
        want = brute_entropies(rows, {1, 103}, scored)
        assert len(got) == len(scored)
        for r in got:
            assert [r.target_entropy, r.background_entropy] == pytest.approx(want[r.doc_id], abs=1e-9)


def test_lm_scores_do_not_depend_on_pieces_groups_or_what_is_common(spark, monkeypatch):
    for name, value in {"COMMON_WORDS": 8, "COMMON_PAIRS": 8, "PIECE": 300, "PIECE_ROWS": 3, "GROUP_TOKENS": 60, "TURN_TOKENS": 9}.items():
        monkeypatch.setattr(lm_scoring, name, value)
    rows = [(i, " ".join(["very often"] * (i % 4) + [f"w{(i * j) % 23}" for j in range(i % 13)])) for i in range(60)]
    rows.append((60, "very often " * 200))
    targets = {i for i in range(60) if i % 3 == 0}
    d = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm_scoring.train(d, spark.createDataFrame([(i, 1) for i in targets], "doc_id long, quality int"))
    common = model.common
    assert 0 < len(common.words) <= 8 and 0 < common.pairs.shape[1] <= 8 and len(common.words) < model.kinds
    for scored in (rows, rows[5:20]):
        again = d if scored is rows else spark.createDataFrame(scored, "doc_id long, text string")
        got, want = lm_scoring.score(again, model).collect(), brute_entropies(rows, targets, scored)
        assert sorted(r.doc_id for r in got) == sorted(want)
        for r in got:
            assert [r.target_entropy, r.background_entropy] == pytest.approx(want[r.doc_id], abs=1e-9)


def test_bpe_equals_the_library(docs, texts):
    library = Tokenizer.from_file(BPE_FILE)
    got = {r.doc_id: r for r in bpe.encode_documents(docs, bpe.read_vocabulary(BPE_FILE)).collect()}
    for i, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


ENCODER, LIBRARY = bpe.Encoder(bpe.read_vocabulary(BPE_FILE)), Tokenizer.from_file(BPE_FILE)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text("ab '\nslre1<|>é", max_size=60), st.just("x<|endoftext|>y")), max_size=6))
def test_bpe_on_any_text(batch):
    ids, bounds = ENCODER.encode(*text_bytes(pa.array(batch, pa.string())))
    for i, text in enumerate(batch):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert ENCODER.decode(ids, bounds) == batch


def test_decontamination(spark, bench):
    cases = [
        (1, "before. Ann has 3 apples and Bob gives Ann 5 km more apples today and more"),
        (2, "then Joe has 7 apples and Eve gives Joe 9 km more apples today"),
        (3, "then Joe has 7 apples and Eve gives Max 9 km more apples today"),
        (4, "nothing of this kind is asked in this place at all today"),
    ]
    d = spark.createDataFrame(cases, "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contaminated(d, bench).collect()}
    assert set(got) == {1, 2} and {r.item_id for r in got.values()} == {4}
    assert got[1].verbatim and not got[2].verbatim


def found_items(spark, items, texts):
    """Document and item of each pair reported."""
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(d, asked).collect()}


def test_encoding_holds_small_pieces(texts):
    """What a worker holds while it encodes follows the piece, not the batch."""
    encoder = bpe.Encoder(bpe.read_vocabulary(BPE_FILE))
    text = " ".join(t for t in texts.values() if t)
    batch = pa.RecordBatch.from_arrays([pa.array([text[:200_000]] * 40, pa.string())], ["text"])
    tracemalloc.start()
    for piece in in_pieces(iter([batch]), bpe.PIECE):
        encoder.decode(*encoder.encode(*text_bytes(piece.column(0))))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120_000_000


def test_hashes_of_runs_take_few_copies():
    """Hashes of the runs of a text take two long arrays at a time, and a run hashes as it does alone."""
    data = np.frombuffer(b"some words " * 90_000, np.uint8)
    start = np.arange(0, len(data), 11)
    tracemalloc.start()
    hashes = words.run_hashes(data, start)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 22 * len(data)
    assert (hashes == words.run_hashes(data[:11], np.zeros(1, np.int64))).all()


@pytest.mark.parametrize("limit", [10, 0])
def test_rejected_rows_leave_without_a_shuffle_of_texts(spark, monkeypatch, limit):
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", limit)
    rows, _ = corpus_pipeline._keyed(spark.createDataFrame([(i, f"t{i}", "en", "s", 2) for i in range(20)], "doc_id long, text string, lang string, source string, n_chars int"))
    keys = [r._row for r in rows.orderBy("doc_id").collect()]
    rejected = spark.createDataFrame([(keys[i],) for i in (3, 3, 5)], "doc_id long")
    left = corpus_pipeline._without(rows, rejected)
    assert sorted(r.doc_id for r in left.collect()) == [i for i in range(20) if i not in (3, 5)]
    hint = "strategy=broadcast" in left._jdf.queryExecution().analyzed().toString()
    assert hint == bool(limit)


def test_tagged_words_are_read_from_whole_texts(spark):
    """Marks are taken off whole texts, not word by word, and any run of white space is one blank."""
    d = spark.createDataFrame([(1, " see\t5 km \n\u0001 - and  Janet's 3%\n"), (2, " \u0002 - ")], "doc_id long, text string")
    words = decontaminate._words(d, "doc_id")
    got = {r.doc_id: (r.tags, r.plain_tags) for r in words.collect()}
    tags = ["see", "\u0001\u00045\u0004", "\u0002\u0004km", "and", "\u0003\u0004janets", "\u0001\u00043\u0004\u0002\u0004"]
    assert got == {1: (tags, ["see", "5", "km", "and", "janets", "3"]), 2: ([""], [""])}
    plan = words._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" not in plan


def test_decontamination_reads_names_that_open_sentences(spark):
    items = [
        "Janet has 3 cats. Janet buys 4 more. How many cats does Janet have?",
        "On each day of the week Ann walks to the shop and then Bob walks home with Eve.",
    ]
    got = found_items(spark, items, [
        "So here it is. Peter has 5 cats. Peter buys 9 more. How many cats does Peter have? Say it.",
        "So here it is. Peter has 5 cats. Peter buys 9 more. How many cats does Peter have? Say it.".replace(" ", "\n"),
        "janet has 3 cats. janet buys 4 more. how many cats does janet have?",
        "On each day of the week\nAnn walks  to the shop and then  Bob walks home with\n Eve.",
        "Peter has 5 cats. Paul buys 9 more. How many cats does Peter have?",
    ])
    assert {(0, 0), (1, 0), (3, 1)} <= set(got) and (4, 0) not in got
    assert got[3, 1].verbatim and got[3, 1].matched == got[3, 1].windows and not got[0, 0].verbatim


def test_decontamination_finds_long_passages_of_long_items(spark):
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe", "ra", "so", "tu", "va", "xe") for b in "abcdefghijklmnopqrst"]
    quote = lambda n: "it says " + " ".join(words[20 : 20 + n]) + " and no more"
    got = found_items(spark, [" ".join(words[:60]), " ".join(words)], [quote(30), quote(100), quote(12), quote(13)])
    assert set(got) == {(d, i) for d in (0, 1, 3) for i in (0, 1)}
    assert (got[0, 0].matched, got[0, 0].windows) == (23, 53) and (got[1, 1].matched, got[1, 1].windows) == (93, 193)
    assert all(r.verbatim for r in got.values())


def test_decontamination_finds_items_of_numbers_and_short_items(spark):
    items = [
        "Compute 12 + 37 + 41 + 58 + 66.", "Add 7 and 5", "What is 9?", "", "!!!", "days of the 1 2 3 4 5 6 7 8 9 10 11",
        "one two three four five 1 2 3 4 5 6 7 eight nine ten",
    ]
    texts = [f"here it comes: {t} and it ends" for t in items]
    texts += ["Compute 12 + 37 + 41 + 58 + 67.", "What is 8?", "it lasts 5 " + items[5], "compute", "nothing at all to see"]
    got = found_items(spark, items, texts)
    assert set(got) == {(0, 0), (1, 1), (2, 2), (5, 5), (6, 6), (9, 5)}
    assert all(got[p].verbatim and got[p].matched == got[p].windows for p in {(0, 0), (2, 2), (5, 5), (6, 6)})


def test_decontamination_finds_verbatim_items(spark, docs, texts):
    items = table(spark, SF_DIR, "benchmark")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    planted = {(d, i.item_id) for i in items.collect() for d, t in texts.items() if i.text in t}
    assert planted <= found and len(found - planted) <= 2


def base_rules(text):
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 5)}
    marks = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), marks, len(lines) - len(set(lines)), len(covered)


def test_quality_base_rules(awkward, docs, texts):
    for rows, source in ((quality.rate(docs).collect(), texts), (quality.rate(awkward.filter("doc_id is not null")).collect(), {r[0]: r[1] or "" for r in ROWS})):
        for r in rows:
            expected = base_rules(source[r.doc_id])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
            assert r.base_failed == (expected[0] < 10 or 100 * expected[4] > 20 * expected[0])
            assert not (r.base_failed and r.kept)


def test_kneser_ney_is_a_distribution():
    rng = np.random.default_rng(3)
    symbols = rng.integers(1, 6, 4000).astype(np.uint8)
    codes, _ = charlm.packed(symbols, np.array([0, 1500, 4000]))
    code, n = np.unique(codes, return_counts=True)
    for discounts in (charlm.modified_discounts, charlm.single_discount):
        model = charlm.fit(code, n, discounts)
        for context in (0, 2, 48 * 3 + 4, (48 * 3 + 4) * 48 + 1):
            everything = np.arange(1, charlm.SYMBOLS) + context * charlm.SYMBOLS
            assert np.exp(model.score(everything)).sum() == pytest.approx(1.0, abs=1e-4)


def test_windows_of_characters_are_counted(spark):
    rows = spark.createDataFrame([("en", "ab"), ("en", "ab"), (None, "b"), ("en", None)], "lang string, text string")
    got = {(r.lang, r.code): r.n for r in charlm.count_windows(rows, "letters").collect()}
    assert got == {("en", 2): 2, ("en", 2 * 48 + 3): 2, ("", 3): 1}


def brute_components(rows):
    sets = {}
    for i, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        k = min(4, len(words)) or 1
        sets[i] = {tuple(words[j : j + k]) for j in range(len(words) - k + 1)}
    lowest = {i: i for i in sets}

    def root(i):
        while lowest[i] != i:
            i = lowest[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                lowest[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def near_copies(seed, n=260):
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in rng.integers(0, 300, 150)]
    rows = []
    for i in range(n):
        words = list(base[: int(rng.integers(100, 150))] if i % 3 else base)
        for _ in range(int(rng.integers(0, 6))):
            words[int(rng.integers(0, len(words)))] = f"u{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(n + i, " ".join(f"v{rng.integers(0, 50)}" for _ in range(int(rng.integers(0, 6))))) for i in range(60)]
    return rows


def test_near_duplicates_of_repeated_ids(spark):
    """Rows of one id are one document: A and B of id 5 link 1 (A') and 2 (B')."""
    a, b = (" ".join(f"{w}{i}" for i in range(60)) for w in "ab")
    rows = [(5, a), (5, b), (1, a + " x"), (2, b + " y"), (9, "c " + " ".join(map(str, range(40)))), (5, a), (None, a)]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id or 0, r.component_id) for r in got), key=str) == sorted(
        [(5, 1), (5, 1), (1, 1), (2, 1), (9, 9), (5, 1), (0, None)], key=str
    )


def test_leaders_are_searched_over_inverted_lists(spark, monkeypatch):
    """Partners of a leader are one partition of the corpus: lists of many members are merged and probed."""
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*base[:i], f"u{i}", *base[i + 1 :]])) for i in range(60)]
    asked = []
    found = jaccard.search
    monkeypatch.setattr(jaccard, "search", lambda pairs, texts: (asked.append(pairs), found(pairs, texts))[1])
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0}
    assert asked[0].groupBy("a").count().agg(F.max("count")).first()[0] >= 20


def test_left_pairs_are_formed_once_for_a_run_of_lists(spark, monkeypatch):
    """Six documents of three labels share ten lists; lists of one label give nothing."""
    rows = [(100 + t, d, 20, t, d // 2, 0, 0, 0, 0) for t in range(10) for d in range(6)]
    rows += [(200 + t, d, 20, 10 + t, 0, 0, 0, 0, 0) for t in range(3) for d in (0, 1)]
    lists = spark.createDataFrame(rows, "token long, doc long, n int, pos int, label long, s0 long, s1 long, s2 long, s3 long")
    met, often = [], jaccard._often_enough
    monkeypatch.setattr(jaccard, "_often_enough", lambda m: (met.append(m.count()), often(m))[1])
    got = {(r.a, r.b) for r in jaccard._left_pairs(lists).collect()}
    assert got == {(a, b) for a in range(6) for b in range(a + 1, 6) if a // 2 != b // 2}
    assert met == [len(got)]


@pytest.mark.parametrize("leaders", [10**9, 1])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, leaders):
    monkeypatch.setattr(jaccard, "LONG", leaders)
    rows = near_copies(leaders + 1)
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)


def test_wide_sketches_keep_every_link(spark, monkeypatch):
    """Of pairs near the threshold, those that do not link are mostly left out before texts are fetched."""
    rng = np.random.default_rng(5)
    base, rows = [f"w{i}" for i in range(150)], []
    for i in range(150):
        own = list(base)
        for at in rng.choice(150, rng.integers(1, 6), replace=False):
            own[at] = f"u{i}x{at}"
        rows.append((i, " ".join(own)))
    asked = []
    found = jaccard.search
    monkeypatch.setattr(jaccard, "search", lambda pairs, texts: (asked.append(pairs), found(pairs, texts))[1])
    monkeypatch.setattr(jaccard, "HELD", 500)
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)
    assert sum(pairs.count() for pairs in asked) < 1200


def test_folded_sketches_bound_the_difference(spark):
    """Sets of 64 and 65 shingles have sketches of 128 and 256 buckets; a link of theirs is kept."""
    long = [f"w{i}" for i in range(68)]
    rows = [(0, " ".join(long[:67])), (1, " ".join(long)), (2, " ".join(f"v{i}" for i in range(67)))]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_hash", F.xxhash64("text"))
    sets = jaccard.prefixes(d, np.zeros(1 << jaccard.HEAT_BITS)).withColumnRenamed("doc_id", "doc")
    assert {(r.n, len(r.wide)) for r in sets.collect()} == {(64, 2), (65, 4)}
    pairs = spark.createDataFrame([(0, 1), (1, 0), (0, 2), (1, 2)], "a long, b long")
    assert {(r.a, r.b) for r in jaccard._near(pairs, sets).collect()} == {(0, 1), (1, 0)}


def test_near_duplicates_of_documents(docs, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()}
    assert got == brute_components(texts.items())


def test_divide_skip_finds_what_overlaps_enough():
    rng = np.random.default_rng(5)
    for _ in range(200):
        query = np.unique(rng.integers(0, 60, 40).astype(np.uint64))
        members = [np.unique(rng.choice(60, int(rng.integers(1, 50)))).astype(np.uint64) for _ in range(12)]
        members += [query[: int(rng.integers(1, len(query)))], query]
        want = [i for i, m in enumerate(members) if 100 * len(np.intersect1d(query, m)) >= 85 * len(np.union1d(query, m))]
        assert sorted(jaccard.divide_skip(query, members)) == want


def test_components_take_the_leaves_of_a_hub_at_once(spark, monkeypatch):
    """Two hubs of 40 leaves each, joined by an edge: one round ranked by edges, one for the hubs at most."""
    edges = [(100, i) for i in range(40)] + [(200 + i, 300) for i in range(40)] + [(100, 300)]
    moves, kept = [], jaccard.stored
    monkeypatch.setattr(jaccard, "stored", lambda df, name: (moves.append(name), kept(df, name))[1])
    got = {r.doc: r.label for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: 0 for e in edges for v in e}
    assert moves.count("moved") <= 2


def test_turns_that_take_little_away_are_not_repeated():
    """Copies of a passage in texts that do not link stay apart however often leaders are chosen."""
    rows = 100
    assert jaccard._another_turn(0, []) and jaccard._another_turn(1, [(1e6, rows)])
    assert not jaccard._another_turn(2, [(1e6, rows), (0.9e6, rows)])
    assert jaccard._another_turn(2, [(1e6, rows), (0.5e6, rows)])
    assert not jaccard._another_turn(2, [(1e6, rows), (rows, rows)])
    assert not jaccard._another_turn(4, [(1e6, rows), (0.5e6, rows), (0.2e6, rows)])


def test_a_task_returns_freed_memory():
    """What small arrays of a task took is not kept by its process when the task has ended."""

    def held():
        fields = dict(line.split(":") for line in open("/proc/self/smaps_rollup").read().splitlines()[1:])
        return int(fields["Anonymous"].split()[0]) / 1024

    def run(batches):
        for batch in batches:
            rows = [np.ones(8_000) for _ in range(2_000)]
            pins.extend(np.ones(4_000) for _ in range(2))
            del rows
            yield batch

    pins = []
    before = held()
    assert list(shared.lean(run)(iter([1, 2]))) == [1, 2]
    assert held() - before < 40


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 600), (7, 7)], "a long, b long")
    got = {r.doc: r.label for r in jaccard.components(edges).collect()}
    assert got == {**{i: 0 for i in range(101)}, 500: 500, 600: 500}


def test_token_counts(spark, texts):
    ranks = queries.read_ranks("byte_bpe_50k")
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    count = {"byte_bpe_50k": lambda t: len(encoding.encode_ordinary(t)), "words_v1": lambda t: len(WORD.findall(t))}
    want, seen = defaultdict(lambda: [0, 0]), set()
    for r in sorted(table(spark, SF_DIR, "documents").collect(), key=lambda r: r.doc_id):
        if r.text in seen:
            continue
        seen.add(r.text)
        for name, n in count.items():
            cell = want[(r.source, r.lang, name)]
            cell[0] += 1
            cell[1] += n(token_rollup.without_repeats(r.text))
    got = {(r.source, r.lang, r.tokenizer): [r.documents, r.tokens] for r in queries.op6_token_counts(spark, SF_DIR).collect()}
    assert got == dict(want)


def test_rollup_batches_count_once(spark, tmp_path):
    ledger = token_rollup.Rollup(spark, str(tmp_path / "ledger"))
    rows = spark.createDataFrame([("s", "en", "t", 5), ("s", None, "t", 7)], "source string, lang string, tokenizer string, tokens long")
    assert ledger.totals().count() == 0
    assert ledger.commit("b1", token_rollup.inserts(rows)) and not ledger.commit("b1", token_rollup.inserts(rows))
    (tmp_path / "ledger" / "half" / "_temporary").mkdir(parents=True)
    assert ledger.committed() == ["b1"]
    assert {(r.lang, r.documents, r.tokens) for r in ledger.totals().collect()} == {("en", 1, 5), (None, 1, 7)}
    moved = rows.filter("lang is null").withColumn("lang", F.lit("fr")).withColumn("tokens", F.lit(9))
    ledger.commit("half", token_rollup.revisions(rows.filter("lang is null"), moved))
    ledger.commit("b3", token_rollup.deletes(rows.filter("lang = 'en'")))
    assert {(r.lang, r.documents, r.tokens) for r in ledger.totals().collect()} == {("fr", 1, 9)}


def test_licences(spark):
    lines = {
        1: ("Licensed under the Apache License, Version 2.0.", "apache"), 2: ("Released under the MIT License.", "mit"),
        3: ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
        4: ("Licensed under CC BY-NC 4.0.", "cc_by_nc"), 5: ("All rights reserved.", "proprietary"),
        6: ("The rain fell on the work of the garden all day.", None), 7: ("Released under a custom license, version 7.", "unknown"),
    }
    d = spark.createDataFrame([(i, f"Intro line here.\n{t}\nThe end of it.") for i, (t, _) in lines.items()], "doc_id long, text string")
    got = {r.doc_id: r for r in licences.scan(d, licences.train(d)).collect()}
    assert {i: got[i].family if i in got else None for i in lines} == {i: f for i, (_, f) in lines.items()}
    assert all(r.paragraph == 1 and 0 < r.probability <= 1 for r in got.values())


def test_native_operators_run_no_python(spark, docs, bench):
    for df in (decontaminate.contaminated(docs, bench), licences.scan(docs, licences.train(docs)), sharding.interleave(docs)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", text)


@pytest.mark.parametrize("shards", [3, 24])
def test_shards_match_the_mixture(spark, docs, texts, shards):
    rows = sharding.interleave(docs, shards).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    by_shard, mix = defaultdict(list), defaultdict(Counter)
    for r in rows:
        by_shard[r.shard].append(r.slot)
        mix[r.source][r.shard] += 1
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, binascii.crc32(raw), "rows", None)
    sizes = [len(by_shard[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert all(max(c[s] for s in range(shards)) - min(c[s] for s in range(shards)) <= 2 for c in mix.values())


def test_language_held_out_accuracy(docs):
    model = language.train(docs.filter(remainder(F.col("doc_id"), 4) != 2))
    held = docs.filter(remainder(F.col("doc_id"), 4) == 2)
    rows = language.identify(held, model).join(held.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_undetermined_language(awkward):
    got = {r.doc_id: r for r in language.identify(awkward, language.train(awkward)).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3, 5))
    assert got[8].lang_pred != "und"


def test_toxicity_learns_from_documents(spark):
    clean = "this is a plain sentence. another one follows here. and it ends"
    rows = [(i, clean + (f". you vile{i % 7} thing. bye" if i % 3 == 0 else f". fine {i}. bye")) for i in range(300)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)], "doc_id long, toxic int")
    rows = toxicity.score(d, toxicity.train(d, marks), spans=True).filter("doc_id >= 200").collect()
    assert all(r.predicted == (r.doc_id % 3 == 0) for r in rows)
    for r in rows:
        text = dict(d.filter(F.col("doc_id") == r.doc_id).collect())[r.doc_id] if r.doc_id < 204 and r.predicted else None
        if text:
            assert "vile" in text.encode()[r.worst_start : r.worst_stop].decode()
            assert [(o.start, o.stop) for o in r.offending] == [(r.worst_start, r.worst_stop)]


def test_toxicity_training_holds_small_pieces():
    """What the driver holds while it learns are the texts and some pieces, not the features of all of them."""
    some = [f"w{i * 7919 % 5000:04d}" for i in range(3400)]
    texts = pa.array([f"{i} " + " ".join(some[i : i + 400]) + (" vile." if i % 3 == 0 else " fine.") for i in range(3000)])
    tracemalloc.start()
    model = toxicity.fit(texts, np.array([int(i % 3 == 0) for i in range(3000)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 7 * texts.nbytes and model.weight.any()


def test_window_counts_reach_the_driver_as_columns(spark):
    counted = spark.range(100_000).selectExpr("if(id % 2 = 0, 'b', 'a') as lang", "cast(id * 7 as int) as code", "id % 5 + 1 as n")
    tracemalloc.start()
    models = charlm.fit_all(counted, charlm.modified_discounts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 * 100_000
    i = np.arange(1, 100_000, 2)
    alone = charlm.fit(i[::-1] * 7, i[::-1] % 5 + 1, charlm.modified_discounts)
    assert list(models) == ["a", "b"] and charlm.fit_all(counted.limit(0), charlm.modified_discounts) == {}
    assert all((x == y).all() for x, y in zip(models["a"].codes + models["a"].logp, alone.codes + alone.logp, strict=True))


def test_noisy_or():
    logit, bounds = np.array([0.0, 1.0, -2.0]), np.array([0, 2, 2, 3])
    p = 1 / (1 + np.exp(-logit))
    assert 1 - np.exp(toxicity.noisy_or(logit, bounds)) == pytest.approx([1 - (1 - p[0]) * (1 - p[1]), 0, p[2]])


def test_pipeline(spark, texts):
    kept = texts
    docs = table(spark, SF_DIR, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), "step")
        assert docs.columns == before.columns
        left = {r.doc_id for r in docs.collect()}
        assert left <= set(kept)
        if name == "n-gram Jaccard join":
            groups = brute_components(kept.items())
            assert left == {i for i, (_, root) in groups.items() if i == root}
        if name == "benchmark decontamination":
            items = [r.text for r in table(spark, SF_DIR, "benchmark").collect()]
            assert not any(i in kept[d] for d in left for i in items)
        kept = {d: kept[d] for d in left}
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).collect()} == set(kept)


def test_pipeline_on_awkward_rows(spark, awkward):
    docs = awkward.select(corpus_pipeline.COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), "step")
    assert docs.filter("doc_id = 7").count() <= 1
    assert json.dumps(docs.columns)


def test_pipeline_judges_rows_not_ids(spark):
    item = table(spark, SF_DIR, "benchmark").orderBy("item_id").first().text
    first, other = (" ".join(f"{w}{i}" for i in range(60)) for w in ("a", "b"))
    frame = lambda rows: spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    text = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    mixed = frame([(None, item), (None, first), (5, item), (5, other)])
    assert text(corpus_pipeline.drop_contaminated(spark, mixed, SF_DIR)) == [(5, other), (None, first)]
    copies = frame([(None, first), (None, first + " c"), (5, first), (3, first), (7, other), (7, item), (8, None), (8, None), (None, other)])
    assert text(corpus_pipeline.keep_one_of_each(spark, copies, SF_DIR)) == sorted([(3, first), (7, other), (7, item), (8, None)], key=str)
    poor = frame([(None, "short"), (5, "short"), *[(None, t) for t in [first, other] * 5], (5, other)])
    kept = text(corpus_pipeline.keep_good(spark, poor, SF_DIR))
    assert (None, "short") not in kept and (5, "short") not in kept and kept


def test_decontamination_of_repeated_ids(spark):
    item = " ".join(f"q{i}" for i in range(30))
    other = " ".join(f"r{i}" for i in range(30))
    docs = spark.createDataFrame([(1, item), (1, other), (1, "clean words only"), (2, item + " " + other), (None, item)], "doc_id long, text string")
    bench = spark.createDataFrame([(4, item), (4, other), (5, other)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {(1, 4), (1, 5), (2, 4), (2, 5), (None, 4)}


def test_toxicity_training_is_bounded_for_repeated_ids(spark, monkeypatch):
    docs = spark.range(5000).selectExpr("id % 3 AS doc_id", "concat('some words ', id) AS text")
    known = spark.createDataFrame([(0, 1, 1), (1, 0, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    sizes = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, marks, **_: sizes.append((len(texts), int(marks.sum()))))
    toxicity.train(docs, known, toxic_rows=20, clean_rows=30)
    assert sizes == [(50, 20)]
