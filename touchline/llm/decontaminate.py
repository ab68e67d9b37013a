"""Benchmark decontamination by templates, in DataFrame functions only.

Numbers, units and names become typed placeholders, so that a question asked again with other values
gives the same windows. Windows are hash-joined with those of the benchmark; the values that stand in
the slots of a match must then correspond one to one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.shared import stored

WINDOW = 8
SHORTEST = 4
MIN_COVER = 0.5
#: So many words in a row with equal values are a leak, whatever the length of the item.
VERBATIM_RUN = 13
BROADCAST_WINDOWS = 200_000

NUMBER, UNIT, NAME, VALUE = "\u0001", "\u0002", "\u0003", "\u0004"
#: Units that may follow a number.
UNITS = (
    "km|cm|mm|m|mi|ft|in|kg|mg|g|lb|lbs|oz|ml|l|h|hr|hrs|min|s|sec|mph|kmh|usd|eur|dollars?|euros?|cents?|"
    "miles?|meters?|metres?|feet|inches|hours?|minutes?|seconds?|days?|weeks?|months?|years?|pounds?|"
    "grams?|liters?|litres?|percent"
)


#: Readings of a text, as bits: capitalised words that open a sentence are words, or names as all others;
#: or all stand for themselves, where there are too few words for a template.
OPENERS_ARE_WORDS, OPENERS_ARE_NAMES, VERBATIM = 1, 2, 4
READINGS = [OPENERS_ARE_WORDS, OPENERS_ARE_NAMES, VERBATIM]


def tagged(text: Column, openers: bool = False) -> Column:
    """Lower-cased words with placeholders, each followed by the value it stands for.

    A name is a capitalised word after a lower-case word, comma or semicolon, and with ``openers``
    every capitalised word; a unit stands directly after a number or after the blank that follows it.
    Marks are dropped, and any run of white space is one blank.
    """
    before = r"(?<![\p{L}\p{N}])(?<![\p{L}\p{N}]['\u2019-])" if openers else r"(?<=[\p{Ll},;] )"
    # Single blanks, which are most runs, are not matched.
    runs = "[\u0001-\u0004\\s]{2,}|[\u0001-\u0004\\s&&[^ ]]"
    out = F.regexp_replace(F.coalesce(text, F.lit("")), runs, " ")
    out = F.regexp_replace(out, rf"(?=\p{{Lu}}){before}(\p{{Lu}}[\p{{L}}'\u2019-]*)", f"{NAME}{VALUE}$1")
    out = F.regexp_replace(out, r"[0-9]+(?:[.,][0-9]+)*", f"{NUMBER}{VALUE}$0{VALUE}")
    out = F.regexp_replace(
        out, f"(?i){VALUE}([ \\t]?)({UNITS}|[%$\u20ac\u00a3])(?![\\p{{L}}\\p{{N}}])", f"{VALUE}$1{UNIT}{VALUE}$2"
    )
    out = F.regexp_replace(out, "[^a-zA-Z\\p{L}\\p{N}\\s\u0001-\u0004]+", "")
    return F.lower(F.trim(F.regexp_replace(out, "  +", " ")))


def _plain(text: Column) -> Column:
    """Tagged words without their marks."""
    return F.regexp_replace(text, f"[{NUMBER}{UNIT}{NAME}{VALUE}]+", "")


def _words(df: DataFrame, key: str, after: str = "") -> DataFrame:
    """Tagged words of each text, as they read ``after`` another word, and a hash of each without its value.

    Both readings have the same words at the same places. No filter stands on the words here: it would
    be pushed below and tag every text a second time.
    """
    text = F.concat(F.lit(after), F.coalesce("text", F.lit("")))
    split = lambda words: F.slice(F.split(words, " "), 2, 1 << 30) if after else F.split(words, " ")
    read = df.select(key, tagged(text).alias("tagged"), tagged(text, openers=True).alias("name_tagged"))
    template = lambda word: F.xxhash64(F.substring_index(word, VALUE, 1))
    tagged_words = read.select(
        key,
        split(F.col("tagged")).alias("tags"),
        split(F.col("name_tagged")).alias("name_tags"),
        split(_plain(F.col("tagged"))).alias("plain_tags"),
    )
    literal = lambda word: F.when(word < VALUE, 0).otherwise(1)
    return tagged_words.select(
        key,
        "tags",
        "name_tags",
        "plain_tags",
        F.transform("tags", literal).alias("literal"),
        F.transform("name_tags", literal).alias("name_literal"),
        F.zip_with("tags", "name_tags", lambda x, y: (x != y).cast("int")).alias("differs"),
        F.get("plain_tags", F.lit(0)).rlike(f"^({UNITS})$").alias("unit_first"),
        F.transform("tags", template).alias("words"),
        F.transform("name_tags", template).alias("name_words"),
        F.transform("plain_tags", lambda word: F.xxhash64(word)).alias("plain_words"),
    )


def _windows(rows: DataFrame, key: str, size: int, place: str, usable: bool = False) -> DataFrame:
    """All windows of ``size`` words in each reading: their hash, place, tagged words and readings.

    With ``usable``, templates only with at least as many words as placeholders. Windows that have fewer
    if all names are read as such, that begin with a unit (which it is only after a number), or that are
    short are read verbatim too.
    """
    # One explode over places and readings, and no lambda after it: either would end the generated code
    # there, and the whole text would be copied for every window. Large code is not compiled: slices
    # of arrays made once per text keep it small.
    at, way = F.col(place), F.col("_way")
    ways = len(READINGS)
    last = F.size("words") - size
    starts = F.when(last >= 0, F.sequence(F.lit(0), ways * last + ways - 1))
    placed = rows.select(key, *rows.columns[1:], F.explode(starts).alias("_i"))
    placed = placed.select("*", F.floor(F.col("_i") / ways).cast("int").alias(place), (F.col("_i") % ways).alias("_way"))
    read = lambda plain, names, verbatim: F.slice(
        F.when(way == 0, F.col(plain)).when(way == 1, F.col(names)).otherwise(F.col(verbatim)), at + 1, size
    )
    words = lambda flags: F.size(F.array_remove(F.slice(flags, at + 1, size), 0))
    differ = words("differs") > 0
    on_unit = F.get("name_tags", at).startswith(UNIT) | ((at == 0) & F.col("unit_first"))
    if size < SHORTEST:
        needed = way == 2
    else:
        template = (2 * words("literal") >= size) if usable else F.lit(True)
        names = differ & (2 * words("name_literal") >= size) if usable else differ
        needed = F.when(way == 0, template).when(way == 1, names).otherwise((2 * words("name_literal") < size) | on_unit)
    either = OPENERS_ARE_WORDS | OPENERS_ARE_NAMES
    return placed.filter(needed).select(
        key,
        place,
        F.xxhash64(read("words", "name_words", "plain_words")).alias("window"),
        F.when(way == 2, VERBATIM).when(way == 1, OPENERS_ARE_NAMES).when(differ, OPENERS_ARE_WORDS).otherwise(either).alias(
            f"{place}_reading"
        ),
        read("tags", "name_tags", "plain_tags").alias(f"{place}_tags"),
    )


def _matches(docs: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """Windows that a document and an item of the benchmark share, once per reading shared."""
    sought = (
        _windows(items, "item_id", size, "item_at", usable=True)
        .groupBy("item_id", "item_at", "window")
        .agg(F.bit_or("item_at_reading").alias("item_at_reading"), F.first("item_at_tags").alias("item_at_tags"))
    )
    sought = stored(sought, "windows")
    # Broadcast only below a checked size; a larger benchmark is joined by hash partitions.
    if sought.count() <= BROADCAST_WINDOWS:
        sought = F.broadcast(sought)
    shared = _windows(docs, "doc_id", size, "doc_at").join(sought, "window")
    bits = F.col("doc_at_reading").bitwiseAND(F.col("item_at_reading"))
    readings = F.filter(F.array(*map(F.lit, READINGS)), lambda r: bits.bitwiseAND(r) != 0)
    return shared.withColumn("reading", F.explode(readings)).drop("doc_at_reading", "item_at_reading")


def contaminated(docs: DataFrame, benchmark: DataFrame, min_cover: float = MIN_COVER) -> DataFrame:
    """Pairs of a document and a benchmark item whose text, or template, it contains.

    Windows have eight words, or the item's length if that is less. Windows with more placeholders than
    words, and items under four words, match only word by word with their values. A text is read in two
    ways, as names may open a sentence (Janet has) and words may (How many); a re-asked item matches in
    one. Matches are grouped by reading and offset between document and item; in a group, slots are
    consistent if each value of the item stands for one value of the document and the other way round.
    A pair is reported if consistent offsets cover at least ``min_cover`` of the item's ``windows``, or as
    templates that share of those with enough words for one, or if VERBATIM_RUN words in a row are the
    same with their values; ``verbatim`` says that no value differs in what matched. Texts that share an
    id, or have none, are judged each by itself, and the best match of an id is reported; repeated rows
    are one; NULL and empty texts match nothing; other columns are not read. An empty table gives no pairs.
    """
    asked = _by_text(benchmark.filter("item_id is not null"), "item_id").dropDuplicates(["item_id"])
    docs = _by_text(docs, "doc_id")
    # Inside a document an item's first word may read as a name: both readings are sought.
    read = _words(asked, "item_id").withColumn("quoted", F.lit(False))
    quoted = _words(asked, "item_id", "a ").withColumn("quoted", F.lit(True))
    both = read.unionAll(quoted).withColumn("size", F.least(F.size("words"), F.lit(WINDOW)))
    both = stored(both.filter(F.get("tags", F.lit(0)) != ""), "items")
    items = both.filter("not quoted")
    # At most WINDOW different sizes.
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())
    rows = _words(docs, "doc_id")
    found = [_matches(rows, both.filter(F.col("size") == s), s) for s in sizes or [WINDOW]]
    matches = reduce(DataFrame.unionAll, found)
    is_slot = lambda x: x["item_at_tags"].contains(VALUE)
    slots = F.filter(F.arrays_zip("item_at_tags", "doc_at_tags"), is_slot)
    equal = F.col("item_at_tags") == F.col("doc_at_tags")
    by_offset = matches.groupBy("doc_id", "item_id", "reading", (F.col("doc_at") - F.col("item_at")).alias("offset")).agg(
        F.collect_set("item_at").alias("places"),
        F.flatten(F.collect_set(slots)).alias("slots"),
        F.sort_array(F.collect_set(F.when(equal, F.col("item_at")))).alias("equal"),
    )
    pairs = F.array_distinct("slots")
    ours = F.array_distinct(F.transform(pairs, lambda x: x["item_at_tags"]))
    theirs = F.array_distinct(F.transform(pairs, lambda x: x["doc_at_tags"]))
    consistent = (F.size(ours) == F.size(pairs)) & (F.size(theirs) == F.size(pairs))
    none = F.slice("places", 1, 0)
    read = by_offset.select(
        "doc_id",
        "item_id",
        "offset",
        "equal",
        F.when(consistent, F.col("places")).otherwise(none).alias("places"),
        F.when(consistent & (F.col("reading") != VERBATIM), F.col("places")).otherwise(none).alias("by_template"),
        (~consistent | F.forall(pairs, lambda x: x["item_at_tags"] == x["doc_at_tags"])).alias("verbatim"),
    )
    union = lambda x: F.array_distinct(F.flatten(F.collect_set(x)))
    # A run goes on through windows of different readings. Where slots contradict each other, a long
    # run is still a leak, of its equal windows alone.
    more = VERBATIM_RUN - WINDOW
    in_a_row = lambda i: F.get("equal", i) - F.get("equal", i - more) == more
    ends = F.sequence(F.lit(more), F.size("equal") - 1)
    run = F.when(F.size("equal") > more, F.exists(ends, in_a_row)).otherwise(False)
    aligned = (
        read.groupBy("doc_id", "item_id", "offset")
        .agg(
            F.sort_array(union("equal")).alias("equal"),
            union("places").alias("places"),
            union("by_template").alias("by_template"),
            F.min("verbatim").alias("verbatim"),
        )
        .withColumn("run", run)
    )
    covered = (
        aligned.groupBy("doc_id", "item_id")
        .agg(
            union(F.when(F.col("run"), F.array_union("places", "equal")).otherwise(F.col("places"))).alias("places"),
            F.size(union("by_template")).alias("by_template"),
            F.min("verbatim").alias("verbatim"),
            F.max("run").alias("run"),
        )
        .withColumn("matched", F.size("places").cast("long"))
    )
    leak = (
        F.col("run")
        | ((F.col("by_template") > 0) & (F.col("by_template") >= min_cover * F.col("templates")))
        | ((F.col("matched") > 0) & (F.col("matched") >= min_cover * F.col("windows")))
    )
    found = covered.join(_item_windows(items), "item_id").filter(leak)
    best = F.max_by(F.struct("matched", "windows", "verbatim"), F.struct("matched", "verbatim", "windows"))
    return (
        found.groupBy(F.col("doc_id.id").alias("doc_id"), F.col("item_id.id").alias("item_id"))
        .agg(best.alias("best"))
        .select("doc_id", "item_id", "best.*")
    )


def _by_text(rows: DataFrame, key: str) -> DataFrame:
    """``key`` as a struct of the id and a hash of the text: texts that share an id stay apart."""
    return rows.select(F.struct(F.col(key).alias("id"), F.xxhash64("text").alias("text")).alias(key), "text")


def _item_windows(items: DataFrame) -> DataFrame:
    """How many windows each item has, and how many of them can match as templates."""
    at = F.sequence(F.lit(0), F.size("words") - F.col("size"))
    literal = lambda i: F.size(F.filter(F.slice("tags", i + 1, F.col("size")), lambda w: w >= VALUE))
    usable = F.filter(at, lambda i: (2 * literal(i) >= F.col("size")) & (F.col("size") >= SHORTEST))
    return items.select("item_id", F.size(at).cast("long").alias("windows"), F.size(usable).alias("templates"))
