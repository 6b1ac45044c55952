"""Benchmark decontamination with template windows.

A text becomes two sequences of tokens. In the first every token is a lower-cased word. In
the second numbers (digits and number words), units after a number and capitalised words
are typed placeholders, those that begin a sentence too, since there a name can't be told
from a word. Words that stand together as placeholders are one token, so a name of several
words is one name, and a list of numbers one token of that many numbers. So at least every
second token of a template is a word, however many placeholders there are.

All windows of `size` tokens of documents are hash-joined with those of the benchmark.
Windows of one sequence that agree on an alignment (position in the document minus position
in the item) are evidence together: `least` of them are a leak, in the
second sequence only if their slots are consistent. One benchmark name always stands for one
document name and the other way round; numbers and units may coincide by chance on one
side. So questions with other numbers and names are caught, and one edited value doesn't
hide the verbatim rest. An item shorter than a window is one window of its own length and
is matched word for word.

Each benchmark window has an anchor, the rarest of its words that must be the same, and a
second such word at a fixed distance. Documents make only the windows around places where
both stand, which are few, and these alone leave the row for the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.llm.common import settle

UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml l s sec min h hr hrs day days week weeks month months year years hour hours minute minutes second seconds "
    "meter meters metre metres mile miles inch inches foot feet gram grams kilogram kilograms pound pounds liter liters litre litres "
    "dollar dollars euro euros cent cents usd eur gbp percent pct degree degrees celsius fahrenheit mph kmh"
).split()
#: Cardinal numbers in English, German, French and Spanish; their words for 1 that are articles too are left out.
NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion "
    "null zwei drei vier fünf sechs sieben acht neun zehn elf zwölf zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig hundert tausend "
    "zéro deux trois quatre cinq sept huit neuf dix onze douze vingt trente quarante cinquante soixante cent mille "
    "cero dos tres cuatro cinco seis siete ocho nueve diez doce veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa cien mil"
).split()
#: Characters before a value that tell its type; texts keep none of them, as they are neither letters nor digits.
NUM, NAME, UNIT = map(chr, (1, 2, 3))
MARKS = NUM + NAME + UNIT
#: The sequences: plain words, templates.
PLAIN, TYPED = 0, 1
#: Benchmark windows up to which they are broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 200_000
#: Anchors up to which documents look for them in the row; beyond, they make all their windows.
ANCHORS = 100_000


def _spaced(text: Column) -> Column:
    """The words with one space around each. No word holds a tab: one is put before a word that follows something else than blanks.

    Digits grouped by points and commas are one word.
    """
    blank = lambda x, c: F.replace(x, F.lit(c), F.lit(" "))
    whole = F.regexp_replace(blank(blank(F.coalesce(text, F.lit("")), "\n"), "\t"), r"[.,](?=[0-9])(?<=[0-9].)", "")
    parted = F.regexp_replace(whole, r"[^\p{L}\p{N} ][^\p{L}\p{N}]*+", " \t")
    return F.concat(F.lit(" "), F.btrim(F.regexp_replace(parted, r" {2,}", " "), F.lit(" \t")), F.lit(" "))


def _any_of(words: list[str]) -> str:
    """A pattern for these words, with or without a capital, that looks at each first letter once."""
    firsts: dict[str, list[str]] = {}
    for w in words:
        firsts.setdefault(w[0], []).append(w[1:])
    return "|".join(f"[{k}{k.upper()}](?:{'|'.join(rest)})" for k, rest in firsts.items())


def _tokens(spaced: Column, kind: int) -> Column:
    """struct(t, v) of arrays: the tokens of a sequence, and what they say (values behind the marks of their types)."""
    split = lambda x: F.split(F.btrim(x), " ")
    if kind == PLAIN:
        words = split(F.lower(F.replace(spaced, F.lit("\t"), F.lit(""))))
        return F.struct(words.alias("t"), words.alias("v"))
    x = F.regexp_replace(spaced, rf" \t?(?=[0-9]|(?:{_any_of(NUMBERS)}) )", f" {NUM}")
    x = F.regexp_replace(x, r" (?=\t?[\p{Lu}\p{Lt}]\p{Ll})", f" {NAME}")
    # A name of several words is one value.
    x = F.regexp_replace(x, rf" {NAME}(?!\t)(?<={NAME}[^ ]{{1,60}} {NAME})", "_")
    x = F.lower(F.replace(x, F.lit("\t"), F.lit("")))
    x = F.regexp_replace(x, rf"({NUM}[^ ]* )(?=(?:{'|'.join(UNITS)}) )", f"$1{UNIT}")
    said = F.regexp_replace(x, rf"([{MARKS}][^ ]*) (?=[{MARKS}])", "$1")
    return F.struct(split(F.regexp_replace(said, rf"([{MARKS}])[^ {MARKS}]+", "$1")).alias("t"), split(said).alias("v"))


def _let(value: Column, use) -> Column:
    """use(value), with the value made once however often it is used."""
    return F.transform(F.array(value), use)[0]


def _is_slot(token: Column) -> Column:
    return token.rlike(f"^[{MARKS}]")


def _window(x: Column, i: Column, kind: int, size: Column) -> tuple[Column, Column]:
    """Hash and slot values (with marks) of the window of `size` tokens that begins at i."""
    h = F.xxhash64(F.lit(kind), size.cast("int"), F.slice(x["t"], i + 1, size))
    if kind == PLAIN:
        return h, F.array().cast("array<string>")
    said = F.transform(F.filter(F.slice(x["v"], i + 1, size), _is_slot), lambda v: F.split(v, f"(?=[{MARKS}])"))
    return h, F.flatten(said)


def windows(df: DataFrame, key: str, text: str, size: int, shortest: int) -> DataFrame:
    """All windows of the benchmark: key, kind, size, number of windows of the item's sequence, place, hash, slot values, and
    the words, with their positions in the window, that any match has."""

    def spread(kind: int) -> Column:
        def made(x: Column) -> Column:
            n = F.size(x["t"])
            own = F.least(n, F.lit(size))
            least = size if kind else shortest
            starts = F.when(n >= least, F.sequence(F.lit(0), n - own)).otherwise(F.array().cast("array<int>"))

            def at(i: Column) -> Column:
                h, slots = _window(x, i, kind, own)
                sure = F.filter(F.transform(F.slice(x["t"], i + 1, own), lambda w, k: F.struct(w.alias("w"), k.alias("k"))), lambda s: ~_is_slot(s["w"]))
                return F.struct(F.lit(kind).alias("kind"), own.alias("size"), F.size(starts).alias("of"), i.alias("place"), h.alias("h"), slots.alias("slots"), sure.alias("sure"))

            return F.transform(starts, at)

        return _let(_tokens(F.col("__s"), kind), made)

    spaced = df.select(key, _spaced(F.col(text)).alias("__s"))
    return spaced.select(key, F.inline(F.concat(*[spread(k) for k in (PLAIN, TYPED)])))


def _pair(first: Column, second: Column, distance: Column) -> Column:
    return F.xxhash64(first, second, distance.cast("int"))


def anchors(known: DataFrame) -> DataFrame:
    """(kind, size, w, pair): each window's anchor, and the hash of anchor, second word and their distance.

    They are the two of its words that must be the same which fewest benchmark windows have, the longest of those.
    A window has two such words at least.
    """
    words = known.select("kind", "size", "h", F.inline("sure")).dropDuplicates(["h", "k"])
    rarity = words.groupBy("w").agg(F.count("*").alias("n"))
    order = F.array_sort(F.collect_list(F.struct(F.col("n"), (-F.length("w")).alias("m"), "w", "k")))
    two = words.join(rarity, "w").groupBy("kind", "size", "h").agg(order.alias("x")).select("kind", "size", F.col("x")[0].alias("a"), F.col("x")[1].alias("b"))
    return two.select("kind", "size", F.col("a.w").alias("w"), _pair(F.col("a.w"), F.col("b.w"), F.col("b.k") - F.col("a.k")).alias("pair")).distinct()


def _hits(spaced: Column, kind: int, looked_up: dict[int, tuple[list[str], list[int]] | None]) -> Column:
    """array of (as, pos, h, said): a document's windows of a sequence, for each size all of them or those around anchors."""

    def made(x: Column) -> Column:
        t, n = x["t"], F.size(x["t"])

        def windows_of(size: int, here: Column) -> Column:
            if looked_up[size] is None:
                starts = F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))
            else:
                away, pairs = F.sequence(F.lit(1 - size), F.lit(size - 1)), looked_up[size][1]
                beside = lambda p: F.exists(away, lambda d: _pair(F.get(t, p), F.get(t, p + d), d).isin(pairs))
                near = F.array_distinct(F.flatten(F.transform(F.filter(here, beside), lambda p: F.sequence(p - (size - 1), p))))
                starts = F.filter(near, lambda i: (i >= 0) & (i + size <= n))

            def at(i: Column) -> Column:
                h, said = _window(x, i, kind, F.lit(size))
                return F.struct(F.lit(kind).alias("as"), i.alias("pos"), h.alias("h"), said.alias("said"))

            return F.transform(starts, at)

        rare = sorted({w for found in looked_up.values() if found is not None for w in found[0]})
        here = F.array_compact(F.transform(t, lambda w, i: F.when(w.isin(rare), i)))
        return _let(here, lambda here: F.concat(*[windows_of(size, here) for size in looked_up]))

    return _let(_tokens(spaced, kind), made)


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id", item_text: str = "text", size: int = 8, least: int = 6, shortest: int = 4) -> DataFrame:
    """(key, item, offset, n_windows, n_slots, exact): alignments of documents with items that count as leaks.

    An alignment of one sequence counts if `least` of its windows agree (all windows, for items with fewer) and, in
    templates, their slots are consistent; exact: all its windows, with the item's own values. An item of fewer than `size` words
    matches if it stands in the text word for word, in any case; one of fewer than `shortest` words, which every
    text may hold, matches nothing. Every copy of a passage is a row of its own, found by its own document.

    Null and empty texts match nothing, on either side; repeated document rows count as one document, repeated items
    as items; rows with a null key are left out. Empty tables give no rows. Other columns aren't looked at, so they
    may have any names.
    """
    known = settle(windows(benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("__text")), "item", "__text", size, shortest))
    n = known.count()
    few = anchors(known).limit(ANCHORS + 1).collect()
    rows: dict[tuple[int, int], list] = {(r["kind"], r["size"]): [] for r in known.select("kind", "size").distinct().collect()}
    for r in few:
        rows[r["kind"], r["size"]].append(r)
    looked_up: dict[int, dict] = {}
    for (kind, w), own in sorted(rows.items()):
        looked_up.setdefault(kind, {})[w] = None if len(few) > ANCHORS else (sorted({r["w"] for r in own}), sorted({r["pair"] for r in own}))
    spaced = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("doc"), _spaced(F.col(text)).alias("__s"))
    # No filter on what is made here: pushed down, it would repeat the making inside the lambdas.
    every = [_hits(F.col("__s"), kind, by_size) for kind, by_size in looked_up.items()]
    nothing = F.array().cast("array<struct<as:int,pos:int,h:bigint,said:array<string>>>")
    hits = spaced.select("doc", F.inline(F.concat(nothing, *every)))
    known = known.select("item", "kind", "of", "place", "h", "slots")
    pairs = hits.join(F.broadcast(known) if n <= BROADCAST_ROWS else known, "h").where(F.col("kind") == F.col("as"))
    said = F.zip_with("slots", "said", lambda x, y: F.struct(x.alias("b"), y.alias("d")))
    pairs = pairs.select("doc", "item", "kind", (F.col("pos") - F.col("place")).alias("offset"), "place", "of", said.alias("slots"))
    # A place counts once, and so does a pair of values, however many windows hold it.
    at = pairs.groupBy("doc", "item", "kind", "offset").agg(F.count_distinct("place").alias("n_windows"), F.max("of").alias("of"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
    name = lambda x: F.startswith(x["b"], F.lit(NAME))
    distinct = lambda x, side: F.size(x) == F.size(F.array_distinct(F.transform(x, lambda p: p[side])))
    names, values = F.filter("slots", name), F.filter("slots", lambda x: ~name(x))
    consistent = distinct(names, "b") & distinct(names, "d") & (distinct(values, "b") | distinct(values, "d"))
    return at.where((F.col("n_windows") >= F.least(F.lit(least), F.col("of"))) & consistent).select(
        F.col("doc").alias(key), F.col("item").alias(item), "offset", "n_windows", F.size("slots").alias("n_slots"), ((F.col("n_windows") == F.col("of")) & ~F.exists("slots", lambda x: x["b"] != x["d"])).alias("exact"),
    )


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id", item_text: str = "text", **options) -> DataFrame:
    """The documents with a leak, one row each: key, n_items, first_item, n_windows (the most at one alignment), exact (whether any match is the whole item with its own values)."""
    found = matches(docs, benchmark, text, key, item, item_text, **options)
    return found.groupBy(key).agg(F.countDistinct(item).alias("n_items"), F.min(item).alias("first_item"), F.max("n_windows").alias("n_windows"), F.max("exact").alias("exact"))
