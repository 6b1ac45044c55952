"""The ten operators against brute force, round trips and held-out accuracy, with all hard cases in the rows."""

import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loglake.llm import bpe, chat, common, decontaminate, induced, language_id, licenses, minhash, quality, suffix_dedup, toxicity, vamana
from loglake.llm.components import components

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


# 1


def test_language(spark, documents):
    model = language_id.fit(documents)
    assert model.languages == ["de", "en", "es", "fr"]
    got = {r.doc_id: r for r in language_id.predict(documents, model).collect()}
    assert len(got) == documents.count()
    assert np.mean([got[k].lang_pred == got[k].lang for k in range(240)]) > 0.97
    assert all(got[k].lang_pred == "und" and got[k].rejected and got[k].score == 0 for k in (500, 501, 502, 503, 504))
    assert got[507].lang_pred == "en" and all(0 <= r.score <= 1 for r in got.values())
    assert sum(got[k].rejected for k in range(240)) <= 3


def test_language_blocks_agree():
    text = "Ein langer Satz, mit Wörtern und 12 Zahlen. " * 50
    ids, n = language_id.bag(text, 12)
    model = language_id.Model(["a", "b"], np.random.default_rng(0).normal(size=(1 << 12, 2)).astype(np.float32), 12, 1.0, 0.0)
    whole, _ = model.logits([text])
    old, language_id.BLOCK = language_id.BLOCK, 100
    try:
        cut, _ = model.logits([text, "x", text])
        ids2, n2 = language_id.bag(text, 12)
    finally:
        language_id.BLOCK = old
    assert np.allclose(whole[0], cut[0], atol=1e-4) and np.allclose(cut[0], cut[2], atol=1e-4)
    assert (ids == ids2).all() and (n == n2).all()
    assert np.allclose(whole[0], (model.table[ids] * n[:, None]).sum(axis=0) / n.sum(), atol=1e-4)


def test_language_without_rows(spark, documents):
    empty = documents.limit(0)
    model = language_id.fit(empty)
    assert language_id.predict(empty, model).count() == 0
    assert {r.lang_pred for r in language_id.predict(documents.limit(5), model).collect()} == {"und"}


# 2


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(texts):
    parent = {k: k for k in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {k: shingles(t) for k, t in texts.items()}
    for a, b in itertools.combinations(sorted(texts), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * min(len(x), len(y)) >= 85 * max(len(x), len(y)):
            both = len(x & y)
            if 100 * both >= 85 * (len(x) + len(y) - both):
                i, j = find(a), find(b)
                parent[max(i, j)] = min(i, j)
    return {k: find(k) for k in texts}, {k: len(s) for k, s in sets.items()}


def test_near_duplicates(documents, texts):
    want, sizes = brute_components(texts)
    got = {r.doc_id: r for r in minhash.near_duplicates(documents, percent=85).collect()}
    assert {k: r.component_id for k, r in got.items()} == want
    assert {k: r.n_shingles for k, r in got.items()} == sizes
    assert all(r.kept == (r.component_id == r.doc_id) for r in got.values())
    assert want[311] == 300 and sum(want[k] == 300 for k in range(330, 360)) > 10 and want[510] == 509


def test_near_duplicates_around_a_source(spark, prose):
    """Many variants whose only links are to one source, which isn't the smallest id; small buckets and large ones."""
    base = prose.words(120)
    rows = [(900, " ".join(base))]
    for k in range(80):
        w = list(base)
        for j in prose.rng.sample(range(120), 1 + k % 4):
            w[j] = prose.words(1)[0] + "x"
        rows.append((k, " ".join(w)))
    for k in range(80, 120):  # variants of a variant
        w = rows[5][1].split()
        w[prose.rng.randrange(120)] = prose.words(1)[0] + "y"
        rows.append((k, " ".join(w)))
    want, _ = brute_components(dict(rows))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=85).collect()}
    assert got == want


def test_near_duplicates_without_rows(spark, documents):
    assert minhash.near_duplicates(documents.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 360)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and a != b:
            i, j = find(a), find(b)
            parent[max(i, j)] = min(i, j)
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {k: find(k) for k in parent}


# 3


def check_encoding(texts):
    library = Tokenizer.from_file(WORD_BPE)
    library.no_truncation()
    library.no_padding()
    ours = bpe._built(*bpe.load(WORD_BPE))
    for t, x in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = ours.encode(t)
        assert ids.tolist() == x.ids, t[:60]
        assert ours.decode(ids) == library.decode(x.ids, skip_special_tokens=False)


def test_bpe_like_the_library():
    rng = random.Random(2)
    texts = ["".join(rng.choice("aeioutnsrhld' '.!0é") for _ in range(rng.randint(0, 200))) for _ in range(2000)]
    texts += ["a" * k for k in range(130)] + ["th" * k for k in range(60)] + ["!" * k for k in range(140)]
    texts += ["<|endoftext|>Hi<|startoftext|><|endoftext|> THE'LL  <|x", "ΑΣ ΣΑΣ İI ǅ ﬁ ½²", "é 각", "\x1c\x1d a\x85b", "日本語テキスト", "Ᲊ ꟎ \U000323b0a"]
    check_encoding(texts)


def test_bpe_of_every_character():
    check_encoding([f"{chr(c)}a{chr(c)}{chr(c)} b{chr(c)}" for c in range(1, 0x30000, 7) if not 0xD800 <= c < 0xE000])


def test_bpe_operator(documents, texts):
    library = Tokenizer.from_file(WORD_BPE)
    library.no_truncation()
    library.no_padding()
    out = bpe.encode(documents, WORD_BPE)
    assert out.columns[-2:] == ["ids", "decoded"] and "score" in out.columns
    got = {r.doc_id: r for r in bpe.digests(bpe.encode(documents.where("doc_id <> 508"), WORD_BPE)).collect()}
    for k in [*range(20), 500, 501, 502, 504, 506, 509, 511]:
        x = library.encode(texts[k] or "", add_special_tokens=False)
        assert got[k].n_tokens == len(x.ids)
        assert got[k].ids_sha256 == hashlib.sha256(" ".join(map(str, x.ids)).encode()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256(library.decode(x.ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode(documents.limit(0), WORD_BPE).count() == 0


# 4


def brute_repeats(texts, width):
    seen, out = set(), {}
    for k in sorted(texts):
        b = (texts[k] or "").encode()
        cover, reach = bytearray(len(b)), 0
        for s in range(len(b) - width + 1):
            w = b[s : s + width]
            if w in seen:
                lo = max(s, reach)
                cover[lo : s + width] = b"\1" * (s + width - lo)
                reach = s + width
            seen.add(w)
        spans = sum(1 for j, c in enumerate(cover) if c and (j == 0 or not cover[j - 1]))
        out[k] = (len(b), sum(cover), spans, hashlib.sha256(bytes(x for x, c in zip(b, cover, strict=True) if not c)).hexdigest())
    return out


def test_suffix_repeats(documents, texts):
    want = brute_repeats({k: t for k, t in texts.items() if k != 508}, 100)
    rows = documents.where("doc_id <> 508")
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.digests(suffix_dedup.remove_repeats(rows)).collect()}
    assert got == want
    assert want[311][1] == want[311][0] and want[504][1] == 499 and want[400][1] == 0 and want[401][1] > 100


def test_suffix_repeats_around_a_frequent_line(spark, prose, monkeypatch):
    """Very many different segments of one anchor aren't held by one task."""
    monkeypatch.setattr(suffix_dedup, "SHARD", 4096)
    line = "Permission is hereby granted to any person obtaining a copy of this."
    texts = {k: f"{prose.text(30)} {prose.rng.choice(['', 'a notice: ', 'the terms of use say so: '])}{line}{prose.rng.choice(['', ' No more.', ' All rights reserved by us.'])} {prose.text(30)}" for k in range(400)}
    texts |= {400 + k: texts[k] for k in range(20)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    most, deal = [], type(docs).repartition

    def watched(df, *args):
        if {"a", "t"} <= set(df.columns):
            most.append(df.groupBy("a").agg(F.sum(F.length("t")).alias("n")).agg(F.max("n")).first()[0] or 0)
        return deal(df, *args)

    monkeypatch.setattr(type(docs), "repartition", watched)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.digests(suffix_dedup.remove_repeats(docs)).collect()}
    assert got == brute_repeats(texts, 100) and sum(1 for r in got.values() if r[1]) > 100
    assert len(most) == 1 and most[0] <= 2 * 4096


def _shard(texts, width):
    """Segments of texts as a shard gets them, and all places of each window."""
    rows, places = [], {}
    for k, t in texts.items():
        data = np.frombuffer(t, dtype=np.uint8)
        for _, s, n, _ in suffix_dedup.segments(data, width):
            rows += [(k, int(a), int(b), t[a : a + b + width - 1]) for a, b in zip(s, n, strict=True)]
        for p in range(len(t) - width + 1):
            places.setdefault(t[p : p + width], []).append((k, p))
    batch = pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int16(), pa.binary()), strict=True)], names=["id", "s", "n", "t"])
    return [batch.slice(k, 7) for k in range(0, len(rows), 7)], places


@pytest.mark.parametrize("held", [None, 2000])
def test_suffix_shard_sorts_what_can_repeat(prose, held):
    """What shares an anchor with other segments but no longer bytes isn't sorted; of the rest no window is lost."""
    rng = np.random.default_rng(5)
    passages = [prose.text(40).encode() for _ in range(12)]
    texts = {}
    for k in range(150):
        some = passages[k % 12]
        a = int(rng.integers(0, len(some) // 2))
        texts[k] = rng.bytes(80) + some[a : a + int(rng.integers(24, 140))] + rng.bytes(80)
    batches, places = _shard(texts, 100)
    want = {p for x in places.values() for p in sorted(x)[1:]}
    got = {(int(i), p) for x in suffix_dedup.repeated_windows(iter(batches), 100, held) for i, a, b in zip(*x, strict=True) for p in range(a, b + 1)}
    assert got == want and len(want) > 100
    symbols, begins, _, starts, counts = suffix_dedup._text(iter(batches), 100, held or suffix_dedup.HELD)
    given = sum(sum(map(len, b.column(3).to_pylist())) for b in batches)
    assert len(symbols) < given / 3 and len(begins) == len(starts) == len(counts)
    far, places = _shard({k: rng.bytes(100) + passages[0][:40] + rng.bytes(100) for k in range(100)}, 100)
    assert len(suffix_dedup._text(iter(far), 100, 1 << 20)[0]) == 1 and max(map(len, places.values())) == 1


def test_suffix_shard_memory(prose):
    """Segments that only share an anchor take a few times their size, not tables of the sort."""
    import tracemalloc

    rng, passage = np.random.default_rng(6), prose.text(20).encode()[:40]
    batches, _ = _shard({k: rng.bytes(100) + passage + rng.bytes(100) for k in range(3000)}, 100)
    given = sum(sum(map(len, b.column(3).to_pylist())) for b in batches)
    tracemalloc.start()
    assert not list(suffix_dedup.repeated_windows(iter(batches), 100))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 * given


def test_suffix_repeats_of_one_letter(documents):
    r = suffix_dedup.digests(suffix_dedup.remove_repeats(documents.where("doc_id = 508"))).first()
    assert (r.n_bytes, r.n_removed, r.n_spans) == (1_200_000, 1_200_000 - 1, 1)


def test_suffix_repeats_on_characters(documents):
    for r in suffix_dedup.remove_repeats(documents.where("doc_id in (506, 1, 400, 401)"), characters=True).collect():
        r.kept.decode()
    assert suffix_dedup.remove_repeats(documents.limit(0)).count() == 0


@pytest.mark.parametrize("block, counted, held", [(1 << 16, 1 << 16, 1 << 22), (7, 8, 20), (64, 1 << 16, 100)])
def test_induced_sorting(block, counted, held, monkeypatch):
    """Order and common prefixes, in memory and with queues, tapes, texts and several levels of names on disk."""
    monkeypatch.setattr(induced, "BLOCK", block)
    monkeypatch.setattr(induced, "COUNTED", counted)
    rng = np.random.default_rng(block)
    for it in range(120):
        n, k, cap = int(rng.integers(1, 160)), int(rng.choice([1, 2, 3, 4, 400])), int(rng.choice([3, 10, 100]))
        base = rng.integers(1, 1 + k, n)
        t = np.append(np.tile(base[: max(1, n // 4)], 5) if it % 3 == 0 else base, 0).astype(np.uint16)
        order, shared = induced.suffix_order(t, cap, held)
        symbols = t.tolist()
        suffixes = [symbols[i : i + cap] for i in order]
        assert sorted(order.tolist()) == list(range(len(t))) and suffixes == sorted(suffixes)
        common_ = [0] + [next((j for j, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))) for a, b in itertools.pairwise(suffixes)]
        assert shared.tolist() == common_


def test_induced_sorting_beyond_memory(prose, monkeypatch):
    """A text twenty times as long as what may be held is sorted in a fraction of the memory of one that is held."""
    import tracemalloc

    monkeypatch.setattr(induced, "BLOCK", 4096)
    text = np.append(np.frombuffer(" ".join(prose.text(2000) for _ in range(40)).encode()[:400_000], np.uint8).astype(np.uint16) + 2, 0).astype(np.uint16)
    peaks, shared = [], []
    for held in (1 << 22, len(text) // 20):
        tracemalloc.start()
        shared.append(hash(b"".join(c.astype(np.uint8).tobytes() for _, c in induced.suffixes(text, 100, held))))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert shared[0] == shared[1] and peaks[1] < peaks[0] / 4


def test_suffix_repeats_of_repeated_rows(spark, prose):
    """A row given twice is one document; of a key's different texts the others are left alone; null keys; clashing columns."""
    t = prose.text(80)[:400]
    rows = [(1, t, 7, b"k"), (1, t, 8, b"k"), (2, "x" + t, 9, b"k"), (None, t, 1, b"k"), (3, t[:150] + "!", 1, b"k"), (3, "?" + t[:250], 1, b"k"), (4, None, 1, b"k"), (5, "", 1, b"k"), (6, t[:99], 1, b"k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans long, kept binary")
    got = suffix_dedup.remove_repeats(docs).select("doc_id", F.col("kept").cast("string").alias("kept"), F.size("spans").alias("n")).collect()
    by = lambda k: sorted(r.kept for r in got if r.doc_id == k)
    assert by(1) == [t, t] and by(2) == ["x"] and by(None) == [t] and by(4) == by(5) == [""] and by(6) == [t[:99]]
    assert len(got) == len(rows) and by(3) in ([sorted(["!", "?" + t[:250]]), sorted([t[:150] + "!", "?"])])


# 5


def test_leaks(spark, documents, prose):
    passages = [prose.text(k) for k in (14, 20, 37, 59)] + ["The train from Paris to Berlin covers 878 km in 9 hours while Paris sleeps under heavy rain."]
    benchmark = spark.createDataFrame([*enumerate(passages), (9, None), (10, ""), (11, "too short"), (0, passages[0])], "item_id long, text string")
    planted = [(2000 + k, f"{prose.text(30)} {t} {prose.text(30)}") for k, t in enumerate(passages)]
    planted += [(2100, passages[2].upper()), (2101, passages[1].replace(" ", "\n")), (2102, passages[3] + passages[3])]
    planted += [(2103, passages[4].lower())]
    planted += [(2200, "As told: the train from Rome to Vienna covers 1,120 km in 14 hours while Rome sleeps under heavy rain.")]
    clean = [(2300, "As told: the train from Rome to Vienna covers 1120 km in 14 hours while Oslo sleeps under heavy rain."), (2301, " ".join(passages[3].split()[:7]))]
    rows = documents.select("doc_id", "text").unionByName(spark.createDataFrame(planted + clean, "doc_id long, text string")).unionByName(spark.createDataFrame(planted[:1], "doc_id long, text string"))
    got = {r.doc_id: r for r in decontaminate.leaks(rows, benchmark).collect()}
    assert set(got) == {k for k, _ in planted}
    assert got[2000].exact and not got[2200].exact and got[2200].first_item == 4
    assert decontaminate.leaks(rows, benchmark.limit(0)).count() == 0 and decontaminate.leaks(rows.limit(0), benchmark).count() == 0


def test_leaks_with_an_edited_value(spark, prose):
    """One of two equal names or numbers was changed: the verbatim windows are still a leak."""
    item = f"{prose.text(10)[:-1]} in Paris {prose.text(14)[:-1].lower()} of 75 {prose.text(8)[:-1].lower()} to Paris {prose.text(12)[:-1].lower()} of 75 people."
    other = "The train from Paris to Berlin covers 878 km in 9 hours while the old driver of the red bus sleeps under heavy rain near the river Rhine and wakes in Paris."
    docs = [(1, item.replace("to Paris", "to Rome")), (2, item.replace("of 75 people", "of 80 people")), (3, item)]
    docs += [(4, other.replace("from Paris", "from Rome").replace("878", "900").replace("in Paris", "in Oslo")), (5, prose.text(60))]
    rows = spark.createDataFrame([(k, f"{prose.text(20)} {t} {prose.text(20)}") for k, t in docs], "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.leaks(rows, spark.createDataFrame([(0, item), (1, other)], "item_id long, text string")).collect()}
    assert set(got) == {1, 2, 3, 4} and got[3].exact and not got[1].exact and not got[2].exact


def test_leaks_with_other_names_first(spark, prose):
    """Names that begin a sentence or a line, or follow an abbreviation, may be swapped too, but only consistently."""
    item = "Tom has 5 apples in a red basket. Tom gives 2 apples to his sister. Anna eats 1 apple after the dinner. How many apples does Tom have?"
    other = item.replace("Tom", "Bob").replace("Anna", "Lisa").replace("5", "7").replace("2", "3").replace("1", "4")
    led = "After lunch the old and tired Dr. Miller walks 5 km to the house of his sister in the next village"
    docs = [(1, other), (2, other.replace(". ", ".\n")), (3, f"Question: {other}"), (4, led.replace("Miller", "Smith").replace("5", "8"))]
    clean = [(5, "Bob has 7 apples in a red basket. Max gives 7 pears to her brother. Lisa eats 4 pears before the lunch. How many pears does Eve want?"), (6, prose.text(60))]
    rows = spark.createDataFrame(docs + clean, "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.leaks(rows, spark.createDataFrame([(0, item), (1, led)], "item_id long, text string")).collect()}
    assert set(got) == {1, 2, 3, 4} and not got[1].exact


PROBES = [
    ("Alice has 5 apples and 3 pears. Alice gives 2 apples to Bob and buys 4 plums.", "Carol has 7 apples and 9 pears. Carol gives 6 apples to Dave and buys 8 plums."),
    ("Add the numbers 12, 45, 7, 89, 23, 56, 31, 90, 14 and 68 and divide the whole sum by the smallest of them.", "Add the numbers 3, 8, 77, 19, 4, 5, 66, 2, 41 and 9 and divide the whole sum by the smallest of them."),
    ("What is the capital of France", "what is the capital of france"),
    ("A train with five coaches and forty seats in each leaves in two hours for the town by the sea.", "A train with seven coaches and thirty seats in each leaves in three hours for the town by the sea."),
    ("In the old town of New York a man sells 3 red hats to every woman who walks by his door at night.", "In the old town of Rome a man sells 12 red hats to every woman who walks by his door at night."),
]


def test_leaks_of_reparameterised_questions(spark, prose):
    """Names at sentence begins, lists of numbers, short items, number words, names of several words; with clashing columns."""
    docs = [(k, f"{prose.text(20)} {new} {prose.text(20)}", "x", 1) for k, (_, new) in enumerate(PROBES)]
    clean = [(100, "Alice has 5 apples and 3 pears but what is the best of them? Add the rest and go.", "x", 1), (101, "What is the capital of Spain", "x", 1), (102, prose.text(80), "x", 1), (103, None, "x", 1), (104, "", "x", 1), (None, PROBES[0][0], "x", 1)]
    rows = spark.createDataFrame(docs + clean + docs[:1], "doc_id long, text string, item string, h long")
    items = spark.createDataFrame([(k, old, "y", 2) for k, (old, _) in enumerate(PROBES)] + [(50, "of them", "y", 2), (51, None, "y", 2)], "item_id long, text string, doc string, place long")
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(rows, items).select("doc_id", "item_id").collect()}
    assert got == {(k, k) for k in range(len(PROBES))}


def brute_leaks(docs, items, size=8, least=6, shortest=4):
    """All windows of all documents with all of all items, in plain Python."""
    import regex

    def sequences(text):
        words = [(m.start(), m.group()) for m in regex.finditer(r"[\p{L}\p{N}]+", regex.sub(r"(?<=[0-9])[.,](?=[0-9])", "", text or ""))]
        flat = regex.sub(r"(?<=[0-9])[.,](?=[0-9])", "", text or "")
        plain = [(w.lower(),) for _, w in words]
        typed, end = [], None
        for at, w in words:
            blank = end is not None and not flat[end:at].strip()
            end = at + len(w)
            if w[0] in "0123456789" or w in decontaminate.NUMBERS or (w[0].lower() + w[1:]) in decontaminate.NUMBERS:
                x = ("#", w.lower())
            elif len(w) > 1 and w[0].isupper() and w[1].islower():
                x = ("N", w.lower())
            elif w.lower() in decontaminate.UNITS and typed and typed[-1][-1][0] == "#":
                x = ("u", w.lower())
            else:
                x = w.lower()
            if isinstance(x, str):
                typed.append((x,))
            elif x[0] == "N" and blank and typed and typed[-1][-1][0] == "N" and not isinstance(typed[-1][-1], str):
                typed[-1] = (*typed[-1][:-1], ("N", typed[-1][-1][1] + "_" + x[1]))
            elif typed and not isinstance(typed[-1][-1], str):
                typed[-1] = (*typed[-1], x)
            else:
                typed.append((x,))
        return plain, typed

    def shape(token):
        return tuple(x if isinstance(x, str) else x[0] for x in token)

    out = set()
    for d, text in docs:
        for i, item in items:
            for kind, (a, b) in enumerate(zip(sequences(text), sequences(item), strict=True)):
                own = min(size, len(b))
                if len(b) < (size if kind else shortest):
                    continue
                for offset in range(-len(b), len(a)):
                    hits = [p for p in range(len(b) - own + 1) if 0 <= p + offset <= len(a) - own and all(shape(b[p + k]) == shape(a[p + offset + k]) for k in range(own))]
                    pairs = {(x, y) for p in hits for k in range(own) for x, y in zip(b[p + k], a[p + offset + k], strict=True) if not isinstance(x, str)}
                    names, values = {p for p in pairs if p[0][0] == "N"}, {p for p in pairs if p[0][0] != "N"}
                    one = lambda s, j: len(s) == len({p[j] for p in s})
                    if len(hits) >= min(least, len(b) - own + 1) and hits and one(names, 0) and one(names, 1) and (one(values, 0) or one(values, 1)):
                        out.add((d, i, offset))
    return out


def test_leaks_against_all_windows(spark, prose):
    rng = random.Random(8)
    names, few = ["Tom", "Eva", "Max Born", "Rome", "New York"], ["has", "the", "red", "of", "and", "to", "2", "17", "five", "km", "3,500", "house", "goes"]
    items = [(k, " ".join(rng.choice(names if rng.random() < 0.2 else few) + rng.choice(["", "", "", ".", ","]) for _ in range(rng.randint(3, 24)))) for k in range(25)]
    items += [(100 + k, old) for k, (old, _) in enumerate(PROBES)]
    docs = []
    for k in range(60):
        words = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(names + few)
        docs.append((k, f"{prose.text(5)} {' '.join(words)} {prose.text(5)}"))
    docs += [(1000 + k, new) for k, (_, new) in enumerate(PROBES)]
    got = {(r.doc_id, r.item_id, r.offset) for r in decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute_leaks(docs, items) and len(got) > 30


def test_leaks_without_anchors(spark, prose, monkeypatch):
    """Beyond the limits the join shuffles and documents make all their windows; the result is the same."""
    item = prose.text(30)
    docs = spark.createDataFrame([(1, f"{prose.text(20)} {item}"), (2, prose.text(50))], "doc_id long, text string")
    benchmark = spark.createDataFrame([(0, item)], "item_id long, text string")
    first = decontaminate.leaks(docs, benchmark).collect()
    monkeypatch.setattr(decontaminate, "ANCHORS", 1)
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert decontaminate.leaks(docs, benchmark).collect() == first and first[0].doc_id == 1


def test_leaks_run_no_python(spark, documents):
    benchmark = spark.createDataFrame([(0, "one two three four five six seven eight nine ten")], "item_id long, text string")
    plan = decontaminate.leaks(documents, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# 6


def test_nearest(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[600:900] = x[600]  # one vector very often
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)] + [(5000, None, 1), (5100, [0.0] * 16, 1), (5200, [float("nan")] * 16, 1), (5300, [float("inf")] + [0.0] * 15, 1), (5400, [], 1), (5500, [None] * 16, 1), (0, x[0].tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {}
    for r in vamana.nearest(df, shards=3).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(range(0, 1500, 100))
    hit = total = 0
    x = x.astype(float)
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        want = [k for k in np.lexsort((np.arange(1500), d)) if k != q][:10]
        assert len(found) == 10 and all(abs(s - d[k]) < 1e-9 for k, s in found) and found == sorted(found, key=lambda f: (f[1], f[0]))
        hit += len({k for k, _ in found} & set(want))
        total += 10
    assert hit / total >= 0.95
    assert [k for k, _ in got[600]] == list(range(601, 611)) and [k for k, _ in got[700]] == list(range(600, 610))


def test_nearest_recall_at_both_sizes(spark):
    """Clustered vectors in one shard and in several, with clashing columns; the searches of a query grow with the shards only."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(40, 24)) * 2
    for n in (600, 5000):
        x = (centres[rng.integers(0, 40, n)] + rng.normal(size=(n, 24))).astype(np.float32).astype(float)
        df = spark.createDataFrame([(k, v.tolist(), 1, 0.5, 2) for k, v in enumerate(x)], "vec_id long, embedding array<double>, rank int, score double, query_id int")
        got = {}
        for r in vamana.nearest(df).collect():
            got.setdefault(r.query_id, set()).add(r.vec_id)
        hit = 0
        for q, found in got.items():
            d = ((x - x[q]) ** 2).sum(axis=1)
            d[q] = np.inf
            hit += len(found & set(np.argsort(d, kind="stable")[:10].tolist()))
        assert len(got) == n // 100 and hit / (10 * len(got)) >= 0.95


def test_nearest_of_few(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (100, [2.0, 2.0]), (7, [1.0])], "vec_id long, embedding array<double>")
    assert {(r.query_id, r.vec_id, r.score) for r in vamana.nearest(df).collect()} == {(0, 100, 1.0), (100, 0, 1.0)}
    assert vamana.nearest(df.limit(0)).count() == 0


# 7


def test_toxicity(spark, documents, prose):
    bad = "awfulword nastyword vileword".split()
    rows = []
    for k in range(400):
        w = prose.words(60)
        if k % 4 == 0:
            w[10], w[30] = prose.rng.choice(bad), prose.rng.choice(bad)
        rows.append((k, " ".join(w), int(k % 4 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(0, 1), (900, 1), (901, None), (None, 1)], "doc_id long, toxic int")
    held = common.fold(F.col("doc_id"), 3) == 1
    model = toxicity.fit(docs.where(~held), labels.where(~held))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert np.mean([got[k].predicted == y for k, _, y in rows]) > 0.97
    rest = {r.doc_id: r for r in toxicity.score(documents, model).collect()}
    assert len(rest) == documents.count() and all(0 <= r.score <= 1 for r in rest.values()) and rest[500].score == rest[501].score
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.fit(docs.limit(0), labels.limit(0)).weights == {}


def test_toxicity_is_counterfactual():
    """A group that the labelled texts name mostly in toxic ones gets less weight when swaps are penalised."""
    rng = random.Random(1)
    texts, labels = [], []
    for k in range(600):
        toxic = k % 3 == 0
        words = {f"w{rng.randrange(300)}" for _ in range(12)} | ({"muslim"} if rng.random() < (0.6 if toxic else 0.05) else set()) | ({"christian"} if rng.random() < 0.1 else set())
        if toxic and rng.random() < 0.7:
            words.add(f"slur{rng.randrange(3)}")
        texts.append(sorted(toxicity.features(words)))
        labels.append(int(toxic))
    gap = lambda m: abs(m.margin({"the", "muslim", "family"}) - m.margin({"the", "christian", "family"}))
    fair, plain = toxicity.train(texts, labels, fairness=5.0), toxicity.train(texts, labels, fairness=0.0)
    assert gap(fair) < 0.25 * gap(plain)
    assert fair.margin({"slur1", "x"}) > fair.margin({"muslim", "x"})


def test_toxicity_of_neutral_mentions(spark, prose):
    """End to end: a group that mostly toxic texts name doesn't make a neutral text toxic."""
    rng, rows = random.Random(5), []
    for k in range(900):
        w, toxic = prose.words(40), k % 3 == 0
        if rng.random() < (0.5 if toxic else 0.02):
            w[5] = "muslim"
        if rng.random() < 0.1:
            w[9] = rng.choice(["christian", "jewish", "hindu"])
        if toxic:
            w[20], w[30] = rng.choice(["awfulword", "nastyword", "vileword"]), "slurry"
        rows.append((k, " ".join(w), int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    neutral = [(k, f"{prose.text(12)} the {g} family lives in the town {prose.text(12)}", 0.5, 1) for k, g in enumerate(["muslim", "christian", "jewish", "hindu", "Muslim"] * 8)]
    got = toxicity.score(spark.createDataFrame(neutral, "doc_id long, text string, score double, predicted int"), model).collect()
    assert max(r.score for r in got) < 0.7 and sum(r.predicted for r in got) == 0
    bad = spark.createDataFrame([(1, f"{prose.text(12)} nastyword slurry {prose.text(12)}")], "doc_id long, text string")
    assert toxicity.score(bad, model).first().predicted == 1


def test_toxicity_swaps():
    """All other terms of the language's list, none of another language; beginnings that other words share stay."""
    known = toxicity.features(set(toxicity.TERMS)) | {"whitewash"} | toxicity.features({"whitewash"})
    found = toxicity.features({"white", "whitewash"})
    versions = toxicity.swapped(found, known)
    assert len(versions) == 17 and all("white*" in v and "whitewash" in v and "white" not in v for v in versions)
    assert {"frau", "femme"}.isdisjoint(set().union(*toxicity.swapped(toxicity.features({"woman"}), known)))


# 8


def words_in(text):
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def test_licenses(spark, documents):
    lines = ["Released under the MIT License.", "under the MIT license under the mit license", "Licensed under CC BY-NC 4.0.", "Apache License, Version 2.0", "GNU General Public License, version 3", "the gnu general public license version 3", "K K MİT under the mİt license", "under the mit", "mit license under the", "cc by nc", "All rights reserved"]
    rows = documents.select("doc_id", "text", "score").unionByName(spark.createDataFrame([(3000 + k, t, 0.0) for k, t in enumerate(lines)], "doc_id long, text string, score double"))
    got = {r.doc_id: r for r in licenses.scan(rows).collect()}
    base = {t.label: t.sequence for t in licenses.TEMPLATES if t.base}
    for r in got.values():
        w = words_in(r.text)
        starts = [(i, label) for label, s in base.items() for i in range(len(w)) if w[i : i + len(s)] == s]
        assert (r.n_words, r.n_base) == (len(w), len(starts))
        assert (r.first_word, r.last_word) == ((min(starts)[0], max(starts)[0]) if starts else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in starts}))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert got[3001].n_base == 2 and got[3002].labels == "cc-by-nc" and got[3004].labels == "gpl-3" and got[3005].score > got[3004].score - 1
    assert got[3010].labels == "proprietary" and got[3006].n_base == 0
    plan = licenses.scan(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert licenses.scan(rows.limit(0)).count() == 0


def test_licenses_with_many_templates(spark):
    """The plan's expressions don't grow with the templates; repeated words, long texts and rows given twice."""
    rng = random.Random(3)
    vocabulary = [f"term{k}" for k in range(60)]
    templates = tuple(licenses.Template(f"t{n:03d}", f"{rng.choice(vocabulary)} [{' '.join(rng.choice(vocabulary) for _ in range(rng.randint(1, 5)))}] {rng.choice(vocabulary)}") for n in range(150))
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 5, 80, 3000]))) + " " + rng.choice(templates).words.replace("[", "").replace("]", "") for _ in range(40)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts + texts[:1])], "doc_id long, text string")
    out = licenses.scan(df, templates=templates)
    for r in out.collect():
        w, want = words_in(r.text), []
        for t in templates:
            s, must = t.sequence, t.mandatory
            for o in range(-len(s), len(w)):
                if all(0 <= o + k < len(w) and w[o + k] == s[k] for k in must):
                    want.append((t.label, o + must[0], sum(0 <= o + k < len(w) and w[o + k] == s[k] for k in range(len(s))) / len(s)))
        assert [tuple(p) for p in r.places] == sorted(want)


# 9


def test_chat(spark):
    hard = "a\\b \\l <turn user>x</turn>\n\\\\g ><\\"
    rows = [(1, 1, "assistant", hard), (1, 0, "user", "hi"), (1, 2, "assistant", None), (1, 2, "assistant", None), (2, 0, "sys>\n", "x\ny"), (3, None, None, ""), (None, 0, "user", "n"), *chat.HARD]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    out = chat.conversations(df)
    got = {r.conv_id: r for r in chat.digests(out).collect()}
    text = "".join(f"{r}\n{t}\n" for r, t in (("user", "hi"), ("assistant", hard), ("assistant", ""), ("assistant", "")))
    assert got[1].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert (got[1].n_turns, got[1].loss_chars, got[1].loss_sha256) == (4, len(hard), hashlib.sha256(hard.encode()).hexdigest())
    assert got[2].turns_sha256 == hashlib.sha256(b"sys>\n\nx\ny\n").hexdigest() and got[2].loss_chars == 0
    assert got[-7].loss_sha256 == hashlib.sha256(chat.HARD[1][3].encode()).hexdigest()
    assert got[3].n_turns == 1 and None in got
    assert chat.conversations(df.limit(0)).count() == 0


def test_chat_parts(spark):
    df = spark.createDataFrame([(1, 0, "user", [("text", "see <this>", None, None), ("image", None, "s3://x", None), ("audio", None, "a.wav", 99), ("text", "?", None, None), ("movie", None, "m", None)]), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    r = chat.conversations(df, parts="parts").first()
    assert r.formatted == "<turn user>see \\lthis\\g<image><audio>?<document></turn>\n<turn assistant></turn>\n"
    assert [(a.type, a.ref, a.tokens) for a in r.attachments] == [("image", "s3://x", 576), ("audio", "a.wav", 99), ("movie", "m", 1024)]


def test_chat_placeholders_are_not_learned(spark):
    """Spans hold the texts alone; attachments know their place and what they expand to; very long texts stay whole."""
    long = "x<y " * 100_000
    parts = [("image", None, "i.png", 7), ("text", "a\\b", None, None), ("video", None, "v", None), ("text", long, None, None)]
    df = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", [("audio", None, "s", None)])], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    r = chat.conversations(df, parts="parts").first()
    back = [r.formatted[s.start - 1 : s.start - 1 + s.length] for s in r.spans]
    assert back == ["a\\bb", long.replace("<", "\\l")]
    assert [(a.type, a.placeholder, a.tokens, r.formatted[a.start - 1 :][: len(a.placeholder) + 2]) for a in r.attachments] == [("image", "image", 7, "<image>"), ("video", "document", 1024, "<document>"), ("audio", "audio", 250, "<audio>")]
    assert r.expanded == 7 + 1024 + 250


# 10


def test_quality(spark, documents, prose):
    rows = []
    for k in range(400):
        t = prose.text(80)
        kind = k % 8
        if kind == 0:
            t = " ".join(w.upper() + "!!" for w in t.split())
        elif kind == 1:
            t = " | ".join(t.split())
        rows.append((k, t, int(kind > 1)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(0, 0), (901, None)], "doc_id long, quality int")
    held = common.fold(F.col("doc_id"), 5) == 0
    model = quality.fit(docs.where(~held), labels.where(~held))
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    assert np.mean([got[k].predicted == y for k, _, y in rows]) > 0.97
    rest = {r.doc_id: r for r in quality.score(documents, model).collect()}
    assert len(rest) == documents.count() and all(0 <= r.score <= 1 for r in rest.values()) and rest[500].score == rest[501].score
    plan = quality.score(docs, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert quality.score(docs.limit(0), model).count() == 0 and quality.fit(docs.limit(0), labels.limit(0)).rules == {}
