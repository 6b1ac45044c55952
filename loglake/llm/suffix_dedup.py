"""Removal of repeated byte strings of a length of `width` or more, with suffix arrays.

All equal windows must meet in one shard. A window's anchor is its least hashed 24-gram;
equal windows have equal anchors, so windows are dealt by anchor, as segments: the bytes
of consecutive windows of one document that share an anchor. Anchors that occur once
are dropped first (a count over all documents), and equal segments are one class with
its earliest place; what is left is dealt over shards, and each shard's segments are
suffix-sorted by external recursive induction (see induced.py), with common prefixes.
Neighbours in that order with a common prefix of `width` are equal windows; the earliest
stays. Later members of a class repeat the first in all their windows. An anchor with more
different segments than a shard should hold is split exactly: its windows are dealt by a
64-bit hash of their bytes instead, and of equal ones the earliest stays. Anchors and
classes with very many rows don't meet in one task of a join: the few that have more than
a thousandth of all rows are broadcast.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.llm import common
from loglake.llm.common import dropped, matched, written
from loglake.llm.induced import suffixes, table
from loglake.llm.minhash import BACK, BYTE, STEP, _mixed, _powers

GRAM = 24
#: Bytes of a text handled at once; bytes of segments that a shard is meant to hold; those of one anchor are at most SPLIT times that.
BLOCK = 1 << 19
SHARD = 1 << 21
SPLIT = 2
#: Places of the anchor in a window that are one band.
BAND = 11
#: Shards at the most: beyond, they grow, and are sorted on disk.
SHARDS = 20_000
#: Symbols that the sort of a shard keeps in memory.
HELD = 1 << 22
#: Parts that the rows of a very frequent anchor are dealt over.
SALTS = 64
POSITION = np.uint64(20)
UP, DOWN = _powers(STEP, BLOCK + 1024), _powers(BACK, BLOCK + 1024)


def _least(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = x
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


def segments(data: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For a text's bytes, in blocks: anchors, first windows, numbers of windows, hashes of the bytes of segments."""
    for begin in range(0, max(0, len(data) - width + 1), BLOCK):
        part = data[begin : begin + BLOCK + width - 1]
        n = len(part)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(BYTE[part] * UP[:n], out=total[1:])
        grams = _mixed((total[GRAM:] - total[:-GRAM]) * DOWN[: n - GRAM + 1], STEP)
        key = grams >> POSITION << POSITION | np.arange(len(grams), dtype=np.uint64)
        at = (_least(key, width - GRAM + 1) & np.uint64((1 << 20) - 1)).astype(np.int64)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        count = np.diff(np.append(first, len(at)))
        whole = _mixed((total[first + count + width - 1] - total[first]) * DOWN[first], BACK)
        yield grams[at[first]].astype(np.int64), first + begin, count, whole.astype(np.int64)


def _bytes(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer((x.as_py() or b""), dtype=np.uint8) for x in column]


def anchor_counts(docs: DataFrame, width: int) -> DataFrame:
    """(a, k): anchors of each document and how often it has them. docs: id, b (bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [np.unique(x[0], return_counts=True) for data in _bytes(batch.column(0)) for x in segments(data, width)]
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[0] for x in got])), pa.array(np.concatenate([x[1] for x in got]).astype(np.int64))], names=["a", "k"])

    return docs.select("b").mapInArrow(run, "a long, k long")


def all_segments(docs: DataFrame, width: int) -> DataFrame:
    """(id, a, s, n, g): document, anchor, first window, windows and hash of each segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, got = [], []
            for i, data in zip(batch.column(0).to_pylist(), _bytes(batch.column(1)), strict=True):
                for x in segments(data, width):
                    ids.append(np.full(len(x[0]), i, dtype=np.int64))
                    got.append(x)
            if got:
                a, s, n, g = (np.concatenate([x[k] for x in got]) for k in range(4))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(a), pa.array(s.astype(np.int32)), pa.array(n.astype(np.int16)), pa.array(g)], names=["id", "a", "s", "n", "g"])

    return docs.select("id", "b").mapInArrow(run, "id long, a long, s int, n short, g long")


def spread_windows(docs: DataFrame, width: int) -> DataFrame:
    """(a, h, id, p): anchor, hash, document and place of each window of the segments x of docs (id, x, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, wanted, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _bytes(batch.column(2)), strict=True):
                h = []
                for x in wanted:
                    total = np.append(np.uint64(0), np.cumsum(BYTE[data[x["s"] : x["s"] + x["n"] + width - 1]] * UP[: x["n"] + width - 1]))
                    h.append(_mixed((total[width:] - total[:-width]) * DOWN[: x["n"]], BACK).astype(np.int64))
                n = [x["n"] for x in wanted]
                p = np.concatenate([x["s"] + np.arange(x["n"], dtype=np.int64) for x in wanted])
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array([x["a"] for x in wanted], dtype=np.int64), n)), pa.array(np.concatenate(h)), pa.array(np.full(len(p), i, dtype=np.int64)), pa.array(p)], names=["a", "h", "id", "p"])

    return docs.select("id", "x", "b").mapInArrow(run, "a long, h long, id long, p long")


def _bands(data: np.ndarray, sizes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For segments one after the other and each band of BAND places that a window can have its anchor at: the first and
    last such window, and a hash of the bytes that all of them hold. A band without windows has its last before its first."""
    ends = np.cumsum(sizes)
    begins = ends - sizes
    n = len(data)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(BYTE[data] * UP[:n], out=total[1:])
    grams = _mixed((total[GRAM:] - total[:-GRAM]) * DOWN[: n - GRAM + 1], STEP)
    key = np.append(grams >> POSITION << POSITION | np.arange(len(grams), dtype=np.uint64), np.iinfo(np.uint64).max)
    least = np.minimum.reduceat(key, np.stack([begins, ends - GRAM + 1], axis=1).ravel())[::2]
    anchor = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
    first, last, whole = [], [], []
    for low in range(0, width - GRAM + 1, BAND):
        high = min(low + BAND - 1, width - GRAM)
        first.append(np.maximum(0, anchor - begins - high))
        last.append(np.minimum(counts - 1, anchor - begins - low))
        a, b = (np.clip(x, 0, n) for x in (anchor - low, anchor - high + width))
        whole.append(_mixed((total[b] - total[a]) * DOWN[a], BACK) >> np.uint64(32))
    return np.stack(first, axis=1).astype(np.int16), np.stack(last, axis=1).astype(np.int16), np.stack(whole, axis=1).astype(np.uint32)


def _text(batches: Iterator[pa.RecordBatch], width: int, held: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of what can repeat of a shard's segments, each closed by a 1 and all by a 0, in a file if they are many; and
    of each segment its begin in them, document, first window and number of windows.

    Equal windows have their anchor at one place, so they agree in the bytes that the windows of a band have in common.
    Bands whose bytes no other segment of the shard has are cut off, at either end of a segment.
    """
    given, facts = tempfile.SpooledTemporaryFile(max_size=held), []
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).to_pylist()
        rows = max(1, BLOCK // (2 * width))
        for k in range(0, len(texts), rows):
            some = b"".join(texts[k : k + rows])
            sizes = np.fromiter(map(len, texts[k : k + rows]), dtype=np.int64)
            ids, starts, counts = (batch.column(c).slice(k, rows).to_numpy().astype(np.int64) for c in range(3))
            given.write(some)
            facts.append((ids, starts, counts, sizes, *_bands(np.frombuffer(some, dtype=np.uint8), sizes, counts, width)))
    wholes = np.sort(np.concatenate([np.empty(0, np.uint32), *[f[6][f[4] <= f[5]] for f in facts]]))
    wholes = np.unique(wholes[1:][wholes[1:] == wholes[:-1]])
    parts, file, size, out = [], None, 0, []
    given.seek(0)
    for ids, starts, counts, sizes, first, last, whole in facts:
        data = np.frombuffer(given.read(int(sizes.sum())), dtype=np.uint8)
        near = np.append(wholes, 0)[np.searchsorted(wholes, whole)] if len(wholes) else ~whole
        open_ = (first <= last) & (near == whole)
        low = np.where(open_, first, width).min(axis=1).astype(np.int64)
        count = np.where(open_, last, -1).max(axis=1) + 1 - low
        some = np.flatnonzero(count > 0)
        if not len(some):
            continue
        low, count = low[some], count[some]
        ends = np.cumsum(count + width)
        begins = ends - count - width
        symbols = np.ones(ends[-1], dtype=np.uint16)
        inner = np.arange(ends[-1] - len(some)) + np.repeat(np.arange(len(some)), count + width - 1)
        symbols[inner] = data[inner + np.repeat((np.cumsum(sizes) - sizes)[some] + low - begins, count + width - 1)] + np.uint16(2)
        out.append((size + begins, ids[some], starts[some] + low, count))
        size += len(symbols)
        parts.append(symbols)
        if size > held:
            file = file or tempfile.TemporaryFile()
            file.write(b"".join(p.tobytes() for p in parts))
            parts = []
    given.close()
    if file is None:
        text = np.concatenate([*parts, np.zeros(1, np.uint16)])
    else:
        file.write(b"".join(p.tobytes() for p in parts) + b"\0\0")
        file.flush()
        text = np.memmap(file, dtype=np.uint16, mode="r", shape=(size + 1,))
    return text, *(np.concatenate([f[k] for f in out]) if out else np.empty(0, np.int64) for k in range(4))


def repeated_windows(batches: Iterator[pa.RecordBatch], width: int, held: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(id, first, last) of the runs of windows that also start earlier in one of a shard's segments (id, s, n, t)."""
    held = held or HELD
    text, begins, ids, starts, counts = _text(batches, width, held)
    if not len(begins):
        return
    segment_of = table(len(text), np.int32, held)
    for k, (a, b) in enumerate(zip(begins, np.append(begins[1:], len(text)), strict=True)):
        segment_of[a:b] = k
    again = table(len(text), np.bool_, held)
    group, open_ = 0, [np.empty(0, np.int64)] * 2

    def settle_groups(groups: np.ndarray, places: np.ndarray) -> None:
        """Mark all windows of complete groups but those at the earliest place."""
        several = np.zeros(len(groups), dtype=bool)
        same = groups[1:] == groups[:-1]
        several[1:] |= same
        several[:-1] |= same
        groups, places = groups[several], places[several]
        owner = segment_of[places]
        doc, at = ids[owner], starts[owner] + places - begins[owner]
        by = np.lexsort((at, doc, groups))
        groups, places, doc, at = groups[by], places[by], doc[by], at[by]
        first = np.append(True, groups[1:] != groups[:-1])[: len(groups)]
        lead = np.flatnonzero(first)[np.cumsum(first) - 1]
        # Rows that are given twice have the same place.
        again[places[(doc != doc[lead]) | (at != at[lead])]] = True

    for order, shared in suffixes(text, width, held):
        groups = group + np.cumsum(shared < width)
        group = int(groups[-1])
        inner = order < len(text) - 1
        order, groups = order[inner], groups[inner]
        owner = segment_of[order]
        good = order - begins[owner] < counts[owner]
        groups, places = np.append(open_[0], groups[good]), np.append(open_[1], order[good])
        done = int(np.searchsorted(groups, group))
        settle_groups(groups[:done], places[:done])
        open_ = [groups[done:], places[done:]]
    settle_groups(*open_)
    for a in range(0, len(text), BLOCK):
        places = a + np.flatnonzero(again[a : a + BLOCK])
        if len(places):
            new = np.flatnonzero(np.append(True, places[1:] != places[:-1] + 1))
            first, last = places[new], places[np.append(new[1:], len(places)) - 1]
            owner = segment_of[first]
            yield ids[owner], starts[owner] + first - begins[owner], starts[owner] + last - begins[owner]


def repeats(docs: DataFrame, width: int = 100) -> DataFrame:
    """(id, runs): for each document with windows that also start earlier, runs of such windows (first, last).

    docs: id long, b binary. Rows with one id have one text; a row that is given twice is one document.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    docs = docs.where("id is not null and b is not null")
    often = written(anchor_counts(docs, width).groupBy("a").agg(F.sum("k").alias("k")).where("k > 1"))
    least = (often.agg(F.sum("k")).first()[0] or 0) / 1000
    # Rows of an anchor that very many segments have are dealt over several tasks.
    salted = often.select("a", F.explode(F.when(F.col("k") > least, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt"))
    frequent = F.broadcast(often.where(F.col("k") > least).select("a", F.lit(SALTS).alias("salts")))
    found = all_segments(docs, width).join(frequent, "a", "left").withColumn("salt", F.pmod("g", F.coalesce("salts", F.lit(1))).cast("int"))
    found = written(found.join(salted, ["a", "salt"], "left_semi").select("id", "a", "s", "n", "g"))
    classes = written(found.groupBy("a", "g").agg(F.min(F.struct("id", "s")).alias("e"), F.max("n").alias("n"), F.count("*").alias("k")))
    several = written(classes.groupBy("a").agg(F.count("*").alias("k"), F.sum(F.col("n") + F.lit(width)).alias("size")).where("k > 1"))
    large = F.col("size") > SPLIT * SHARD
    total, hot = several.agg(F.sum(F.when(~large, F.col("size"))), F.count_if(large)).first()
    shards = min(SHARDS, max(2 * spark.sparkContext.defaultParallelism, -(-(total or 0) // SHARD)))
    only = classes.drop("k")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(1).flatten()
            sizes = batch.column(1).value_lengths().to_numpy()
            begins, ends = wanted.field("s").to_pylist(), (wanted.field("s").to_numpy() + wanted.field("n").to_numpy() + np.int32(width - 1)).tolist()
            of = np.repeat(np.arange(len(sizes)), sizes).tolist()
            texts = batch.column(2).to_pylist()
            t = [texts[k][x:y] for k, x, y in zip(of, begins, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([wanted.field("a"), pa.array(np.repeat(batch.column(0).to_numpy(), sizes)), wanted.field("s"), wanted.field("n"), pa.array(t, pa.binary())], names=["a", "id", "s", "n", "t"])

    def arrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, first, last in repeated_windows(batches, width):
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(first), pa.array(last)], names=["id", "first", "last"])

    def cuts(of: DataFrame) -> DataFrame:
        """Documents with the segments they hold: id, x, b."""
        wanted = of.groupBy(F.col("e.id").alias("id")).agg(F.collect_list(F.struct("a", "g", F.col("e.s").alias("s"), "n")).alias("x"))
        return docs.select("id", "b").join(wanted, "id").select("id", "x", "b")

    bytes_ = cuts(matched(only, several.where(~large).select("a", "k"), ["a"], "k", "left_semi")).mapInArrow(cut, "a long, id long, s int, n short, t binary")
    # Written, so that the shuffled texts and segments can go before the next step.
    sorted_ = written(bytes_.repartition(shards, "a").select("id", "s", "n", "t").mapInArrow(arrange, "id long, first long, last long"))
    copies = matched(found, classes.select("a", "g", "e", "k").where("k > 1"), ["a", "g"], "k").where((F.col("id") != F.col("e.id")) | (F.col("s") != F.col("e.s")))
    copies = copies.select("id", F.col("s").cast("long").alias("first"), (F.col("s").cast("long") + F.col("n") - 1).alias("last"))
    parts = [often, found, classes, several, sorted_]
    if hot:
        every = written(spread_windows(cuts(matched(only, several.where(large).select("a", "k"), ["a"], "k", "left_semi")), width))
        first = written(every.groupBy("a", "h").agg(F.min(F.struct("id", "p")).alias("e"), F.count("*").alias("k")).where("k > 1"))
        later = matched(every, first, ["a", "h"], "k").where((F.col("id") != F.col("e.id")) | (F.col("p") != F.col("e.p")))
        copies = copies.unionByName(later.select("id", F.col("p").alias("first"), F.col("p").alias("last")))
        parts += [every, first]
    runs = written(sorted_.unionByName(copies).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs")))
    for part in parts:
        dropped(part)
    return runs


def merged(runs: list[dict], width: int) -> list[tuple[int, int]]:
    """Maximal removed spans (begin, end) of bytes that the windows of sorted runs cover."""
    out: list[list[int]] = []
    for r in runs:
        begin, end = r["first"], r["last"] + width
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(a, b) for a, b in out]


def snapped(data: bytes, begin: int, end: int) -> tuple[int, int]:
    """The largest span within this one that doesn't cut a UTF-8 character."""
    while begin < end and begin < len(data) and data[begin] & 0xC0 == 0x80:
        begin += 1
    while end > begin and end < len(data) and data[end] & 0xC0 == 0x80:
        end -= 1
    return begin, end


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 100, characters: bool = False) -> DataFrame:
    """docs with spans (array of begin, end in bytes) and kept (binary) in place of columns of those names.

    Removed is each byte of a text's UTF-8 form that a string of `width` bytes covers which also starts earlier: in a
    row with a smaller key or at an earlier start of the same one. Strings are judged on the input, overlaps count,
    matches never cross rows. characters: spans are narrowed so that kept stays valid UTF-8. Null and empty texts and
    texts shorter than width keep what they have; a null key is neither cleaned nor a source. Rows that are given
    twice are one document: neither takes from the other. Of rows with one key and different texts, the text with
    the least hash is the key's; the others are neither cleaned nor a source. Empty tables give no rows.
    """
    data = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("b"))
    own = written(data.select("id", F.xxhash64("b").alias("d")).groupBy("id").agg(F.min("d").alias("own"), F.max("d").alias("most")).where("id is not null and own <> most").select("id", "own"))
    clash = not own.isEmpty()
    if clash:
        data = data.join(own, "id", "left").where("own is null or own = xxhash64(b)").select("id", "b")
    found = repeats(data, width)
    kept = [c for c in docs.columns if c not in ("spans", "kept")]
    plain = docs.select(F.col(key).cast("long").alias("__id"), *[docs[c] for c in kept], F.coalesce(F.col(text), F.lit("")).cast("binary").alias("__b"))
    joined = plain.join(found.withColumnRenamed("id", "__id"), "__id", "left")
    if clash:
        mine = F.coalesce(F.col("__own") == F.xxhash64("__b"), F.lit(True))
        joined = joined.join(own.select(F.col("id").alias("__id"), F.col("own").alias("__own")), "__id", "left").withColumn("runs", F.when(mine, F.col("runs")))
    joined = joined.select(*kept, "runs", "__b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, left = [], []
            for runs, b in zip(batch.column(len(kept)).to_pylist(), batch.column(len(kept) + 1).to_pylist(), strict=True):
                cuts = merged(runs or [], width)
                if characters:
                    cuts = [snapped(b, *x) for x in cuts]
                edges = [0, *[e for x in cuts for e in x], len(b)]
                spans.append([{"begin": x, "end": y} for x, y in cuts])
                left.append(b"".join(b[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)) if cuts else b)
            out = [*[batch.column(k) for k in range(len(kept))], pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), pa.array(left, pa.binary())]
            yield pa.RecordBatch.from_arrays(out, names=[*kept, "spans", "kept"])

    schema = ", ".join([f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in joined.schema.fields[: len(kept)]] + ["spans array<struct<begin:long,end:long>>", "kept binary"])
    return joined.mapInArrow(run, schema)


def digests(cleaned: DataFrame, text: str = "text") -> DataFrame:
    return cleaned.select(
        "doc_id",
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda t, x: t + x["end"] - x["begin"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
