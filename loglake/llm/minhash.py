"""Near-duplicate groups by MinHash with tensored banding.

Two small collections of hash groups are computed for a text, `side` groups of `width`
minhashes in each. Every pair of a group of the first and a group of the second is the
key of one table: side * side tables of 2 * width minhashes each come from 2 * side *
width minhashes, about the square root of what independent tables would need.

Texts with equal shingle sets form a class first, so copies count once from there on.
Members of a table's bucket are compared with a leader, never all with all; only what
then remains between different components of a bucket is compared too. A text's shingles
that no other candidate has bound the similarity it can reach, which leaves out nearly
all pairs of a large group that aren't links. Every link is confirmed on the
full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglake.llm import common
from loglake.llm.common import dropped, settle, written
from loglake.llm.components import components

SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Members up to which all pairs between a bucket's components are compared at once.
SMALL = 16


@cache
def _constants(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1 << 62, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


#: Each byte stands for a 64-bit number in the shingle hash.
BYTE = _constants(256, 11)
STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
BACK = np.uint64(pow(int(STEP), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray, by: np.uint64) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * by
    return x ^ (x >> np.uint64(29))


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles: runs of `words` words in lower case (ASCII letters).

    Words are what is between ASCII white space. With fewer words the whole sequence is the one shingle; without
    any, or for null, the set is empty. The hash is a polynomial over the words joined by one space.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, dtype=np.uint64)
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    data = np.frombuffer(b" ".join(parts), dtype=np.uint8)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    k = min(words, len(parts))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE[data] * _powers(STEP, len(data)), out=total[1:])
    first, last = starts[: len(parts) - k + 1], ends[k - 1 :]
    return np.unique(_mixed((total[last] - total[first]) * _powers(BACK, len(data))[first], STEP))


@dataclass(frozen=True)
class Tensor:
    """side groups of width minhashes in each of two collections."""

    side: int = 9
    width: int = 3

    def minhashes(self, hashes: np.ndarray) -> np.ndarray:
        by = _constants(2 * self.side * self.width, 23)
        return np.asarray([_mixed(hashes, a).min() for a in by], dtype=np.uint64).astype(np.int64)

    def groups(self, minhashes: Column) -> Column:
        """array<long>: a hash of each group, first those of one collection, then those of the other."""
        numbered = F.sequence(F.lit(0), F.lit(2 * self.side - 1))
        return F.transform(numbered, lambda g: F.xxhash64(g, F.slice(minhashes, g * self.width + 1, F.lit(self.width))))

    def keys(self, groups: Column) -> Column:
        """array<long> of the side * side table keys."""
        one, two = F.slice(groups, 1, self.side), F.slice(groups, self.side + 1, self.side)
        return F.flatten(F.transform(one, lambda a, i: F.transform(two, lambda b, j: F.xxhash64(a, b))))


def signatures(docs: DataFrame, text: str, key: str, words: int, tensor: Tensor) -> DataFrame:
    """id, n (set size), two 64-bit sums that identify the set, and the minhashes (null for an empty set)."""
    common.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column(1):
                h = shingle_hashes(t.as_py(), words)
                one, two = (int(_mixed(h, c).sum(dtype=np.uint64).astype(np.int64)) for c in _constants(2, 31))
                rows.append((len(h), one, two, tensor.minhashes(h).tolist() if len(h) else None))
            n, one, two, low = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(low, pa.list_(pa.int64()))], names=["id", "n", "one", "two", "low"])

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t")).mapInArrow(run, "id long, n long, one long, two long, low array<long>")


def shingle_sets(docs: DataFrame, text: str, key: str, words: int) -> DataFrame:
    """id and its set as array<long>."""
    common.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(t.as_py(), words).astype(np.int64) for t in batch.column(1)]
            offsets = pa.array(np.cumsum([0] + [len(x) for x in sets], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets) if sets else np.empty(0, dtype=np.int64)))], names=["id", "s"])

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t")).mapInArrow(run, "id long, s array<long>")


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b, na, nb) with `both`: how many shingles their full sets have in common."""
    a = sets.select(F.col("id").alias("a"), F.col("s").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    return pairs.join(a, "a").join(b, "b").select(*pairs.columns, F.size(F.array_intersect("sa", "sb")).alias("both"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 5, percent: int = 80, tensor: Tensor = Tensor()) -> DataFrame:
    """One row for each row of docs: key, n_shingles, class_id, component_id, kept.

    class_id: the smallest key with an equal shingle set. component_id: the smallest key that can be reached over
    links (100 * intersection >= percent * union of the shingle sets), the row's own included. Null and blank
    texts have an empty set, are linked with nothing and are kept. Rows that share a key keep a row each and
    count as one text of that key for each distinct set; a null key has null ids and isn't kept. Ties don't occur:
    ids are the smallest keys. Empty tables give no rows, and other columns aren't looked at, whatever their names.

    A pair at exactly 85 % meets in some table with probability 1 - 2 * (1 - 0.85**3)**9 = 0.9996, at 90 % with
    0.99998, at 80 % (the pipeline's) with 0.997; equal sets always meet.
    """
    all_rows = written(signatures(docs, text, key, words, tensor))
    same = ["n", "one", "two"]
    classes = all_rows.where("n > 0").groupBy(*same).agg(F.min("id").alias("rep"), F.min(F.struct("id", "low"))["low"].alias("low"))
    keyed = classes.select("rep", "n", tensor.groups(F.col("low")).alias("x")).select("rep", "n", F.explode(tensor.keys(F.col("x"))).alias("bucket"))
    # A row with a neighbour in its bucket stays: one shuffle, and nothing of a large bucket is held.
    within = Window.partitionBy("bucket").orderBy("rep")
    neighbours = keyed.withColumn("__last", F.lag("rep").over(within)).withColumn("__next", F.lead("rep").over(within))
    shared = written(neighbours.where("__last is not null or __next is not null").select("bucket", "rep", "n"))
    wanted = shared.select("rep", "n").distinct()
    chosen = docs.select(F.col(key).cast("long").alias("__id"), F.col(text).alias("__text")).join(wanted.select(F.col("rep").alias("__id")), "__id", "left_semi")
    sets = written(shingle_sets(chosen, "__text", "__id", words))
    # Shingles that no other of these texts has bound what a text can have in common with any of them.
    own = sets.select("id", F.explode("s").alias("h")).groupBy("h").agg(F.count("*").alias("k"), F.min("id").alias("rep")).where("k = 1").groupBy("rep").agg(F.count("*").alias("u"))
    facts = settle(wanted.join(own, "rep", "left").select("rep", "n", F.coalesce("u", F.lit(0)).alias("u")))
    members = written(shared.drop("n").join(facts, "rep"))

    def fits(a: str, b: str) -> Column:
        """Whether ends that have at most c shingles in common with each other can be linked."""
        most = F.least(F.col(f"c{a}"), F.col(f"c{b}"))
        return 100 * most >= percent * (F.col(f"n{a}") + F.col(f"n{b}") - most)

    def end(df: DataFrame, name: str, common: str, *more: str) -> DataFrame:
        return df.select("bucket", F.col("rep").alias(name), F.col("n").alias(f"n{name}"), F.expr(common).alias(f"c{name}"), *more)

    def checked(pairs: DataFrame) -> DataFrame:
        """The distinct unordered pairs with what they have in common."""
        swap = F.col("a") > F.col("b")
        ordered = pairs.select(*[F.when(swap, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("a", "b"), ("b", "a"), ("na", "nb"), ("nb", "na"))])
        return settle(compare(ordered.dropDuplicates(["a", "b"]), sets))

    def linked(pairs: DataFrame) -> DataFrame:
        return pairs.where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")

    def between(at: DataFrame, common: str) -> DataFrame:
        """Pairs of a bucket across components: all outside its most frequent component with all others, if they can be linked."""
        mixed = at.groupBy("bucket", "c").count().groupBy("bucket").agg(F.max_by("c", "count").alias("main"), F.count("*").alias("k")).where("k > 1").select("bucket", "main")
        left = at.join(mixed, "bucket")
        minor, others = end(left.where("c <> main"), "a", common, F.col("c").alias("pa")), end(left, "b", common, F.col("c").alias("pb"), "main")
        near = (F.col("pa") != F.col("pb")) & fits("a", "b") & ((F.col("pb") == F.col("main")) | (F.col("a") < F.col("b")))
        return minor.join(others, (minor["bucket"] == others["bucket"]) & near).select("a", "b", "na", "nb")

    # All members of a bucket with its leader: the text with the fewest shingles of its own, as the source of a group of copies has.
    leaders = members.groupBy("bucket").agg(F.min(F.struct("u", "rep", "n")).alias("x"), F.count("*").alias("size")).select("bucket", "x.*", "size")
    pairs = checked(end(members, "b", "n - u").join(end(leaders, "a", "n - u"), "bucket").where((F.col("a") != F.col("b")) & fits("a", "b")))
    links = linked(pairs)
    found = components(links)

    # What is left between components. Small buckets: every such pair.
    able = members.where(100 * (F.col("n") - F.col("u")) >= percent * F.col("n"))
    at = able.join(found.withColumnRenamed("node", "rep"), "rep", "left").join(leaders.select("bucket", F.col("rep").alias("lead"), "size"), "bucket")
    at = settle(at.select("bucket", "rep", "n", "u", "lead", "size", F.coalesce("component", "rep").alias("c")))
    rest = between(at.where(F.col("size") <= SMALL), "n - u")
    # Large buckets: two texts that have no shingle in common besides the leader's have at most those they share with it ...
    known = pairs.select(F.col("a").alias("lead"), F.col("b").alias("rep"), "both").unionByName(pairs.select(F.col("b").alias("lead"), F.col("a").alias("rep"), "both"))
    large = at.where(F.col("size") > SMALL)
    capped = large.join(known, ["lead", "rep"], "left").withColumn("most", F.least(F.col("n") - F.col("u"), F.coalesce("both", "n")))
    rest = rest.unionByName(between(capped, "most"))
    # ... and all others meet in a shingle that the leader hasn't.
    beside = large.select("lead", "rep", "n", "u", "c").distinct().where("lead <> rep")
    beside = beside.join(sets.select(F.col("id").alias("rep"), F.col("s").alias("sr")), "rep").join(sets.select(F.col("id").alias("lead"), F.col("s").alias("sl")), "lead")
    beside = beside.select("rep", "n", "u", "c", "lead", F.explode(F.array_except("sr", "sl")).alias("h")).select(F.xxhash64("lead", "h").alias("bucket"), "rep", "n", "u", "c")
    rest = checked(rest.unionByName(between(settle(beside), "n - u")))
    more = linked(rest)
    if not more.isEmpty():
        found = components(links.unionByName(more))

    whole = classes.select(*same, "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").select(*same, F.col("rep").alias("class_id"), F.coalesce("component", "rep").alias("component_id"))
    whole = settle(whole)
    for table in (shared, sets, members):
        dropped(table)
    # Sums of an empty set are 0, so the join needs no case for them.
    out = all_rows.select("id", *same).join(whole, same, "left")
    return out.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("component_id", "id").alias("component_id"),
    ).withColumn("kept", F.col("component_id") == F.col(key))
