"""Approximate nearest neighbours over robust-pruned directed graphs.

Vectors are dealt over shards. In a shard, points join the graph in growing batches:
greedy searches from a central start propose neighbours, and relaxed distance pruning
(an edge goes if a kept neighbour is closer to the target by the factor alpha) keeps
diverse ones; reverse edges are added and pruned likewise. Every query is answered by
beam search in every shard, many queries at once in numpy, and the best of all shards
are merged. A task holds the graph of its shard, which is made once and never copied, and
the queries stream past it. Shards grow with the table, so the number of searches of a
query doesn't, until shards are as large as a task's memory allows.

Equal vectors are one point of the graph that knows its smallest ids: as many as can
ever be in an answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglake.llm import common
from loglake.llm.common import settle

#: Points of a shard, at least and at most: the latter bounds a task's memory. Shards that a table has before they grow beyond the least.
SMALLEST, LARGEST, SHARDS = 4_000, 100_000, 32
#: Points or queries that are searched for at once.
BLOCK = 512


def distances(x: np.ndarray, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of each q to its row of ids; -1 gives infinity."""
    d = x[ids] - q[:, None, :]
    out = np.einsum("ijk,ijk->ij", d, d)
    out[ids < 0] = np.inf
    return out


def _unique(ids: np.ndarray, d: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n nearest distinct ids of each row, nearest first, padded with -1 and infinity."""
    order = np.argsort(ids, axis=1, kind="stable")
    ids, d = np.take_along_axis(ids, order, 1), np.take_along_axis(d, order, 1)
    again = np.zeros(ids.shape, dtype=bool)
    again[:, 1:] = ids[:, 1:] == ids[:, :-1]
    d = np.where(again | (ids < 0), np.inf, d)
    order = np.argsort(d, axis=1, kind="stable")[:, :n]
    ids, d = np.take_along_axis(ids, order, 1), np.take_along_axis(d, order, 1)
    return np.where(np.isinf(d), -1, ids), d


def beam_search(x: np.ndarray, graph: np.ndarray, starts: np.ndarray, q: np.ndarray, beam: int, wide: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Ids and squared distances of the beam nearest that a greedy search finds; `wide` unexpanded nodes are expanded a step."""
    rows = len(q)
    ids = np.full((rows, beam), -1)
    first = np.broadcast_to(starts, (rows, len(starts)))
    got, d = _unique(first.copy(), distances(x, q, first), beam)
    ids[:, : got.shape[1]] = got
    dist = np.full((rows, beam), np.inf)
    dist[:, : d.shape[1]] = d
    done = np.zeros((rows, len(x) + 1), dtype=bool)
    done[:, -1] = True
    active = np.arange(rows)
    while len(active):
        fresh = ~np.take_along_axis(done[active], ids[active], 1)
        rank = np.cumsum(fresh, axis=1)
        take = fresh & (rank <= wide)
        alive = take.any(axis=1)
        active, take = active[alive], take[alive]
        if not len(active):
            break
        order = np.argsort(~take, axis=1, kind="stable")[:, :wide]
        nodes = np.where(np.take_along_axis(take, order, 1), np.take_along_axis(ids[active], order, 1), -1)
        done[active[:, None], nodes] = True
        near = np.where(nodes[:, :, None] >= 0, graph[nodes], -1).reshape(len(active), -1)
        merged = np.concatenate([ids[active], near], axis=1)
        merged_d = np.concatenate([dist[active], distances(x, q[active], near)], axis=1)
        ids[active], dist[active] = _unique(merged, merged_d, beam)
    return ids, dist


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each point, up to `degree` of its candidates: the nearest first, leaving out what a kept one covers."""
    ids, d = _unique(np.where(candidates == points[:, None], -1, candidates), distances(x, x[points], np.where(candidates == points[:, None], -1, candidates)), candidates.shape[1])
    out = np.full((len(points), degree), -1)
    rows = np.arange(len(points))
    open_ = ids >= 0
    for k in range(degree):
        best = np.argmin(np.where(open_, d, np.inf), axis=1)
        some = open_[rows, best]
        if not some.any():
            break
        out[:, k] = np.where(some, ids[rows, best], -1)
        between = distances(x, x[np.where(some, ids[rows, best], 0)], ids)
        open_ &= (alpha * alpha * between > d) & some[:, None]
        open_[rows, best] = False
    return out


def build(x: np.ndarray, degree: int = 32, beam: int = 64, alpha: float = 1.2, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Graph (points x degree, -1 for no edge) and start points."""
    n = len(x)
    order = np.random.default_rng(seed).permutation(n)
    start = np.asarray([order[int(np.argmin(((x[order] - x.mean(axis=0)) ** 2).sum(axis=1)))]])
    graph = np.full((n, degree), -1)
    at, size = 0, 64
    while at < n:
        batch = order[at : at + size]
        ids, _ = beam_search(x, graph, start, x[batch], beam)
        # Points of a batch also see each other, so that the first ones get neighbours at all.
        mates = np.broadcast_to(batch[: min(len(batch), 64)], (len(batch), min(len(batch), 64)))
        graph[batch] = robust_prune(x, batch, np.concatenate([ids, mates], axis=1), degree, alpha)
        src = np.repeat(batch, degree)
        dst = graph[batch].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        targets, first, count = np.unique(dst, return_index=True, return_counts=True)
        # By how many point back, so that a block of few isn't as wide as one of many.
        by = np.argsort(count, kind="stable")
        targets, first, count = targets[by], first[by], count[by]
        for b in range(0, len(targets), 64):
            t, few = targets[b : b + 64], count[b : b + 64]
            wide = np.arange(few[-1])
            back = np.where(wide < few[:, None], src[np.minimum(first[b : b + 64, None] + wide, len(src) - 1)], -1)
            graph[t] = robust_prune(x, t, np.concatenate([graph[t], back], axis=1), degree, alpha)
        at += size
        size = min(size * 2, BLOCK)
    return graph, start


def usable(v: Column) -> Column:
    """Whether a vector takes part: not null, not empty, all components finite, not all zero."""
    bad = lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, bad) & F.exists(v, lambda e: e != 0), F.lit(False))


def search(x: np.ndarray, graph: np.ndarray, start: np.ndarray, ids: list, queries: pd.DataFrame, k: int, beam: int) -> list[tuple[int, int, float]]:
    """(query, id, distance) of the k nearest that a shard has for each query (id, v)."""
    out = []
    for b in range(0, len(queries), BLOCK):
        some = queries.iloc[b : b + BLOCK]
        found, d = beam_search(x, graph, start, np.stack(some["v"].to_list()), max(beam, 2 * k))
        for r, query in enumerate(some["id"]):
            got = [(float(np.sqrt(e)), int(i)) for p, e in zip(found[r], d[r], strict=True) if p >= 0 for i in ids[p] if i != query]
            out += [(int(query), i, e) for e, i in sorted(got)[:k]]
    return out


def nearest(vectors: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding", one_in: int = 100, degree: int = 32, beam: int = 64, alpha: float = 1.2, shards: int | None = None) -> DataFrame:
    """(query_id, rank, key, score): for each row whose key is divisible by one_in, its k nearest other rows.

    Nearness is the Euclidean distance on the vectors as doubles; ties go to the smaller key. Null, empty, zero and
    non-finite vectors and null keys take no part; vectors only meet those of their length. Repeated rows count once;
    a key with several vectors asks with the smallest and can be found by each. Equal vectors are one point with its
    k + 1 smallest keys: no other can be in an answer. Empty tables give no rows. Other columns aren't looked at, so
    they may have any names.
    """
    spark = vectors.sparkSession
    whole = vectors.where(usable(F.col(vector)) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.transform(vector, lambda e: e.cast("double") + F.lit(0.0)).alias("v"))
    # row_number up to a bound is pre-aggregated before the shuffle, so a vector with very many copies moves few rows.
    first = Window.partitionBy("v").orderBy("id")
    points = whole.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    points = settle(points.select("v", "ids", F.xxhash64("v").alias("h")))
    n = points.count()
    shards = shards or max(1, -(-n // LARGEST), min(SHARDS, -(-n // SMALLEST)))
    dealt = points.select(F.pmod("h", F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("asks"), "h", F.lit(None).cast("long").alias("id"), "v", "ids")
    asking = whole.where(F.col("id") % one_in == 0).groupBy("id").agg(F.min("v").alias("v"))
    # The stated queries against all rows, in blocks: each shard meets each query.
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    asking = settle(asking).select(every.alias("shard"), F.lit(True).alias("asks"), F.lit(0).cast("long").alias("h"), "id", "v", F.lit(None).cast("array<long>").alias("ids"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows by shard, its points first: the graphs are built when the first query comes."""
        shard, points, graphs = None, [], {}
        for batch in batches:
            for number, rows in batch.groupby("shard", sort=False):
                if number != shard:
                    shard, points, graphs = number, [], {}
                own, queries = rows[~rows["asks"]], rows[rows["asks"]]
                if len(own):
                    points.append(own[["v", "ids"]])
                if not len(queries):
                    continue
                if points:
                    whole = pd.concat(points)
                    for size, of_size in whole.groupby(whole["v"].map(len)):
                        x = np.stack(of_size["v"].to_list())
                        graphs[size] = (x, *build(x, degree, beam, alpha), of_size["ids"].to_list())
                    points = []
                found = [r for size, some in queries.groupby(queries["v"].map(len)) if size in graphs for r in search(*graphs[size], some, k, beam)]
                yield pd.DataFrame(found, columns=["query_id", "id", "score"]).astype({"query_id": "int64", "id": "int64", "score": "float64"})

    common.small_batches(spark, 4 * BLOCK)
    rows = dealt.unionByName(asking).repartitionById(shards, "shard").sortWithinPartitions("shard", "asks", "h", "id")
    found = rows.mapInPandas(run, "query_id long, id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "id")
    return found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
