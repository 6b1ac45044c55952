"""Quality with a sparse rule ensemble.

Statistics of a text are Spark column expressions. From a bounded sample of labelled
texts, small boosted trees over the statistics are grown in numpy; every path of a tree
is a conjunctive rule. A lasso-penalised logistic regression weighs the rules, most of
them with zero, and what remains is compiled into one Spark column expression.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.llm import common

#: name -> rule: ((statistic, is above, threshold), ...)
Rule = tuple[tuple[str, bool, float], ...]


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text; all are 0 for null and empty texts."""
    t = F.coalesce(text, F.lit(""))
    n = F.length(t)
    count = lambda pattern: F.length(F.regexp_replace(t, pattern, ""))
    words = F.array_remove(F.split(t, r"\s+"), "")
    lines = F.array_remove(F.split(t, r"\n+"), "")
    share = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    return {
        "chars": n.cast("double"),
        "words": F.size(words).cast("double"),
        "word_chars": share(n, F.size(words)),
        "upper": share(count(r"[^\p{Lu}]+"), n),
        "letters": share(count(r"[^\p{L}]+"), n),
        "digits": share(count(r"[^0-9]+"), n),
        "marks": share(count(r"[^!?#$%&*|@<>{}=_~^+\\/]+"), n),
        "ends": share(count(r"[^.,;:]+"), n),
        "lines": F.size(lines).cast("double"),
        "line_chars": share(n, F.size(lines)),
        "distinct_words": share(F.size(F.array_distinct(words)), F.size(words)),
        "distinct_lines": share(F.size(F.array_distinct(lines)), F.size(lines)),
    }


def _tree(x: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int, least: int) -> list[tuple[tuple[tuple[int, bool, float], ...], float]]:
    """Paths of a tree that fits -g / h: (conditions, value of the leaf). Inner nodes are paths too, with value 0."""
    leaf = float(-g[rows].sum() / (h[rows].sum() + 1.0))
    best = (1e-6, None)
    if depth:
        total = g[rows].sum() ** 2 / (h[rows].sum() + 1.0)
        for f, c in enumerate(cuts):
            if not len(c):
                continue
            bins = np.searchsorted(c, x[rows, f], side="left")
            sg, sh, sn = (np.cumsum(np.bincount(bins, v, len(c) + 1))[:-1] for v in (g[rows], h[rows], np.ones(len(rows))))
            gain = sg**2 / (sh + 1) + (g[rows].sum() - sg) ** 2 / (h[rows].sum() - sh + 1) - total
            gain[(sn < least) | (len(rows) - sn < least)] = -1
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), (f, float(c[k])))
    if best[1] is None:
        return [((), leaf)]
    f, cut = best[1]
    above = x[rows, f] > cut
    out = []
    for side in (False, True):
        below = _tree(x, cuts, g, h, rows[above == side], depth - 1, least)
        out += [(((f, side, cut), *path), value) for path, value in below]
        if len(below) > 1:
            out.append((((f, side, cut),), 0.0))
    return out


@dataclass
class Model:
    """Weighed rules over statistics; the score is the sigmoid of bias plus the weights of the rules that hold."""

    rules: dict[Rule, float]
    bias: float

    def column(self) -> Column:
        """The score over columns that are named as the statistics."""
        hold = lambda rule: reduce(lambda a, b: a & b, [(F.col(s) > cut) if above else (F.col(s) <= cut) for s, above, cut in rule])
        z = reduce(lambda a, b: a + b, [F.when(hold(r), F.lit(w)).otherwise(F.lit(0.0)) for r, w in self.rules.items()], F.lit(self.bias))
        return 1 / (1 + F.exp(-z))


def train(names: list[str], x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.2, l1: float = 1e-3, steps: int = 600, least: int = 10) -> Model:
    """Boosted trees, their paths as rules, lasso logistic weights by accelerated proximal gradient."""
    share = float(np.clip(y.mean() if len(y) else 0.5, 0.001, 0.999))
    bias = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return Model({}, bias)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0.02, 0.98, 49), method="lower")) for f in range(x.shape[1])]
    z, rules = np.full(len(y), bias), {}
    holds = lambda path: np.logical_and.reduce([(x[:, f] > cut) == above for f, above, cut in path]) if path else np.ones(len(y), dtype=bool)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        for path, value in _tree(x, cuts, p - y, p * (1 - p), np.arange(len(y)), depth, least):
            if value:
                z = z + rate * value * holds(path)
            if path:
                rules.setdefault(tuple(sorted(set(path))), None)
    paths = list(rules)
    if not paths:
        return Model({}, bias)
    m = np.stack([holds(p) for p in paths], axis=1).astype(float)
    mean = m.mean(axis=0)
    m -= mean
    step = 4.0 / (np.linalg.norm(m, 2) ** 2 / len(y) + 1)
    w = v = np.zeros(len(paths))
    b = vb = bias
    t = 1.0
    for _ in range(steps):
        g = 1 / (1 + np.exp(-(m @ v + vb))) - y
        new = v - step * (m.T @ g) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
        nb = vb - step * g.mean()
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / s * (new - w), nb + (t - 1) / s * (nb - b)
        w, b, t = new, nb, s
    kept = {tuple((names[f], above, cut) for f, above, cut in p): float(w[k]) for k, p in enumerate(paths) if w[k]}
    return Model(kept, float(b - mean @ w))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", bound: int = 8000, **options) -> Model:
    """Train from at most `bound` labelled documents (those whose key hash is smallest); null labels aren't learned from.

    Only the statistics of the sampled texts come to the driver. Of several labels for a key the largest counts.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    chosen = common.sample_ids(known, key, bound)
    rows = known.join(F.broadcast(chosen), key, "left_semi").groupBy(key).agg(F.max(label).cast("double").alias("__y"))
    stats = statistics(F.col(text))
    texts = docs.select(key, text).join(F.broadcast(rows), key)
    got = texts.select(F.col(key).alias("__k"), "__y", *[c.alias(n) for n, c in stats.items()]).dropDuplicates(["__k"]).orderBy("__k").toPandas()
    return train(list(stats), got[list(stats)].to_numpy(float), got["__y"].to_numpy(float), **options)


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """docs with score double (0 to 1) and predicted int (1 from the threshold on) in place of columns of those names.

    Null and empty texts have statistics of 0 and get the score of the rules that hold there. One projection makes
    the statistics, one the score; no Python runs.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    inner = {f"__{n}": c.alias(f"__{n}") for n, c in statistics(docs[text]).items()}
    renamed = Model({tuple((f"__{s}", a, c) for s, a, c in r): w for r, w in model.rules.items()}, model.bias)
    out = docs.select(*[docs[c] for c in kept], *inner.values())
    return out.select(*kept, renamed.column().alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
