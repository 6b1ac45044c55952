"""Toxicity with a counterfactually regularised classifier.

A sparse logistic model over the words of a text and their beginnings (their presence),
trained in numpy from a bounded sample. Texts that name a group are also trained on with the group swapped
for the others of its kind in its language: squared differences between the scores of a text and its swapped
versions are penalised, so that naming a group as such doesn't move the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from loglake.llm import common

#: Terms that are swapped with each other: a list for each kind and language.
IDENTITIES = [
    line.split()
    for line in (
        "man woman men women male female boy girl boys girls transgender",
        "homme femme hommes femmes garçon fille",
        "mann frau männer frauen junge mädchen",
        "hombre mujer hombres mujeres niño niña",
        "christian christians muslim muslims jew jews jewish hindu hindus buddhist buddhists atheist atheists catholic catholics protestant protestants",
        "chrétien musulman juif catholique athée",
        "christ moslem jude hindu buddhist atheist",
        "cristiano musulmán judío católico ateo",
        "gay lesbian straight bisexual queer homosexual heterosexual",
        "schwul lesbisch homosexuell heterosexuell",
        "hétérosexuel homosexuel lesbienne",
        "homosexual heterosexual lesbiana",
        "black white asian african european american latino latina hispanic arab chinese indian mexican immigrant immigrants refugee refugees native",
        "noir blanc asiatique africain européen arabe chinois immigré réfugié",
        "schwarz weiß asiatisch afrikanisch europäisch arabisch einwanderer flüchtling",
        "negro blanco asiático africano europeo árabe chino inmigrante refugiado",
        "deaf blind disabled autistic",
        "aveugle sourd handicapé",
        "behindert blind taub",
        "ciego sordo discapacitado",
        "old young elderly teenage",
        "vieux jeune âgé",
        "alt jung",
        "viejo joven anciano",
    )
]
TERMS = frozenset(t for terms in IDENTITIES for t in terms)


def words_of(text: str | None) -> set[str]:
    """Distinct lower-cased words of a whole text: runs of letters and digits."""
    import regex

    return set(regex.findall(r"[\p{L}\p{N}]+", (text or "").lower()))


#: Lengths of the beginnings that stand for all forms of a word.
STEMS = (4, 5, 6)


def features(words: set[str]) -> set[str]:
    """The words and their beginnings, those with a star."""
    return words.union(*[{f"{w[:k]}*" for w in words if len(w) >= k} for k in STEMS])


@dataclass
class Model:
    """Features and their weights; a text's score is the sigmoid of bias plus the weights of its distinct features."""

    weights: dict[str, float]
    bias: float

    def margin(self, words: set[str]) -> float:
        return self.bias + sum(map(self.weights.__getitem__, sorted(self.weights.keys() & features(words))))


def swapped(found: set[str], known: set[str]) -> list[set[str]]:
    """Versions of a text's features with each named group replaced by each other of its list that has a weight.

    Beginnings that other words of the text share stay.
    """
    out = []
    plain = {w for w in found if not w.endswith("*")}
    for term in sorted(plain & TERMS):
        rest = found - (features({term}) - features(plain - {term}))
        others = sorted({x for terms in IDENTITIES if term in terms for x in terms if x != term and x in known})
        out += [rest | (features({x}) & known) for x in others] or [rest]
    return out


def train(texts: list[list[str]], labels: list[int], width: int = 6000, l1: float = 5e-5, fairness: float = 2.0, steps: int = 600, least: int = 5) -> Model:
    """Accelerated proximal gradient steps on log loss + fairness * mean squared swap difference + l1 * |weights|.

    texts: the features of each text. They are chosen by document frequency (at least `least`) and the strength of their association with the label.
    """
    y = np.asarray(labels, dtype=float)
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.0, 0.001, 0.999))
        return Model({}, float(np.log(share / (1 - share))))
    sets = [set(t) for t in texts]
    seen: dict[str, list[int]] = {}
    for words, label in zip(sets, labels, strict=True):
        for w in words:
            seen.setdefault(w, [0, 0])[label] += 1
    n1, n0 = y.sum(), len(y) - y.sum()
    strength = {}
    for w, (c0, c1) in seen.items():
        if c0 + c1 >= least:
            e1 = (c0 + c1) * n1 / len(y)
            strength[w] = (c1 - e1) ** 2 / (e1 * (1 - n1 / len(y)) + 1e-9)
    named = TERMS & strength.keys()
    chosen = sorted(sorted(strength, key=lambda w: (-strength[w], w))[:width] + sorted(named))
    column = {w: k for k, w in enumerate(dict.fromkeys(chosen))}

    def sparse(rows: list[set[str]]) -> tuple[np.ndarray, np.ndarray]:
        pairs = [(r, column[w]) for r, words in enumerate(rows) for w in sorted(words & column.keys())]
        return np.asarray([p[0] for p in pairs], dtype=np.int64), np.asarray([p[1] for p in pairs], dtype=np.int64)

    r, c = sparse(sets)
    twins = [(words, other) for words in sets for other in swapped(words, column.keys())]
    ra, ca = sparse([a - b for a, b in twins])
    rb, cb = sparse([b - a for a, b in twins])
    rt, ct, vt = np.concatenate([ra, rb]), np.concatenate([ca, cb]), np.concatenate([np.ones(len(ra)), -np.ones(len(rb))])
    m, n, k = len(twins), len(y), len(column)
    w = np.zeros(k)
    b = float(np.log(n1 / n0))
    v, vb, t = w.copy(), b, 1.0
    # The step is the inverse of the curvature's largest eigenvalue, by power iteration.
    u, curve = np.ones(k), 1.0
    for _ in range(30):
        u /= np.linalg.norm(u)
        next_u = 0.25 * np.bincount(c, np.bincount(r, u[c], n)[r], k) / n
        if m:
            next_u += 2 * fairness * np.bincount(ct, vt * np.bincount(rt, vt * u[ct], m)[rt], k) / m
        u, curve = next_u, np.linalg.norm(next_u)
    step = 0.9 / (curve + 1e-6)
    for _ in range(steps):
        z = np.bincount(r, v[c], n) + vb
        g = 1 / (1 + np.exp(-z)) - y
        grad = np.bincount(c, g[r], k) / n
        if m:
            d = np.bincount(rt, vt * v[ct], m)
            grad += 2 * fairness * np.bincount(ct, vt * d[rt], k) / m
        new = v - step * grad
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
        nb = vb - min(step, 2.0) * g.mean()
        if (new - w) @ (v - new) > 0:
            t = 1.0
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / s * (new - w), nb + (t - 1) / s * (nb - b)
        w, b, t = new, nb, s
    return Model({x: float(w[j]) for x, j in column.items() if w[j]}, float(b))


@F.pandas_udf(ArrayType(StringType()))
def _features_of(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: sorted(features(words_of(t))))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", bound: int = 8000, width: int = 6000, least: int = 5, **options) -> Model:
    """Train from at most `bound` labelled documents (those whose key hash is smallest); null labels aren't learned from.

    Features are counted and chosen by Spark (see train()); the driver receives `width` of them and, for each
    sampled text, the numbers of those it has. Of several labels for a key the largest counts, of several rows one.
    Without labels, or with one value only, the score is a constant; null texts have no words.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    chosen = common.sample_ids(known, key, bound)
    rows = known.join(F.broadcast(chosen), key, "left_semi").groupBy(key).agg(F.max(label).cast("long").alias("y"))
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("t")).join(F.broadcast(rows.withColumnRenamed(key, "id")), "id").dropDuplicates(["id"])
    texts = common.written(texts.select("id", "y", _features_of(F.col("t")).alias("w")))
    labelled = {r["id"]: r["y"] for r in texts.select("id", "y").collect()}
    n, n1 = len(labelled), sum(labelled.values())
    each = texts.select("id", "y", F.explode("w").alias("w"))
    expected = F.col("n") * (n1 / max(n, 1))
    strength = (F.col("n1") - expected) ** 2 / (expected * (1 - n1 / max(n, 1)) + 1e-9)
    counts = each.groupBy("w").agg(F.count("*").alias("n"), F.sum("y").alias("n1")).where(F.col("n") >= least).select("w", strength.alias("s"))
    named = sorted(features(set(TERMS)))
    kept = counts.orderBy(F.desc("s"), "w").limit(width).unionByName(counts.where(F.col("w").isin(named))).select("w").distinct()
    vocabulary = sorted(r["w"] for r in kept.collect())
    if not vocabulary:
        return train([[] for _ in labelled], list(labelled.values()))
    numbers = docs.sparkSession.createDataFrame(list(enumerate(vocabulary)), "k int, w string")
    got = each.join(F.broadcast(numbers), "w").groupBy("id").agg(F.sort_array(F.collect_list("k")).alias("k")).toPandas()
    held = dict(zip(got["id"], got["k"], strict=True))
    ids = sorted(labelled)
    return train([[vocabulary[j] for j in held.get(i, ())] for i in ids], [labelled[i] for i in ids], width=len(vocabulary), least=least, **options)


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """docs with score double (0 to 1) and predicted int (1 from the threshold on) in place of columns of those names.

    Null and empty texts have no words: they get the score of the bias. Rows don't depend on each other.
    """
    common.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def rate(texts: pd.Series) -> pd.Series:
        z = np.asarray([shared.value.margin(words_of(t)) for t in texts])
        return pd.Series(1 / (1 + np.exp(-z)))

    kept = [docs[c] for c in docs.columns if c not in ("score", "predicted")]
    return docs.select(*kept, rate(docs[text]).alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
