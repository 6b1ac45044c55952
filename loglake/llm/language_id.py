"""Language identification with averaged hashed subword embeddings.

A text is the mean of the embeddings of its hashed subwords (letter n-grams of each
word, with word ends); a linear softmax over that mean gives the languages. Embeddings
and softmax are trained by stochastic gradient descent in numpy, on the driver, from a
bounded sample. A held-back part of the sample sets a softmax temperature and the
probability below which a prediction counts as rejected.

As both layers are linear, a trained model is one table of bucket x language scores;
a text's logits are the mean of the rows of its subwords, so prediction is one pass of
numpy gathers over the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.llm import common

SIZES = (2, 3, 4)
BLOCK = 1 << 17
UND = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """letter[c]: whether code point c is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def code_points(text: str) -> np.ndarray:
    """The lower-cased text as code points with 0 for whatever isn't a letter, and a 0 at both ends."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    out = np.zeros(len(raw) + 2, dtype=np.uint32)
    np.multiply(raw, _letters()[raw], out=out[1:-1], casting="unsafe")
    return out


def subwords(points: np.ndarray, begin: int, end: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size, the buckets of the n-grams that start in [begin, end), and their starts relative to begin.

    An n-gram may have a word end (0) at its ends, never inside, and holds a letter.
    """
    reach = points[begin : min(end + max(SIZES) - 1, len(points))].astype(np.uint64)
    inner = reach != 0
    for n in SIZES:
        m = min(end - begin, len(reach) - n + 1)
        if m <= 0:
            continue
        h = np.full(m, n, dtype=np.uint64)
        for k in range(n):
            h *= np.uint64(0x100000001B3)
            h += reach[k : k + m]
        ok = inner[:m] | inner[1 : 1 + m] if n == 2 else inner[1 : 1 + m].copy()
        for k in range(2, n - 1):
            ok &= inner[k : k + m]
        at = np.flatnonzero(ok)
        h = h[at] * np.uint64(0x9E3779B97F4A7C15)
        yield (h >> np.uint64(64 - bits)).astype(np.int64), at


def bag(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A text's distinct buckets and their counts; at most 2**bits whatever the length."""
    points = code_points(text)
    total = np.zeros(1 << bits, dtype=np.int64)
    for begin in range(0, len(points), BLOCK):
        for buckets, _ in subwords(points, begin, min(begin + BLOCK, len(points)), bits):
            total += np.bincount(buckets, minlength=1 << bits)
    ids = np.flatnonzero(total)
    return ids, total[ids]


@dataclass
class Model:
    """A trained model: languages, scores (buckets x languages), temperature, rejection threshold."""

    languages: list[str]
    table: np.ndarray
    bits: int
    temperature: float
    reject_below: float

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Mean subword scores of each text, and its number of subwords. Blocks bound the memory."""
        total, count = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), dtype=np.int64)
        group: list[int] = []
        held: list[np.ndarray] = []
        room = BLOCK

        def flush() -> None:
            if not group:
                return
            points = np.concatenate(held)
            starts = np.cumsum([0] + [len(x) for x in held])
            for begin in range(0, len(points), BLOCK):
                for buckets, at in subwords(points, begin, min(begin + BLOCK, len(points)), self.bits):
                    edges = np.searchsorted(at, starts - begin)
                    n = np.diff(edges)
                    full = np.flatnonzero(n)
                    if len(full):
                        where = np.asarray(group)[full]
                        total[where] += np.add.reduceat(self.table[buckets], edges[:-1][full], axis=0)
                        count[where] += n[full]

        for k, text in enumerate(texts):
            x = code_points(text)
            if len(x) > room:
                flush()
                group, held, room = [], [], BLOCK
            group.append(k)
            held.append(x)
            room -= len(x)
        flush()
        return total / np.maximum(count, 1)[:, None], count

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def predict(self, texts: list[str]) -> pd.DataFrame:
        if not texts:
            return pd.DataFrame({"lang_pred": [], "score": [], "rejected": []})
        if not self.languages:
            return pd.DataFrame({"lang_pred": UND, "score": 0.0, "rejected": True}, index=range(len(texts)))
        logits, count = self.logits(texts)
        p = self.probabilities(logits)
        best = p.argmax(axis=1)
        score = np.where(count > 0, p[np.arange(len(p)), best], 0.0)
        lang = np.where(count > 0, np.asarray(self.languages, dtype=object)[best], UND)
        return pd.DataFrame({"lang_pred": lang, "score": np.clip(score, 0, 1), "rejected": (count == 0) | (score < self.reject_below)})


def train(
    bags: list[tuple[np.ndarray, np.ndarray]], labels: list[str], bits: int = 16, dim: int = 16, epochs: int = 8, rate: float = 0.5, seed: int = 7, reject_share: float = 0.001
) -> Model:
    """Stochastic gradient descent, one text a step; every fifth text is held back for the calibration.

    reject_share: the share of held-back texts that the threshold may reject; it never exceeds one half.
    """
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.1, (1 << bits, dim))
    w = np.zeros((dim, len(languages)))
    y = np.asarray([languages.index(x) for x in labels])
    shares = [(ids, (n / n.sum()).astype(np.float32)) for ids, n in bags]
    keep = [k for k in range(len(bags)) if k % 5 or len(bags) < 50]
    back = [k for k in range(len(bags)) if k % 5 == 0] if len(bags) >= 50 else keep
    steps, done = max(1, epochs * len(keep)), 0
    if len(languages) > 1:
        for _ in range(epochs):
            for k in rng.permutation(keep):
                ids, share = shares[k]
                lr = rate * (1 - done / steps)
                x = share @ e[ids]
                z = x @ w
                g = np.exp(z - z.max())
                g /= g.sum()
                g[y[k]] -= 1
                e[ids] -= (lr * len(ids) ** 0.5) * np.outer(share, w @ g)
                w -= lr * np.outer(x, g)
                done += 1
    scores = (e @ w).astype(np.float32)
    z = np.asarray([share @ scores[ids] for ids, share in (shares[k] for k in back)]).reshape(len(back), len(languages))
    model = Model(languages, scores, bits, 1.0, 0.0)

    def loss(t: float) -> float:
        model.temperature = t
        return -np.log(np.maximum(model.probabilities(z)[np.arange(len(back)), y[back]], 1e-12)).mean() if back else 0.0

    model.temperature = float(min(np.geomspace(0.05, 5, 60), key=loss))
    if back:
        p = np.sort(model.probabilities(z).max(axis=1))
        model.reject_below = float(min(0.5, p[int(reject_share * len(p))] * 0.9))
    return model


def fit(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", bound: int = 2000, bits: int = 16, **options) -> Model:
    """Train from at most `bound` labelled rows of docs (those whose key hash is smallest).

    Null texts, null labels and texts without a letter are not learned from; without any, the model rejects all. Executors turn the sampled
    texts into bags, so the driver receives at most bound x 2**bits pairs, not texts.
    """
    rows = common.sample_rows(docs.where(F.col(label).isNotNull() & F.col(text).isNotNull()), key, bound)
    common.small_batches(docs.sparkSession)
    small = np.uint16 if bits <= 16 else np.uint32

    def bags(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            both = [bag(t, bits) for t in part["t"]]
            yield pd.DataFrame({"k": part["k"], "y": part["y"], "ids": [x[0].astype(small).tobytes() for x in both], "n": [x[1].astype(np.int32).tobytes() for x in both]})

    got = rows.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(label).cast("string").alias("y")).mapInPandas(bags, "k long, y string, ids binary, n binary").toPandas()
    found = sorted((k, y, i, n) for k, y, i, n in got.itertuples(index=False, name=None) if len(i))
    del got
    if not found:
        return Model([], np.zeros((1 << bits, 0), dtype=np.float32), bits, 1.0, 0.0)
    # Bytes, not lists: a sample of texts of any length stays small on the driver.
    return train([(np.frombuffer(i, dtype=small), np.frombuffer(n, dtype=np.int32)) for _, _, i, n in found], [y for _, y, _, _ in found], bits, **options)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred string, score double and rejected boolean in place of columns of those names.

    Null, empty or letterless texts give `und`, 0.0, true; every other text gets a learned language.
    Repeated rows each get their row; ties between languages go to the first in order of name.
    """
    common.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def guess(texts: pd.Series) -> pd.DataFrame:
        return shared.value.predict(["" if t is None else t for t in texts])

    rest = [docs[c] for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    return docs.select(*rest, guess(docs[text]).alias("__guess")).select(*[c for c in docs.columns if c not in ("lang_pred", "score", "rejected")], "__guess.*")
