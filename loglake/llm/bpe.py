"""Byte-pair encoding and decoding by dynamic programming over prefixes.

For every prefix of a word there is exactly one token with which the encoding of that
prefix ends. An automaton with suffix links over the vocabulary reports all tokens that
are suffixes of a prefix; the one that is compatible with the stored last token of the
prefix before it is stored, and following these back from the end of the word gives the
ids. The work is linear in the word's length, however long the word is, and no merge
queue is kept.

Two tokens are compatible if encoding their joined strings gives just those two, which
holds if no merge across their border ever comes before the merges that build them.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loglake.llm import common

#: Fixed values of the tokenizer file that this module implements.
SUFFIX = "</w>"
NEVER = 1 << 60
#: Words and pairs that a worker remembers before it starts afresh; longer words are not remembered.
REMEMBERED = 300_000
REMEMBERED_LENGTH = 64
#: The last symbol of a word is another symbol than the same byte elsewhere.
MARK = 0xE000


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {}, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return [out[b] for b in range(256)]


def newer_code_points(source: str) -> tuple[str, dict[int, str]]:
    """How the tokenizers library sees the letters and digits that Python's tables don't know yet.

    Unicode versions differ between the library, `regex` and Python. For code points that are unassigned in
    Python's version, returns those that the library takes for neither letter nor digit though `regex` does,
    and the lower case that the library gives to others. Run once on the driver; its size is that of Unicode.
    """
    library = Tokenizer.from_str(source)
    others, lower = [], {}
    known = regex.compile(r"[\p{L}\p{N}]").match
    for c in range(0x370, 0x40000):
        x = chr(c)
        if unicodedata.category(x) == "Cn" and known(x):
            if len(library.pre_tokenizer.pre_tokenize_str(f"a!{x}")) == 2:
                others.append(x)
            if (small := library.normalizer.normalize_str(x)) != x:
                lower[c] = small
    return "".join(others), lower


def _ranges(points: list[int]) -> str:
    """Code points as the inside of a character class, runs as ranges."""
    out: list[list[int]] = []
    for c in sorted(set(points)):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in out)


class Words(dict):
    """word -> its ids as int32 bytes; fills itself."""

    def __init__(self, bpe: Bpe):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, word: str) -> bytes:
        ids = array("i", self.bpe.word(word)).tobytes()
        if len(word) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = ids
        return ids


class Bpe:
    """Encoder and decoder for one tokenizer file (text of its JSON); newer: what newer_code_points() gave for it."""

    def __init__(self, source: str, newer: tuple[str, dict[int, str]]):
        spec = json.loads(source)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != SUFFIX or spec.get("decoder") is not None:
            raise ValueError("this encoder is for byte-level BPE files with word ends and no decoder")
        vocab: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        self.decoded = [self.tokens.get(i, "") for i in range(max(self.tokens) + 1)]
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = self.split_newer = regex.compile(pattern).findall
        others, self.lower = newer
        self.newer = regex.compile(f"[{_ranges([*map(ord, others), *self.lower])}]").search if others or self.lower else None
        if others:
            others = _ranges([*map(ord, others)])
            for kind in ("\\p{L}", "\\p{N}"):
                pattern = pattern.replace(kind, f"[{kind}--[{others}]]")
            self.split_newer = regex.compile(f"(?V1){pattern}").findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        # rank of the merge that makes a token, and its two parts; the rank of the merge of a pair
        self.rank, self.parts, self.merge = {}, {}, {}
        for k, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b, made = vocab[a], vocab[b], vocab[a + b]
            self.merge.setdefault((a, b), k)
            if made not in self.rank:
                self.rank[made], self.parts[made] = k, (a, b)
        self.symbol = [s for s in byte_symbols()]
        self.marked = {s: chr(MARK + ord(s)) for s in self.symbol}
        self.find = ahocorasick.Automaton()
        for t, i in vocab.items():
            own = self._marked(t[: -len(SUFFIX)]) if t.endswith(SUFFIX) and t != SUFFIX else t
            self.find.add_word(own, (len(own), i))
        self.find.make_automaton()
        self.bytes_to_symbols = str.maketrans({chr(b): s for b, s in enumerate(self.symbol)})
        self.pairs: dict[int, bool] = {}
        self.words = Words(self)

    def _marked(self, symbols: str) -> str:
        return symbols[:-1] + self.marked[symbols[-1]]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the encoding of left + right is those two tokens.

        Walks back in time over the parts that touch at the border: the later-made of the two is undone
        first. The pair that stands there is merged if its merge comes before the ones that join either part
        to its neighbour; of equal merges the leftmost comes first.
        """
        a, b, next_a, next_b, good = left, right, NEVER, NEVER, True
        while True:
            crossing = self.merge.get((a, b))
            if crossing is not None and crossing < next_a and crossing <= next_b:
                good = False
                break
            rank_a, rank_b = self.rank.get(a, -1), self.rank.get(b, -1)
            if rank_a < 0 and rank_b < 0:
                break
            if rank_a >= rank_b:
                next_a, a = rank_a, self.parts[a][1]
            else:
                next_b, b = rank_b, self.parts[b][0]
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        self.pairs[left << 20 | right] = good
        return good

    def word(self, word: str) -> list[int]:
        """The ids of one word (a match of the split pattern)."""
        s = self._marked(word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.bytes_to_symbols))
        n = len(s)
        # last[k]: the last token of the prefix of k symbols; no token is needed before the empty prefix.
        last, back = [-1] * (n + 1), [0] * (n + 1)
        known = self.pairs.get
        for end, (length, token) in self.find.iter(s):
            end += 1
            if last[end] < 0:
                before = end - length
                if before:
                    left = last[before]
                    if left < 0:
                        continue
                    good = known(left << 20 | token)
                    if good is False or good is None and not self.compatible(left, token):
                        continue
                last[end], back[end] = token, length
        out, k = [], n
        while k:
            out.append(last[k])
            k -= back[k]
        out.reverse()
        return out

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            if self.newer and self.newer(text):
                return b"".join(map(self.words.__getitem__, self.split_newer(text.translate(self.lower).lower())))
        return b"".join(map(self.words.__getitem__, self.split(text.lower())))

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a whole text; null is empty. Strings of special tokens give their ids."""
        if not text:
            return np.empty(0, dtype=np.int32)
        if self.specials is None or "<" not in text:
            return np.frombuffer(self._plain(text), dtype=np.int32)
        parts = [np.asarray([self.special[x]], dtype=np.int32).tobytes() if k % 2 else self._plain(x) for k, x in enumerate(self.specials.split(text))]
        return np.frombuffer(b"".join(parts), dtype=np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The tokens joined by a space, as files without a decoder are decoded; special tokens stay."""
        return " ".join(map(self.decoded.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def _built(source: str, others: str, lower: tuple[tuple[int, str], ...]) -> Bpe:
    return Bpe(source, (others, dict(lower)))


def load(path: str) -> tuple[str, str, tuple[tuple[int, str], ...]]:
    """What _built() takes, from a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        source = f.read()
    others, lower = newer_code_points(source)
    return source, others, tuple(lower.items())


def encode(docs: DataFrame, path: str, text: str = "text", decoded: bool = True) -> DataFrame:
    """docs with ids array<int> and, if asked for, decoded string (the decoding of those ids).

    path: the tokenizer file, read on the driver; its text (a few MB whatever the data) goes to the executors
    as a broadcast. Columns of docs named ids or decoded are replaced. Null and empty texts give no ids and ''.
    Each row is encoded by itself: repeated rows, ties and other columns don't matter.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(load(path))
    common.small_batches(spark)
    new = ["ids array<int>"] + ["decoded string"] * decoded
    kept = [c for c in docs.columns if c not in ("ids", "decoded")]
    column = docs[text].alias("__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _built(*shared.value)
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64)
                ids = [bpe.encode(t) for t in part.column(part.num_columns - 1).to_pylist()]
                offsets = pa.array(np.cumsum([0] + [len(x) for x in ids], dtype=np.int32))
                out = [part.column(k) for k in range(part.num_columns - 1)]
                out.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids) if ids else np.empty(0, dtype=np.int32))))
                if decoded:
                    out.append(pa.array([bpe.decode(x) for x in ids], type=pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=[*part.schema.names[:-1], "ids", *["decoded"] * decoded])

    plain = docs.select(*[docs[c] for c in kept], column)
    schema = ", ".join([f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in plain.schema.fields[:-1]] + new)
    return plain.mapInArrow(run, schema)


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the decimal ids and of the decoded text; more: columns to keep besides."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        *more,
    )
