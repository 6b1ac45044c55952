"""License scans with a positional index of rare licence words.

Each template is a sequence of words with mandatory key phrases. The index holds, for each
template, the postings (template, position) of its two mandatory words with the highest
inverse document frequency among all templates. A file's words that the index has are looked
up: where they stand in the file, minus where they stand in the template, gives the places
at which the template could begin; places that both words agree on, found by intersecting
the two lists, are verified: all mandatory phrases must stand there word for word, and the
share of all template words that do is the score. Every true place survives the look-up, as
it holds both words. Index and templates are constants of the plan, whose expressions
are the same for any number of templates; the corpus is read once.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed: what parts words once A-Z is in lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """words: the template's words; `[a b c]` marks a mandatory phrase. base: its places are counted."""

    label: str
    words: str
    base: bool = False

    @property
    def sequence(self) -> list[str]:
        return self.words.replace("[", "").replace("]", "").split()

    @property
    def mandatory(self) -> list[int]:
        inside, out = False, []
        for k, w in enumerate(self.words.split()):
            inside = inside or w.startswith("[")
            if inside:
                out.append(k)
            inside = inside and not w.endswith("]")
        return out


TEMPLATES = (
    Template("mit", "[under the mit license]", base=True),
    Template("apache-2", "[apache license version 2]", base=True),
    Template("cc-by-nc", "[cc by nc]", base=True),
    Template("mit", "[permission is hereby granted free of charge] to any person obtaining [a copy of this software]"),
    Template("gpl-3", "this work is licensed under the [gnu general public license version 3]"),
    Template("gpl-2", "this work is licensed under the [gnu general public license version 2]"),
    Template("lgpl", "[gnu lesser general public license]"),
    Template("agpl", "[gnu affero general public license]"),
    Template("bsd", "[redistribution and use in source and binary forms] with or without [modification are permitted]"),
    Template("mpl-2", "this source code form is subject to the terms of the [mozilla public license] v 2 0"),
    Template("cc0", "[cc0 1 0 universal]"),
    Template("cc-by", "licensed under [cc by 4 0]"),
    Template("cc-by-sa", "licensed under [cc by sa]"),
    Template("proprietary", "[all rights reserved]"),
)


def words_of(text: Column) -> Column:
    """Words of a whole text: A-Z in lower case, then runs of digits, letters and what isn't ASCII."""
    # The Kelvin sign is the one character besides A-Z whose lower case is an ASCII letter alone.
    lower = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("Å")))
    return F.array_remove(F.split(lower, SEPARATORS), "")


def look_up(templates: tuple[Template, ...]) -> list[list[int]]:
    """For each template the positions of its two mandatory words that fewest templates have, the longest of those (one, if it has no other)."""
    df = Counter(w for t in templates for w in set(t.sequence))
    return [sorted(t.mandatory, key=lambda k, t=t: (df[t.sequence[k]], -len(t.sequence[k]), k))[:2] for t in templates]


def _postings(of: list[tuple[str, int, int]]) -> dict[str, list[Column]]:
    out: dict[str, list[Column]] = {}
    for word, n, k in of:
        out.setdefault(word, []).append(F.struct(F.lit(n).alias("n"), F.lit(k).alias("k")))
    return out


def _starts(found: Column, postings: dict[str, list[Column]]) -> Column:
    """array of (n, o): templates and where they could begin, by one word of each."""
    if not postings:
        return F.array().cast("array<struct<n:int,o:int>>")
    index = F.map_from_arrays(F.array(*map(F.lit, postings)), F.array(*[F.array(*p) for p in postings.values()]))
    known = F.filter(found, lambda x: x["w"].isin(list(postings)))
    return F.flatten(F.transform(known, lambda x: F.transform(F.element_at(index, x["w"]), lambda p: F.struct(p["n"].alias("n"), (x["i"] - p["k"]).alias("o")))))


def scan(docs: DataFrame, text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """docs with n_words, n_base, first_word, last_word, base_labels, labels, score and places.

    places: (label, start of its first key phrase, score) of every verified place, in order, base phrases included; what
    comes before the key phrase in a template may lack. first_word and last_word: smallest
    and largest start of a base phrase, null without one. labels: distinct labels, sorted, comma-joined; '' for none.
    score: the largest share of a template's words that stand at a verified place, 0 for none. Null and empty texts
    have no words. Rows don't depend on each other, so rows given twice get equal answers; an empty table gives none.
    Columns of docs with these names are replaced.
    """
    picks = look_up(templates)
    at = lambda j, single: _postings([(t.sequence[ks[j]], n, ks[j]) for n, (t, ks) in enumerate(zip(templates, picks, strict=True)) if (len(ks) == 1) == single])
    first, second, alone = at(0, False), at(1, False), at(0, True)
    rare = sorted({*first, *second, *alone})
    new = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places")
    kept = [c for c in docs.columns if c not in new]
    nothing = F.array().cast("array<struct<i:int,w:string>>")
    tokens = docs.select(*[docs[c] for c in kept], words_of(docs[text]).alias("__w"))
    # Only files that hold a word of the index anywhere are walked.
    holds = F.arrays_overlap("__w", F.array(*map(F.lit, rare)))
    found = F.filter(F.transform("__w", lambda w, i: F.struct(i.cast("int").alias("i"), w.alias("w"))), lambda x: x["w"].isin(rare))
    posted = tokens.withColumn("__found", F.when(holds, found).otherwise(nothing))
    places = F.concat(F.array_intersect(_starts(F.col("__found"), first), _starts(F.col("__found"), second)), _starts(F.col("__found"), alone))
    facts = F.array(*[F.struct(F.lit(t.label).alias("label"), F.array(*map(F.lit, t.sequence)).alias("words"), F.array(*map(F.lit, t.mandatory)).alias("must"), F.lit(t.base).alias("base")) for t in templates])
    of = lambda c: F.get(facts, c["n"])
    stands = lambda c, k: F.coalesce(F.get("__w", c["o"] + k) == F.get(of(c)["words"], k), F.lit(False))
    good = F.filter(places, lambda c: F.forall(of(c)["must"], lambda k: stands(c, k)))
    share = lambda c: F.aggregate(of(c)["words"], F.struct(F.lit(0).alias("k"), F.lit(0).alias("n")), lambda a, w: F.struct((a["k"] + 1).alias("k"), (a["n"] + F.coalesce(F.get("__w", c["o"] + a["k"]) == w, F.lit(False)).cast("int")).alias("n")))["n"] / F.size(of(c)["words"])
    made = F.transform(good, lambda c: F.struct(of(c)["label"].alias("label"), (c["o"] + of(c)["must"][0]).cast("long").alias("start"), share(c).alias("score"), of(c)["base"].alias("base")))
    every = F.array_sort(made)
    empty = F.array().cast("array<struct<label:string,start:bigint,score:double,base:boolean>>")
    out = posted.withColumn("__all", F.when(F.size("__found") > 0, every).otherwise(empty))
    out = out.withColumn("__base", F.filter("__all", lambda x: x["base"]))
    joined = lambda c: F.concat_ws(",", F.array_sort(F.array_distinct(F.col(f"{c}.label"))))
    return out.select(
        *kept,
        F.size("__w").cast("long").alias("n_words"),
        F.size("__base").cast("long").alias("n_base"),
        F.array_min(F.col("__base.start")).alias("first_word"),
        F.array_max(F.col("__base.start")).alias("last_word"),
        joined("__base").alias("base_labels"),
        joined("__all").alias("labels"),
        F.coalesce(F.array_max(F.col("__all.score")), F.lit(0.0)).alias("score"),
        F.transform("__all", lambda x: F.struct(x["label"].alias("label"), x["start"].alias("start"), x["score"].alias("score"))).alias("places"),
    )


def oracle_sql(templates: tuple[Template, ...] = TEMPLATES) -> str:
    """DuckDB SQL for the query's columns; it looks at all words of all templates."""
    index = ", ".join(f"({n}, '{t.label}', {t.base}, {k}, '{w}', {k in t.mandatory}, {len(t.mandatory)}, {len(t.sequence)})" for n, t in enumerate(templates) for k, w in enumerate(t.sequence))
    return rf"""
WITH idx(tpl, label, base, k, w, must, n_must, n) AS (VALUES {index}),
split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), words AS (
  SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM split
), hits AS (
  SELECT doc_id, tpl, any_value(label) AS label, any_value(base) AS base, i - k AS start, count(*) / any_value(n)::DOUBLE AS score
  FROM words JOIN idx USING (w)
  GROUP BY doc_id, tpl, i - k HAVING count(*) FILTER (must) = any_value(n_must)
), per AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM hits GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM split LEFT JOIN per USING (doc_id)
"""
