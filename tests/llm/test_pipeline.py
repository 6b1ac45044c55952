"""The pipeline's stages against brute force, and the operators' queries against their SQL."""

import hashlib
from pathlib import Path

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from loglake.llm import queries as llm
from loglake.llm.suffix_dedup import snapped
from test_operators import brute_components

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def cut_repeats(texts, width=100):
    """Texts without the bytes of windows that also start earlier, whole characters only."""
    seen, out = set(), {}
    for k in sorted(texts):
        b = texts[k].encode()
        cover = bytearray(len(b) + 1)
        for s in range(len(b) - width + 1):
            w = b[s : s + width]
            if w in seen:
                cover[s : s + width] = b"\1" * width
            seen.add(w)
        kept, j = b"", 0
        while j < len(b):
            end = j
            while end < len(b) and cover[end] == cover[j]:
                end += 1
            if cover[j]:
                a, z = snapped(b, j, end)
                kept += b[j:a] + b[z:end]
            else:
                kept += b[j:end]
            j = end
        if kept == b or kept.decode().strip():
            out[k] = kept.decode()
    return out


def test_pipeline(spark, prose, tmp_path):
    passage, item = prose.text(40, "fr"), prose.text(30)
    base = prose.text(150)
    near = base.split()
    near[70] = "other"
    rows = [(k, prose.text(60, ("en", "fr", "de", "es")[k % 4]), ("en", "fr", "de", "es")[k % 4]) for k in range(80)]
    rows += [(100, base, "en"), (101, base, "en"), (102, " ".join(near), "en"), (103, None, "en"), (104, "12 34 !!", None), (105, "", "de")]
    rows += [(110 + k, f"{prose.text(30, 'fr')} {passage} {prose.text(30, 'fr')}", "fr") for k in range(4)]
    rows += [(120, f"{prose.text(30)} {item} {prose.text(30)}", "en"), (121, passage[:200], "fr"), (122, prose.text(12_000), "en")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, texts = docs.columns, {i: t for i, t, _ in rows}

    def stage(k, df):
        out = corpus_pipeline.STAGES[k][1](spark, df, str(tmp_path))
        assert out.columns == columns
        path = str(tmp_path / f"stage{k}")
        out.write.parquet(path)
        out = spark.read.parquet(path)
        return out, {r.doc_id: r.text for r in out.select("doc_id", "text").collect()}

    df, got = stage(0, docs)
    assert not {103, 104, 105} & got.keys() and len(got) >= len(rows) - 3 - 3
    texts = {k: texts[k] for k in got}
    df, got = stage(1, df)
    want, _ = brute_components(texts)
    assert got == {k: t for k, t in texts.items() if want[k] == k} and not {101, 102} & got.keys()
    df, now = stage(2, df)
    assert now == cut_repeats(got) and now[110] == got[110] and len(now[111]) < len(got[111]) and 121 not in now
    assert all(r.n_chars == len(r.text) for r in df.collect())
    df, left = stage(3, df)
    assert left == {k: t for k, t in now.items() if k != 120}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    last = {r.doc_id: r for r in corpus_pipeline.STAGES[4][1](spark, df, str(tmp_path)).collect()}
    assert last.keys() == left.keys()
    for k, t in left.items():
        x = library.encode(t, add_special_tokens=False)
        assert last[k].ids == x.ids and last[k].n_tokens == len(x.ids)
        assert last[k].decoded_sha256 == hashlib.sha256(library.decode(x.ids, skip_special_tokens=False).encode()).hexdigest()
    whole = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert whole == {k: r.ids for k, r in last.items()}


def test_near_duplicates_from_80_percent(spark, prose):
    words = prose.words(100)
    near = [*words[:30], "other", *words[31:70], "other", *words[71:]]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, prose.text(100))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    a, b = ({tuple(w[k : k + 5]) for k in range(96)} for w in (words, near))
    assert 0.8 <= len(a & b) / len(a | b) < 0.85
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()} == {1, 3}


def test_near_duplicates_without_an_id(spark, prose):
    text = prose.text(100)
    docs = spark.createDataFrame([(i, text, "en", "s", len(text)) for i in (1, 2, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    got = [r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert sorted(got, key=str) == [1, None, None]


def test_stages_of_odd_rows(spark, prose, tmp_path):
    """Empty tables stay empty; null and empty texts, rows without an id and rows given twice have their defined results."""
    spark.createDataFrame([(0, prose.text(30))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = prose.text(60)
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, text), (4, prose.text(9000)), (None, None)]
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], schema)
    want = [None, sorted(str(r) for r in rows), sorted(str(r) for r in rows), sorted(str(r) for r in rows)]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        assert stage(spark, odd.limit(0), str(tmp_path)).count() == 0
        if k in (1, 2, 3):
            assert sorted(str((r.doc_id, r.text)) for r in stage(spark, odd, str(tmp_path)).collect()) == want[k]
    encoded = corpus_pipeline.STAGES[4][1](spark, odd, str(tmp_path)).collect()
    assert len(encoded) == len(rows) and [r.n_tokens for r in encoded if r.doc_id in (2, 3)] == [0, 0]


def test_names():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "suffix_repeats", "decontamination", "bpe"]


@needs_data
@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    ours = llm.queries()[name](spark, SF)
    theirs = con.execute(llm.oracle_sql()[name])
    names = [d[0] for d in theirs.description]
    assert sorted(names) == sorted(ours.columns)
    found = [tuple(r[n] for n in names) for r in ours.collect()]
    assert found and sorted(map(str, found)) == sorted(map(str, theirs.fetchall()))


@needs_data
@pytest.mark.parametrize("name", ["op1_language_id", "op7_toxicity", "op10_quality"])
def test_held_out(spark, name):
    """Accuracy on labelled rows that weren't learned from."""
    import pyarrow.parquet as pq

    sf = "/root/testdata/sf0.01"
    column = {"op1_language_id": "lang", "op7_toxicity": "toxic", "op10_quality": "quality"}[name]
    table = pq.read_table(f"{sf}/{'documents' if column == 'lang' else 'labels'}.parquet", columns=["doc_id", column])
    known = dict(zip(*(c.to_pylist() for c in table.columns), strict=True))
    got = [r for r in llm.queries()[name](spark, sf).collect() if r.held_out and known.get(r.doc_id) is not None]
    right = [(r.lang_pred if column == "lang" else r.predicted) == known[r.doc_id] for r in got]
    assert len(right) > 50 and sum(right) / len(right) > {"lang": 0.97, "toxic": 0.85, "quality": 0.9}[column]
