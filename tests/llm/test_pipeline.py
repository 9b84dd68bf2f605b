"""The pipeline's stages on planted cases, and the guard that lets the rest of the library stand alone."""

import subprocess
import sys

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline

from .test_operators import brute_contamination, docs_of, plain_spans, tiktoken_encoding

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def planted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()
    base = docs.where("n_chars > 600 AND lang = 'en'").orderBy("doc_id").first()
    words = base.text.split(" ")
    more = [
        (90001, base.text),  # an exact copy
        (90002, " ".join([*words[:40], "changed", *words[41:]])),  # a near copy
        (90003, f"{base.text[:200]} and so {bench.text} {base.text[200:260]} alone"),  # holds a benchmark text
        (90004, "Write to some.one@mail.example.com or +1 (269) 555-3296 in the thing of the other and that"),
        (90005, None),
        (90006, "123 456 !!"),
        (None, "The thing of the that and in an other one for this"),
    ]
    rows = [*more, (90004, more[3][1])]
    extra = spark.createDataFrame([(*r, "en", "planted", len(r[1] or "")) for r in rows], docs.schema)
    return base, docs.unionByName(extra).withColumn("lang", F.when(F.col("doc_id") == 90004, None).otherwise(F.col("lang")))


def test_stages_decide_on_planted_rows(spark, planted):
    base, docs = planted
    kept = docs
    ids = {}
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, SF)
        rows = kept.collect()
        if name != "byte_bpe":
            assert kept.columns == docs.columns
            kept = spark.createDataFrame(rows, docs.schema)
        ids[name] = [r.doc_id for r in rows]
        by = {r.doc_id: r for r in rows}
        if name == "language_id":
            assert by[90004].lang == "en" and 90005 not in by and 90006 not in by and None in by
            assert len(rows) >= docs.count() - 4
        if name == "near_dedup":
            assert base.doc_id in by or any(i < base.doc_id for i in by if i is not None)
            assert 90001 not in by and 90002 not in by and ids[name].count(90004) == 1 and None in by
        if name == "decontamination":
            assert 90003 not in by
            bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            assert not any(v[1] for v in brute_contamination([(r.doc_id, r.text) for r in rows], bench).values())
        if name == "pii":
            assert "[EMAIL]" in by[90004].text and "[PHONE]" in by[90004].text and by[90004].n_chars == len(by[90004].text)
            assert not any(plain_spans(r.text) for r in rows)
            texts = {r.doc_id: r.text for r in rows}
        if name == "byte_bpe":
            encoding = tiktoken_encoding()
            assert all(r.round_trip for r in rows)
            assert all(np.frombuffer(r.ids, "<u4").tolist() == encoding.encode_ordinary(texts[r.doc_id]) for r in rows)


def test_texts_of_one_id_are_documents_of_their_own(spark):
    text = lambda name: " ".join(f"{name}{k}" for k in range(60))
    near = text("b") + " more"
    rows = [(1, text("a")), (2, text("a")), (2, text("b")), (2, text("b")), (3, near), (4, text("c")), (4, text("d")), (5, text("d")), (6, None), (6, None), (7, text("e")), (None, text("a")), (None, text("a"))]
    kept = corpus_pipeline.near_dedup(spark, docs_of(spark, rows), SF)
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, text("a")), (2, text("b")), (4, text("c")), (4, text("d")), (6, None), (7, text("e")), (None, text("a")), (None, text("a"))], key=str)


def test_stages_take_an_empty_table(spark):
    kept = docs_of(spark, [(1, "x")]).where("false")
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, SF)
        assert kept.count() == 0


def test_run_gives_the_rows_of_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert rows and all(r.round_trip for r in rows) and len({r.doc_id for r in rows}) == len(rows)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "pii", "byte_bpe"]
    assert public_tokenizers.path("byte_bpe_50k.tiktoken") == corpus_pipeline.RANKS


def test_entry_without_the_corpus_operators():
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('reelspark.llm'):\n"
        "            raise ModuleNotFoundError(name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.corpus is None and not any(q.startswith('op') or q == 'pipeline' for q in e.queries())\n"
        "assert e.queries() and set(e.oracle_sql()) <= set(e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])
