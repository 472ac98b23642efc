"""Registered queries next to their SQL, and the pipeline's stages in order."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.check import compare, duck
from twinline.llm.oracles import ORACLES
from twinline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    line = compare(spark, con, name, SF)
    assert line.startswith("ok" if name in ORACLES else "rows"), line
    assert ": 0 rows" not in line, line


def test_names():
    assert set(ORACLES) <= set(QUERIES)
    assert {**QUERIES, "pipeline": corpus_pipeline.run}.items() <= entry.queries().items()


def test_pipeline_stages_keep_odd_rows(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    secret, other = "token = Zx9Qw8Er7Ty6Ui5Op4", "api_key: Aa1Bb2Cc3Dd4Ee5Ff6"
    prose = "A plain sentence of ordinary words that goes on for a while, number"
    rows = [
        (1, f"{prose} one. {secret}", "en", "src1", 10), (1, f"{other} first. {prose} two, with rather more to say.", "en", "src1", 10),
        (None, f"{prose} three and more of it. {secret}", None, None, None), (None, None, "en", "src2", 0), (2, "", "en", "src2", 0),
        (2, "", "en", "src2", 0), (3, "long " * 3000, "en", "src1", 15000), (4, None, None, "src1", None),
    ]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns
        assert set(got.select("doc_id").collect()) <= set(docs.select("doc_id").collect()), name
        assert stage(spark, docs.limit(0), SF).collect() == [], name
    hidden = corpus_pipeline.secret_scan(spark, docs, SF).collect()
    assert len(hidden) == len(rows) and sum(r.text is None for r in hidden) == 2
    texts = [r.text for r in hidden if r.text]
    assert not any(v in t for t in texts for v in ("Zx9Qw8Er7Ty6Ui5Op4", "Aa1Bb2Cc3Dd4Ee5Ff6"))  # each by its own text
    assert sum(prose in t for t in texts) == 3 and "long " * 3000 in texts
    assert sum(r.start == 0 for r in corpus_pipeline.packed(spark, docs, SF).collect()) == len(rows)
    assert corpus_pipeline.packed(spark, docs.limit(0), SF).collect() == []


def test_pipeline(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == documents.columns
        seen[name] = [r.doc_id for r in docs.collect()]
    quality, near, secret, mixed = seen.values()
    assert set(near) <= set(quality) and len(near) == len(set(near)) < len(quality)
    assert sorted(secret) == sorted(near)
    assert set(mixed) <= set(near)
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert sum(r.length for r in pieces if r.start == 0) > 0
    assert sum(r.start == 0 for r in pieces) == len(mixed)
