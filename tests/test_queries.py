"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from workload.queries import QUERIES
from tests.check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    line = compare(spark, con, name, SF)
    assert line.startswith("ok"), line
    assert ": 0 rows" not in line, line


@pytest.mark.parametrize("name", ["first_case_normalize", "transform_chain", "preprocess"])
def test_letters_with_long_capitals(spark, tmp_path, name):
    """Such letters in first place, below lines of either case, in every kind of marked line."""
    lines = [f"{src}\n{tgt}aus und ein" for tgt in "ßŉﬁᾀǰaÄ" for src in ("Der Weg", "der Weg", "7 Wege", "Ein Haus", "ein Haus")]
    rows = [(n, "\n".join(lines), f"src{n % 2}") for n in range(4)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    line = compare(spark, con, name, str(tmp_path))
    assert line.startswith("ok"), line


def test_entry(spark):
    assert entry.entry(spark).columns == ["source", "pairs", "copies"]
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
