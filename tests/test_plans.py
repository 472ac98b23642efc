"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from workload.queries import QUERIES
from twinline.operators import bleu, merge, mix, selection
from twinline.operators import chain as chains
from twinline.operators.registry import chain
from twinline.sources import tables
from workload import views
from workload.queries import FULL

SF = "/root/testdata/sf0.001"
ALL_FILTERS = [
    "duplicates",
    {"char_length": {"min": 1}},
    {"source_target_ratio": {"min": 0.1, "max": 9}},
    "uppercase_count_mismatch",
    {"contains": {"words": ["x"]}},
    "digits_ratio",
    "nonalphanum_ratio",
    "digits_mismatch",
    "nonalphanum_count_mismatch",
    "characters_count_mismatch",
    "first_char_mismatch",
    {"limit_latin_chars": {"s_chset": "Cyrl", "t_chset": "Latn"}},
]


@pytest.fixture(autouse=True)
def no_automatic_broadcast(spark):
    """Plans as they are when no table is small."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> list[str]:
    return re.findall(r"Exchange (\w+)", plan(df))


@pytest.fixture(scope="module")
def pairs(spark):
    return tables.document_pairs(tables.load(spark, SF, "documents"))


def test_the_chain_is_one_narrow_stage(pairs):
    spec = chain(filters=ALL_FILTERS, transforms=["remove_unpaired_quotes_and_brackets"], augmenters=["lowercase"])
    assert exchanges(chains.preprocess(pairs, spec)) == []
    assert exchanges(chains.with_reason(chains.clean_pairs(pairs, spec), spec.filters)) == []
    assert "Python" not in plan(chains.preprocess(pairs, spec))


def test_texts_are_stripped_once(pairs):
    assert plan(chains.preprocess(pairs, chain(filters=ALL_FILTERS))).count("trim(") == 2


def test_long_chains_stay_small(pairs):
    step = ["remove_unpaired_quotes_and_brackets", "first_case_normalize", {"remove_chars": {"chars": ["ab", "c"]}}]
    few, many = (len(plan(chains.preprocess(pairs, chain(transforms=step * n)))) for n in (2, 8))
    assert many < 6 * few


def test_dedup_shuffles_once_after_combining(pairs):
    spec = chain(filters=["duplicates"])
    df = merge.dedup_pairs(chains.preprocess(pairs, spec), order=("source_ord", "doc_id", "pair_no", "aug_ord"))
    assert exchanges(df) == ["hashpartitioning"]
    assert "partial_min" in plan(df)


def test_only_needed_columns_are_read(pairs, spark):
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in plan(chains.preprocess(pairs, FULL))
    # Counting corpora needs no text at all.
    assert re.search(r"ReadSchema: struct<source:string>", plan(entry.queries()["source_fingerprint"](spark, SF)))


def test_filters_on_corpora_reach_the_scan(pairs):
    specs = {"src0": chain(filters=["duplicates"]), "src1": None, "src2": chain(augmenters=["lowercase"])}
    text = plan(merge.preprocess_by_source(pairs, specs))
    assert text.count("FileScan") == 2 and text.count("source,src") >= 2 and "PushedFilters: [IsNotNull(source), EqualTo" in text


def test_numbering_never_gathers_a_corpus(spark):
    df = views.numbered_pairs(spark, SF)
    assert "SinglePartition" not in plan(df)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    # One scan for the texts and one, shared, to count their lines.
    assert "ReusedExchange" in final and final.count("FileScan") == 2


def test_cuts_drop_documents_where_they_are_read(spark):
    cuts = chain(filters=[{"excerpt": {"top_percentile": 20, "bottom_percentile": 30}}]).cuts
    df = views.numbered_pairs(spark, SF, cuts)
    # below the exchange of the texts there is nothing but the filter by the bounds of each corpus
    assert re.search(r"Exchange hashpartitioning\(source#\d+, doc_id#\d+L, \d+\).*\n\W*Filter .*doc_id#\d+L >= .*Subquery", plan(df))
    whole = chains.cut_lines(views.numbered_pairs(spark, SF), cuts)
    assert 0 < df.count() == whole.count() and df.exceptAll(whole).isEmpty()


def test_the_split_is_one_narrow_pass(spark, pairs):
    distinct = pairs.select("src", "tgt").distinct()
    for df in (selection.train_val_split(distinct, 5), selection.take_sample(distinct, 5, selection.pair_key(1))):
        assert exchanges(df) == exchanges(distinct) and plan(df).count("FileScan") == 1


def test_the_mix_reads_its_pairs_once(spark):
    numbered = views.numbered_pairs(spark, SF)
    sizes = tables.pair_offsets(views.documents(spark, SF)).withColumn("source_ord", tables.corpus_number(F.col("source")))
    df = mix.weighted_mix(numbered, {f"src{n}": 1 + n for n in range(20)}, sizes=sizes)
    assert plan(df).count("FileScan") == plan(numbered).count("FileScan")
    assert [e for e in exchanges(df) if e != "HashedRelationBroadcastMode"] == exchanges(numbered)  # one row per corpus is sent along


def test_bleu_moves_no_text(spark):
    df = bleu.corpus_bleu(views.scored(spark, SF))
    assert exchanges(df) == ["SinglePartition"]  # one row of sums from each partition


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_result_is_the_same_on_any_partitioning(spark):
    documents = tables.load(spark, SF, "documents")
    spec = chain(filters=["duplicates", {"top": {"percent": 70}}], augmenters=["lowercase"])
    results = []
    for parts in (1, 13):
        numbered = tables.numbered_document_pairs(documents.repartition(parts))
        df = merge.dedup_pairs(chains.preprocess(numbered, spec))
        results.append(df.select("source", "line_no", "aug_ord", "src", "tgt", F.col("copies")))
    assert results[0].count() > 100
    assert results[0].exceptAll(results[1]).isEmpty() and results[1].exceptAll(results[0]).isEmpty()
