"""Documents to packed training sequences: quality, near-duplicates, secrets, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from twinline.llm import mixing, odd_sketch, ordinal, packing, secrets
from twinline.llm.queries import grades, tokenizer_path
from twinline.sources.scratch import materialize
from twinline.sources.tables import load


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier, fitted on the rated ones among them, gives the highest grade."""
    return ordinal.select(docs, ordinal.fit(docs, grades(spark, sf_dir)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each group linked at five words and a similarity of 0.8."""
    return odd_sketch.deduplicated(docs, width=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live credentials masked in their texts; widely copied examples stay."""
    return secrets.masked(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight takes them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens next to lexical neighbours."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", source_mix),
    ("packing", packed),
]

# A fitted classifier, rounded rates and tokenization have no SQL; tests hold the rows against plain models.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each result written and read as the next one's input."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
