"""Corpora held in tables: documents whose lines alternate between source and translation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from twinline.operators import chain, numbering
from twinline.operators.registry import Op

# Documents per numbering block: 2**14 consecutive ids.
BLOCK_BITS = 14


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def corpus_number(source: Column) -> Column:
    """``src12`` is corpus 12."""
    return F.regexp_extract(source, r"(\d+)$", 1).cast("int")


def _line_pairs(lines: Column) -> Column:
    return F.arrays_zip(
        F.filter(lines, lambda _, i: i % 2 == 0).alias("src"),
        F.filter(lines, lambda _, i: i % 2 == 1).alias("tgt"),
    )


def line_count(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1


def pair_count(text: Column) -> Column:
    return F.ceil(line_count(text) / 2)


def document_pairs(documents: DataFrame, *carry: str) -> DataFrame:
    """``source, source_ord, doc_id, pair_no, src, tgt``: odd lines paired with the line below, a last one without with an empty one."""
    kept = ["source", "source_ord", "doc_id", *carry]
    lines = documents.withColumns(
        {"source_ord": corpus_number(F.col("source")), "lines": F.split("text", "\n", -1)}
    ).select(*kept, "lines")
    exploded = lines.select(*kept, F.posexplode_outer(_line_pairs(F.col("lines"))).alias("pos", "pair"))
    return exploded.filter("pair.src IS NOT NULL").select(
        *kept,
        (F.col("pos") + 1).alias("pair_no"),
        F.col("pair.src").alias("src"),
        F.coalesce("pair.tgt", F.lit("")).alias("tgt"),
    )


def pair_offsets(documents: DataFrame) -> DataFrame:
    """``source, doc_id, lines_before, unit_lines, n_lines``: a narrow table, the texts themselves stay put."""
    pairs = pair_count(F.col("text"))
    block = F.shiftright(F.col("doc_id"), BLOCK_BITS)
    return numbering.unit_offsets(documents, "source", "doc_id", block, pairs)


def number_pairs(pairs: DataFrame, documents: DataFrame) -> DataFrame:
    """Add ``line_no`` (position in the corpus) and ``n_lines`` (its size) to document pairs."""
    return (
        pairs.join(pair_offsets(documents), ["source", "doc_id"])
        .withColumn("line_no", F.col("lines_before") + F.col("pair_no"))
        .drop("lines_before", "unit_lines")
    )


def numbered_document_pairs(documents: DataFrame, cuts: Sequence[Op] = ()) -> DataFrame:
    """As ``document_pairs`` with line numbers; texts are joined to their offsets before the fan-out.

    The join is always by key and spills: document ids are unique, so no source makes a task large.
    Broadcasting either side would leave the fan-out to the partitions of the other.

    Positional ``cuts`` are taken first. Lines are numbered in the order of ids, so what a cut keeps of a corpus is a
    range of documents: one row of bounds for each corpus, from the narrow table, drops the others where texts are read.
    """
    offsets = pair_offsets(documents)
    texts = documents.select("source", "doc_id", "text")
    if cuts:
        begin, end = chain.cut_range(cuts, F.col("n_lines"))
        offsets = offsets.filter((F.col("lines_before") < end) & (F.col("lines_before") + F.col("unit_lines") >= begin))
        bounds = offsets.groupBy("source").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        by_source = F.map_from_entries(F.collect_list(F.struct("source", F.struct("first", "last"))))
        kept = F.try_element_at(bounds.agg(by_source).scalar(), F.col("source"))
        texts = texts.filter(F.col("doc_id").between(kept["first"], kept["last"]))
    placed = texts.join(offsets.drop("unit_lines").hint("merge"), ["source", "doc_id"])
    pairs = (
        document_pairs(placed, "lines_before", "n_lines")
        .withColumn("line_no", F.col("lines_before") + F.col("pair_no"))
        .drop("lines_before")
    )
    return chain.cut_lines(pairs, cuts)
