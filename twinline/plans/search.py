"""Text search over the raw files of configured corpora."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from twinline.operators.search import matches
from twinline.plans import build
from twinline.plans.config import Plan
from twinline.sources import text


def readable(
    spark: SparkSession, plan: Plan, folders: Mapping[str, str], listing: DataFrame | None = None
) -> tuple[dict[str, tuple[str, str]], dict[str, str]]:
    """The two files of every corpus that has them, and what is wrong with the others: one bad corpus does not end a search."""
    files, wrong = {}, {}
    for corpus in plan.corpora:
        try:
            found = build.corpus_files(spark, plan, build.corpus_folder(plan, corpus.name, folders, listing))
            files[corpus.name] = (found["src_path"], found["tgt_path"])
        except (LookupError, ValueError, PySparkException) as error:
            wrong[corpus.name] = str(error).strip().split("\n")[0]
    return files, wrong


def find_in_files(
    spark: SparkSession, files: Mapping[str, tuple[str, str]], wanted: str, exact: bool = False
) -> DataFrame:
    """``source, side, line_no, text`` of every match; ``files`` maps a corpus to its two files.

    Each file is scanned as it lies: the sides need not be paired to be searched.
    """
    found = [
        text.read_lines(spark, path)
        .filter(matches(F.col("line"), wanted, exact))
        .select(F.lit(name).alias("source"), F.lit(side).alias("side"), "line_no", F.col("line").alias("text"))
        for name, paths in files.items()
        for side, path in zip(("src", "tgt"), paths)
    ]
    return reduce(DataFrame.unionByName, found)
