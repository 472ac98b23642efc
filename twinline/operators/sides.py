"""Exchanging the two sides."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def swap_sides(pairs: DataFrame) -> DataFrame:
    """The source becomes the target and the other way round."""
    return pairs.withColumns({"src": F.col("tgt"), "tgt": F.col("src")})
