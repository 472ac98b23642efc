"""Text search over both sides of raw corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from twinline.functions import chars
from twinline.operators.selection import sentences


def matches(line: Column, wanted: str, exact: bool = False) -> Column:
    """The line contains the text, or stripped equals it when ``exact``, ignoring case."""
    lowered, wanted = F.lower(line), wanted.lower()
    return chars.strip(lowered) == wanted if exact else lowered.contains(wanted)


def find_text(
    pairs: DataFrame, text: str, exact: bool = False, position: tuple[str, ...] = ("source", "line_no")
) -> DataFrame:
    """Lines of either side that match ``text``: ``position..., side, text``.

    Narrow. Where line numbers cost a join, number the few matches afterwards.
    """
    return sentences(pairs, *position).filter(matches(F.col("text"), text, exact))
