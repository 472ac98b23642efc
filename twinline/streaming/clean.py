"""The per-corpus chain on a stream of pairs: the same narrow columns, no state."""

from __future__ import annotations

from pyspark.sql import DataFrame

from twinline.operators.chain import preprocess
from twinline.operators.registry import Chain


def preprocess_stream(pairs: DataFrame, spec: Chain) -> DataFrame:
    """As ``preprocess``, for a streaming frame. Cuts need the size of a corpus, which a stream lacks."""
    if not pairs.isStreaming:
        raise ValueError("not a stream: use preprocess")
    if spec.cuts:
        raise ValueError("cuts by line number need a finished corpus")
    return preprocess(pairs, spec)
