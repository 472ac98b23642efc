"""Weighted mixing: w pairs from each corpus in turn."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

STOPS = ("all_exhausted", "first_exhausted")
# Bytes of the table of stretches up to which it is sent to every task rather than joined by shuffle.
SMALL_TABLE = 8 << 20


def stretches(corpora: list[tuple[int, int]]) -> tuple[list[int], list[int], list[list[int]]]:
    """Rounds at which the mix changes, pairs a round takes from there on, and for each corpus what it starts from.

    ``corpora`` has size and weight, in the order they take their turns. A corpus gives its weight in each of its whole
    rounds, the rest in the next, then nothing. So between two such rounds every round takes the same; pair ``line`` of a corpus of weight ``w``
    in round ``r`` stands at ``start + taken * r + line - w * r``.
    """
    rounds = sorted({0, *(r for n, w in corpora for r in (n // w, n // w + 1))})
    taken, starts = [], [[] for _ in corpora]
    for first in rounds:
        given = [max(0, min(w, n - first * w)) for n, w in corpora]
        taken.append(sum(given))
        before = sum(min(n, first * w) for n, w in corpora) - first * taken[-1]
        for start, earlier in zip(starts, accumulate([0, *given])):
            start.append(before + earlier)
    return rounds, taken, starts


def _last_at_most(values: list[int], wanted: Column) -> Column:
    """Index of the last of ascending ``values`` that is not over ``wanted``, in as many steps as their number has bits."""
    table = F.array(*[F.lit(v).cast("long") for v in values])
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(len(values).bit_length()))])

    def step(at: Column, more: Column) -> Column:
        return at + F.when(F.get(table, at + more) <= wanted, more).otherwise(F.lit(0))

    return F.aggregate(steps, F.lit(0), step)


def weighted_mix(
    pairs: DataFrame, weights: Mapping[str, int], stop: str = "all_exhausted", sizes: DataFrame | None = None
) -> DataFrame:
    """Add ``round`` and ``position``: each round takes ``weights[source]`` pairs of every corpus.

    ``pairs`` has ``source, source_ord, line_no, n_lines``; ``sizes`` is any cheaper table with
    ``source, source_ord, n_lines`` to take the sizes from, which are read at once: one row for each weight.
    The position follows from the stretch of rounds that a pair's round lies in: a search among the rounds where a
    corpus ends and one row per corpus, so a row costs the logarithm of the number of corpora, and nothing is ranked,
    shuffled or sorted. ``first_exhausted`` ends the mix where a corpus first cannot give its next pair.
    """
    if stop not in STOPS:
        raise ValueError(f"stop must be one of {STOPS}, not {stop!r}")
    bad = {name: w for name, w in weights.items() if not isinstance(w, int) or w < 1}
    if bad or not weights:
        raise ValueError(f"weights must be positive whole numbers: {bad or weights!r}")
    known = (pairs if sizes is None else sizes).filter(F.col("source").isin(list(weights)))
    counts = known.groupBy("source", "source_ord").agg(F.max("n_lines").alias("n")).orderBy("source_ord", "source").collect()
    corpora = [(c.n, weights[c.source]) for c in counts]
    rounds, taken, starts = stretches(corpora)
    rows = [(c.source, w, start) for c, (_, w), start in zip(counts, corpora, starts)]
    table = pairs.sparkSession.createDataFrame(rows, "source string, _weight bigint, _starts array<bigint>")
    if len(rows) * (len(rounds) + 4) * 8 <= SMALL_TABLE:
        table = F.broadcast(table)
    mixed = pairs.join(table, "source").withColumn("round", F.floor((F.col("line_no") - 1) / F.col("_weight")))
    if stop == "first_exhausted" and corpora:
        last, corpus = min((n // w, c.source_ord) for c, (n, w) in zip(counts, corpora))
        mixed = mixed.filter((F.col("round") < last) | (F.col("round") == last) & (F.col("source_ord") <= corpus))
    per_round = F.array(*[F.lit(t).cast("long") for t in taken])
    mixed = mixed.withColumn("_at", _last_at_most(rounds, F.col("round")))
    place = F.get("_starts", F.col("_at")) + (F.get(per_round, F.col("_at")) - F.col("_weight")) * F.col("round")
    return mixed.withColumn("position", place + F.col("line_no")).select(*pairs.columns, "round", "position")
