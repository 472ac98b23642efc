"""Deterministic shuffling, sampling and splitting by a hash key.

"Random" means the order of an md5 key, which needs no generator state, gives the same answer on any
number of partitions and survives recomputation. Keys are spread evenly, so the n-th smallest lies close to where
their number says, and counting keys by prefix gives exact ranks with nothing bigger than one prefix in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Hex digits counted by: at most 16**5 (about a million) counts, each for a millionth of the rows.
PREFIX_DIGITS = 5
# Hex digits of a key that a share of all keys is turned into; standard deviations, and rows, looked at around the wanted key.
KEY_DIGITS = 12
SIGMAS = 6
SLACK = 8


def pair_key(seed: int | str, *extra: Column) -> Column:
    """Hash key of a pair; ``extra`` columns tell copies of one pair apart."""
    return F.md5(F.concat_ws("\t", "src", "tgt", *extra, F.lit(str(seed))))


def _prefix(key: str) -> Column:
    return F.substring(key, 1, PREFIX_DIGITS)


def _counts_by_prefix(df: DataFrame, key: str) -> DataFrame:
    """``prefix, in_prefix, before``: a table of bounded size, whatever the size of ``df``."""
    counts = df.groupBy(_prefix(key).alias("prefix")).agg(F.count("*").alias("in_prefix"))
    earlier = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("in_prefix").over(earlier), F.lit(0)))


def nth_smallest_key(df: DataFrame, key: str, n: Column | int) -> str | None:
    """The ``n``-th smallest of the unique md5 keys; None for 0, the last one beyond the end.

    Keys are spread evenly, so the number of rows tells between which two keys it lies but for a few standard deviations of
    the number of rows below a key. One pass over the keys counts those below and keeps those between (some
    thousands of a billion rows); should they not hold the wanted one, the next pass looks four times as wide.
    """
    total = F.least(F.lit(n) if isinstance(n, int) else n, F.count("*")).alias("wanted")
    rows, wanted = df.agg(F.count("*").alias("rows"), total).first()
    if not wanted or wanted < 1:
        return None
    share = wanted / rows
    spread = SIGMAS * math.sqrt(rows * share * (1 - share)) + SLACK
    while True:
        low, high = (_hex(edge / rows) for edge in (wanted - spread, wanted + spread))
        column = F.col(key)
        between = F.when((column >= low) & (column < high), column)
        below, kept = df.agg(F.count_if(column < low), F.sort_array(F.collect_list(between))).first()
        if below < wanted <= below + len(kept):
            return kept[wanted - below - 1]
        spread *= 4


def _hex(share: float) -> str:
    """The key that this share of all keys lies below; beyond the ends one that none or all lie below."""
    return "" if share <= 0 else "g" if share >= 1 else f"{int(share * 16**KEY_DIGITS):0{KEY_DIGITS}x}"


def train_val_split(pairs: DataFrame, n: Column | int, seed: int | str = 0) -> DataFrame:
    """Add ``split``: exactly ``n`` pairs are ``val``, the rest ``train``. Pairs must be distinct.

    ``n`` is a number or an aggregate of ``pairs``. The threshold is found at once, in a count and one pass over the keys; the
    result is a narrow pass. Hand it a materialized table when ``pairs`` is costly.
    """
    keyed = pairs.withColumn("key", pair_key(seed))
    threshold = nth_smallest_key(keyed, "key", n)
    split = F.when(F.col("key") <= F.lit(threshold), "val").otherwise("train")
    return keyed.withColumn("split", split).drop("key")


def take_sample(df: DataFrame, n: int, key: Column) -> DataFrame:
    """Exactly ``n`` rows (all, if fewer) with the smallest unique keys, found as in ``train_val_split``: nothing is shuffled."""
    keyed = df.withColumn("_key", key)
    return keyed.filter(F.col("_key") <= F.lit(nth_smallest_key(keyed, "_key", n))).drop("_key")


def shuffle_corpus(pairs: DataFrame, seed: int | str = 0, unique: Sequence[str] = ()) -> DataFrame:
    """Add ``position``, the 1-based place of each pair in a shuffled corpus.

    Positions come from prefix counts plus a rank inside one prefix, so the rows need not be sorted
    globally. ``unique`` names columns that tell copies of a pair apart; distinct pairs need none.
    """
    keyed = pairs.withColumn("_key", pair_key(seed, *[F.col(c).cast("string") for c in unique]))
    keyed = keyed.withColumn("prefix", _prefix("_key"))
    counts = _counts_by_prefix(keyed.select("_key"), "_key").select("prefix", "before")
    rank = F.row_number().over(Window.partitionBy("prefix").orderBy("_key"))
    ranked = keyed.withColumn("_rank", rank).join(counts, "prefix")
    return ranked.withColumn("position", F.col("before") + F.col("_rank")).drop("_key", "_rank", "before", "prefix")


def sentences(pairs: DataFrame, *position: str) -> DataFrame:
    """Both sides as one column: ``position..., side, text``."""
    sides = F.explode(
        F.array(
            F.struct(F.lit("src").alias("side"), F.col("src").alias("text")),
            F.struct(F.lit("tgt").alias("side"), F.col("tgt").alias("text")),
        )
    )
    return pairs.select(*position, sides.alias("s")).select(*position, "s.side", "s.text")


def training_sample(
    pairs: DataFrame, position: Sequence[str], n: int = 1_000_000, seed: int | str = 0
) -> DataFrame:
    """At most ``n`` sentences drawn from both sides; ``position`` identifies a pair."""
    key = F.md5(F.concat_ws("\t", "side", *[F.col(c).cast("string") for c in position], F.lit(str(seed))))
    return take_sample(sentences(pairs, *position), n, key)


def tokens(text: Column) -> Column:
    """Blank-separated tokens."""
    return F.array_remove(F.split(text, " ", -1), "")


def max_tokens(pairs: DataFrame, src: int = 150, tgt: int = 150, tokenize=tokens) -> DataFrame:
    """Drop pairs with a side over its token limit or without any token."""

    def fits(side: str, limit: int) -> Column:
        return F.size(tokenize(F.col(side))).between(1, limit)

    return pairs.filter(fits("src", src) & fits("tgt", tgt))
