"""The per-corpus chain: strip, cuts, empties, filters, transforms, augmenters.

Everything here is narrow: one scan stage, no shuffle, and the same code runs on a stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, functions as F

from twinline.functions import chars
from twinline.operators.registry import Chain, Op


def with_computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Like ``withColumns``, but the new columns are evaluated once per row.

    Filters are pushed below a projection by copying the projected expression into every place that
    uses it; ten filters would strip each text a score of times. A one-element ``inline`` stops that.
    """
    struct = F.struct(*[column.alias(name) for name, column in columns.items()])
    kept = [name for name in df.columns if name not in columns]
    order = df.columns + [name for name in columns if name not in df.columns]
    return df.select(*kept, F.inline(F.array(struct))).select(*order)


def strip_pair(df: DataFrame) -> DataFrame:
    """Remove whitespace, in Python's sense, from both ends of both sides."""
    return with_computed(df, src=chars.strip(F.col("src")), tgt=chars.strip(F.col("tgt")))


def drop_empty(df: DataFrame) -> DataFrame:
    """Drop pairs with an empty (or missing) side."""
    return df.filter((F.length("src") > 0) & (F.length("tgt") > 0))


def cut_range(cuts: Sequence[Op], n_lines: Column) -> tuple[Column, Column]:
    """First and last line number that positional cuts keep of a corpus of ``n_lines``. The last cut sets the end."""
    begin, end = F.lit(1).cast("long"), n_lines.cast("long")

    def position(percent: float) -> Column:
        return (F.lit(percent / 100) * n_lines.cast("double")).cast("long")

    for cut in cuts:
        if cut.name == "excerpt":
            begin, end = position(cut.args["top_percentile"]), position(cut.args["bottom_percentile"]) + 1
        else:
            end = position(cut.args["percent"]) + 1
    return begin, end


def cut_lines(df: DataFrame, cuts: Sequence[Op], line_no: str = "line_no", n_lines: str = "n_lines") -> DataFrame:
    """Positional cuts, by line number and number of lines of the corpus."""
    if not cuts:
        return df
    begin, end = cut_range(cuts, F.col(n_lines))
    return df.filter((F.col(line_no) >= begin) & (F.col(line_no) <= end))


def rejections(filters: Sequence[Op]) -> list[tuple[str, Column]]:
    """Name and predicate of each filter; a predicate that is null removes nothing."""
    return [(op.name, F.coalesce(op.build(F.col("src"), F.col("tgt"), **op.args), F.lit(False))) for op in filters]


def with_reason(df: DataFrame, filters: Sequence[Op]) -> DataFrame:
    """Add ``reason``: the first filter that removes the pair, null when none does."""
    reasons = [F.when(removed, F.lit(name)) for name, removed in rejections(filters)]
    return df.withColumn("reason", F.coalesce(*reasons, F.lit(None).cast("string")))


def filter_chain(df: DataFrame, filters: Sequence[Op]) -> DataFrame:
    """Keep the pairs no filter removes."""
    if not filters:
        return df
    return df.filter(reduce(and_, [~removed for _, removed in rejections(filters)]))


def transform_chain(df: DataFrame, transforms: Sequence[Op]) -> DataFrame:
    """Apply the transforms in order, one projection each so that expressions do not nest."""
    for op in transforms:
        src, tgt = op.build(F.col("src"), F.col("tgt"), **op.args)
        df = df.withColumns({"src": src, "tgt": tgt})
    return df


def augment_fanout(df: DataFrame, augmenters: Sequence[Op]) -> DataFrame:
    """Every pair followed by its augmented pairs, in one pass.

    ``aug`` names the augmenter (null for the original) and ``aug_ord`` numbers the rows of one line.
    """
    src, tgt = F.col("src"), F.col("tgt")
    kept = [name for name in df.columns if name not in ("src", "tgt")]
    if not augmenters:
        return df.select(
            *kept, F.lit(None).cast("string").alias("aug"), F.lit(0).alias("aug_ord"), "src", "tgt"
        )

    def labelled(pairs: Column, name: Column) -> Column:
        named = F.transform(
            pairs, lambda p: F.struct(name.alias("aug"), p["src"].alias("src"), p["tgt"].alias("tgt"))
        )
        return F.coalesce(named, F.array().cast("array<struct<aug:string,src:string,tgt:string>>"))

    original = F.array(F.struct(F.lit(None).cast("string").alias("aug"), src.alias("src"), tgt.alias("tgt")))
    extra = [labelled(op.build(src, tgt, **op.args), F.lit(op.name)) for op in augmenters]
    # The array is never empty; the outer form only spares a second evaluation that checks this.
    rows = df.select(*kept, F.posexplode_outer(F.concat(original, *extra)).alias("aug_ord", "pair"))
    return rows.select(*kept, "pair.aug", "aug_ord", "pair.src", "pair.tgt")


def clean_pairs(df: DataFrame, spec: Chain) -> DataFrame:
    """Stripped, cut, non-empty pairs: the input of the filters."""
    if spec.cuts:
        df = cut_lines(df, spec.cuts)
    return drop_empty(strip_pair(df))


def preprocess(df: DataFrame, spec: Chain) -> DataFrame:
    """The whole chain for one corpus. Cuts need ``line_no`` and ``n_lines`` columns."""
    kept = filter_chain(clean_pairs(df, spec), spec.filters)
    return augment_fanout(transform_chain(kept, spec.transforms), spec.augmenters)


def observed_preprocess(df: DataFrame, spec: Chain) -> tuple[DataFrame, Observation | None]:
    """As ``preprocess``, with an observation of how many pairs each filter removes, credited to the first that matched.

    The job that writes the pairs takes it on the way; None without filters. It has its numbers when that job has ended.
    """
    clean = clean_pairs(df, spec)
    if not spec.filters:
        return augment_fanout(transform_chain(clean, spec.transforms), spec.augmenters), None
    names = dict.fromkeys(op.name for op in spec.filters)
    seen = Observation()
    judged = with_reason(clean, spec.filters)
    judged = judged.observe(seen, *[F.count_if(F.col("reason") == name).alias(name) for name in names])
    kept = judged.filter("reason IS NULL").drop("reason")
    return augment_fanout(transform_chain(kept, spec.transforms), spec.augmenters), seen


def rejection_report(df: DataFrame, spec: Chain, by: str = "source") -> DataFrame:
    """Pairs removed per corpus and filter, credited to the first filter that matched, with a total.

    Totals have a null ``reason``.
    """
    judged = with_reason(clean_pairs(df, spec), spec.filters).select(by, "reason")
    removed = judged.filter(F.col("reason").isNotNull()).groupBy(by, "reason").agg(F.count("*").alias("removed"))
    totals = removed.groupBy(by).agg(F.sum("removed").alias("removed"))
    return removed.unionByName(totals.withColumn("reason", F.lit(None).cast("string")))
