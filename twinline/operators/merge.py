"""Merging corpora: union, duplicates, bookkeeping, change detection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from twinline.operators.chain import preprocess
from twinline.operators.registry import Chain

# The validation set holds at most this many pairs and at most this share of all pairs.
MAX_VALIDATION = 5000
VALIDATION_SHARE = 0.2

POSITION = ("source_ord", "line_no", "aug_ord")


def merge_corpora(corpora: Sequence[tuple[DataFrame, Chain, int | None]]) -> DataFrame:
    """Union of the preprocessed corpora without a weight; weighted ones are left alone."""
    merged = [preprocess(df, spec) for df, spec, weight in corpora if weight is None]
    if not merged:
        raise ValueError("no sources merged: every corpus has a weight")
    return reduce(DataFrame.unionByName, merged)


def preprocess_by_source(df: DataFrame, specs: Mapping[str, Chain | None], by: str = "source") -> DataFrame:
    """Preprocess a table of many corpora; corpora mapped to ``None`` (weighted) are left out.

    Corpora with equal chains share one branch, so the table is read once per distinct chain.
    """
    groups: list[tuple[Chain, list[str]]] = []
    for name, spec in specs.items():
        if spec is None:
            continue
        names = next((members for known, members in groups if known == spec), None)
        if names is None:
            groups.append((spec, [name]))
        else:
            names.append(name)
    return merge_corpora([(df.filter(F.col(by).isin(names)), spec, None) for spec, names in groups])


def dedup_pairs(
    df: DataFrame, keys: Sequence[str] = ("src", "tgt"), order: Sequence[str] = POSITION
) -> DataFrame:
    """One row per key, the first in ``order``; ``copies`` tells how many rows it stands for.

    An aggregation, so copies collapse before the shuffle even when one pair dominates the data.
    """
    carried = [name for name in df.columns if name not in keys and name not in order]
    first = F.min(F.struct(*order, *carried))
    grouped = df.groupBy(*keys).agg(first.alias("first"), F.count("*").alias("copies"))
    rest = [F.col(f"first.{name}").alias(name) for name in df.columns if name not in keys]
    return grouped.select(*keys, *rest, "copies").select(*df.columns, "copies")


def validation_size(total: Column, max_eval: int = MAX_VALIDATION) -> Column:
    """Pairs held out of ``total``: the count before duplicates are removed."""
    return F.least(F.lit(float(max_eval)), total.cast("double") * F.lit(VALIDATION_SHARE)).cast("long")


def merge_stats(added: DataFrame, max_eval: int = MAX_VALIDATION) -> DataFrame:
    """Lines added per corpus with the running total, and the resulting split sizes.

    ``added`` is the preprocessed union; the windows run over its per-corpus counts only.
    """
    counts = added.groupBy("source", "source_ord").agg(F.count("*").alias("added"))
    so_far = Window.orderBy("source_ord", "source").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    total = F.sum("added").over(everything)
    return (
        counts.withColumn("running_total", F.sum("added").over(so_far))
        .withColumn("validation_size", validation_size(total, max_eval))
        .withColumn("training_size", total - F.col("validation_size"))
    )


def source_fingerprint(sources: DataFrame, name: str = "source") -> DataFrame:
    """md5 of the sorted corpus names, one row. Takes the manifest or any table naming corpora."""
    names = F.array_sort(F.collect_set(name))
    return sources.agg(F.md5(F.array_join(names, "|")).alias("fingerprint"))


def chain_fingerprint(manifest: DataFrame) -> DataFrame:
    """As ``source_fingerprint``, but sensitive to the operators and weight of each corpus."""
    described = F.to_json(F.struct("name", "weight", "filters", "transforms", "augmenters"))
    return source_fingerprint(manifest.select(described.alias("source")))


def sources_changed(current: DataFrame, stored: DataFrame) -> DataFrame:
    """Compare two one-row fingerprints; an empty ``stored`` counts as changed."""
    before = stored.select("fingerprint").scalar()
    return current.select(
        "fingerprint", before.alias("stored"), (~F.col("fingerprint").eqNullSafe(before)).alias("changed")
    )
