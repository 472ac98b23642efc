"""URL verdicts: rules by host and path, and boosted trees on lexical features for the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from twinline.sources.scratch import materialize

# Labelled URLs that trees are fitted on, chosen by hash: the bound of the fit.
TRAINING_ROWS = 20000
# How many times as many are expected to pass the cheap choice by hash, ahead of the exact one.
MARGIN = 1.1
# Parts of the labelled URLs, each of which is taught with suffix shares of the others.
FOLDS = 5
TREES = 20
DEPTH = 4
# Weight of the overall share of bad URLs in the share of a suffix.
PRIOR = 20.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = (
    "length", "host_length", "path_length", "query_length", "labels", "longest_label", "depth", "digit_ratio", "hyphens",
    "odd_ratio", "entropy", "host_entropy", "parameters", "vowel_ratio", "secure", "top_share", "site_share",
)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule(host_name: Column, path_name: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """``rule, verdict`` of the longest rule that fits the host or a domain above it, and the start of the path."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # longer ones override
        domain, slash, rest = text.partition("/")
        domain = domain.translate(str.maketrans(UPPER, LOWER))
        fits = ((host_name == domain) | host_name.endswith("." + domain)) & path_name.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(text).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _share(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]", ""))) / F.greatest(F.length(text), F.lit(1))


def _entropy(text: Column) -> Column:
    letters = F.split(text, "")
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    share = lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n
    total = F.aggregate(F.array_distinct(letters), F.lit(0.0), lambda s, c: s - F.when(c == "", 0.0).otherwise(share(c) * F.log2(share(c))))
    return F.when(F.length(text) > 0, total).otherwise(0.0)


def with_features(urls: DataFrame) -> DataFrame:
    """``urls(host, path, url)`` with the lexical features but the two shares, and the suffixes these belong to."""
    h, p = F.col("host"), F.col("path")
    u = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    labels = F.filter(F.split(h, r"\."), lambda x: x != "")
    made = {
        "length": F.length(u),
        "host_length": F.length(h),
        "path_length": F.length(p),
        "query_length": F.length(query),
        "labels": F.size(labels),
        "longest_label": F.coalesce(F.array_max(F.transform(labels, lambda x: F.length(x))), F.lit(0)),
        "depth": F.size(F.filter(F.split(p, "/"), lambda x: x != "")),
        "digit_ratio": _share(u, "0-9"),
        "hyphens": F.length(h) - F.length(F.replace(h, F.lit("-"), F.lit(""))),
        "odd_ratio": _share(u, "^A-Za-z0-9"),
        "entropy": _entropy(u),
        "host_entropy": _entropy(h),
        "parameters": F.size(F.filter(F.split(query, "[&;]"), lambda x: x != "")),
        "vowel_ratio": _share(h, "aeiou"),
        "secure": F.startswith(u, F.lit("https:")).cast("int"),
    }
    kept = urls.withColumns({k: v.cast("double") for k, v in made.items()})
    site = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(0)) + 1, 3), ".")
    return kept.withColumns({"top": F.substring_index(h, ".", -2), "site": site})


def fold() -> Column:
    """The part of the labelled URLs that a URL belongs to; copies of it belong to the same."""
    return F.pmod(F.xxhash64("url", F.lit("fold")), F.lit(FOLDS)).cast("int")


def suffix_shares(labelled: DataFrame, suffix: str) -> tuple[DataFrame, float]:
    """Share of bad URLs by suffix, drawn to the overall share, of all URLs (null ``fold``) and of those outside each fold."""
    bad = F.sum(F.col("label") * F.col("copies"))
    overall = labelled.agg(bad / F.sum("copies")).first()[0] or 0.0
    parts = labelled.groupBy(suffix, fold().alias("fold")).agg(bad.alias("bad"), F.sum("copies").alias("n"))
    whole = parts.groupBy(suffix).agg(F.sum("bad").alias("all_bad"), F.sum("n").alias("all_n"))
    outside = parts.join(whole, suffix).select(suffix, "fold", (F.col("all_bad") - F.col("bad")).alias("bad"), (F.col("all_n") - F.col("n")).alias("n"))
    every = whole.select(suffix, F.lit(None).cast("int").alias("fold"), F.col("all_bad").alias("bad"), F.col("all_n").alias("n"))
    share = (F.col("bad") + PRIOR * overall) / (F.col("n") + PRIOR)
    return outside.unionByName(every).select(suffix, "fold", share.alias(f"{suffix}_share")), overall


def with_shares(urls: DataFrame, shares: dict[str, tuple[DataFrame, float]], outside: bool = False) -> DataFrame:
    """URLs with the shares of their suffixes; ``outside`` leaves a URL's own fold out, for URLs that are themselves labelled."""
    for suffix, (table, overall) in shares.items():
        if outside:
            urls = urls.withColumn("fold", fold()).join(table.filter("fold IS NOT NULL"), [suffix, "fold"], "left").drop("fold")
        else:
            urls = urls.join(table.filter("fold IS NULL").drop("fold"), suffix, "left")
        urls = urls.fillna({f"{suffix}_share": overall})
    return urls


def fit(labelled: DataFrame) -> tuple[GBTClassificationModel | None, dict[str, tuple[DataFrame, float]]]:
    """Trees and suffix shares from ``labelled(url, host, path, label)`` with label 1 for bad URLs.

    Shares count all labelled rows. Trees see ``TRAINING_ROWS`` labelled URLs at most, those of lowest hash, each weighted by its
    copies, with the shares of the other folds: a URL's own label does not reach its features. Without both labels there is no model.
    """
    counted = labelled.groupBy("url", "host", "path", "label").agg(F.count("*").alias("copies"))
    rows = materialize(with_features(counted), "labelled-urls")
    shares = {s: (materialize(t, f"{s}-shares"), o) for s in ("top", "site") for t, o in [suffix_shares(rows, s)]}
    n, kinds = rows.agg(F.count("*"), F.count_distinct("label")).first()
    if kinds < 2:
        return None, shares
    lowest = F.xxhash64("url") / 2.0**64 + 0.5 < min(1.0, MARGIN * TRAINING_ROWS / n)
    # bounded before anything is joined, and in one order, so that reruns fit the same trees
    bounded = rows.filter(lowest).orderBy(F.xxhash64("url"), "url", "label").limit(TRAINING_ROWS)
    chosen = with_shares(bounded, shares, outside=True)
    sample = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(chosen)
    sample = sample.select("url", "features", F.col("label").cast("double"), F.col("copies").cast("double").alias("weight"))
    sample = sample.repartition(1).sortWithinPartitions("url", "label")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, minInstancesPerNode=20, seed=1, weightCol="weight")
    return trees.fit(sample.select("features", "label", "weight")), shares


def judge(urls: DataFrame, rules: Sequence[tuple[str, str]], labelled: DataFrame) -> DataFrame:
    """``urls`` with ``host, path, rule, bad, verdict``: the rule's verdict, else block where trees give ``bad >= 0.5``.

    ``labelled(url, label)`` are the URLs that trees learn from, label 1 for bad ones; rows with a null in it are left out. Null URLs
    and those without ``://`` have empty host and path, fit no rule and are judged by the trees; without labels of both kinds ``bad`` is null and
    they are allowed. Repeated rows are judged each. Columns of ``urls`` pass through under their names; one that has a name of the new
    ones is replaced. No rows give no rows.
    """
    taught = labelled.filter("url IS NOT NULL AND label IS NOT NULL").select("url", F.col("label").cast("double"))
    model, shares = fit(taught.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))}))
    carried = [c for c in urls.columns if c not in ("host", "path", "rule", "bad", "verdict")]
    own = urls.select(F.struct(*carried).alias("row"), "url")
    split = own.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    known = split.withColumn("found", rule(F.col("host"), F.col("path"), rules))
    if model is None:
        scored = known.withColumn("bad", F.lit(None).cast("double"))
    else:
        ready = with_shares(with_features(known), shares)
        ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(ready)
        scored = model.transform(ready).withColumn("bad", vector_to_array("probability")[1])
    guessed = F.when(F.col("bad") >= 0.5, "block").otherwise("allow")
    return scored.select(
        "row.*", "host", "path", F.col("found.rule").alias("rule"), "bad", F.coalesce("found.verdict", guessed).alias("verdict")
    )
