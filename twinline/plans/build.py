"""The whole build: read corpora, clean, merge, deduplicate, split, export, remember what was built."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession, Window, functions as F

from twinline.operators import merge, selection
from twinline.operators.chain import observed_preprocess
from twinline.operators.mix import weighted_mix
from twinline.plans.config import CATALOGUE_PREFIX, FOLDER_PREFIX, Plan, manifest
from twinline.sources import catalogue as catalogues
from twinline.sources import scratch, text
from twinline.sources.scratch import materialize

# Name and weight of the merged training pairs in the mix, and lines that are numbered together.
MERGED, MERGED_WEIGHT = "(merged)", 1
BLOCK = 1 << 14


@dataclass(frozen=True)
class Built:
    """Tables of a finished build."""

    pairs: DataFrame  # distinct pairs with ``split``
    stats: DataFrame  # lines added per corpus and split sizes
    weighted: DataFrame | None  # weighted corpora as they are
    rejections: DataFrame | None = None  # pairs that filters removed, by corpus and filter, with a total of null ``reason``


def corpus_folder(plan: Plan, name: str, folders: Mapping[str, str], listing: DataFrame | None = None) -> str:
    """Folder of a corpus: a local address, one given in ``folders``, or one named in a catalogue."""
    if name in folders:
        return folders[name]
    if name.lower().startswith(FOLDER_PREFIX):
        return name[len(FOLDER_PREFIX) :]
    if name.lower().startswith(CATALOGUE_PREFIX) and listing is not None:
        corpus = name[len(CATALOGUE_PREFIX) :]
        return catalogues.resolve_corpus(listing, corpus, plan.src_lang, plan.tgt_lang)
    raise LookupError(f"no folder known for {name!r}")


def corpus_files(spark: SparkSession, plan: Plan, folder: str) -> Row:
    """The two files of a folder, exchanged where a reversed build asks for it.

    Files found by their language ending already are on the right side.
    """
    [files] = catalogues.discover_corpora(spark, folder, plan.src_lang, plan.tgt_lang).collect()
    if plan.reverse and not (files["src_by_lang"] or files["tgt_by_lang"]):
        return Row(src_path=files["tgt_path"], tgt_path=files["src_path"])
    return Row(src_path=files["src_path"], tgt_path=files["tgt_path"])


def read_corpora(
    spark: SparkSession, plan: Plan, folders: Mapping[str, str] | None = None, listing: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Raw pairs of every corpus with ``source, source_ord, line_no, n_lines``."""
    return {
        c.name: text.read_parallel(
            spark, *corpus_files(spark, plan, corpus_folder(plan, c.name, folders or {}, listing))
        ).withColumns({"source": F.lit(c.name), "source_ord": F.lit(c.source_ord)})
        for c in plan.corpora
    }


def build_corpus(
    spark: SparkSession,
    plan: Plan,
    corpora: Mapping[str, DataFrame],
    seed: int | str = 0,
    max_eval: int = merge.MAX_VALIDATION,
    remove_duplicates: bool = True,
    evaluation: DataFrame | None = None,
) -> Built:
    """Merge, deduplicate and split. The merged corpus is written once; everything else reads that table.

    With only weighted corpora there is nothing to merge, and ``evaluation`` pairs are the validation set.
    """
    weighted = [corpora[name] for name in plan.weights]
    as_they_are = weighted[0] if weighted else None
    for frame in weighted[1:]:
        as_they_are = as_they_are.unionByName(frame)
    if plan.all_weighted:
        if evaluation is None:
            raise ValueError("all corpora are weighted: an evaluation set is needed for validation")
        pairs = evaluation.withColumn("split", F.lit("val"))
        return Built(pairs, spark.createDataFrame([], "source string, added bigint"), as_they_are)

    watched = {c.name: observed_preprocess(corpora[c.name], c.chain) for c in plan.corpora if c.weight is None}
    merged = reduce(DataFrame.unionByName, [df for df, _ in watched.values()])
    added = materialize(merged.withColumn("key", selection.pair_key(seed)), "merged")
    removed = rejections(spark, {name: seen for name, (_, seen) in watched.items() if seen is not None})
    stats = merge.merge_stats(added, max_eval)
    if added.isEmpty():
        raise ValueError("no sources merged")
    size = stats.select("validation_size").first()[0]
    if remove_duplicates:
        pairs = merge.dedup_pairs(added)
        threshold = selection.nth_smallest_key(materialize(added.select("key").distinct(), "keys"), "key", size)
    else:
        unique = [F.col(c).cast("string") for c in merge.POSITION]
        pairs = added.withColumn("key", selection.pair_key(seed, "source", *unique))
        threshold = selection.nth_smallest_key(pairs, "key", size)
    split = F.when(F.col("key") <= F.lit(threshold), "val").otherwise("train")
    return Built(pairs.withColumn("split", split), stats, as_they_are, removed)


def sentence_sample(built: Built, plan: Plan, seed: int | str = 0) -> DataFrame:
    """Sentences for training a subword model: from both sides of the training and the weighted pairs."""
    columns = ["source", "line_no", "aug_ord", "src", "tgt"]
    parts = []
    if not plan.all_weighted:
        parts.append(built.pairs.filter("split = 'train'").select(*columns))
    if built.weighted is not None:
        parts.append(built.weighted.withColumn("aug_ord", F.lit(0)).select(*columns))
    pairs = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return selection.training_sample(pairs, columns[:3], plan.input_sentence_size, seed)


def renumbered(pairs: DataFrame) -> DataFrame:
    """``line_no`` and ``n_lines`` counted anew for each corpus, in the order of the lines that are left."""
    blocks = pairs.withColumn("block", F.floor(F.col("line_no") / BLOCK))
    whole = Window.partitionBy("source")
    earlier = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = blocks.groupBy("source", "block").agg(F.count("*").alias("n"))
    counts = counts.select(
        "source", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("n_lines")
    )
    rank = F.row_number().over(Window.partitionBy("source", "block").orderBy("line_no"))
    ranked = blocks.withColumn("rank", rank).drop("n_lines").join(counts, ["source", "block"])
    return ranked.withColumn("line_no", F.col("before") + F.col("rank")).drop("block", "rank", "before")


def mixed(built: Built, plan: Plan, seed: int | str = 0) -> DataFrame | None:
    """The training pairs in shuffled order and the weighted corpora, those of up to ``max_tokens``, mixed by weight until
    all are used up; None without weighted corpora. The merged pairs have the weight ``MERGED_WEIGHT``."""
    if built.weighted is None:
        return None
    columns = ["source", "source_ord", "line_no", "src", "tgt"]
    parts, weights = [built.weighted.select(*columns)], dict(plan.weights)
    if not plan.all_weighted:
        train = selection.shuffle_corpus(built.pairs.filter("split = 'train'"), seed, merge.POSITION)
        named = {"source": F.lit(MERGED), "source_ord": F.lit(-1), "line_no": F.col("position")}
        parts.append(train.withColumns(named).select(*columns))
        weights[MERGED] = MERGED_WEIGHT
    short = materialize(selection.max_tokens(reduce(DataFrame.unionByName, parts)), "short")
    return weighted_mix(materialize(renumbered(short), "numbered"), weights)


def rejections(spark: SparkSession, seen: Mapping[str, Observation]) -> DataFrame | None:
    """``source, reason, removed`` as ``rejection_report`` has them, from what the writing job observed; None if no corpus has filters."""
    if not seen:
        return None
    rows = []
    for name, observation in seen.items():
        counts = {reason: n for reason, n in observation.get.items() if n}
        rows += [(name, reason, n) for reason, n in counts.items()]
        rows += [(name, None, sum(counts.values()))] if counts else []
    return spark.createDataFrame(rows, "source string, reason string, removed bigint")


def export(built: Built, path: str) -> None:
    """Aligned text files of both splits in shuffled (key) order. An evaluation set keeps the order of its lines."""
    order = ["key", *merge.POSITION] if "key" in built.pairs.columns else ["line_no"]
    text.write_parallel(built.pairs, path, order, split=F.col("split"))


def export_rest(built: Built, plan: Plan, path: str, seed: int | str = 0) -> None:
    """Beside the splits: the mix (``file=src-mix``, ``file=tgt-mix``), the sentence sample and, as JSON, added lines with
    split sizes and the rejections."""
    mix = mixed(built, plan, seed)
    if mix is not None:
        text.write_parallel(mix, path, ["position"], split="mix", mode="append")
    sentence_sample(built, plan, seed).select("text").write.text(f"{path}/file=sample")
    built.stats.write.json(f"{path}/file=stats")
    if built.rejections is not None:
        built.rejections.write.json(f"{path}/file=rejections")


def run(
    spark: SparkSession, plan: Plan, corpora: Mapping[str, DataFrame], out: str, state: str, operators: bool = False, **options
) -> bool:
    """Build and export unless the corpora are those of the last successful run; tells whether it ran.

    With ``operators``, a change of a corpus's filters, transforms, augmenters or weight counts as a change too.
    Everything is written beside ``out`` and takes its place when it is complete: a run that fails leaves the files of the
    one before. The fingerprint is stored after that, so a failed run is not mistaken for a finished one.
    """
    listed = manifest(spark, plan)
    current = merge.chain_fingerprint(listed) if operators else merge.source_fingerprint(listed, "name")
    [verdict] = merge.sources_changed(current, read_state(spark, state)).collect()
    if not verdict["changed"]:
        return False
    built = build_corpus(spark, plan, corpora, **options)
    staging = f"{out.rstrip('/')}.{uuid.uuid4().hex}"
    export(built, staging)
    export_rest(built, plan, staging, options.get("seed", 0))
    scratch.put_in_place(spark, staging, out)
    current.write.mode("overwrite").parquet(state)
    return True


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Stored fingerprint, empty before the first run."""
    schema = "fingerprint string"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
