"""Line-aligned text files: numbered lines, corpora, evaluation sets, exports.

Lines end in LF only. The default reader also splits on CR, which would shift the pairing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from twinline.sources import languages

# Splits of the evaluation sets.
EVAL_SPLITS = ("dev", "devtest")


def _scan(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.option("lineSep", "\n").text(paths)


def _file_order() -> list[Column]:
    """Files by folder, then ``part-<n>`` files by number, as names of more than five digits sort wrongly, then by name."""
    folder = F.regexp_extract("file", r"^(.*/)", 1)
    number = F.regexp_extract("file", r"/part-(\d{1,18})[^/]*$", 1)
    return [folder, F.when(number != "", number.cast("bigint")).asc_nulls_first(), F.col("file")]


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``line_no, line, n_lines``: the 1-based position over all files of ``path``, part files by their number.

    The scan numbers its rows per partition; counting the rows of each file block and summing the
    counts of earlier blocks turns that into positions, without moving a line. Lines and counts come from two scans,
    which the planner packs alike; a line that does not lie in its block as counted is an error.
    """
    raw = _scan(spark, path).select(
        F.validate_utf8("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
    )
    blocks = raw.groupBy("file", "block").agg(F.min("id").alias("first_id"), F.count("*").alias("rows"))
    everything = Window.partitionBy()
    earlier = everything.orderBy(*_file_order(), "block").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.select(
        "file",
        "block",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        "first_id",
        "rows",
        F.sum("rows").over(everything).alias("n_lines"),
    )
    place = F.col("id") - F.col("first_id") + 1
    wrong = F.raise_error(F.concat(F.lit("lines and counts were packed differently in "), F.col("file"))).cast("bigint")
    line_no = F.col("before") + F.when(place.between(1, F.col("rows")), place).otherwise(wrong)
    return raw.join(placed, ["file", "block"]).select(line_no.alias("line_no"), "line", "n_lines")


def same_root(file: Column) -> Column:
    return F.regexp_replace(file, "^file:/+", "file:///")


def count_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file, lines`` for every file, also for empty ones; an unfinished last line counts."""
    scan = _scan(spark, path)
    counted = scan.groupBy(same_root(F.col("_metadata.file_path")).alias("file")).agg(F.count("*").alias("lines"))
    # the planner's own list of files: a scan leaves empty ones out
    listed = spark.createDataFrame([(f,) for f in scan.inputFiles()], "file string").select(same_root(F.col("file")).alias("file"))
    return listed.join(counted, "file", "left").select("file", F.coalesce("lines", F.lit(0)).alias("lines"))


def read_parallel(
    spark: SparkSession, src_path: str | Sequence[str], tgt_path: str | Sequence[str], strict: bool = True
) -> DataFrame:
    """``line_no, n_lines, src, tgt``: two files joined line by line.

    Surplus target lines are ignored. A target that ends early is an error when ``strict``; otherwise
    the corpus ends there. ``n_lines`` counts the source.
    """
    src = read_lines(spark, src_path).withColumnRenamed("line", "src")
    tgt = read_lines(spark, tgt_path).select("line_no", F.col("line").alias("tgt"))
    pairs = src.join(tgt, "line_no", "left" if strict else "inner")
    if strict:
        ended = F.concat(F.lit("the target ends before source line "), F.col("line_no").cast("string"))
        pairs = pairs.withColumn("tgt", F.coalesce("tgt", F.raise_error(ended).cast("string")))
    return pairs.select("line_no", "n_lines", "src", "tgt")


def read_eval_set(spark: SparkSession, root: str, lang: str, split: str) -> DataFrame:
    """``split, lang, line_no, text`` of one language of an aligned evaluation set."""
    if split not in EVAL_SPLITS:
        raise ValueError(f"split must be one of {EVAL_SPLITS}, not {split!r}")
    code = languages.codes().get(lang)
    if code is None:
        raise ValueError(f"no evaluation set for language {lang!r}")
    lines = read_lines(spark, f"{root}/{split}/{code}.{split}")
    return lines.select(
        F.lit(split).alias("split"), F.lit(lang).alias("lang"), "line_no", F.col("line").alias("text")
    )


def eval_pairs(eval_sets: DataFrame, src_lang: str, tgt_lang: str, split: str) -> DataFrame:
    """``line_no, src, tgt``: two languages of an evaluation table joined by line."""

    def side(lang: str, name: str) -> DataFrame:
        chosen = eval_sets.filter((F.col("lang") == lang) & (F.col("split") == split))
        return chosen.select("line_no", F.col("text").alias(name))

    return side(src_lang, "src").join(side(tgt_lang, "tgt"), "line_no")


def _one_line(text: Column) -> Column:
    broken = F.concat(F.lit("text with a line feed cannot be a line of a file: "), text)
    return F.when(text.contains("\n"), F.raise_error(broken).cast("string")).otherwise(text)


def write_parallel(
    pairs: DataFrame, path: str, order: Sequence[str], split: Column | str = "train", parts: int | None = None,
    mode: str = "error",
) -> None:
    """Export to ``path/file=src-<split>`` and ``path/file=tgt-<split>``; equally numbered part files align.

    Both lines of a pair carry the same ``order`` values, so a range partitioning on them keeps the two
    together, and one task writes the matching part of every file.
    """
    split = F.lit(split) if isinstance(split, str) else split
    sides = F.explode(
        F.array(
            *[
                F.struct(F.concat(F.lit(f"{side}-"), split).alias("file"), _one_line(F.col(side)).alias("value"))
                for side in ("src", "tgt")
            ]
        )
    )
    rows = pairs.select(*order, sides.alias("row")).select(*order, "row.file", "row.value")
    ranged = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    ranged.sortWithinPartitions("file", *order).select("file", "value").write.mode(mode).partitionBy("file").text(path)


def write_hypotheses(hypotheses: DataFrame, path: str, text: str = "hyp", order: Sequence[str] = ("line_no",)) -> None:
    """One translation per line, in order over the part files."""
    ranged = hypotheses.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.select(_one_line(F.col(text)).alias("value")).write.text(path)
