"""Finding corpora: in a folder tree, or by name in a catalogue table."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from twinline.sources import text


def discover_corpora(spark: SparkSession, root: str, src_lang: str, tgt_lang: str, strict: bool = True) -> DataFrame:
    """``folder, src_path, tgt_path, src_by_lang, tgt_by_lang`` for every folder that ``root`` names and that holds files.

    ``root`` is a folder or a pattern such as ``corpora/*``. Files right in a folder count, folders inside it do not.
    A file is the target if its name contains "target" or ends in ``.<tgt_lang>``, the source likewise.
    A missing or doubled side is an error when ``strict``, else the folder's paths are null. The
    ``by_lang`` flags tell sides found by their ending. Only file names are read, so empty files count too.
    """
    # the planner's own list of files, as a scan leaves empty ones out; it has encoded names
    listed = [(unquote(file),) for file in spark.read.format("binaryFile").load(root).inputFiles()]
    files = spark.createDataFrame(listed, "path string").select(text.same_root(F.col("path")).alias("path"))
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    folder = F.regexp_replace("path", "/[^/]*$", F.lit(""))

    def side(word: str, lang: str) -> tuple[Column, Column]:
        by_word, by_lang = name.contains(word), name.endswith(f".{lang.lower()}")
        return by_word | by_lang, ~by_word & by_lang

    is_src, src_by_lang = side("source", src_lang)
    is_tgt, tgt_by_lang = side("target", tgt_lang)
    marked = files.select(
        "path",
        folder.alias("folder"),
        is_src.alias("is_src"),
        is_tgt.alias("is_tgt"),
        src_by_lang.alias("src_lang_hit"),
        tgt_by_lang.alias("tgt_lang_hit"),
    )
    found = marked.groupBy("folder").agg(
        F.max(F.when(F.col("is_src"), F.col("path"))).alias("src_path"),
        F.max(F.when(F.col("is_tgt"), F.col("path"))).alias("tgt_path"),
        F.count_if("is_src").alias("n_src"),
        F.count_if("is_tgt").alias("n_tgt"),
        F.coalesce(F.bool_or(F.when(F.col("is_src"), F.col("src_lang_hit"))), F.lit(False)).alias("src_by_lang"),
        F.coalesce(F.bool_or(F.when(F.col("is_tgt"), F.col("tgt_lang_hit"))), F.lit(False)).alias("tgt_by_lang"),
    )
    sound = (F.col("n_src") == 1) & (F.col("n_tgt") == 1)
    message = F.concat(F.lit("needs exactly one source and one target file: "), F.col("folder"))
    refused = F.raise_error(message).cast("string") if strict else F.lit(None).cast("string")
    return found.select(
        "folder",
        *[F.when(sound, F.col(p)).otherwise(refused).alias(p) for p in ("src_path", "tgt_path")],
        "src_by_lang",
        "tgt_by_lang",
    )


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """``pos, corpus, src_lang, tgt_lang, url`` from tab-separated lines of the last four, in the order of the file."""
    lines = text.read_lines(spark, path).filter(F.trim("line") != "")
    fields = F.split("line", "\t", -1)
    wrong = F.raise_error(F.concat(F.lit("not four fields in catalogue line "), F.col("line_no").cast("string")))
    checked = lines.select(F.col("line_no").alias("pos"), F.when(F.size(fields) == 4, fields).otherwise(wrong.cast("array<string>")).alias("f"))
    return checked.select("pos", *[F.trim(F.col("f")[n]).alias(c) for n, c in enumerate(("corpus", "src_lang", "tgt_lang", "url"))])


def resolve_corpora(catalogue: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """``corpus, src_lang, tgt_lang, url, matches``: the first entry of each corpus and language pair.

    ``catalogue`` has ``pos, corpus, src_lang, tgt_lang, url``; ``wanted`` limits the lookup to its
    ``corpus, src_lang, tgt_lang`` rows. Names are case-sensitive.
    """
    keys = ["corpus", "src_lang", "tgt_lang"]
    if wanted is not None:
        catalogue = catalogue.join(wanted.select(*keys).distinct(), keys, "left_semi")
    return catalogue.groupBy(*keys).agg(F.min_by("url", "pos").alias("url"), F.count("*").alias("matches"))


def resolve_corpus(catalogue: DataFrame, name: str, src_lang: str, tgt_lang: str) -> str:
    """URL of one corpus; unknown names are an error."""
    chosen = catalogue.filter(
        (F.col("corpus") == name) & (F.col("src_lang") == src_lang) & (F.col("tgt_lang") == tgt_lang)
    )
    row = resolve_corpora(chosen).head()
    if row is None:
        raise LookupError(f"no corpus {name} ({src_lang}-{tgt_lang})")
    if row["matches"] > 1:
        print(f"{row['matches']} entries for {name} ({src_lang}-{tgt_lang}), using the first")
    return row["url"]
