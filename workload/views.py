"""Inputs of the registered queries, derived from whole test tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from twinline.operators import numbering
from twinline.operators.chain import drop_empty, strip_pair
from twinline.operators.registry import Op
from twinline.operators.selection import tokens
from twinline.sources import models
from twinline.sources.scratch import materialize
from twinline.sources.tables import BLOCK_BITS, document_pairs, load, numbered_document_pairs, pair_count

KEY = ("source", "doc_id", "pair_no")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents")


def raw_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return document_pairs(documents(spark, sf))


def clean_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return drop_empty(strip_pair(raw_pairs(spark, sf)))


def numbered_pairs(spark: SparkSession, sf: str, cuts: Sequence[Op] = ()) -> DataFrame:
    return numbered_document_pairs(documents(spark, sf), cuts)


def marked_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Numbered pairs with marks the documents lack, by line number."""
    src, tgt = F.col("src"), F.col("tgt")
    kind = F.col("line_no") % 7
    marked = (
        F.when(kind == 1, F.concat(F.lit("("), src))
        .when(kind == 2, F.concat(src, F.lit('"')))
        .when(kind == 3, F.concat(F.lit("["), src, F.lit("]")))
        .when(kind == 4, F.concat(F.lit("“"), src))
        .when(kind == 5, _first_word(src))
        .when(kind == 6, F.concat(src, F.lit("?")))
        .otherwise(src)
    )
    return numbered_pairs(spark, sf).withColumns({"src": marked, "tgt": F.when(kind == 5, _first_word(tgt)).otherwise(tgt)})


def _first_word(text: Column) -> Column:
    return F.substring_index(text, " ", 1)


def conversation_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Each user turn with the turn after it: another corpus, in a table of its own."""
    turns = load(spark, sf, "conversations")
    asked = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("src"))
    answers = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("tgt")
    )
    return asked.join(answers, ["conv_id", "turn"]).select(
        F.lit("conv").alias("source"),
        F.lit(1000).alias("source_ord"),
        F.col("conv_id").alias("doc_id"),
        F.col("turn").cast("int").alias("pair_no"),
        "src",
        "tgt",
    )


def html_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "pages").select("page_id", F.col("html").alias("src"), F.col("url").alias("tgt"))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs as hypothesis and reference, under one key."""
    pair_id = F.shiftleft(F.col("doc_id"), 24) + F.col("pair_no")
    return raw_pairs(spark, sf).select(pair_id.alias("id"), F.col("src").alias("hyp"), F.col("tgt").alias("ref"))


def eval_sets(spark: SparkSession, sf: str) -> DataFrame:
    """The benchmark as an evaluation set in two languages, one line per item."""
    items = load(spark, sf, "benchmark")
    text = F.translate("text", "\n", " ")
    lines = {"en": text, "it": F.upper(text)}
    both = F.explode(F.array(*[F.struct(F.lit(k).alias("lang"), v.alias("text")) for k, v in lines.items()]))
    rows = items.select(F.col("item_id"), both.alias("side"))
    return rows.select(
        F.lit("devtest").alias("split"), "side.lang", (F.col("item_id") + 1).alias("line_no"), "side.text"
    )


def word_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``line_no, line``: the first words of both sides of every pair, as a two-field file."""
    docs = documents(spark, sf).withColumn("corpus", F.lit("all"))
    offsets = numbering.unit_offsets(
        docs, "corpus", "doc_id", F.shiftright(F.col("doc_id"), BLOCK_BITS), pair_count(F.col("text"))
    )
    words = [F.coalesce(F.nullif(_first_word(F.col(side)), F.lit("")), F.lit("_")) for side in ("src", "tgt")]
    return raw_pairs(spark, sf).join(offsets.select("doc_id", "lines_before"), "doc_id").select(
        (F.col("lines_before") + F.col("pair_no")).alias("line_no"), F.concat_ws(" ", *words).alias("line")
    )


def word_counts(spark: SparkSession, sf: str) -> DataFrame:
    words = documents(spark, sf).select(F.explode(F.split("text", "[ \n]", -1)).alias("word")).filter("word <> ''")
    return words.groupBy("word").agg(F.count("*").alias("freq"))


def count_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``word count`` lines of a vocabulary file."""
    return word_counts(spark, sf).select(F.concat_ws(" ", "word", F.col("freq").cast("string")).alias("line"))


def logprob_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``word logprob`` lines, blanks as separators, with entries a reader must skip."""
    counts = word_counts(spark, sf)
    total = counts.agg(F.sum("freq")).scalar()
    logprob = F.log(F.col("freq") / total).cast("decimal(12,4)").cast("string")
    written = F.when(F.col("freq") == 7, "many").otherwise(logprob)
    line = F.when(F.col("freq") == 8, F.col("word")).otherwise(F.concat(F.col("word"), F.lit(" \t"), written))
    return counts.select(line.alias("line"))


# Size of the model derived below: the number of merges is a setting of a model, not a cut of the data.
MODEL_MERGES = 2000


def merges(spark: SparkSession, sf: str) -> DataFrame:
    """``rank, left, right``: words of the benchmark built up letter by letter, frequent steps first."""
    text = load(spark, sf, "benchmark").select(F.explode(F.split("text", "[ \n]", -1)).alias("word"))
    counts = text.filter("word <> ''").groupBy("word").agg(F.count("*").alias("freq"))
    steps = counts.select(
        "freq",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.length("word")),
                lambda i: F.struct(
                    F.substring(F.col("word"), F.lit(1), i).alias("left"),
                    F.when(i == F.length("word"), "</w>")
                    .otherwise(F.substring(F.col("word"), i + 1, F.lit(1)))
                    .alias("right"),
                ),
            )
        ).alias("step"),
    )
    weighed = steps.groupBy("step.left", "step.right").agg(F.sum("freq").alias("weight"))
    chosen = weighed.orderBy(F.desc("weight"), "left", "right").limit(MODEL_MERGES)
    rank = F.row_number().over(Window.orderBy(F.desc("weight"), "left", "right")) - 1
    return chosen.select(rank.cast("bigint").alias("rank"), "left", "right")


def merge_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The merges as a file with a version header."""
    listed = merges(spark, sf).select(
        (F.col("rank") + 2).alias("line_no"), F.concat_ws(" ", "left", "right").alias("line")
    )
    header = spark.createDataFrame([(1, f"{models.VERSION_HEADER} 0.1")], "line_no bigint, line string")
    return materialize(header.unionByName(listed), "merges")


def model_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """``token, freq`` of frequent words and frequent beginnings of words, from ``token freq`` lines."""
    # words and beginnings in one pass: as separate branches each would read and count all texts again
    starts = [F.when(F.length("word") > n, F.concat(F.left("word", F.lit(n)), F.lit("@@"))) for n in (1, 2, 3)]
    forms = F.explode(F.array("word", *starts)).alias("word")
    tokens = word_counts(spark, sf).select(forms, "freq").filter("word IS NOT NULL").groupBy("word").agg(F.sum("freq").alias("freq"))
    lines = tokens.select(F.concat_ws(" ", "word", F.col("freq").cast("string")).alias("line"))
    return models.read_bpe_vocab(lines, threshold=20)


def piece_tokens(text: Column) -> Column:
    """Words cut after four letters, in subword notation."""
    return tokens(F.regexp_replace(text, r"(\p{L}{4})(\p{L})", F.lit("$1@@ $2")))


def catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """A corpus catalogue from page addresses: host as corpus name, first path element as language."""
    return load(spark, sf, "pages").select(
        F.col("page_id").alias("pos"),
        F.regexp_extract("url", r"^https?://([^/]+)/", 1).alias("corpus"),
        F.lit("en").alias("src_lang"),
        F.regexp_extract("url", r"^https?://[^/]+/([a-z]+)/", 1).alias("tgt_lang"),
        "url",
    )
