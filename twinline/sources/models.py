"""Subword model files: merge lists and vocabularies, from lines with their line numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from twinline.functions import chars
from twinline.operators.chain import with_computed

# Header of a merge list, its version when there is none, special vocabulary tokens.
VERSION_HEADER = "#version:"
DEFAULT_VERSION = (0, 1)
SPECIAL_TOKENS = ("<unk>", "<s>", "</s>")
LINE_EDGE = "\r\n "

# Beyond this a count would not fit 64 bits (a log-probability is at most 0 anyway).
LARGEST_LOGPROB = 29.0


def _fields(line: Column) -> Column:
    return F.split(F.trim(line, F.lit(LINE_EDGE)), " ", -1)


def _two_fields(line: Column, what: str) -> Column:
    fields = _fields(line)
    broken = F.concat(F.lit(f"{what} needs exactly two blank-separated fields: "), line)
    return F.when(F.size(fields) == 2, fields).otherwise(F.raise_error(broken).cast("array<string>"))


def bpe_version(lines: DataFrame) -> tuple[int, int]:
    """Version in the first line of a merge list. ``lines`` has ``line_no, line``."""
    first = lines.filter(F.col("line_no") == 1).select("line").head()
    if first is None or not first["line"].startswith(VERSION_HEADER):
        return DEFAULT_VERSION
    numbers = [int(part) for part in first["line"].split()[-1].split(".")]
    while len(numbers) > 1 and numbers[-1] == 0:
        numbers.pop()
    return tuple(numbers)


def read_bpe_codes(lines: DataFrame, merges: int = -1) -> DataFrame:
    """``rank, left, right`` from ``line_no, line``: the first ``merges`` lines, first use of a pair counts."""
    header = lines.filter((F.col("line_no") == 1) & F.col("line").startswith(VERSION_HEADER))
    skipped = header.agg(F.count("*").alias("skipped")).scalar()
    ranked = lines.withColumn("rank", F.col("line_no") - 1 - skipped).filter("rank >= 0")
    if merges != -1:
        ranked = ranked.filter(F.col("rank") < merges)
    pair = ranked.select("rank", _two_fields(F.col("line"), "a merge").alias("pair"))
    named = pair.select("rank", F.col("pair")[0].alias("left"), F.col("pair")[1].alias("right"))
    return named.groupBy("left", "right").agg(F.min("rank").alias("rank")).select("rank", "left", "right")


def read_bpe_vocab(lines: DataFrame, threshold: int | None = None) -> DataFrame:
    """``token, freq`` from ``token freq`` lines with at least the threshold frequency."""
    pair = lines.select(_two_fields(F.col("line"), "a vocabulary entry").alias("pair"))
    vocab = pair.select(F.col("pair")[0].alias("token"), F.col("pair")[1].cast("bigint").alias("freq"))
    return vocab if threshold is None else vocab.filter(F.col("freq") >= threshold)


def vocab_to_counts(lines: DataFrame) -> DataFrame:
    """``token, freq`` from ``token logprob`` lines; anything that is not such an entry is skipped."""
    blank = f"[{chars.blank()}]+"
    parts = F.split(F.ltrim(F.col("line"), F.lit(chars.whitespace())), blank, 2)
    fields = with_computed(lines.select("line"), parts=parts).filter(F.size("parts") == 2)
    number = chars.strip(F.col("parts")[1])
    # Fixed value: the written forms of a number that count.
    is_number = number.rlike(r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$|^[-+]?(?i:inf|infinity)$")
    valued = with_computed(
        fields, token=F.col("parts")[0], logprob=F.when(is_number, number.try_cast("double"))
    ).filter(F.col("logprob").isNotNull() & ~F.col("token").isin(*SPECIAL_TOKENS))
    too_large = F.raise_error(F.concat(F.lit("the count does not fit a long: "), F.col("token"))).cast("bigint")
    count = (F.floor(F.exp("logprob") * 1_000_000) + 1).cast("bigint")
    return valued.select("token", F.when(F.col("logprob") >= LARGEST_LOGPROB, too_large).otherwise(count).alias("freq"))
