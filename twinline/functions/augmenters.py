"""Pair augmenters. Each returns an array Column of extra ``struct<src,tgt>`` pairs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from twinline.functions import chars as classes

PAIRS = "array<struct<src:string,tgt:string>>"


def _pair(src: Column, tgt: Column) -> Column:
    return F.struct(src.alias("src"), tgt.alias("tgt"))


def _no_pairs() -> Column:
    return F.array().cast(PAIRS)


def single_word_punctuation(src: Column, tgt: Column, chars: str = "?!.") -> Column:
    """For single words: the pair without its common final mark, or one pair per mark added."""
    single = ~src.contains(" ") & ~tgt.contains(" ") & (F.length(src) > 0) & (F.length(tgt) > 0)
    src_last, tgt_last = F.right(src, F.lit(1)), F.right(tgt, F.lit(1))
    marks = list(chars)

    def shortened(side: Column) -> Column:
        return F.left(side, F.length(side) - 1)

    removed = [F.when((src_last == ch) & (tgt_last == ch), _pair(shortened(src), shortened(tgt))) for ch in marks]
    bare = (
        src.rlike(rf"[{classes.alnum()}]\z")
        & ~src_last.isin(marks)
        & ~tgt_last.isin(marks)
    )
    added = [F.when(bare, _pair(F.concat(src, F.lit(ch)), F.concat(tgt, F.lit(ch)))) for ch in marks]
    if not marks:
        return _no_pairs()
    return F.when(single, F.array_compact(F.array(*removed, *added))).otherwise(_no_pairs())


def lowercase(src: Column, tgt: Column) -> Column:
    """The lowercased pair, when lowercasing changes both sides."""
    low_src, low_tgt = F.lower(src), F.lower(tgt)
    return F.when((low_src != src) & (low_tgt != tgt), F.array(_pair(low_src, low_tgt))).otherwise(_no_pairs())
