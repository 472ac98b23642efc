"""Pair filters. Each returns a boolean Column that is true when the pair must be removed."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from twinline.functions import chars

# Fixed value: the characters compared by default.
COMPARED_CHARACTERS = '()[]?!:"“”{}'


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def _outside(value: Column, low: float, high: float) -> Column:
    """Bounds themselves count as outside."""
    bounds = [value <= F.lit(low)]
    if not math.isinf(high):
        bounds.append(value >= F.lit(high))
    return _any(bounds)


def _share(count: Column, text: Column) -> Column:
    return F.try_divide(count.cast("double"), F.length(text).cast("double"))


def duplicates(src: Column, tgt: Column) -> Column:
    """Both sides are the same text."""
    return src == tgt


def char_length(src: Column, tgt: Column, min: float = 0, max: float = math.inf) -> Column:
    """A side is not strictly between ``min`` and ``max`` characters long."""
    return _outside(F.length(src), min, max) | _outside(F.length(tgt), min, max)


def source_target_ratio(src: Column, tgt: Column, min: float = 0, max: float = math.inf) -> Column:
    """``len(src) / len(tgt)`` is not strictly between ``min`` and ``max``."""
    ratio = _share(F.length(src), tgt)
    return F.coalesce(_outside(ratio, float(min), float(max)), F.lit(False))


def uppercase_count_mismatch(src: Column, tgt: Column) -> Column:
    """The sides have different numbers of uppercase letters."""
    return chars.count_in(src, chars.upper()) != chars.count_in(tgt, chars.upper())


def contains(src: Column, tgt: Column, words: Iterable[str] = ()) -> Column:
    """Either side contains one of the words (case-sensitive)."""
    return _any(side.contains(F.lit(word)) for word in words for side in (src, tgt))


def digits_ratio(src: Column, tgt: Column, max: float = 0.4) -> Column:
    """The share of digits reaches ``max`` on either side."""
    return _any(
        F.coalesce(_share(chars.count_in(side, chars.digit()), side) >= F.lit(float(max)), F.lit(False))
        for side in (src, tgt)
    )


def _symbols(side: Column) -> Column:
    """Number of characters that are neither alphanumeric nor U+0020."""
    return F.length(F.regexp_replace(side, f"[ {chars.alnum()}]+", F.lit("")))


def nonalphanum_ratio(src: Column, tgt: Column, max: float = 0.4) -> Column:
    """The share of symbols, blanks counting in the length only, reaches ``max`` on either side."""
    return _any(
        F.coalesce(_share(_symbols(side), side) >= F.lit(float(max)), F.lit(False)) for side in (src, tgt)
    )


def digits_mismatch(src: Column, tgt: Column) -> Column:
    """Exactly one side has a digit other than zero."""
    nonzero = chars.nonzero_decimal()
    return chars.has_class(src, nonzero) != chars.has_class(tgt, nonzero)


def nonalphanum_count_mismatch(src: Column, tgt: Column) -> Column:
    """The sides have different numbers of symbols."""
    return _symbols(src) != _symbols(tgt)


def characters_count_mismatch(src: Column, tgt: Column, chars: Sequence[str] = COMPARED_CHARACTERS) -> Column:
    """Some listed character does not occur equally often on both sides."""
    if all(len(ch) == 1 for ch in chars):
        return _bag(src, chars) != _bag(tgt, chars) if chars else F.lit(False)
    return _any(_occurrences(src, ch) != _occurrences(tgt, ch) for ch in chars)


def _bag(side: Column, listed: Sequence[str]) -> Column:
    """The listed characters of a text in sorted order: equal bags mean equal counts."""
    kept = F.regexp_replace(side, f"[^{chars.in_bracket(''.join(listed))}]+", F.lit(""))
    return F.array_sort(F.split(kept, ""))


def _occurrences(side: Column, piece: str) -> Column:
    if not piece:
        return F.length(side) + 1
    return (F.length(side) - F.length(F.replace(side, F.lit(piece), F.lit("")))) / F.lit(len(piece))


def first_char_mismatch(src: Column, tgt: Column) -> Column:
    """First letters differ in case, only one side starts with a letter, or first symbols differ."""
    src_letter = chars.starts_with_class(src, chars.alpha())
    tgt_letter = chars.starts_with_class(tgt, chars.alpha())
    return (
        F.when((F.length(src) == 0) | (F.length(tgt) == 0), False)
        .when(src_letter != tgt_letter, True)
        .when(
            src_letter,
            chars.starts_with_class(src, chars.upper()) != chars.starts_with_class(tgt, chars.upper()),
        )
        .otherwise(F.substring(src, 1, 1) != F.substring(tgt, 1, 1))
    )


def limit_latin_chars(src: Column, tgt: Column, s_chset: str, t_chset: str, max: int = 12) -> Column:
    """More than ``max`` basic Latin letters on the first side not written in Latin script."""
    for side, script in ((src, s_chset), (tgt, t_chset)):
        if script != "Latn":
            return chars.count_in(side, "A-Za-z") > F.lit(max)
    return F.lit(False)
