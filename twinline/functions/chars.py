r"""Character classes that agree with Python's ``str`` predicates inside JVM regexes.

The JVM and Python ship different Unicode versions, so ``\p{L}`` and ``str.isalpha`` differ on
several thousand code points. Every class below is the JVM property (a table lookup per character)
plus Python's own ranges, consulted only for code points the JVM calls unassigned (``\p{Cn}``) or
puts in one of the few categories where the two definitions differ. Ordinary text therefore never
walks the long range list.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, functions as F


def _matching(predicate: Callable[[str], bool]) -> list[int]:
    surrogates = range(0xD800, 0xE000)
    return [cp for cp in range(sys.maxunicode + 1) if cp not in surrogates and predicate(chr(cp))]


def _ranges(code_points: list[int]) -> str:
    """Regex range list (without brackets) covering exactly these code points."""
    spans: list[list[int]] = []
    for cp in code_points:
        if spans and spans[-1][1] == cp - 1:
            spans[-1][1] = cp
        else:
            spans.append([cp, cp])
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in spans)


def _class(base: str, differing: str, predicate: Callable[[str], bool]) -> str:
    """``base`` plus the code points of ``differing`` categories for which ``predicate`` holds."""
    return rf"{base}[[{differing}]&&[{_ranges(_matching(predicate))}]]"


@cache
def alpha() -> str:
    """``str.isalpha`` as the inside of a regex character class."""
    return _class(r"\p{L}", r"\p{Cn}", str.isalpha)


@cache
def alnum() -> str:
    """``str.isalnum``."""
    return _class(r"\p{L}\p{N}", r"\p{Cn}", str.isalnum)


@cache
def upper() -> str:
    """``str.isupper`` of a single character."""
    return _class(r"\p{IsUppercase}", r"\p{Cn}", str.isupper)


@cache
def lower() -> str:
    """``str.islower`` of a single character."""
    return _class(r"\p{IsLowercase}", r"\p{Cn}\p{Lm}", str.islower)


@cache
def digit() -> str:
    """``str.isdigit``: decimal digits, superscripts, circled digits and the like."""
    return _class(r"\p{Nd}", r"\p{Cn}\p{No}", str.isdigit)


@cache
def nonzero_decimal() -> str:
    """Decimal digits whose value is not zero."""
    unassigned = _ranges(_matching(lambda c: c.isdecimal() and int(c) > 0))
    zeros = _ranges(_matching(lambda c: c.isdecimal() and int(c) == 0))
    return rf"[\p{{Nd}}&&[^{zeros}]][\p{{Cn}}&&[{unassigned}]]"


@cache
def blank() -> str:
    """``str.isspace``, the characters ``str.split`` and ``str.strip`` go by."""
    return _ranges(_matching(str.isspace))


@cache
def whitespace() -> str:
    """The characters ``str.strip`` removes, as a plain string."""
    return "".join(map(chr, _matching(str.isspace)))


@cache
def single_capitals() -> dict[str, str]:
    """Letters whose ``str.upper`` is several characters, with the one whose small letter they are, or else themselves."""
    long = _matching(lambda c: len(c.upper()) > 1)
    capital = {chr(cp).lower(): chr(cp) for cp in _matching(str.istitle)}
    return {chr(cp): capital.get(chr(cp), chr(cp)) for cp in long}


def strip(text: Column) -> Column:
    """``str.strip``: linear in the text, unlike an anchored regex over long inner blanks."""
    return F.trim(text, F.lit(whitespace()))


def count_in(text: Column, char_class: str) -> Column:
    """How many characters of ``text`` fall in ``char_class`` (the inside of a bracket)."""
    return F.length(F.regexp_replace(text, f"[^{char_class}]+", F.lit("")))


def starts_with_class(text: Column, char_class: str) -> Column:
    return text.rlike(f"^[{char_class}]")


def has_class(text: Column, char_class: str) -> Column:
    return text.rlike(f"[{char_class}]")


def in_bracket(characters: str) -> str:
    """User-given characters, safe inside a regex bracket."""
    return "".join(rf"\x{{{ord(c):X}}}" for c in characters)
