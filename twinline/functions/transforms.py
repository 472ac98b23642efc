"""Pair transforms. Each takes and returns the two sides as Columns."""

from __future__ import annotations

from collections.abc import Iterable
from html.entities import html5

from pyspark.sql import Column, functions as F

from twinline.functions import chars

Pair = tuple[Column, Column]

# Mark pairs counted together (an odd total drops both) and bracket kinds that must balance.
TWO_SIDED_QUOTES = ("“”", "«»")
BRACKETS = ("[]", "()", "{}")
# Fixed value: what stands for a number that is no character.
REPLACEMENT = "\ufffd"


def _occurrences(text: Column, marks: str) -> Column:
    return F.length(text) - F.length(F.translate(text, marks, ""))


def _drop_unpaired(text: Column) -> Column:
    odd = [F.when(_occurrences(text, q) % 2 != 0, q).otherwise("") for q in TWO_SIDED_QUOTES]
    uneven = [
        F.when(_occurrences(text, b[0]) != _occurrences(text, b[1]), b).otherwise("") for b in BRACKETS
    ]
    doomed = F.concat(*odd, *uneven)
    # The plain quote is the one case that loses a single mark, the first. No other removal touches it.
    one_quote_less = F.when(
        _occurrences(text, '"') % 2 != 0, F.regexp_replace(text, r'(?s)^([^"]*)"', F.lit("$1"))
    ).otherwise(text)
    cleaned = F.call_function("translate", one_quote_less, doomed, F.lit(""))
    # Most lines carry none of these marks; one scan settles them.
    return F.when(text.rlike(r'[“”«»"\[\](){}]'), cleaned).otherwise(text)


def remove_unpaired_quotes_and_brackets(src: Column, tgt: Column) -> Pair:
    """Drop odd quotes and every bracket kind whose opening and closing counts differ."""
    return _drop_unpaired(src), _drop_unpaired(tgt)


def remove_chars(src: Column, tgt: Column, chars: Iterable[str] = ()) -> Pair:
    """Delete each listed string in turn; a plain string is a list of its characters."""
    pieces = [piece for piece in chars if piece]
    if all(len(piece) == 1 for piece in pieces):
        return F.translate(src, "".join(pieces), ""), F.translate(tgt, "".join(pieces), "")
    for piece in pieces:
        src, tgt = (F.replace(side, F.lit(piece), F.lit("")) for side in (src, tgt))
    return src, tgt


def first_case_normalize(src: Column, tgt: Column, one_letter: bool = False) -> Pair:
    """Give the first letter of ``tgt`` the case of the first letter of ``src``.

    Some letters have several as their capital (``ß``: ``SS``). With ``one_letter`` one letter stays one: it becomes the
    single capital of which it is the small letter (``ẞ``), or stays as it is where there is none.
    """
    first, rest = F.substring(tgt, 1, 1), F.right(tgt, F.length(tgt) - 1)
    raised_first, lowered_first = F.upper(first), F.lower(first)
    if one_letter:
        capitals = F.create_map(*[F.lit(c) for pair in chars.single_capitals().items() for c in pair])
        raised_first = F.coalesce(F.try_element_at(capitals, first), raised_first)
        lowered_first = F.substring(lowered_first, 1, 1)
    both_letters = chars.starts_with_class(src, chars.alpha()) & chars.starts_with_class(tgt, chars.alpha())
    raised = chars.starts_with_class(src, chars.upper()) & ~chars.starts_with_class(tgt, chars.upper())
    lowered = chars.starts_with_class(src, chars.lower()) & ~chars.starts_with_class(tgt, chars.lower())
    fixed = (
        F.when(both_letters & raised, F.concat(raised_first, rest))
        .when(both_letters & lowered, F.concat(lowered_first, rest))
        .otherwise(tgt)
    )
    return src, fixed


def _named_references() -> Column:
    """The standard's names, each with its semicolon, in one map per first letter: a look-up walks one letter's names."""
    by_letter: dict[str, list[str]] = {}
    for name, characters in html5.items():
        if name.endswith(";"):
            by_letter.setdefault(name[0], []).append(f"{name}\x1f{characters}")
    maps = [
        (F.lit(letter), F.str_to_map(F.lit("\x1e".join(names)), F.lit("\x1e"), F.lit("\x1f")))
        for letter, names in by_letter.items()
    ]
    return F.create_map(*[part for pair in maps for part in pair])


def _named(piece: Column, names: Column) -> Column:
    """``piece`` follows an ampersand. Old names also count without a semicolon, the longest that fits."""

    def characters(name: Column) -> Column:
        return F.try_element_at(F.try_element_at(names, F.left(name, F.lit(1))), name)

    old = sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True)
    whole, short = F.regexp_extract(piece, "^[A-Za-z0-9]{1,32};", 0), F.regexp_extract(piece, f"^(?:{'|'.join(old)})", 0)
    return F.coalesce(
        F.concat(characters(whole), F.substr(piece, F.length(whole) + 1)),
        F.concat(characters(F.concat(short, F.lit(";"))), F.substr(piece, F.length(short) + 1)),
        F.concat(F.lit("&"), piece),
    )


def _numeric(piece: Column) -> Column:
    """``piece`` follows an ampersand and starts with a number sign."""
    whole = F.regexp_extract(piece, "^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", 0)
    digits, base = F.regexp_extract(whole, "^#[xX]?0*([0-9a-fA-F]*)", 1), F.lower(F.substring(whole, 2, 1))
    in_range = F.length(digits) <= 8
    code = F.when(in_range & (base == "x"), F.conv(digits, 16, 10)).when(in_range, F.conv(digits, 10, 10))
    number = F.when(digits == "", 0).otherwise(F.coalesce(code.cast("bigint"), F.lit(0x110000)))
    # a byte order mark ahead keeps U+FEFF from being read as one
    units = F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(F.hex(number), 8, "0")))
    character = F.decode(units, "UTF-32")
    # Numbers of the C1 range mean the bytes of Windows-1252, where it has a character for them.
    c1 = [chr(byte) for byte in range(0x80, 0xA0)]
    windows = [bytes([ord(c)]).decode("cp1252", "replace").replace(REPLACEMENT, c) for c in c1]
    without_character = (
        (number.between(1, 0x1F) & ~number.isin(0x9, 0xA, 0xC, 0xD))
        | (number == 0x7F)
        | number.between(0xFDD0, 0xFDEF)
        | (number % 0x10000 >= 0xFFFE)
    )
    read = (
        F.when((number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF), REPLACEMENT)
        .when(number.between(0x80, 0x9F), F.translate(character, "".join(c1), "".join(windows)))
        .when(without_character, "")
        .otherwise(character)
    )
    return F.when(whole == "", F.concat(F.lit("&"), piece)).otherwise(
        F.concat(read, F.substr(piece, F.length(whole) + 1))
    )


def recode_html_escape_chars(src: Column, tgt: Column) -> Pair:
    """Replace HTML character references, as HTML 5 reads them in text: numbers, names, old names without a semicolon.

    A text is split at its ampersands; only what follows one can hold a reference. What is not one stays as it is.
    """
    names = _named_references()

    def reference(piece: Column, place: Column) -> Column:
        read = F.when(piece.startswith("#"), _numeric(piece)).otherwise(_named(piece, names))
        return F.when(place == 0, piece).otherwise(read)

    def recode(side: Column) -> Column:
        pieces = F.transform(F.split(side, "&", -1), reference)
        return F.when(side.contains("&"), F.array_join(pieces, "")).otherwise(side)

    return recode(src), recode(tgt)
