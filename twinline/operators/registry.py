"""Named operators: the built-in ones and those users register.

An operator is written ``"name"`` or ``{"name": {argument: value}}``. Names and arguments are checked
while the plan is built, so a misspelt configuration fails before any data is read.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from twinline.functions import augmenters, filters, transforms

Spec = str | Mapping[str, Mapping[str, Any]]


def top(percent: float) -> None:
    """Keep the first ``percent`` of a corpus (a cut by line number, not a predicate)."""


def excerpt(top_percentile: float, bottom_percentile: float) -> None:
    """Keep the lines between two percentiles of a corpus (a cut by line number)."""


CUTS: dict[str, Callable] = {"excerpt": excerpt, "top": top}
FILTERS: dict[str, Callable] = {
    f.__name__: f
    for f in (
        filters.duplicates,
        filters.char_length,
        filters.source_target_ratio,
        filters.uppercase_count_mismatch,
        filters.contains,
        filters.digits_ratio,
        filters.nonalphanum_ratio,
        filters.digits_mismatch,
        filters.nonalphanum_count_mismatch,
        filters.characters_count_mismatch,
        filters.first_char_mismatch,
        filters.limit_latin_chars,
    )
}
TRANSFORMS: dict[str, Callable] = {
    f.__name__: f
    for f in (
        transforms.remove_unpaired_quotes_and_brackets,
        transforms.remove_chars,
        transforms.first_case_normalize,
        transforms.recode_html_escape_chars,
    )
}
AUGMENTERS: dict[str, Callable] = {f.__name__: f for f in (augmenters.single_word_punctuation, augmenters.lowercase)}


@dataclass(frozen=True)
class Op:
    """One operator with its arguments."""

    name: str
    args: Mapping[str, Any]
    build: Callable = field(compare=False)


@dataclass(frozen=True)
class Chain:
    """What is done to the pairs of one corpus."""

    cuts: tuple[Op, ...] = ()
    filters: tuple[Op, ...] = ()
    transforms: tuple[Op, ...] = ()
    augmenters: tuple[Op, ...] = ()


def register_filter(name: str, build: Callable) -> None:
    """``build(src, tgt, **arguments) -> Column``, true where the pair is removed."""
    FILTERS[name] = build


def register_transform(name: str, build: Callable) -> None:
    """``build(src, tgt, **arguments) -> (Column, Column)``."""
    TRANSFORMS[name] = build


def register_augmenter(name: str, build: Callable) -> None:
    """``build(src, tgt, **arguments) -> Column`` of ``array<struct<src,tgt>>``."""
    AUGMENTERS[name] = build


def name_and_args(spec: Spec) -> tuple[str, dict[str, Any]]:
    if isinstance(spec, str):
        return spec, {}
    if len(spec) != 1:
        raise ValueError(f"an operator needs exactly one name: {dict(spec)!r}")
    [(name, args)] = spec.items()
    return name, dict(args)


def _bind(spec: Spec, kind: str, known: Mapping[str, Callable], sides: int = 2) -> Op:
    name, args = name_and_args(spec)
    if name not in known:
        raise ValueError(f"unknown {kind} {name!r}; known: {', '.join(sorted(known))}")
    try:
        inspect.signature(known[name]).bind(*[None] * sides, **args)
    except TypeError as error:
        raise ValueError(f"{kind} {name!r}: {error}") from None
    return Op(name, args, known[name])


def chain(
    filters: Iterable[Spec] = (), transforms: Iterable[Spec] = (), augmenters: Iterable[Spec] = ()
) -> Chain:
    """Bind the operators of one corpus. Cuts are listed among the filters but always apply first."""
    filters = list(filters)
    is_cut = [name_and_args(spec)[0] in CUTS for spec in filters]
    return Chain(
        cuts=tuple(_bind(s, "filter", CUTS, sides=0) for s, cut in zip(filters, is_cut) if cut),
        filters=tuple(_bind(s, "filter", FILTERS) for s, cut in zip(filters, is_cut) if not cut),
        transforms=tuple(_bind(s, "transform", TRANSFORMS) for s in transforms),
        augmenters=tuple(_bind(s, "augmenter", AUGMENTERS) for s in augmenters),
    )
