"""From a configuration to the corpora and chains of a build."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from twinline.operators.registry import Chain, Spec, chain, name_and_args
from twinline.sources import languages

# Prefixes of corpus addresses, default settings of the sentence sample.
FOLDER_PREFIX, CATALOGUE_PREFIX = "file://", "opus://"
SAMPLE_SENTENCES = 1_000_000

MANIFEST = (
    "name string, source_ord int, weight int, "
    "filters array<struct<name:string,args:string>>, "
    "transforms array<struct<name:string,args:string>>, "
    "augmenters array<struct<name:string,args:string>>"
)


@dataclass(frozen=True)
class Corpus:
    """One entry of the configuration; ``filters`` and so on are as written, global ones first."""

    name: str
    source_ord: int
    weight: int | None
    filters: tuple[Spec, ...]
    transforms: tuple[Spec, ...]
    augmenters: tuple[Spec, ...]
    chain: Chain


@dataclass(frozen=True)
class Plan:
    src_lang: str
    tgt_lang: str
    version: str
    reverse: bool
    corpora: tuple[Corpus, ...]
    input_sentence_size: int

    @property
    def chains(self) -> dict[str, Chain | None]:
        """Chain per corpus name, None for weighted corpora: those are used as they are."""
        return {c.name: None if c.weight is not None else c.chain for c in self.corpora}

    @property
    def weights(self) -> dict[str, int]:
        return {c.name: c.weight for c in self.corpora if c.weight is not None}

    @property
    def all_weighted(self) -> bool:
        return all(c.weight is not None for c in self.corpora)


def pipeline_from_config(conf: Mapping[str, Any] | str, reverse: bool = False) -> Plan:
    """Parse a configuration (a mapping or JSON text). Unknown operators and arguments raise here.

    Global operators go before those of a corpus. A corpus listed twice keeps its place and takes the
    later settings.
    """
    conf = json.loads(conf) if isinstance(conf, str) else conf
    src_lang, tgt_lang = conf["from"]["code"], conf["to"]["code"]
    if reverse:
        src_lang, tgt_lang = tgt_lang, src_lang

    entries: dict[str, Mapping[str, Any]] = {}
    for entry in conf["sources"]:
        entry = {"source": entry} if isinstance(entry, str) else entry
        if "source" not in entry:
            raise ValueError(f"a source needs a 'source' key: {entry!r}")
        entries[entry["source"]] = entry

    corpora = []
    for order, (name, entry) in enumerate(entries.items()):
        ops = {
            kind: tuple([*(conf.get(kind) or []), *(entry.get(kind) or [])])
            for kind in ("filters", "transforms", "augmenters")
        }
        ops["filters"] = tuple(_with_scripts(spec, src_lang, tgt_lang) for spec in ops["filters"])
        weight = entry.get("weight")
        corpora.append(Corpus(name=name, source_ord=order, weight=weight, chain=chain(**ops), **ops))
    return Plan(
        src_lang,
        tgt_lang,
        str(conf.get("version", "")),
        reverse,
        tuple(corpora),
        conf.get("input_sentence_size", SAMPLE_SENTENCES),
    )


def _with_scripts(spec: Spec, src_lang: str, tgt_lang: str) -> Spec:
    """Scripts the Latin limit is not told come from the language table."""
    name, args = name_and_args(spec)
    if name != "limit_latin_chars":
        return spec
    known = {"s_chset": languages.script_of(src_lang), "t_chset": languages.script_of(tgt_lang)}
    return {name: {**{k: v for k, v in known.items() if v}, **args}}


def manifest(spark: SparkSession, plan: Plan) -> DataFrame:
    """The corpora as a (small) table, one row each."""

    def described(specs: tuple[Spec, ...]) -> list[tuple[str, str]]:
        return [(name, json.dumps(args, sort_keys=True)) for name, args in map(name_and_args, specs)]

    rows = [
        (c.name, c.source_ord, c.weight, described(c.filters), described(c.transforms), described(c.augmenters))
        for c in plan.corpora
    ]
    return spark.createDataFrame(rows, MANIFEST)
