"""Secrets in texts: patterns, and credentials told from examples by who owns them, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from twinline.sources.scratch import materialize

# Kind, pattern, capture group whose length counts, and least length: the base patterns (fixed values).
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
# Other runs that can be credentials: long, with lower and upper case and digits.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "owned")
# A value that this many owners, or this many repositories, share is an example that was copied around.
OWNERS = 3
REPOSITORIES = 4
# Different characters that a live-looking value has at least.
VARIETY = 8
MASK = "[SECRET]"


def matches(text: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """``start, kind, stop, value`` of the pattern's matches, leftmost first, without those shorter than ``least``.

    Offsets count code points: the text between matches is cut out and lengths are added up.
    """
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    found = F.filter(parts, lambda p: p["whole"].isNotNull())
    span = "struct<start:bigint,kind:int,stop:bigint,value:string>"
    empty = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

    def step(state: Column, p: Column) -> Column:
        start = state["at"] + F.length(p["gap"])
        stop = start + F.length(p["whole"])
        one = F.struct(
            start.cast("bigint").alias("start"), F.lit(kind).alias("kind"), stop.cast("bigint").alias("stop"), p["value"].alias("value")
        )
        kept = F.when(F.length(p["value"]) >= least, F.concat(state["spans"], F.array(one))).otherwise(state["spans"])
        return F.struct(stop.cast("bigint").alias("at"), kept.alias("spans"))

    spans = F.aggregate(found, empty, step, lambda s: s["spans"])
    return F.when(F.regexp(text, F.lit(pattern)), spans).otherwise(F.array().cast(f"array<{span}>"))


def live_looking(value: Column) -> Column:
    """Lower and upper case and digits, and enough different characters."""
    variety = F.size(F.array_distinct(F.split(value, ""))) >= VARIETY
    return value.rlike("[a-z]") & value.rlike("[A-Z]") & value.rlike("[0-9]") & variety


def scan(docs: DataFrame, owner: str, repository: list[str]) -> DataFrame:
    """``row, doc_id, owner, repository, base, more`` for every row; ``more`` are candidates apart from base spans."""
    text = F.coalesce("text", F.lit(""))
    base = F.array_sort(F.concat(*[matches(text, k, *rule[1:]) for k, rule in enumerate(BASE)]))
    more = F.filter(matches(text, len(BASE), CANDIDATE, 0, 20), lambda s: live_looking(s["value"]))
    repo = F.concat_ws("/", *[F.coalesce(c, F.lit("")) for c in repository])
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(owner, F.lit("")).alias("owner"), repo.alias("repository"), text.alias("text"))
    rows = rows.withColumns({"base": base, "more": more}).drop("text")
    apart = F.filter("more", lambda m: ~F.exists("base", lambda b: (b["start"] < m["stop"]) & (m["start"] < b["stop"])))
    return rows.withColumn("more", apart)


def ownership(scanned: DataFrame) -> DataFrame:
    """``hash, owners, repositories, live`` of every value found: who holds it, over the whole corpus."""
    spans = scanned.select("owner", "repository", F.explode(F.concat("base", "more")).alias("s"))
    held = spans.select(F.sha2(F.col("s.value"), 256).alias("hash"), "owner", "repository").distinct()
    counts = held.groupBy("hash", "owner").agg(F.count("*").alias("r")).groupBy("hash")
    counts = counts.agg(F.count("*").alias("owners"), F.sum("r").alias("repositories"))
    return counts.withColumn("live", (F.col("owners") < OWNERS) & (F.col("repositories") < REPOSITORIES))


def find_secrets(docs: DataFrame, owner: str = "source", repository: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """``doc_id, spans, n_live, n_copied`` for every ``doc_id`` of ``docs``: ``start, kind, stop, live`` of each secret.

    Base patterns always give a span. A candidate outside them becomes a span of kind ``owned`` if its value is
    owner-specific: held by fewer than ``OWNERS`` owners and ``REPOSITORIES`` repositories of the corpus, counted over hashes of all
    candidates. ``live`` tells the same of each base span; those widely copied are examples.

    Null text is empty, a null owner is an owner. Rows of one ``doc_id`` with equal spans give one row, different ones have their spans
    brought together; null ids share a row. Other columns are not read.
    """
    found = scan(docs, owner, list(repository))
    scanned = materialize(found, "spans")
    verdicts = ownership(scanned)
    spans = scanned.select("doc_id", F.explode(F.concat("base", "more")).alias("s")).select(
        "doc_id", "s.start", "s.kind", "s.stop", F.sha2(F.col("s.value"), 256).alias("hash")
    )
    judged = spans.distinct().join(verdicts, "hash").filter((F.col("kind") < len(BASE)) | F.col("live"))
    one = F.struct("start", "kind", "stop", "live")
    per_doc = judged.groupBy("doc_id").agg(F.array_sort(F.collect_set(one)).alias("spans"))
    every = scanned.select("doc_id").distinct().alias("e")
    out = every.join(per_doc.alias("p"), F.equal_null("e.doc_id", "p.doc_id"), "left")
    kind = "array<struct<start:bigint,kind:int,stop:bigint,live:boolean>>"
    spans = F.coalesce("p.spans", F.array().cast(kind))
    out = out.select("e.doc_id", spans.alias("spans"))
    live = F.size(F.filter("spans", lambda s: s["live"]))
    return out.select("doc_id", "spans", live.cast("bigint").alias("n_live"), (F.size("spans") - live).cast("bigint").alias("n_copied"))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of all spans by start, then kind, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(
        spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))
    )
    return F.array_join(text, ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans and the list of all spans, per document."""
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    kinds = F.transform("spans", lambda s: s["kind"])
    of_kind = [F.size(kinds) - F.size(F.array_remove(kinds, k)) for k in range(len(BASE))]
    counts = [n.cast("bigint").alias(f"n_{rule[0]}") for n, rule in zip(of_kind, BASE, strict=True)]
    hashed = F.sha2(span_list(base), 256).alias("base_sha256")
    return found.select("doc_id", *counts, hashed, span_list(F.col("spans")).alias("spans"), "n_live", "n_copied")


def masked(docs: DataFrame, owner: str = "source", repository: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """``docs`` with the live spans of each text replaced by ``MASK`` and ``n_chars`` counted anew.

    Widely copied examples stay. Spans go back to their rows by a hash of the text, so rows of one ``doc_id`` or of none
    are masked each by its own text; a null text stays null, and no rows give none.
    """
    # texts that are null have nothing to mask; they get different keys
    key = F.coalesce(F.when(F.col("text").isNotNull(), F.xxhash64("text")), F.xxhash64("doc_id"))
    found = find_secrets(docs.filter("text IS NOT NULL").withColumn("doc_id", key), owner, repository).filter("n_live > 0").alias("f")
    kept = docs.withColumn("_key", key).alias("d").join(found, F.col("d._key") == F.col("f.doc_id"), "left")
    text = F.col("d.text")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("done"))

    def step(state: Column, s: Column) -> Column:
        inside = s["start"] < state["at"]  # part of a span that was masked
        between = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        done = F.when(inside, state["done"]).otherwise(F.concat(state["done"], between, F.lit(MASK)))
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"), done.alias("done"))

    def finish(state: Column) -> Column:
        return F.concat(state["done"], F.substring(text, (state["at"] + 1).cast("int"), F.length(text)))

    live = F.filter("f.spans", lambda s: s["live"])
    clean = F.when(text.isNotNull() & F.col("f.spans").isNotNull(), F.aggregate(live, start, step, finish)).otherwise(text)
    changed = {"text": clean}
    if "n_chars" in docs.columns:
        length = F.length(clean).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("f.spans").isNull(), F.col("d.n_chars")).otherwise(length)
    return kept.select(*[(changed[c] if c in changed else F.col(f"d.{c}")).alias(c) for c in docs.columns])
