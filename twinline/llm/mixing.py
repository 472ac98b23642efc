"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from twinline.sources.scratch import materialize

# No document is taken more often than this, no source is asked for more of its size.
MOST = 3
# Newton steps at most, and the relative error at which they end.
STEPS = 60
CLOSE = 1e-9
# Rounds that take up what rounding left: by a share of the smaller documents of a source, or by one.
REPAIRS = ("many", "one", "many", "one", "one")
# Documents of one source and size that are ranked together; larger cells are split.
CELL = 512
# Rates are whole numbers of 2**-RATE_BITS, so that running totals are exact in any order.
RATE_BITS = 24
# Running totals go over 2**BLOCK_BITS sizes, or parts of a size, at a time, then over such blocks.
BLOCK_BITS = 10


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; none in null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources by code point, null last, have the weights in turn and share the whole size by them; a target stops at ``MOST`` times its
    source's size and the excess goes to the others by weight until none is above.
    """
    # one row a source: the list of sources passes through one task, its documents never do
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    rows = materialize(sizes.select("source", "source_size", weight.alias("weight")), "sources")
    cap = F.col("source_size") * float(MOST)
    scale, held = 0.0, None
    while True:  # each round adds to what is held; the number held only grows
        full = F.col("weight") * scale >= cap if held is not None else F.lit(False)
        free_weight = F.sum(F.when(~full, F.col("weight")).otherwise(0.0))
        fixed = F.sum(F.when(full, cap).otherwise(0.0))
        total, free, taken, now = rows.agg(F.sum("source_size"), free_weight, fixed, F.sum(full.cast("int"))).first()
        if not free or now == held:
            break
        held, scale = now, max(scale, (total - taken) / free)
    return rows.select("source", "source_size", F.least(cap, F.col("weight") * scale).alias("target"))


def rate(tilt: Column, z: Column) -> Column:
    """Rate in (0, ``MOST``) under a tilt, 1 without one: the maximum-entropy rates with that limit."""
    return MOST / (1 + (MOST - 1) * F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -tilt * z))))


def balanced(cells: DataFrame, wanted: DataFrame) -> DataFrame:
    """``source, mean, tilt, flat``: the tilt at which a source's rates give its target.

    Newton steps on the convex dual, one per source and all sources at once, over counts by source and size; a step that leaves the
    bracket found so far halves it instead. ``flat`` is a rate for all documents, where the target is all or nothing.
    """
    means = cells.groupBy("source").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"))
    share = F.col("target") / F.greatest("source_size", F.lit(1))
    flat = F.when(F.col("source_size") == 0, 0.0).when(share >= MOST * (1 - 1e-12), float(MOST)).when(share <= 0, 0.0)
    state = wanted.join(means, F.equal_null(wanted["source"], means["source"])).drop(means["source"])
    state = state.select(
        "source", "source_size", "target", "mean", flat.alias("flat"), F.lit(0.0).alias("tilt"),
        F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"), F.lit(float("inf")).alias("error"),
    )
    state = materialize(state, "dual")
    for _ in range(STEPS):
        now = state.select(F.col("source").alias("s"), "tilt", "mean")
        z, r = F.col("size") / F.col("mean"), rate(F.col("tilt"), F.col("size") / F.col("mean"))
        tokens = F.col("n") * F.col("size")
        sums = (
            cells.filter("size > 0")
            .join(now, F.equal_null("source", "s"))
            .groupBy("s")
            .agg(F.sum(tokens * r).alias("given"), F.sum(tokens * z * r * (1 - r / MOST)).alias("slope"))
        )
        off = F.col("given") - F.col("target")
        low = F.when(off < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(off > 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - off / F.greatest(F.col("slope"), F.lit(1e-300))
        inside = (step > F.col("low")) & (step < F.col("high"))
        half = (
            F.when(F.col("low") == float("-inf"), F.least(F.lit(-1.0), F.col("high") * 2))
            .when(F.col("high") == float("inf"), F.greatest(F.lit(1.0), F.col("low") * 2))
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        error = F.abs(off) / F.greatest("target", F.lit(1e-9))
        fixed = ["source", "source_size", "target", "mean", "flat"]
        moved = state.join(sums, F.equal_null("source", "s"), "left").withColumns({"low": low, "high": high, "error": error})
        # a far step would only saturate the rates
        far = F.abs(step - F.col("tilt")) > 4 + 4 * F.abs(F.col("tilt"))
        moved = moved.withColumn("next", F.when(F.col("error") <= CLOSE, F.col("tilt")).when(inside & ~far, step).otherwise(half))
        state = materialize(moved.select(*fixed, F.col("next").alias("tilt"), "low", "high", "error"), "dual")
        if not state.filter("flat IS NULL").agg(F.max("error") > CLOSE).first()[0]:
            break
    return state.select("source", "mean", "tilt", "flat")


def running(parts: DataFrame) -> DataFrame:
    """``source, size, part, base``: the ``mass`` of all parts of a source before each, by size and number.

    Totals run over the parts of a block, over the blocks of a range of sizes and over the ranges of a source. The first hold at most
    2**``BLOCK_BITS`` rows, the second as many sizes, and ranges grow with the longest document, not with the number of documents.
    """

    def before(by: Sequence[str], order: Sequence[str]) -> Column:
        window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("mass").over(window), F.lit(0))

    block = {"range": F.shiftright("size", BLOCK_BITS), "block": F.shiftright("part", BLOCK_BITS)}
    parts = materialize(parts.withColumns(block), "parts")
    blocks = parts.groupBy("source", "range", "size", "block").agg(F.sum("mass").alias("mass"))
    ranges = blocks.groupBy("source", "range").agg(F.sum("mass").alias("mass"))
    ranges = ranges.select("source", "range", before(["source"], ["range"]).alias("in_source")).alias("r")
    blocks = blocks.withColumn("in_range", before(["source", "range"], ["size", "block"])).alias("b")
    parts = parts.withColumn("in_block", before(["source", "size", "block"], ["part"])).alias("p")
    of_range = F.equal_null("b.source", "r.source") & (F.col("b.range") == F.col("r.range"))
    of_block = F.equal_null("p.source", "b.source") & (F.col("p.size") == F.col("b.size")) & (F.col("p.block") == F.col("b.block"))
    base = F.col("in_source") + F.col("in_range") + F.col("in_block")
    return parts.join(blocks.join(ranges, of_range), of_block).select("p.source", "p.size", "p.part", base.alias("base"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1)) -> DataFrame:
    """``doc_id, repeat, source, size, source_size, target, copies, taken`` for every row of ``docs(doc_id, text, source)``.

    Sizes are words. The rates of a source are ``rate(tilt * size / mean size)`` with the tilt that meets its target
    (``balanced``). Copies are rates rounded by systematic sampling in order of size, so that a source's words miss its
    target by about its longest document at most: parts of a source and size give running totals (``running``), and only
    a part's documents are ranked together. ``taken`` is copies times size, at most ``MOST`` times size.

    Repeated rows are rounded each on its own; null text has size 0; a null source is a source, sorted last. Documents of size 0
    are taken as often as their rate says, with no words. Reruns agree. No rows give no rows. Other columns are not read.
    """
    read = docs.select(F.col("doc_id").cast("bigint"), "source", word_count(F.col("text")).alias("size"))
    counted = read.groupBy("doc_id", "source", "size").agg(F.count("*").alias("repeats"))
    # repeated rows become one with a number, so that a rerun ranks alike
    sized = materialize(counted, "sized")
    per_size = sized.groupBy("source", "size").agg(F.sum("repeats").alias("n"))
    cells = materialize(per_size, "sizes")
    sizes = cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    wanted = materialize(targets(sizes, weights), "targets")
    tilts = balanced(cells, wanted).withColumnRenamed("source", "s")
    rated = cells.join(tilts, F.equal_null("source", "s")).drop("s")
    own_rate = F.coalesce("flat", rate(F.col("tilt"), F.col("size") / F.greatest("mean", F.lit(1e-300))))
    parts = F.ceil(F.col("n") / CELL).cast("bigint")
    units = F.round(own_rate * (1 << RATE_BITS)).cast("bigint")
    rated = rated.select("source", "size", units.alias("rate"), parts.alias("parts"))
    both = F.equal_null("d.source", "c.source") & (F.col("d.size") == F.col("c.size"))
    rows = sized.alias("d").join(rated.alias("c"), both).select("doc_id", "d.source", "d.size", "repeats", "rate", "parts")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")))
    rows = rows.withColumn("repeat", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("repeats")))).drop("repeats", "parts")
    rows = materialize(rows, "rated")
    offsets = running(rows.groupBy("source", "size", "part").agg(F.sum("rate").alias("mass")))
    same = F.equal_null("r.source", "o.source") & (F.col("r.size") == F.col("o.size")) & (F.col("r.part") == F.col("o.part"))
    placed = rows.alias("r").join(offsets.alias("o"), same).select("doc_id", "repeat", "r.source", "r.size", "r.part", "rate", "base")
    rank = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy(F.xxhash64("doc_id", "repeat"), "doc_id", "repeat"))
    upto = lambda k: F.shiftright(F.col("base") + k * F.col("rate") + (1 << RATE_BITS - 1), RATE_BITS)
    copies = F.least(F.lit(MOST), (upto(F.col("k")) - upto(F.col("k") - 1))).cast("bigint")
    counted = placed.withColumn("k", rank).withColumn("copies", copies).select("doc_id", "repeat", "source", "size", "copies")
    out = repaired(materialize(counted, "copies"), wanted).alias("m").join(wanted.alias("w"), F.equal_null("m.source", "w.source"))
    return out.select(
        "doc_id", "repeat", "m.source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def repaired(counted: DataFrame, wanted: DataFrame) -> DataFrame:
    """``counted`` with a copy more or less of a few documents, so that the words of each source come closer to its target.

    A round changes the document of each source whose size is nearest to what the source is off by, or, by hash, the
    share of documents of at most half that size that makes up for it.
    """
    key = ["doc_id", "repeat", "source"]
    moves = counted.select(*key, F.lit(0).cast("bigint").alias("step")).limit(0)

    def moved() -> DataFrame:
        same = F.equal_null("c.doc_id", "v.doc_id") & (F.col("c.repeat") == F.col("v.repeat")) & F.equal_null("c.source", "v.source")
        changes = moves.groupBy(*key).agg(F.sum("step").alias("step"))
        both = counted.alias("c").join(changes.alias("v"), same, "left")
        return both.select("c.*", F.coalesce("v.step", F.lit(0)).alias("step")).withColumn("copies", F.col("copies") + F.col("step")).drop("step")

    for turn, kind in enumerate(REPAIRS):
        now = moved()
        sums = now.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"))
        gaps = wanted.alias("w").join(sums.alias("s"), F.equal_null("w.source", "s.source"))
        gaps = materialize(gaps.select("w.source", (F.col("target") - F.col("taken")).alias("gap")), "gaps")
        room = F.when(F.col("gap") > 0, F.col("copies") < MOST).otherwise(F.col("copies") > 0) & (F.col("size") > 0)
        fits = now.alias("n").join(gaps.alias("g"), F.equal_null("n.source", "g.source")).filter(room)
        fits = fits.select("doc_id", "repeat", "n.source", "size", "gap", F.signum("gap").cast("bigint").alias("step"))
        if kind == "one":
            left = F.abs(F.abs("gap") - F.col("size"))
            best = F.min(F.struct(left.alias("left"), "doc_id", "repeat", "step")).alias("best")
            picked = fits.filter(left < F.abs("gap")).groupBy("source").agg(best).select("best.doc_id", "best.repeat", "source", "best.step")
        else:
            small = fits.filter(2 * F.col("size") <= F.abs("gap"))
            room = small.groupBy("source").agg(F.sum("size").alias("room")).alias("r")
            chance = F.pmod(F.xxhash64("doc_id", "repeat", F.lit(turn)), F.lit(1 << 20)) / (1 << 20)
            chosen = small.alias("c").join(room, F.equal_null("c.source", "r.source")).filter(chance < F.abs("gap") / F.col("room"))
            picked = chosen.select("doc_id", "repeat", "c.source", "step")
        moves = moves.unionByName(materialize(picked, "moves"))
    return moved()


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (5, 2, 1)) -> DataFrame:
    """Rows of ``docs`` as often as ``mix`` takes them.

    Rows that share ``doc_id``, source and size share their copies evenly; what is left over goes by a hash of the text.
    """
    chosen = mix(docs, weights).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    chosen = chosen.filter("copies > 0").alias("c")
    # made before the join, so that texts are counted where they are read
    held = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), "source", word_count(F.col("text")).alias("size"))
    same = F.equal_null("d.id", "c.doc_id") & F.equal_null("d.source", "c.source") & (F.col("d.size") == F.col("c.size"))
    left = F.col("c.copies") % F.col("c.rows")
    turn = F.pmod(F.xxhash64("d.row.doc_id", "d.row.text"), F.col("c.rows"))
    times = F.floor(F.col("c.copies") / F.col("c.rows")) + (turn < left).cast("int")
    taken = held.alias("d").join(chosen, same).select("d.row", times.cast("int").alias("times")).filter("times > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
