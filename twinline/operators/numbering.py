"""Line numbers without putting a corpus into one task.

Lines come in units (a document, a block of a file). A unit knows how many lines it holds; the first
line number of a unit is the prefix sum of the counts before it. The prefix sum runs inside bounded
blocks of units and then over the blocks, so no task ever sees a whole corpus, however uneven the
corpora are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def unit_offsets(units: DataFrame, corpus: str, unit: str, block: Column, lines: Column) -> DataFrame:
    """``corpus, unit, lines_before, unit_lines, n_lines`` for every unit.

    ``block`` must not decrease as ``unit`` grows, and should hold a bounded number of units.
    ``n_lines`` is the number of lines of the corpus.
    """
    counted = units.select(corpus, unit, block.alias("_block"), lines.cast("long").alias("_lines"))
    counted = counted.filter(F.col(corpus).isNotNull() & F.col("_block").isNotNull())
    in_block = Window.partitionBy(corpus, "_block").orderBy(unit)
    running = F.sum("_lines").over(in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = counted.select(
        corpus, unit, "_block", "_lines", running.alias("_up_to"), F.lead(unit).over(in_block).isNull().alias("_last")
    )
    # The last unit of a block knows the block's total. Taking it from the same window, not from an
    # aggregation of its own, lets both uses share one exchange and one scan of the units.
    totals = placed.filter("_last").select(corpus, "_block", F.col("_up_to").alias("_in_block"))
    whole = Window.partitionBy(corpus)
    earlier_blocks = whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = totals.select(
        corpus,
        "_block",
        F.coalesce(F.sum("_in_block").over(earlier_blocks), F.lit(0)).alias("_before_block"),
        F.sum("_in_block").over(whole).alias("n_lines"),
    )
    before = F.col("_before_block") + F.col("_up_to") - F.col("_lines")
    own = F.col("_lines").alias("unit_lines")
    return placed.join(blocks, [corpus, "_block"]).select(corpus, unit, before.alias("lines_before"), own, "n_lines")
