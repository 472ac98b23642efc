"""Fill-in-middle transformation: texts cut at two token ranks that an indexable skip list finds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# One node in so many of a lane is also a node of the lane above.
FANOUT = 16
# Code points whose tokens are found in one step.
SLICE = 1 << 20
SENTINELS = ("<P>", "<S>", "<M>")
CUTS = "struct<n bigint, first bigint, second bigint>"


def token_widths(text: str) -> np.ndarray:
    """Code points of each token of ``[A-Za-z]+|[^A-Za-z]``, in order."""
    starts = []
    letter_before = False
    for at in range(0, len(text), SLICE):
        points = np.frombuffer(text[at : at + SLICE].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        folded = points | np.uint32(32)
        letter = (folded >= 97) & (folded <= 122)
        goes_on = np.empty(len(letter), dtype=bool)
        goes_on[0] = letter_before and letter[0]
        goes_on[1:] = letter[1:] & letter[:-1]
        starts.append(np.flatnonzero(~goes_on) + at)
        letter_before = bool(letter[-1])
    if not starts:
        return np.zeros(0, dtype=np.int64)
    return np.diff(np.concatenate([*starts, [len(text)]]))


class SkipList:
    """Tokens under express lanes.

    A node of lane 0 is a token. A node of a lane above stands for the nodes of the lane below from its own place to the
    next node of its lane, and carries both of its widths: how many tokens and how many code points it passes over.
    """

    def __init__(self, widths: np.ndarray, fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.fanout = fanout
        self.units = [np.ones(len(widths), dtype=np.int64)]
        self.points = [np.asarray(widths, dtype=np.int64)]
        while len(self.units[-1]) > fanout:
            heads = np.arange(0, len(self.units[-1]), fanout)
            self.units.append(np.add.reduceat(self.units[-1], heads))
            self.points.append(np.add.reduceat(self.points[-1], heads))

    def __len__(self) -> int:
        return int(self.units[-1].sum())

    def points_before(self, rank: int) -> int:
        """Code points of the first ``rank`` tokens: on each lane go on while the next node stays within the rank, then go down."""
        if not 0 <= rank <= len(self):
            raise IndexError(f"rank {rank} of {len(self)} tokens")
        left, passed, node = rank, 0, 0
        for units, points in zip(reversed(self.units), reversed(self.points), strict=True):
            while node < len(units) and units[node] <= left:
                left -= int(units[node])
                passed += int(points[node])
                node += 1
            node *= self.fanout
        return passed


def _cuts(text: str | None, a: int, b: int, fanout: int) -> tuple[int, int, int]:
    tokens = SkipList(token_widths(text or ""), fanout)
    n = len(tokens)
    low, high = sorted((a % (n + 1), b % (n + 1)))
    return n, tokens.points_before(low), tokens.points_before(high)


def cuts(fanout: int = FANOUT):
    """Arrow function of (text, a, b): number of tokens n, and code points before ranks ``a % (n + 1)`` and ``b % (n + 1)``, smaller first."""

    def run(texts: pa.Array, a: pa.Array, b: pa.Array) -> pa.Array:
        found = [_cuts(t.as_py(), x, y, fanout) for t, x, y in zip(texts, a.to_pylist(), b.to_pylist(), strict=True)]
        columns = zip(*found, strict=True) if found else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["n", "first", "second"])

    return F.arrow_udf(run, CUTS)


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32: the first groups of eight digits of the hex SHA-256 of ``seed:key``; a null key has no digits."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def infill(docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, fanout: int = FANOUT) -> DataFrame:
    """``doc_id, text, n, form, prefix_chars, middle_chars, output`` for every row of ``docs(doc_id, text)``.

    A text of ``n`` tokens (runs of A-Z and a-z, or one other code point) is cut after two ranks drawn from its ``doc_id``
    into prefix, middle and suffix. ``form`` is ``plain`` (the text itself) for texts that are empty or hold a sentinel
    and for ``plain_percent`` of the others, ``spm`` (suffix first) for ``spm_percent`` of the rest, else ``psm``.
    ``prefix_chars`` and ``middle_chars`` count code points and are null where the form is plain.

    Only text and two numbers of a row go to Python, whole whatever the length; the output is put together by Spark.
    A row depends on itself alone: repeated rows give equal rows, a null text is empty, a null ``doc_id`` draws from the seed alone.
    Other columns are not read, whatever their names.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    a, b, plain, order = draws(F.col("doc_id"), seed)
    cut = docs.select("doc_id", text.alias("text")).withColumn("cut", cuts(fanout)("text", a, b))
    marked = F.lit(False)
    for mark in SENTINELS:
        marked = marked | F.col("text").contains(mark)
    form = (
        F.when((F.col("text") == "") | marked | (plain % 100 >= 100 - plain_percent), "plain")
        .when(order % 100 < spm_percent, "spm")
        .otherwise("psm")
    )
    first, second = F.col("cut.first"), F.col("cut.second")
    prefix = F.col("text").substr(F.lit(1), first.cast("int"))
    middle = F.col("text").substr((first + 1).cast("int"), (second - first).cast("int"))
    suffix = F.col("text").substr((second + 1).cast("int"), F.length("text"))
    p, s, m = map(F.lit, SENTINELS)
    output = (
        F.when(F.col("form") == "plain", F.col("text"))
        .when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .otherwise(F.concat(s, suffix, p, prefix, m, middle))
    )
    is_cut = F.col("form") != "plain"
    return cut.withColumn("form", form).select(
        "doc_id",
        "text",
        F.col("cut.n").alias("n"),
        "form",
        F.when(is_cut, first).alias("prefix_chars"),
        F.when(is_cut, second - first).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that ``infill`` was given, from its output and form alone.

    A cut text holds no sentinel, and no two of them overlap, so the first of each kind is the one that was put there.
    """
    psm = form == "psm"
    p, s, m = SENTINELS
    second_at = F.when(psm, F.position(F.lit(s), output)).otherwise(F.position(F.lit(p), output))
    last_at = F.position(F.lit(m), output)
    size = len(p)
    head = output.substr(F.lit(size + 1), second_at - size - 1)
    tail = output.substr(second_at + size, last_at - second_at - size)
    middle = output.substr(last_at + size, F.length(output))
    whole = F.when(psm, F.concat(head, middle, tail)).otherwise(F.concat(tail, middle, head))
    return F.when(form == "plain", output).otherwise(whole)
