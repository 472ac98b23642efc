"""Shards of documents by vector bin packing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from twinline.llm.mixing import word_count
from twinline.sources.scratch import materialize

# Groups that are packed together in one step.
LOT = 32768
# Most a piece of a group may be of one shard's share, in any dimension; also most it may be of a lot's part of that share.
PIECE = 1 / 8
# How many times as many lots each level has as the one of larger pieces before it.
SPREAD = 32
RESOURCES = ("bytes", "tokens", "rows")


def place(sizes: np.ndarray, shards: int, first: str = "bytes", room: np.ndarray | None = None, turn: int = 0) -> np.ndarray:
    """A shard for every row of ``sizes`` (bytes, tokens, rows).

    Rows are placed by descending largest share. Each goes where the dot product of its shares with the residual
    capacity is highest among the shards that have room for it; if none has, where most of the ``first`` resource is left.
    Capacities are in proportion to ``room`` (by shard and resource; negative is none), or equal. Ties go to the first
    shard from ``turn`` on.
    """
    shares = sizes / np.maximum(sizes.sum(axis=0), 1) * shards
    lead = RESOURCES.index(first)
    order = np.lexsort((np.arange(len(shares)), -shares[:, lead], -shares.max(axis=1)))
    left = np.ones((shards, len(RESOURCES)))
    if room is not None:
        room = np.roll(np.maximum(room, 0), -turn, axis=0)
        whole = room.sum(axis=0)
        left = np.where(whole > 0, room / np.where(whole > 0, whole, 1) * shards, left)
    out = np.empty(len(shares), dtype=np.int32)
    for i in order:
        fits = (left >= shares[i]).all(axis=1)
        score = left @ shares[i]
        best = int(np.where(fits, score, -np.inf).argmax()) if fits.any() else int(left[:, lead].argmax())
        out[i] = best
        left[best] -= shares[i]
    return ((out + turn) % shards).astype(np.int32)


def _place_lot(shards: int, room: np.ndarray):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("piece", "ascending")])
        sizes = np.stack([table[c].to_numpy().astype(np.float64) for c in RESOURCES], axis=1)
        lot = table["lot"][0].as_py()
        shard = place(sizes, shards, room=room, turn=lot % shards)
        order = np.argsort(shard, kind="stable")
        rows = table["rows"].to_numpy().astype(np.int64)
        running = np.cumsum(rows[order]) - rows[order]
        first = np.searchsorted(shard[order], shard[order])
        before = np.empty(len(rows), dtype=np.int64)
        before[order] = running - running[first]
        columns = {c: table[c] for c in ("lot", "key", "piece", "bytes", "tokens")}
        return pa.table({**columns, "rows": rows, "shard": shard, "before": before})

    return run


def _levels(lots: int) -> list[int]:
    """Lots of each level: one, then ``SPREAD`` times as many as the level before, at last ``lots``."""
    levels = [1]
    while levels[-1] < lots:
        levels.append(min(lots, levels[-1] * SPREAD))
    return levels


def pack_shards(docs: DataFrame, shards: int) -> DataFrame:
    """``doc_id, size, tokens, text_crc32, shard, slot`` for every row of ``docs(doc_id, text)``; bytes of shards nearly equal.

    Equal texts are a group and stay together, unless the group is more than ``PIECE`` of a shard's share of bytes, tokens or
    rows: then its rows are dealt by a hash of their ids to pieces within it. Pieces go by hash to lots of about ``LOT``; each lot is packed
    into all shards by ``place``, so the lots' shards add up evenly and no task sees all groups. A piece that is more than
    ``PIECE`` of a lot's part of a shard's share goes to a level of fewer lots where it is not, or else to the one lot of the first
    level. Levels are packed one after the other, each into the room the larger pieces have left, so a lot of a level holds
    at most ``SPREAD / PIECE`` pieces a shard and resource. ``slot`` numbers the rows of a shard from 0 by lot, piece and id.

    Size is the UTF-8 bytes of the text plus 16; null text counts as empty and shares its group. Repeated rows are rows of their own.
    A text larger than a shard's share is one piece. Null ids sort first. No rows give no rows. Other columns are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint"),
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        word_count(text).alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("key"),
    )
    rows = materialize(rows, "sized")
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    groups = rows.groupBy("key").agg(*sums)
    total = rows.agg(*sums).first()
    limits = [max(1.0, (total[c] or 0) / shards * PIECE) for c in RESOURCES]

    def part(limits: list[float]):
        return F.greatest(*[F.col(c) / limit for c, limit in zip(RESOURCES, limits, strict=True)])

    parts = F.ceil(part(limits))
    # groups over a limit: at most shards / PIECE for each resource
    split = materialize(groups.withColumn("parts", parts).filter("parts > 1 AND rows > 1").select("key", "parts"), "large-groups")
    piece = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("parts"))).cast("int")
    dealt = rows.join(F.broadcast(split), "key", "left").withColumn("piece", piece).drop("parts")
    dealt = materialize(dealt, "dealt")
    levels = _levels(-(-(total["rows"] or 0) // LOT))
    # the last level whose lots are few enough for the piece, its lots numbered after those of the levels before
    lot, before = F.lit(0), 1
    for lots in levels[1:]:
        own = F.pmod(F.xxhash64("key", "piece"), F.lit(lots)) + before
        lot = F.when(part([(total[c] or 0) / shards * PIECE / lots for c in RESOURCES]) <= 1, own).otherwise(lot)
        before += lots
    pieces = dealt.groupBy("key", "piece").agg(*sums).withColumn("lot", lot.cast("int"))
    if len(levels) > 1:
        pieces = materialize(pieces, "pieces")
    schema = "lot int, key binary, piece int, bytes bigint, tokens bigint, rows bigint, shard int, before bigint"
    room = np.tile([(total[c] or 0) / shards for c in RESOURCES], (shards, 1))
    placed, first = None, 0
    for lots in levels:
        inside = pieces.filter(F.col("lot").between(first, first + lots - 1)) if len(levels) > 1 else pieces
        done = materialize(inside.groupBy("lot").applyInArrow(_place_lot(shards, room.copy()), schema), "placed")
        if first + lots < before:
            for r in done.groupBy("shard").agg(*[F.sum(c).alias(c) for c in RESOURCES]).collect():
                room[r["shard"]] -= [r[c] for c in RESOURCES]
        placed = done if placed is None else placed.unionByName(done)
        first += lots
    placed = placed.drop("bytes", "tokens")
    # one row for a lot and shard
    cells = placed.groupBy("shard", "lot").agg(F.sum("rows").alias("rows"))
    earlier = Window.partitionBy("shard").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("shard", "lot", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("base"))
    start = placed.join(cells, ["shard", "lot"]).select("key", "piece", "shard", (F.col("base") + F.col("before")).alias("start"))
    numbered = dealt.join(start, ["key", "piece"])
    rank = F.row_number().over(Window.partitionBy("key", "piece").orderBy("doc_id")) - 1
    return numbered.select(
        "doc_id", "size", "tokens", "text_crc32", "shard", (F.col("start") + rank).cast("bigint").alias("slot")
    )
