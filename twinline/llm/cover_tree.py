"""Exact threshold pairs of embeddings by cover trees and dual traversal."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from twinline.llm import vectors
from twinline.llm.components import connected
from twinline.sources.scratch import materialize

# Vectors of a block, whose tree is one task's step; cells beyond it are split.
BLOCK = 4096
# Most pivots: the bound of what the driver holds and every task is given.
PIVOTS = 256
# Radii of the levels below the root (chords of the unit sphere, at most 2).
RADII = (1.0, 0.5, 0.25, 0.125)
# Bounds are taken this much wider than they are, against rounding.
SLACK = 1e-9
# Most that a product of unit vectors in single precision is off by.
ROUGH = 1e-4
PAIRS_AT_ONCE = 1 << 18


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows at length one; rows that are zero or not finite become NaN."""
    most = np.abs(x).max(axis=1, initial=0)
    with np.errstate(invalid="ignore", divide="ignore"):
        x = x / most[:, None]
        x = x / np.sqrt((x * x).sum(axis=1))[:, None]
    x[~(np.isfinite(most) & (most > 0))] = np.nan
    return x


def chord(dots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * dots))


def cover(u: np.ndarray, members: np.ndarray, radius: float) -> np.ndarray:
    """For each member the nearest of greedily chosen centres, all members within ``radius``; the first is a centre."""
    if len(members) <= 64:
        d = chord(u[members] @ u[members].T)
        centers, covered = [], np.zeros(len(members), dtype=bool)
        for i in range(len(members)):
            if not covered[i]:
                centers.append(i)
                covered |= d[i] <= radius
        return members[np.array(centers)[d[:, centers].argmin(axis=1)]]
    centers = np.zeros(0, dtype=np.int64)
    for first in range(0, len(members), 512):
        part = members[first : first + 512]
        free = part
        if len(centers):
            free = part[chord(u[part] @ u[centers].T).min(axis=1) > radius]
        if len(free):
            d = chord(u[free] @ u[free].T)
            covered, fresh = np.zeros(len(free), dtype=bool), []
            for i in range(len(free)):
                if not covered[i]:
                    fresh.append(i)
                    covered |= d[i] <= radius
            centers = np.append(centers, free[fresh])
    best = np.empty(len(members), dtype=np.int64)
    for first in range(0, len(members), 1024):
        best[first : first + 1024] = (u[members[first : first + 1024]] @ u[centers].T).argmax(axis=1)
    return centers[best]


def build(u: np.ndarray) -> np.ndarray:
    """Centre of every row at each level of ``RADII``: nested covers, each inside the nodes of the one above."""
    path = np.empty((len(u), len(RADII)), dtype=np.int32)
    path[:, 0] = cover(u, np.arange(len(u)), RADII[0])
    for level in range(1, len(RADII)):
        above = path[:, level - 1]
        far = chord(np.einsum("ij,ij->i", u, u[above]))
        path[:, level] = above
        order = np.argsort(above, kind="stable")
        starts = np.append(np.flatnonzero(np.append(True, above[order][1:] != above[order][:-1])), len(u))
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            members = order[a:b]
            if b - a > 1 and far[members].max() > RADII[level]:
                center = above[members[0]]
                members = np.append(center, members[members != center])
                path[members, level] = cover(u, members, RADII[level])
    return path


class Tree:
    """Levels of nodes with centre, covering radius, size and children; the last level is the rows themselves."""

    def __init__(self, u: np.ndarray, path: np.ndarray):
        self.u, self.centers, self.radius, self.size, self.node = u, [], [], [], []
        for level in range(path.shape[1]):
            centers, node, size = np.unique(path[:, level], return_inverse=True, return_counts=True)
            radius = np.zeros(len(centers))
            np.maximum.at(radius, node, chord(np.einsum("ij,ij->i", u, u[path[:, level]])))
            self._add(centers, radius, size, node)
        n = len(u)
        self._add(np.arange(n), np.zeros(n), np.ones(n, dtype=np.int64), np.arange(n))
        self.children = []
        for level in range(len(self.centers) - 1):
            parent = self.node[level][self.centers[level + 1]]
            order = np.argsort(parent, kind="stable")
            self.children.append((order, np.append(0, np.cumsum(np.bincount(parent, minlength=len(self.centers[level]))))))

    def start(self, reach: float) -> int:
        """Level at which a traversal begins: below levels whose wide nodes hardly save any.

        A level is skipped if more than one node in a thousand is too wide to be settled as a whole and the next level has at most
        half as many nodes again.
        """
        for level in range(len(self.children)):
            wide = (2 * self.radius[level] > reach).mean() if len(self.u) else 0
            if wide <= 1e-3 or len(self.centers[level + 1]) > 1.5 * len(self.centers[level]):
                return level
        return len(self.children)

    def _add(self, centers, radius, size, node) -> None:
        self.centers.append(centers)
        self.radius.append(radius)
        self.size.append(size)
        self.node.append(node)


class Union:
    """Smallest label reachable, for batches of index pairs."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while True:
                jumped = self.label[self.label]
                if (jumped == self.label).all():
                    break
                self.label = jumped


def _product(left: tuple, i: np.ndarray, right: tuple, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Children of node pairs, paired, in chunks."""
    (kids, at), (others, start) = left, right
    ni, nj = at[i + 1] - at[i], start[j + 1] - start[j]
    total = np.cumsum(ni * nj)
    first = 0
    while first < len(i):
        base = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, base + PAIRS_AT_ONCE, side="right")))
        a, b, n = i[first:last], j[first:last], (ni * nj)[first:last]
        pair = np.repeat(np.arange(len(a)), n)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = nj[first:last][pair]
        yield kids[at[a][pair] + place // width], others[start[b][pair] + place % width]
        first = last


def dual(a: Tree, b: Tree, same: bool, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of each row of ``a`` and of ``b``, and labels of what they connect (rows of ``b`` after those of ``a``).

    Node pairs whose centres are further apart than both radii and the threshold are pruned; pairs that lie wholly
    within the threshold are counted as a whole; the others go down one level. Rows are compared by cosine.
    """
    reach = float(np.sqrt(2 - 2 * cosine))
    shift = 0 if same else len(a.u)
    union = Union(len(a.u) + (0 if same else len(b.u)))
    found = [np.zeros(len(a.u), dtype=np.int64), np.zeros(len(b.u), dtype=np.int64)]
    last = len(a.centers) - 1

    def settle(level: int, i: np.ndarray, j: np.ndarray, dots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count what is decided about node pairs; the pairs to go down with."""
        if level == last:
            linked = (dots >= cosine) & ((i != j) if same else True)
            i, j = i[linked], j[linked]
            found[0] += np.bincount(i, minlength=len(a.u))
            found[0 if same else 1] += np.bincount(j, minlength=len(b.u))
            union.add(i, j + shift)
            return i[:0], j[:0]
        ra, rb, d = a.radius[level][i], b.radius[level][j], chord(dots)
        near = d <= ra + rb + reach + SLACK
        i, j, d, ra, rb = i[near], j[near], d[near], ra[near], rb[near]
        own = (i == j) if same else np.zeros(len(i), dtype=bool)
        within = np.where(own, 2 * ra, d + ra + rb) <= reach - SLACK
        x, y, own_x = i[within], j[within], own[within]
        per_a, per_b = np.zeros(len(a.radius[level]), np.int64), np.zeros(len(b.radius[level]), np.int64)
        np.add.at(per_a, x, np.where(own_x, b.size[level][y] - 1, b.size[level][y]))
        np.add.at(per_b, y[~own_x], a.size[level][x[~own_x]])
        found[0] += per_a[a.node[level]]
        found[0 if same else 1] += per_b[b.node[level]]
        for tree, nodes, by, move in ((a, x, per_a, 0), (b, y, per_b, shift)):
            whole = np.zeros(len(by), dtype=bool)
            whole[nodes] = True
            rows = np.flatnonzero(whole[tree.node[level]])
            union.add(rows + move, tree.centers[level][tree.node[level][rows]] + move)
        union.add(a.centers[level][x], b.centers[level][y] + shift)
        return i[~within], j[~within]

    open_i, open_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    top = max(a.start(reach), b.start(reach))
    ca, cb, ra, rb = a.centers[top], b.centers[top], a.radius[top], b.radius[top]
    # single precision only rules out, by bounds widened for it; nodes of like radius share a bound
    ua, ub = a.u[ca].astype(np.float32), b.u[cb].astype(np.float32)
    by_radius = np.argsort(rb, kind="stable")
    limits = np.searchsorted(rb[by_radius], [1e-6, 0.125, 0.25, 0.5, 1.0], side="right")
    for start, stop in zip((0, *limits), (*limits, len(cb)), strict=True):
        part = by_radius[start:stop]
        if not len(part):
            continue
        widest = ra + rb[part[-1]] + reach + SLACK
        least = (1 - widest * widest / 2 - ROUGH).astype(np.float32)
        for first in range(0, len(ca), 1024):
            rough = ua[first : first + 1024] @ ub[part].T
            at = np.flatnonzero(rough >= least[first : first + 1024, None])
            i, j = first + at // len(part), part[at % len(part)]
            if same:
                i, j = i[i <= j], j[i <= j]
            for cut in range(0, len(i), PAIRS_AT_ONCE):
                x, y = i[cut : cut + PAIRS_AT_ONCE], j[cut : cut + PAIRS_AT_ONCE]
                x, y = settle(top, x, y, np.einsum("ij,ij->i", a.u[ca[x]], b.u[cb[y]]))
                open_i.append(x)
                open_j.append(y)
    for level in range(top, last):
        i, j = np.concatenate(open_i), np.concatenate(open_j)
        open_i, open_j = [i[:0]], [j[:0]]
        for x, y in _product(a.children[level], i, b.children[level], j):
            if same:
                # an own pair gives each pair of children twice
                parent = a.node[level]
                twice = (parent[a.centers[level + 1][x]] == parent[b.centers[level + 1][y]]) & (x > y)
                x, y = x[~twice], y[~twice]
            dots = np.einsum("ij,ij->i", a.u[a.centers[level + 1][x]], b.u[b.centers[level + 1][y]])
            x, y = settle(level + 1, x, y, dots)
            open_i.append(x)
            open_j.append(y)
    return found[0], found[1], union.label


def _links(cosine: float, width: int):
    def run(table: pa.Table) -> pa.Table:
        block = table["block"].to_numpy()
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        trees, names = [], []
        for side in (low,) if low == high else (low, high):
            part = table.filter(pa.array(block == side))
            order = np.argsort(part["pos"].to_numpy())
            part = part.take(pa.array(order))
            trees.append(Tree(vectors.unpacked(part["u"], width), vectors.unpacked(part["path"], len(RADII), np.int32)))
            names.append(part["vec_id"].to_numpy())
        same = low == high
        if len(trees[-1].u) == 0 or len(trees[0].u) == 0:
            return pa.table({"vec_id": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        na, nb, label = dual(trees[0], trees[-1], same, cosine)
        name, n = (names[0], na) if same else (np.concatenate(names), np.concatenate([na, nb]))
        hit = n > 0
        return pa.table({"vec_id": name[hit], "n": n[hit], "root": name[label][hit]})

    return run


def _tree(width: int):
    def run(table: pa.Table) -> pa.Table:
        u, name = vectors.unpacked(table["u"], width), table["vec_id"].to_numpy()
        rows = np.ascontiguousarray(np.column_stack([u, name.astype(np.int64).view(np.float64)])).view(np.int64)
        _, first = np.unique(rows, axis=0, return_index=True)
        order = first[np.lexsort((first, name[first]))]
        u, name = u[order], name[order]
        return pa.table(
            {
                "block": pa.array(np.full(len(u), table["block"][0].as_py(), dtype=np.int64)),
                "pos": pa.array(np.arange(len(u), dtype=np.int32)),
                "vec_id": pa.array(name),
                "u": vectors.packed(u),
                "path": vectors.packed(build(u)),
            }
        )

    return run


def assigned(embeddings: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    """``vec_id, cell, far, u``: unit vector, nearest pivot and the distance to it, of vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u = unit_rows(vectors.matrix(batch.column(1), width))
            good = np.flatnonzero(np.isfinite(u).all(axis=1))
            u = u[good]
            dots = u @ pivots.T
            cell = dots.argmax(axis=1)
            far = chord(dots[np.arange(len(u)), cell])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(good)), pa.array(cell.astype(np.int64)), pa.array(far), vectors.packed(u)],
                names=["vec_id", "cell", "far", "u"],
            )

    return embeddings.mapInArrow(run, "vec_id bigint, cell bigint, far double, u binary")


def link_counts(embeddings: DataFrame, cosine: float = 0.9) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every ``vec_id`` of ``embeddings(vec_id, embedding)``.

    The top of the tree is spread over the cluster: at most ``PIVOTS`` pivots, each vector in its nearest pivot's cell,
    cells cut into blocks of about ``BLOCK`` rows, which hold a cover tree each. Pairs of cells are pruned by their
    covering radii, pairs of blocks traversed together, one pair a step; links are counted in the step, so a large group of near-equal
    vectors costs no pairs.

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing. Shorter vectors are
    padded with zeros. Repeated equal rows of one ``vec_id`` count once; different vectors under one ``vec_id`` link on its behalf and can
    link with each other, and the id has one row. Null ids are left out. Other columns are not read.
    """
    if not 0 < cosine < 1:
        raise ValueError("cosine must lie between 0 and 1")
    source = embeddings.filter("vec_id IS NOT NULL").select(F.col("vec_id").cast("bigint"), "embedding")
    n, width = source.agg(F.count("*"), F.max(F.size("embedding"))).first()
    width = max(1, width or 1)
    plain = F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x))
    chosen = source.filter(plain).orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(PIVOTS, 1 + n // BLOCK)).toArrow()
    pivots = unit_rows(vectors.matrix(chosen["embedding"], width)) if len(chosen) else np.zeros((0, width))
    pivots = pivots[np.isfinite(pivots).all(axis=1)]
    pivots = pivots if len(pivots) else np.eye(1, width)
    placed = materialize(assigned(source, pivots, width), "cells")
    cells = {r[0]: r for r in placed.groupBy("cell").agg(F.count("*"), F.max("far")).collect()}
    apart, reach, base = chord(pivots @ pivots.T), float(np.sqrt(2 - 2 * cosine)), 0
    blocks = {}
    for cell in sorted(cells):
        blocks[cell] = (base, -(-cells[cell][1] // BLOCK))
        base += blocks[cell][1]
    near = [
        (c, *blocks[c], *blocks[o])
        for c in blocks
        for o in blocks
        if apart[c, o] <= cells[c][2] + cells[o][2] + reach + SLACK
    ]
    spark = embeddings.sparkSession
    schema = "cell bigint, base bigint, splits bigint, first bigint, others bigint"
    # at most PIVOTS * PIVOTS rows
    partners = spark.createDataFrame(near, schema)
    own = spark.createDataFrame([(c, *blocks[c]) for c in blocks], "cell bigint, base bigint, splits bigint")
    own_block = F.col("base") + F.pmod(F.xxhash64("vec_id"), F.col("splits"))
    dealt = placed.join(F.broadcast(own), "cell").select(own_block.alias("block"), "vec_id", "u")
    trees = materialize(
        dealt.groupBy("block").applyInArrow(_tree(width), "block bigint, pos int, vec_id bigint, u binary, path binary"),
        "trees",
    )
    ranges = F.sequence(F.col("first"), F.col("first") + F.col("others") - 1)
    pairs = partners.select(F.explode(F.sequence(F.col("base"), F.col("base") + F.col("splits") - 1)).alias("block"), ranges.alias("r"))
    pairs = pairs.select("block", F.explode("r").alias("other"))
    pairs = pairs.select("block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    steps = trees.join(pairs, "block").groupBy("low", "high")
    linked = materialize(steps.applyInArrow(_links(cosine, width), "vec_id bigint, n bigint, root bigint"), "links")
    groups = connected(linked.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    counts = linked.groupBy("vec_id").agg(F.sum("n").alias("n"))
    every = source.select("vec_id").distinct()
    out = every.join(counts, "vec_id", "left").join(groups.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        (component == F.col("vec_id")).alias("kept"),
    )
