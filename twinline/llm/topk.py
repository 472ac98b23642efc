"""Exact top-k inner products by norm-sorted scans with rotated partial sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from twinline.llm import vectors
from twinline.sources.scratch import materialize

# Ranges of candidate lengths at most.
RANGES = 256
# Candidates and queries of one step of the search.
CANDIDATES = 4096
QUERIES = 4096
# Longest candidates that give every query its first bound: the bound of what the driver holds.
SEEDS = 2048
# Candidates scanned between two looks at the bounds.
STRIDE = 512
# Sums of integer products below it are exact in doubles.
EXACT = 2.0**53
# Part of a bound that rounding may take.
SLACK = 1e-6


def scaled(embeddings: DataFrame, scale: int, repeats: int = 1) -> DataFrame:
    """``vec_id, v, n2``: integer components and squared length of the vectors that take part.

    Equal rows stay up to ``repeats`` times: more of them can't be among that many best.
    """
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = embeddings.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").filter(finite)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    rows = kept.select(F.col("vec_id").cast("bigint"), whole.alias("v")).groupBy("vec_id", "v").agg(F.count("*").alias("times"))
    n2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    again = F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(repeats), "times")))
    return rows.select("vec_id", "v", n2.alias("n2"), again.alias("time"))


def gram(rows: DataFrame, width: int) -> np.ndarray:
    """Sum of outer products; each partition sends ``width`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = vectors.matrix(batch.column(0), width)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "g"]
        )

    parts = rows.select("v").mapInArrow(run, "i bigint, g array<double>")
    summed = parts.select("i", F.posexplode("g").alias("j", "g")).groupBy("i", "j").agg(F.sum("g").alias("g")).toArrow()
    out = np.zeros((width, width))
    out[summed["i"].to_numpy(), summed["j"].to_numpy()] = summed["g"].to_numpy()
    return out


def rotation(g: np.ndarray) -> np.ndarray:
    """Right singular vectors of the data, the strongest direction first."""
    if not np.isfinite(g).all():
        return np.eye(len(g))
    return np.linalg.eigh(g)[1][:, ::-1]


def exact_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows."""
    if np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * q.shape[1] < EXACT:
        return (q @ c.T).astype(np.int64)
    return q.astype(np.int64) @ c.astype(np.int64).T


class Best:
    """The k best of each query so far, ties to the smaller id, and the score a newcomer must reach."""

    def __init__(self, bounds: np.ndarray, k: int):
        self.k, self.bounds, self.rows = k, bounds.astype(np.float64).copy(), [np.zeros((3, 0), dtype=np.int64)]

    def add(self, query: np.ndarray, name: np.ndarray, score: np.ndarray) -> None:
        self.rows.append(np.stack([query, name, score]))

    def settle(self) -> np.ndarray:
        q, name, score = np.concatenate(self.rows, axis=1)
        order = np.lexsort((name, -score, q))
        q, name, score = q[order], name[order], score[order]
        first = np.searchsorted(q, q)
        rank = np.arange(len(q)) - first
        kept = rank < self.k
        last = rank == self.k - 1
        self.bounds[q[last]] = np.maximum(self.bounds[q[last]], score[last])
        self.rows = [np.stack([q[kept], name[kept], score[kept]])]
        return self.rows[0]


def scan(q: np.ndarray, q_names: np.ndarray, bounds: np.ndarray, c: np.ndarray, c_names: np.ndarray, turn: np.ndarray, k: int) -> np.ndarray:
    """``query, name, score`` rows that can be among the k best, from candidates in order of descending length.

    A query stops where its length times the candidate's falls below its bound. Before whole products, sums over the leading rotated
    components plus the product of the lengths of the rest (Cauchy-Schwarz) rule pairs out.
    """
    order = np.argsort(-(c * c).sum(axis=1), kind="stable")
    c, c_names = c[order], c_names[order]
    lead = max(1, len(turn) // 4)
    rq, rc = q @ turn, c @ turn
    norm_q, norm_c = np.sqrt((q * q).sum(axis=1)), np.sqrt((c * c).sum(axis=1))
    rest_q = np.sqrt(np.maximum(0, (rq[:, lead:] ** 2).sum(axis=1)))
    rest_c = np.sqrt(np.maximum(0, (rc[:, lead:] ** 2).sum(axis=1)))
    best = Best(bounds, k)
    for first in range(0, len(c), STRIDE):
        part = slice(first, first + STRIDE)
        slack = SLACK * (1 + norm_q * norm_c[first])
        live = np.flatnonzero(norm_q * norm_c[first] + slack >= best.bounds)
        if not len(live):
            break
        upper = rq[live, :lead] @ rc[part, :lead].T + rest_q[live, None] * rest_c[None, part] + slack[live, None]
        open_pairs = upper >= best.bounds[live, None]
        some, cols = open_pairs.any(axis=1), np.flatnonzero(open_pairs.any(axis=0)) + first
        live = live[some]
        if len(live) and len(cols):
            score = exact_products(q[live], c[cols])
            i, j = np.nonzero((score >= best.bounds[live, None]) & (q_names[live][:, None] != c_names[cols][None, :]))
            best.add(live[i], c_names[cols[j]], score[i, j])
            best.settle()
    return best.settle()


def _search(width: int, turn: np.ndarray, k: int):
    def run(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy(zero_copy_only=False)
        x, name = vectors.matrix(table["v"], width), table["vec_id"].to_numpy()
        bounds = table["bound"].to_numpy(zero_copy_only=False)[asks]
        found = scan(x[asks], name[asks], bounds, x[~asks], name[~asks], turn, k)
        return pa.table({"query_id": name[asks][found[0]], "vec_id": found[1], "score": found[2]})

    return run


def _first_bounds(seeds: np.ndarray, seed_names: np.ndarray, width: int, k: int):
    """The k-th best score of each query among the longest candidates, which its true k-th best can't be below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, name = vectors.matrix(batch.column(1), width), vectors.ids(batch.column(0))
            bound = np.full(len(q), -np.inf)
            if len(seeds) > k:
                for first in range(0, len(q), 1024):
                    part = slice(first, first + 1024)
                    score = exact_products(q[part], seeds).astype(np.float64)
                    score[name[part][:, None] == seed_names[None, :]] = -np.inf
                    bound[part] = np.partition(score, len(seeds) - k, axis=1)[:, len(seeds) - k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bound)], names=["vec_id", "v", "n2", "time", "bound"])

    return run


class Ranges:
    """Candidates by descending length in at most ``RANGES`` ranges; what is kept of each is its size and greatest length."""

    def __init__(self, rows: DataFrame, n: int):
        count = max(1, min(RANGES, -(-n // CANDIDATES)))
        cuts = rows.agg(F.percentile_approx("n2", [i / count for i in range(1, count)], 10_000)).first()[0] if count > 1 else []
        self.cuts = sorted(set(cuts or []))
        found = rows.groupBy(self.of("n2").alias("range")).agg(F.count("*"), F.max("n2")).collect()
        size, longest = {r[0]: r[1] for r in found}, {r[0]: r[2] for r in found}
        every = range(max(size, default=0) + 1)
        self.blocks = [-(-size.get(i, 0) // CANDIDATES) for i in every]
        self.longest = [longest.get(i, 0.0) for i in every]

    def of(self, n2: str) -> Column:
        """Range of a squared length, the longest vectors in range 0."""
        return F.size(F.filter(_numbers(self.cuts), lambda cut: cut > F.col(n2)))

    def reached(self) -> Column:
        """Last range that holds a vector whose length times the query's can reach the query's ``bound``."""
        product = lambda n2: F.sqrt(n2 * F.col("n2"))
        near = F.filter(_numbers(self.longest), lambda n2: product(n2) + SLACK * (1 + product(n2)) >= F.col("bound"))
        return F.greatest(F.lit(0), F.size(near) - 1)


def _numbers(values: list) -> Column:
    return F.array(*[F.lit(float(v)) for v in values]).cast("array<double>")


def _before(counts: list[int]) -> list[int]:
    """Blocks of the earlier entries for every entry, then all."""
    return [sum(counts[:i]) for i in range(len(counts) + 1)]


def _at(values: list[int], place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), place + 1)


def _upto(first: Column | int, end: Column | int) -> Column:
    """A row for every block from ``first`` on, ``end`` left out; none if there is none."""
    first, last = (F.lit(x) if isinstance(x, int) else x for x in (first, end))
    return F.explode(F.when(first < last, F.sequence(first, last - 1)).otherwise(F.array().cast("array<int>")))


def exact_topk(embeddings: DataFrame, is_query: str, k: int = 20, scale: int = 64) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` other vectors of highest integer inner product for every query.

    Components are taken times ``scale``, rounded down; ``is_query`` is a condition on ``vec_id``. Ties go to the
    smaller ``vec_id``; with fewer candidates all are given. Candidates lie in blocks by range of length, the longest first. A bound
    from the ``SEEDS`` longest vectors tells how many ranges a query can need (Cauchy-Schwarz), and queries lie in blocks by that number:
    pairs of blocks beyond it never meet. A pair that does is a step, which scans its candidates by descending length
    (``scan``) and returns at most ``k`` rows a query; these are ranked by query.

    Vectors that are null or hold null or non-finite components take no part, nor do null ids. Shorter vectors are
    padded with zeros, an empty one scores 0. Every row is a candidate, repeated rows and different vectors of one ``vec_id`` too, except
    for queries of the same ``vec_id``; where several rows ask under one ``vec_id``, the ``k`` highest of all their scores count.
    Scores are exact while they fit a long. Other columns are not read.
    """
    rows = materialize(scaled(embeddings, scale, k), "scaled")
    n, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    width = max(1, width or 1)
    turn = rotation(gram(rows, width))
    longest = rows.orderBy(F.desc("n2"), "vec_id").limit(SEEDS).select("vec_id", "v").toArrow()
    seeds, seed_names = vectors.matrix(longest["v"], width), longest["vec_id"].to_numpy()
    ranges = Ranges(rows, n)
    asked = rows.filter(is_query).select("vec_id", "v", "n2", "time").mapInArrow(
        _first_bounds(seeds, seed_names, width, k), "vec_id bigint, v array<bigint>, n2 double, time bigint, bound double"
    )
    asked = materialize(asked.withColumn("reach", ranges.reached()), "queries")
    asking = {r["reach"]: r["count"] for r in asked.groupBy("reach").count().collect()}
    q_blocks = [-(-asking.get(i, 0) // QUERIES) for i in range(len(ranges.blocks))]
    q_first, c_first = _before(q_blocks), _before(ranges.blocks)
    spread = F.xxhash64("vec_id", "v", "time")
    qb = _at(q_first, F.col("reach")) + F.pmod(spread, F.greatest(F.lit(1), _at(q_blocks, F.col("reach")))).cast("int")
    q_side = asked.select(
        qb.alias("qb"), _upto(0, _at(c_first, F.col("reach") + 1)).alias("cb"), F.lit(True).alias("asks"), "vec_id", "v", "bound"
    )
    own = ranges.of("n2")
    cb = _at(c_first, own) + F.pmod(spread, F.greatest(F.lit(1), _at(ranges.blocks, own))).cast("int")
    c_side = rows.select(
        _upto(_at(q_first, own), q_first[-1]).alias("qb"), cb.alias("cb"), F.lit(False).alias("asks"), "vec_id", "v",
        F.lit(None).cast("double").alias("bound"),
    )
    steps = q_side.unionByName(c_side).groupBy("qb", "cb")
    found = steps.applyInArrow(_search(width, turn, k), "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
