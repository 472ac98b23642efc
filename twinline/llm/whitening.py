"""Embedding whitening: blockwise QR of centred rows, then an accurate decomposition of the small triangle that remains."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from twinline.llm import bidiagonal, vectors
from twinline.sources.scratch import materialize

# Partial results merged in one step.
FAN = 32
# Larger integers count as not finite: their products with row counts would not fit a long.
LARGEST = float(2**40)
# Rows reduced by one QR.
BLOCK = 2048

Merge = Callable[[list[bytes]], bytes]


def integers(embedding: Column, scale: int, offset: int, width: int) -> Column:
    """``floor(scale * c) + offset`` of each component; components that are missing at the end count as zero."""
    whole = F.transform(embedding, lambda c: F.floor(c.cast("double") * scale) + offset)
    return F.concat(whole, F.array_repeat(F.lit(offset).cast("bigint"), width - F.size(embedding)))


def usable(embedding: Column, scale: int) -> Column:
    bad = F.exists(embedding, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double") * scale) > LARGEST))
    return embedding.isNotNull() & ~F.coalesce(bad, F.lit(True))


def folded(rows: DataFrame, partial: Callable[[Iterator[np.ndarray]], bytes], merge: Merge, width: int, label: str) -> bytes | None:
    """One partial result per partition of ``rows(x)``, merged ``FAN`` at a time by Spark until few are left; None without rows."""

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = (vectors.matrix(b.column(0), width) for b in batches if b.num_rows)
        first = next(blocks, None)
        if first is not None:
            state = partial(_chained(first, blocks))
            yield pa.RecordBatch.from_arrays([pa.array([state], pa.binary())], names=["state"])

    def together(table: pa.Table) -> pa.Table:
        table = table.sort_by("slot")
        return pa.table({"slot": table["slot"][:1].cast(pa.int32()), "state": pa.array([merge(table["state"].to_pylist())], pa.binary())})

    parts = rows.mapInArrow(summarize, "state binary").select(F.spark_partition_id().alias("slot"), "state")
    parts = materialize(parts, label)
    while parts.count() > FAN:
        dealt = parts.select(F.floor(F.col("slot") / FAN).cast("int").alias("slot"), "state")
        parts = materialize(dealt.groupBy("slot").applyInArrow(together, "slot int, state binary"), label)
    left = [r.state for r in parts.orderBy("slot").collect()]
    return merge(left) if left else None


def _chained(first: np.ndarray, rest: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    for block in (b for part in ([first], rest) for b in part):
        for at in range(0, len(block), BLOCK):
            yield block[at : at + BLOCK]


def _wide(values: list[int]) -> bytes:
    return b"".join(int(v).to_bytes(24, "little", signed=True) for v in values)


def _unwide(state: bytes) -> list[int]:
    return [int.from_bytes(state[i : i + 24], "little", signed=True) for i in range(0, len(state), 24)]


def exact_sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows and exact sum of each dimension."""

    def partial(blocks: Iterator[np.ndarray]) -> bytes:
        total = [0] * (width + 1)
        for block in blocks:
            sums = block.astype(np.int64).sum(axis=0)
            total = [t + int(s) for t, s in zip(total, [len(block), *sums], strict=True)]
        return _wide(total)

    def merge(states: list[bytes]) -> bytes:
        return _wide([sum(v) for v in zip(*map(_unwide, states), strict=True)])

    state = folded(rows, partial, merge, width, "sums")
    n, *sums = _unwide(state) if state else [0] * (width + 1)
    return n, sums


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums``, exact, as 64-bit integers where they fit and else as Python's."""
    largest = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0)
    if largest < 2**62:
        return x.astype(np.int64) * n - np.array(sums, dtype=np.int64)
    return x.astype(np.int64).astype(object) * n - np.array(sums, dtype=object)


def squared_length(d: np.ndarray) -> list[int]:
    """Exact sum of squares of each row."""
    largest = max((abs(int(v)) for v in (d.min(initial=0), d.max(initial=0))), default=0)
    if d.dtype != object and largest**2 * max(1, d.shape[1]) < 2**63:
        return (d * d).sum(axis=1).tolist()
    return [sum(int(v) ** 2 for v in row) for row in d]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (deviations(x, n, sums) / n).astype(np.float64)


def triangle(rows: DataFrame, width: int, n: int, sums: list[int]) -> np.ndarray:
    """``R`` of the QR decomposition of all centred rows: blocks, partitions and groups of partitions are reduced in turn."""

    def reduced(stack: list[np.ndarray]) -> np.ndarray:
        return np.linalg.qr(np.concatenate(stack), mode="r")

    def partial(blocks: Iterator[np.ndarray]) -> bytes:
        r = np.zeros((0, width))
        for block in blocks:
            r = reduced([r, centred(block, n, sums)])
        return r.tobytes()

    def merge(states: list[bytes]) -> bytes:
        return reduced([np.frombuffer(s).reshape(-1, width) for s in states]).tobytes()

    state = folded(rows, partial, merge, width, "triangle")
    r = np.frombuffer(state).reshape(-1, width)
    return np.concatenate([r, np.zeros((width - len(r), width))])


def covariance(rows: DataFrame, width: int, n: int, sums: list[int], directions: np.ndarray) -> np.ndarray:
    """Covariance of the projected rows, with divisor ``n``; blocks are centred before they are multiplied, then combined."""
    k = directions.shape[1]

    def pack(count: int, mean: np.ndarray, product: np.ndarray) -> bytes:
        return np.concatenate([[float(count)], mean, product.ravel()]).tobytes()

    def unpack(state: bytes) -> tuple[float, np.ndarray, np.ndarray]:
        flat = np.frombuffer(state)
        return flat[0], flat[1 : k + 1], flat[k + 1 :].reshape(k, k)

    def merge(states: list[bytes]) -> bytes:
        count, mean, product = 0.0, np.zeros(k), np.zeros((k, k))
        for more, its_mean, its_product in map(unpack, states):
            apart = its_mean - mean
            both = count + more
            product = product + its_product + np.outer(apart, apart) * (count * more / both)
            mean = mean + apart * (more / both)
            count = both
        return pack(count, mean, product)

    def partial(blocks: Iterator[np.ndarray]) -> bytes:
        state = None
        for block in blocks:
            z = centred(block, n, sums) @ directions
            mean = z.mean(axis=0)
            fresh = pack(len(z), mean, (z - mean).T @ (z - mean))
            state = fresh if state is None else merge([state, fresh])
        return state

    count, _, product = unpack(folded(rows, partial, merge, width, "covariance"))
    return product / count


def whiten(rows: DataFrame, components: int = 16, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """``vec_id, n, deviation, whitened, explained, identity_error`` for every usable row of ``rows(vec_id, embedding)``.

    Components become integers ``x = floor(scale * c) + offset``. The ``n`` distinct x vectors are fitted: their exact sums
    S, the triangle R of a blockwise QR of ``x - S / n``, its Householder bidiagonal form, singular values by dqds and
    right vectors by twisted factorisations. ``whitened`` holds up to ``components`` projections over the square roots of
    the eigenvalues of the covariance, ``explained`` their shares of its trace, ``deviation`` is the sum of
    ``(n * x - S)^2`` as an exact decimal(38,0). ``identity_error`` is the largest entry of the whitened rows' covariance
    over the fitted rows less the identity, measured in a pass of its own.

    What reaches the driver is bounded by the dimension: S, R and the final covariance, merged ``FAN`` at a time in Spark.

    Rows whose vector is null or holds null, NaN, infinite components (or ones beyond 2^40 / scale) are left out. Shorter vectors count as
    filled up with zeros, an empty one too. Every other row, repeated or of null id, has its own result; copies are fitted
    once. A direction without any variance (fewer distinct vectors than components, constant columns) has share 0 and a null projection, and
    does not count in the error. No rows, or only empty vectors, give no rows. Other columns are not read.
    """
    kept = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").filter(usable(F.col("embedding"), scale))
    width = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    schema = "vec_id bigint, n bigint, deviation decimal(38,0), whitened array<double>"
    if not width:
        nothing = rows.sparkSession.createDataFrame([], schema)
        return nothing.withColumns({"explained": F.array().cast("array<double>"), "identity_error": F.lit(0.0)})
    whole = kept.select("vec_id", integers(F.col("embedding"), scale, offset, width).alias("x"))
    fit = materialize(whole.select("x").distinct(), "fit-list")
    n, sums = exact_sums(fit, width)
    values, right, total = bidiagonal.decompose(triangle(fit, width, n, sums), components)
    positive = int((values > 8 * width * np.finfo(np.float64).eps * values[0]).sum()) if values[0] > 0 else 0
    # values are singular values of the centred rows: the covariance's eigenvalues are their squares over n
    directions = right[:, :positive] / (values[:positive] / np.sqrt(n))
    explained = [float(v) ** 2 / total if i < positive else 0.0 for i, v in enumerate(values)]
    error = 0.0
    if positive:
        error = float(np.abs(covariance(fit, width, n, sums, directions) - np.eye(positive)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = pa.decimal128(38, 0)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                d = deviations(vectors.matrix(part.column(1), width), n, sums)
                lengths = squared_length(d)
                z = (d / n).astype(np.float64) @ directions
                flat = pa.array(np.pad(z, ((0, 0), (0, len(values) - positive)), constant_values=np.nan).ravel(), from_pandas=True)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * len(values), pa.int32()), flat)
                small = max(lengths, default=0) < 2**63
                exact = pa.array(lengths, pa.int64()).cast(wide) if small else _decimals(lengths, wide)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.full(len(z), n)), exact, lists], names=["vec_id", "n", "deviation", "whitened"]
                )

    shares = F.array(*map(F.lit, explained))
    return whole.mapInArrow(project, schema).withColumns({"explained": shares, "identity_error": F.lit(error)})


def _decimals(values: list[int], kind: pa.DataType) -> pa.Array:
    from decimal import Context, Decimal

    context = Context(prec=38)
    return pa.array([context.create_decimal(Decimal(v)) for v in values], kind)


def per_component(whitened: DataFrame) -> DataFrame:
    """One row for each vector and component, numbered from 1."""
    both = F.arrays_zip("whitened", "explained")
    spread = whitened.select("vec_id", F.posexplode(both).alias("at", "of"), "n", "deviation", "identity_error")
    return spread.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        F.col("of.whitened").alias("whitened"),
        F.col("of.explained").alias("explained"),
        "identity_error",
    )
