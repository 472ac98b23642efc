"""Near-duplicate documents by MinHash, odd sketches and exact confirmation."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from twinline.llm import textscan
from twinline.llm.batches import lean
from twinline.llm.components import connected
from twinline.sources.scratch import materialize

# MinHash samples per document; bands of ROWS samples are candidate keys, all samples fold into the sketch.
SAMPLES = 128
ROWS = 4
SKETCH_BITS = 512
# Chance that a pair exactly at the threshold shares no band.
MISSED = 1e-7
# Rows of a bucket, and rows and bytes of a candidate group, compared in one step; larger ones become a grid of such.
BUCKET_ROWS = 1024
GROUP_ROWS = 256
GROUP_BYTES = 16 << 20
_FACTORS = (np.random.default_rng(7).integers(0, 2**32, SAMPLES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_ONES = np.array([bin(i).count("1") for i in range(1 << 16)], dtype=np.uint8)


def bands(threshold: float) -> int:
    """Bands needed to miss a pair at ``threshold`` with a chance of at most ``MISSED``."""
    needed = math.ceil(math.log(MISSED) / math.log1p(-(threshold**ROWS)))
    if needed * ROWS > SAMPLES:
        raise ValueError(f"a similarity of {threshold} needs more than {SAMPLES} samples")
    return needed


def minhash(shingles: np.ndarray) -> np.ndarray:
    """The smallest image of a set under each of ``SAMPLES`` maps."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, 2**32 - 1, dtype=np.uint32)
    for first in range(0, len(short), 512):
        np.minimum(least, (short[first : first + 512, None] * _FACTORS).min(axis=0), out=least)
    return least


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parities of how many samples fall on each bit, 64 bits a word: equal samples cancel out under XOR."""
    places = textscan.mix(samples.astype(np.uint64) + (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)))
    odd = np.bincount((places % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def differing_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _ONES[np.bitwise_xor(a, b).view(np.uint16)].sum(axis=-1, dtype=np.int64)


def estimate(differing: np.ndarray) -> np.ndarray:
    """Similarity from the population count of the XOR of two sketches."""
    share = np.minimum(2 * differing / SKETCH_BITS, 1 - 1e-9)
    return 1 + SKETCH_BITS / (4 * SAMPLES) * np.log1p(-share)


def most_differing(threshold: float) -> int:
    """Bits two sketches at ``threshold`` differ in, plus six standard deviations of samples and folding."""
    differ = 2 * SAMPLES * (1 - threshold)
    bits = SKETCH_BITS / 2 * -math.expm1(-2 * differ / SKETCH_BITS)
    spread = math.sqrt(4 * SAMPLES * threshold * (1 - threshold) + SKETCH_BITS / 4)
    return math.ceil(bits + 6 * spread)


def sketch_documents(docs: DataFrame, width: int, threshold: float) -> DataFrame:
    """``doc_id, n_shingles, d1, d2, bytes, sketch, keys``: set size, digest of the set, sketch and band keys."""
    n_bands = bands(threshold)
    salts = np.random.default_rng(11).integers(1, 2**63, (n_bands, ROWS), dtype=np.uint64) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            count = np.zeros(len(texts), dtype=np.int64)
            digest = np.zeros((2, len(texts)), dtype=np.uint64)
            sketches, keys = [], []
            for i, shingles in enumerate(textscan.shingle_sets(texts, width)):
                count[i] = len(shingles)
                if not len(shingles):
                    sketches.append(None)
                    keys.append([])
                    continue
                digest[0, i] = shingles.sum(dtype=np.uint64)
                digest[1, i] = np.bitwise_xor.reduce(textscan.mix(shingles + np.uint64(1)))
                samples = minhash(shingles)
                sketches.append(odd_sketch(samples).tobytes())
                band = (samples[: n_bands * ROWS].reshape(n_bands, ROWS).astype(np.uint64) * salts).sum(axis=1, dtype=np.uint64)
                keys.append(textscan.mix(band).view(np.int64))
            _, at = textscan.buffers(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(count),
                    pa.array(digest[0].view(np.int64)),
                    pa.array(digest[1].view(np.int64)),
                    pa.array(np.diff(at)),
                    pa.array(sketches, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "d1", "d2", "bytes", "sketch", "keys"],
            )

    schema = "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, bytes bigint, sketch binary, keys array<bigint>"
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(lean(run), schema)


def grid(df: DataFrame, blocks: str, key: str) -> DataFrame:
    """Each row once for every pair of blocks its own block is part of, as ``ci, cj`` (``ci <= cj``) and ``block``."""
    dealt = df.withColumn("block", F.pmod(F.xxhash64(key), F.col(blocks).cast("bigint")).cast("int"))
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)))
    return other.withColumns({"ci": F.least("block", "other"), "cj": F.greatest("block", "other")}).drop("other")


def spanning(linked: np.ndarray) -> np.ndarray:
    """Smallest reachable index for every index of a symmetric boolean matrix."""
    n = len(linked)
    label = np.full(n, -1)
    for root in range(n):
        if label[root] >= 0:
            continue
        label[root] = root
        front = np.array([root])
        while len(front):
            reached = linked[front].any(axis=0) & (label < 0)
            front = np.flatnonzero(reached)
            label[front] = root
    return label


def similar_components(sketches: np.ndarray, most: int) -> np.ndarray:
    """Components of rows whose sketches differ in at most ``most`` bits; a row is compared with unreached rows only."""
    n = len(sketches)
    label = np.full(n, -1)
    left = np.arange(n)
    while len(left):
        root, left = left[0], left[1:]
        label[root] = root
        front = [root]
        while front and len(left):
            near = differing_bits(sketches[front.pop()], sketches[left]) <= most
            label[left[near]] = root
            front.extend(left[near])
            left = left[~near]
    return label


def _bucket_edges(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            done, rest = _whole_groups(rest)
            if done is not None:
                yield from emit(done)
        if rest is not None and len(rest):
            yield from emit(rest)

    def emit(table: pa.Table) -> Iterator[pa.RecordBatch]:
        cells, rep = _cells(table), table["rep"].to_numpy()
        words = np.frombuffer(b"".join(table["sketch"].to_pylist()), dtype=np.uint64).reshape(len(rep), -1)
        starts = np.append(np.flatnonzero(np.append(True, cells[1:] != cells[:-1])), len(cells))
        sizes = np.diff(starts)
        found = []
        # small buckets: neighbours at every distance up to 7, all buckets at once
        cell_no = np.repeat(np.arange(len(sizes)), sizes)
        small = sizes[cell_no] <= 8
        for step in range(1, 8):
            both = np.flatnonzero(small[:-step] & (cell_no[:-step] == cell_no[step:]))
            if len(both):
                near = both[differing_bits(words[both], words[both + step]) <= most]
                found.append(np.stack([rep[near], rep[near + step]]))
        for cell in np.flatnonzero(sizes > 8):
            a, b = starts[cell], starts[cell + 1]
            roots = similar_components(words[a:b], most)
            moved = roots != np.arange(b - a)
            found.append(np.stack([rep[a:b][moved], rep[a:b][roots[moved]]]))
        pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    return run


def _cells(table: pa.Table) -> np.ndarray:
    """One hash for the bucket and grid cell of each row."""
    key = table["key"].to_numpy().astype(np.int64).view(np.uint64)
    cell = table["ci"].to_numpy().astype(np.uint64) * np.uint64(1 << 32) + table["cj"].to_numpy().astype(np.uint64)
    return textscan.mix(key) + textscan.mix(cell + np.uint64(1))


def _whole_groups(table: pa.Table) -> tuple[pa.Table | None, pa.Table]:
    """Rows of finished buckets, and the rows of the last one, which may go on in the next batch."""
    cells = _cells(table)
    other = np.flatnonzero(cells != cells[-1])
    if not len(other):
        return None, table
    cut = int(other[-1]) + 1
    return table.slice(0, cut), table.slice(cut)


def candidate_groups(reps: DataFrame, threshold: float) -> DataFrame:
    """``node, component``: sets that share a band and whose sketches allow the threshold, transitively.

    A bucket of any size is compared completely: its rows are dealt to blocks of about ``BUCKET_ROWS`` and each pair of
    blocks is one task's step. Only a spanning forest of each step is kept, never its pairs.
    """
    keyed = reps.select("rep", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    placed = keyed.join(shared, "key").join(reps.select("rep", "sketch"), "rep")
    blocks = F.ceil(F.col("size") / BUCKET_ROWS).cast("int")
    cells = grid(placed.withColumn("blocks", blocks), "blocks", "rep")
    dealt = cells.select("key", "ci", "cj", "rep", "sketch").repartition("key", "ci", "cj")
    ordered = dealt.sortWithinPartitions("key", "ci", "cj", "rep")
    found = ordered.mapInArrow(_bucket_edges(most_differing(threshold)), "a bigint, b bigint")
    return connected(found)


def _confirm(width: int, percent: int):
    """Links of one cell of a group, by intersections of the whole sets."""

    def run(table: pa.Table) -> pa.Table:
        rep = table["rep"].to_numpy()
        order = np.argsort(rep, kind="stable")
        rep = rep[order]
        sets = list(textscan.shingle_sets(table["text"].combine_chunks(), width))
        sets = [sets[i] for i in order]
        linked = links(sets, percent)
        roots = spanning(linked)
        moved = roots != np.arange(len(rep))
        return pa.table({"a": rep[moved], "b": rep[roots[moved]]})

    return run


def links(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets have ``100 * intersection >= percent * union``; empty sets link with nothing."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    common = np.zeros((n, n), dtype=np.int64)
    if n <= 8:
        for i in range(n):
            for j in range(i + 1, n):
                if 100 * min(sizes[i], sizes[j]) >= percent * max(sizes[i], sizes[j]):
                    common[i, j] = common[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
    else:
        values = np.concatenate(sets)
        owner = np.repeat(np.arange(n), sizes)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        fresh = np.append(True, values[1:] != values[:-1])
        column = np.cumsum(fresh) - 1
        twice = np.bincount(column)[column] > 1
        owner, column = owner[twice], np.cumsum(fresh[twice]) - 1
        width = 8192
        bounds = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else 0) + 1 + width, width))
        for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            has = np.zeros((n, width), dtype=np.float32)
            has[owner[a:b], column[a:b] - k * width] = 1
            common += (has @ has.T).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - common
    linked = (100 * common >= percent * union) & (sizes[:, None] > 0) & (sizes[None, :] > 0)
    np.fill_diagonal(linked, False)
    return linked


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every ``doc_id`` of ``docs(doc_id, text)``.

    Documents with ``100 * intersection >= percent * union`` of their sets of ``width``-word shingles (A-Z lower-cased,
    words split at ASCII white space) are linked; ``component_id`` is the smallest ``doc_id`` reachable.

    1. Equal sets form a class, whose smallest document stands for it.
    2. Classes that share a band of MinHash samples and whose odd sketches allow the threshold (six standard deviations
       of slack) form candidate groups.
    3. Inside a group the whole sets are compared. Groups beyond ``GROUP_ROWS`` or ``GROUP_BYTES`` become a grid of blocks, one pair of
       blocks a step, so that no task holds a group of unbounded size; links are kept as spanning forests.

    A pair exactly at the threshold is missed with a chance of ``MISSED`` (no shared band). Null or empty texts have no
    shingles and stay alone. Repeated rows of one ``doc_id`` give one row; different texts under one ``doc_id`` are all
    compared and share that document's row, with the size of the largest set. Null ids are left out. Other columns are
    not read.
    """
    source = docs.filter("doc_id IS NOT NULL")
    sketched = materialize(sketch_documents(source, width, percent / 100), "sketches")
    digest = ["d1", "d2", "n_shingles"]
    # the smallest document of each class with its sketch: copies fall away before the shuffle
    least = F.min(F.struct("doc_id", "bytes", "sketch", "keys")).alias("least")
    reps = sketched.filter("n_shingles > 0").groupBy(*digest).agg(least)
    carried = [F.col(f"least.{c}").alias(c) for c in ("bytes", "sketch", "keys")]
    reps = materialize(reps.select(F.col("least.doc_id").alias("rep"), *digest, *carried), "classes")
    groups = materialize(candidate_groups(reps, percent / 100), "candidate-groups")
    sized = groups.join(reps.select("rep", "bytes"), F.col("node") == F.col("rep"))
    totals = sized.groupBy("component").agg(F.count("*").alias("size"), F.sum("bytes").alias("total"))
    blocks = F.ceil(F.greatest(F.col("size") / GROUP_ROWS, F.col("total") / GROUP_BYTES)).cast("int")
    members = groups.join(totals.withColumn("blocks", blocks), "component")
    texts = source.select(F.col("doc_id").cast("bigint").alias("node"), "text").join(members, "node")
    cells = grid(texts.withColumnRenamed("node", "rep"), "blocks", "rep")
    confirmed = cells.select("component", "ci", "cj", "rep", "text").groupBy("component", "ci", "cj").applyInArrow(
        _confirm(width, percent), "a bigint, b bigint"
    )
    linked = connected(confirmed)
    named = sketched.join(reps.select("rep", *digest), digest, "left").select(
        "doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep")
    )
    whole = named.join(linked.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id")
    )
    one = whole.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"), F.min("component_id").alias("component_id"))
    return one.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that a smaller ``doc_id`` stands for; rows without an id stay."""
    dropped = near_duplicates(docs, width, percent).filter("NOT kept").select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
