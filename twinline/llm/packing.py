"""Packing documents into training windows next to their lexical neighbours."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from twinline.llm.batches import lean, release
from twinline.sources.scratch import materialize

WINDOW = 2048
END_ID = 1
# Text bytes whose documents share one inverted index.
SHARD_BYTES = 4 << 20
# Terms are 16-bit token ids. KEYS terms of a document say where it goes; NONE stands for a missing one.
TERMS, KEYS, NONE = 1 << 16, 3, (1 << 16) - 1
# Bins of a hot key for each shard that it fills.
FAN = 8
# Terms of more than one in so many documents of a shard are rows of a matrix.
DENSE = 8
# The usual BM25 constants.
K1, B = 1.2, 0.75
# How byte-level BPE splits text before its merges (fixed value of that tokenizer family).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """The byte-level BPE model of a ``tokenizers`` file, run by tiktoken: the same ids, several times as fast."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("byte-bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)


def token_rows(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, size, tie, ids``: token ids of each row as unsigned 16-bit values with the end id last; its text's bytes
    plus 16; a hash of id, size and the row's place, which also tells repeats apart. Write it before use: the place is not stable."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(path)
        if encoder.n_vocab > TERMS:
            raise ValueError("token ids must fit into 16 bits")
        for batch in batches:
            held, size, first = [], 0, 0
            for i, text in enumerate(batch.column(3)):
                ids = np.append(encoder.encode_to_numpy(text.as_py() or "", allowed_special="all"), END_ID)
                held.append(ids.astype("<u2").tobytes())
                size += len(held[-1])
                if size > 32 << 20 or i + 1 == len(batch):
                    part = batch.slice(first, len(held))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[:3], pa.array(held, pa.binary())], names=["doc_id", "size", "tie", "ids"]
                    )
                    held, size, first = [], 0, i + 1

    text = F.col("text").cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)) + 16
    tie = F.pmod(F.xxhash64("doc_id", F.octet_length(text), F.monotonically_increasing_id()), F.lit((1 << 31) - 1))
    rows = docs.select(F.col("doc_id").cast("bigint"), size.cast("bigint").alias("size"), tie.cast("bigint").alias("tie"), text.alias("text"))
    return rows.mapInArrow(lean(run), "doc_id bigint, size bigint, tie bigint, ids binary")


def _ids(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype="<u2") for x in column]


def _summed(rows: DataFrame, bins: int, count) -> np.ndarray:
    """Sum over all batches of ``count(batch)``, an array of ``bins`` whole numbers; a worker sends its sums only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(bins, dtype=np.int64)
        for batch in batches:
            sums += count(batch)
        [at] = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[at], pa.int64())], names=["bin", "n"])

    out = np.zeros(bins, dtype=np.int64)
    for r in rows.mapInArrow(lean(run), "bin bigint, n bigint").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        out[r["bin"]] = r["n"]
    return out


def documents_of_terms(docs: list[np.ndarray]) -> np.ndarray:
    """Number of documents that hold each term."""
    distinct = [np.unique(ids[:-1]) for ids in docs]
    return np.bincount(np.concatenate(distinct), minlength=TERMS) if docs else np.zeros(TERMS, dtype=np.int64)


def ranks(spread: np.ndarray, n: int) -> np.ndarray:
    """Place of each term in one random order for the whole corpus, in which a term's chance to come before others is in
    proportion to its inverse document frequency. Terms of one document alone are last, as ``NONE``.

    Two documents have the same first term with the chance of their weighted Jaccard similarity (weighted MinHash).
    """
    draws = -np.log1p(-np.random.default_rng(0).random(TERMS)) / np.log1p(max(n, 1) / np.maximum(spread, 1))
    shared = np.flatnonzero(spread > 1)
    out = np.full(TERMS, NONE, dtype=np.uint16)
    out[shared[np.argsort(draws[shared], kind="stable")]] = np.arange(len(shared))
    return out


def first_terms(docs: list[np.ndarray], rank: np.ndarray) -> np.ndarray:
    """The ``KEYS`` lowest ranks of the terms of each document, ``NONE`` where it has fewer."""
    out = np.full((len(docs), KEYS), NONE, dtype=np.int64)
    if docs:
        lengths = np.array([len(ids) for ids in docs])
        starts = np.cumsum(lengths) - lengths
        flat = rank[np.concatenate(docs)]
        flat[starts + lengths - 1] = NONE  # the end id
        for k in range(KEYS):
            least = np.minimum.reduceat(flat, starts)
            out[:, k] = least
            flat[flat == np.repeat(least, lengths)] = NONE
    return out


class Shards:
    """Which shard a document goes to: by its first term; where that is hot (more than ``SHARD_BYTES``), by the bin of its
    next one too, and so on; equal in all ``KEYS`` and still hot, by the hash of id, size and place."""

    def __init__(self):
        self.bins = TERMS
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # first bin of the next level or -1, its bins, shard
        self.shards = 0

    def place(self, keys: np.ndarray, ties: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin of each document at the level after the last, -1 where it has its shard already; the shard."""
        at, shard = keys[:, 0].copy(), np.full(len(keys), -1, dtype=np.int64)
        for level, (base, fan, own) in enumerate(self.levels, 1):
            live = np.flatnonzero(at >= 0)
            here = at[live]
            mark = (keys[live, level] * 40503 & NONE) if level < KEYS else ties[live]
            done = base[here] < 0
            shard[live[done]] = own[here[done]]
            at[live] = np.where(done, -1, base[here] + mark % np.maximum(fan[here], 1))
        return at, shard

    def add(self, sizes: np.ndarray) -> bool:
        """Take the bytes of each bin of the next level; tells whether another level is needed."""
        last = len(self.levels) == KEYS
        hot = (sizes > SHARD_BYTES) & (not last)
        fan = np.where(hot, -(-sizes // SHARD_BYTES) * (1 if len(self.levels) == KEYS - 1 else FAN), 0)
        base = np.where(hot, np.cumsum(fan) - fan, -1)
        rest = np.where(hot, 0, sizes)
        # neighbouring bins fill a shard together; bins by hash of id have one each
        own = np.arange(len(sizes)) if last else (np.cumsum(rest) - rest // 2) // SHARD_BYTES
        self.levels.append((base, fan, own + self.shards))
        self.shards += int(own.max(initial=-1)) + 1
        self.bins = int(fan.sum())
        return self.bins > 0


def content_shards(rows: DataFrame) -> tuple[np.ndarray, Shards]:
    """Ranks of the terms of ``token_rows`` and the shards of about ``SHARD_BYTES`` for them.

    The driver gets at most one number for each term and bin.
    """
    n = rows.count()
    rank = ranks(_summed(rows.select("ids"), TERMS, lambda batch: documents_of_terms(_ids(batch.column(0)))), n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = first_terms(_ids(batch.column(2)), rank)
            columns = [*batch.columns[:2], *(pa.array(keys[:, k]) for k in range(KEYS))]
            yield pa.RecordBatch.from_arrays(columns, names=["size", "tie", *(f"k{k}" for k in range(KEYS))])

    schema = ", ".join(["size bigint", "tie bigint", *(f"k{k} bigint" for k in range(KEYS))])
    keyed = materialize(rows.select("size", "tie", "ids").mapInArrow(lean(run), schema), "shard-keys")
    shards, more = Shards(), True
    while more:

        def count(batch: pa.RecordBatch, shards: Shards = shards) -> np.ndarray:
            size, tie, *keys = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            at, _ = shards.place(np.stack(keys, axis=1), tie)
            live = at >= 0
            sums = np.zeros(shards.bins, dtype=np.int64)
            np.add.at(sums, at[live], size[live])
            return sums

        more = shards.add(_summed(keyed, shards.bins, count))
    return rank, shards


def sharded(rows: DataFrame, rank: np.ndarray, shards: Shards) -> DataFrame:
    """``shard, doc_id, ids`` of ``token_rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, shard = shards.place(first_terms(_ids(batch.column(2)), rank), batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), batch.column(0), batch.column(2)], names=["shard", "doc_id", "ids"]
            )

    return rows.select("doc_id", "tie", "ids").mapInArrow(lean(run), "shard int, doc_id bigint, ids binary")


class Index:
    """BM25 over the documents of one shard; terms are token ids. Documents of one name are repeats."""

    def __init__(self, docs: list[np.ndarray], names: np.ndarray | None = None):
        n = len(docs)
        self.names = np.arange(n) if names is None else names
        terms, owner, counts = [], [], []
        for d, ids in enumerate(docs):
            t, c = np.unique(ids[:-1], return_counts=True)
            terms.append(t)
            counts.append(c)
            owner.append(np.full(len(t), d))
        self.n = n
        term, count, doc = (np.concatenate(x) if n else np.zeros(0, int) for x in (terms, counts, owner))
        self.own = np.append(0, np.cumsum([len(t) for t in terms]))
        lengths = np.array([max(1, len(d) - 1) for d in docs], dtype=np.float64)
        spread = np.bincount(term, minlength=1 << 16)
        idf = np.log1p((n - spread + 0.5) / (spread + 0.5))
        norm = K1 * (1 - B + B * lengths / lengths.mean()) if n else lengths
        weight = idf[term] * count * (K1 + 1) / (count + norm[doc])
        # terms of many documents as rows of a matrix, which add up faster than postings do
        frequent = np.flatnonzero(spread * DENSE > n)
        self.row = np.full(TERMS, -1, dtype=np.int64)
        self.row[frequent] = np.arange(len(frequent))
        self.dense = np.zeros((len(frequent), n), dtype=np.float32)
        many = self.row[term] >= 0
        self.dense[self.row[term[many]], doc[many]] = weight[many]
        few = np.flatnonzero(~many)
        order = few[np.argsort(term[few], kind="stable")]
        self.doc, self.weight = doc[order], weight[order]
        self.starts = np.append(0, np.cumsum(np.where(self.row >= 0, 0, spread)))
        self.own_terms = term.astype(np.int64)

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document against all terms of ``seed``; 0 for the seed and its repeats."""
        terms = self.own_terms[self.own[seed] : self.own[seed + 1]]
        if not len(terms):
            return np.zeros(self.n)
        rows = self.row[terms]
        out = self.dense[rows[rows >= 0]].sum(axis=0, dtype=np.float64)
        terms = terms[rows < 0]
        first, n = self.starts[terms], self.starts[terms + 1] - self.starts[terms]
        at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        out += np.bincount(self.doc[at], weights=self.weight[at], minlength=self.n)
        out[self.names == self.names[seed]] = 0
        return out


def fill_windows(lengths: list[int], index: Index, window: int) -> Iterator[tuple[int, int, int, int, int]]:
    """``doc, start, length, sequence, offset`` of every piece.

    A window opens with what is left of the last document, its seed; unused documents that score best against the
    seed (or else the next in order) follow until it is full, the last one cut. What remains at the end is cut into
    powers of two, so nothing is padded.
    """
    n, unused = len(lengths), np.ones(len(lengths), dtype=bool)
    following, sequence, filled, seed, scores = 0, 0, 0, -1, None
    pending: list[tuple[int, int, int, int]] = []  # of the open window: doc, start, length, offset

    def choose() -> int:
        nonlocal following, seed, scores
        if seed >= 0:
            if scores is None:
                scores = index.scores(seed)
                scores[~unused] = 0
            best = int(np.argmax(scores))
            if scores[best] > 0:
                return best
        while not unused[following]:
            following += 1
        return following

    for _ in range(n):
        doc = choose()
        unused[doc] = False
        if scores is not None:
            scores[doc] = 0
        start = 0
        if seed < 0:
            seed, scores = doc, None
        while start < lengths[doc]:
            part = min(lengths[doc] - start, window - filled)
            pending.append((doc, start, part, filled))
            start, filled = start + part, filled + part
            if filled == window:
                yield from ((d, s, m, sequence, o) for d, s, m, o in pending)
                pending, filled, sequence = [], 0, sequence + 1
                seed, scores = (doc, None) if start < lengths[doc] else (-1, None)
    edge = 0
    while pending:  # cut the rest at the largest power of two that fits
        size = 1 << ((filled - edge).bit_length() - 1)
        rest = []
        for doc, start, part, offset in pending:
            inside = min(part, edge + size - offset)
            if inside > 0:
                yield doc, start, inside, sequence, offset - edge
            if inside < part:
                cut = max(inside, 0)
                rest.append((doc, start + cut, part - cut, offset + cut))
        pending, edge, sequence = rest, edge + size, sequence + 1


def _pack(window: int):
    def run(table: pa.Table) -> pa.Table:
        release()
        order = np.lexsort((np.arange(len(table)), table["doc_id"].to_numpy(zero_copy_only=False)))
        table = table.take(pa.array(order))
        shard = table["shard"][0].as_py()
        docs = _ids(table["ids"])
        lengths = [len(d) for d in docs]
        names = table["doc_id"].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy().astype(np.int64)
        names = np.where(names < 0, -1 - np.arange(len(names)), names)  # rows without an id repeat none
        rows = list(fill_windows(lengths, Index(docs, names), window))
        doc, start, length, sequence, offset = (np.array(x, dtype=np.int64) for x in zip(*rows, strict=True))
        crc = [zlib.crc32(docs[d][s : s + m].astype("<u4").tobytes()) for d, s, m, _, _ in rows]
        return pa.table(
            {
                "doc_id": table["doc_id"].combine_chunks().take(pa.array(doc)),
                "start": start,
                "length": length,
                "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": np.array(lengths, dtype=np.int64)[doc],
                "sequence_id": sequence + (shard << 32),
                "offset": offset,
            }
        )

    return run


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """Pieces of every row of ``docs(doc_id, text)`` in sequences of at most ``window`` tokens.

    Rows go by content (``Shards``) to shards of about ``SHARD_BYTES`` of text (one long text can be more), so that similar
    texts tend to share one; each shard is a BM25 inverted index that hands out unused neighbours (``fill_windows``). A
    neighbour in another shard is out of reach. A row's tokens are its text's ids and the end id; null and empty texts
    have that id alone. Repeated rows are packed each on its own, with their ids' order, and are not neighbours of each
    other; a null ``doc_id`` stays null. Sequences are full, or at the end of a shard a power of two long. No rows
    give no pieces. Other columns are not read.
    """
    tokens = materialize(token_rows(docs, tokenizer_path), "token-ids")
    rows = sharded(tokens, *content_shards(tokens))
    schema = (
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    )
    return rows.groupBy("shard").applyInArrow(_pack(window), schema)
