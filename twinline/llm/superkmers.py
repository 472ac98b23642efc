"""Repeated passages by super-k-mers: consecutive windows that share a minimiser travel together to the minimiser's bucket."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from twinline.llm import textscan
from twinline.llm.batches import lean, release
from twinline.sources.scratch import materialize

# Words whose hash orders the places of a window; the smallest is its minimiser.
SEED_WORDS = 4
# Bytes of text per bucket, on average.
BUCKET_BYTES = 8 << 20
# Bytes of super-k-mers gathered before a task hands them on, a row for each bucket.
HELD_BYTES = 32 << 20
# Windows of a super-k-mer at most; a longer run of one minimiser goes on in the next.
RUN = 1024
# A minimiser of more than one in so many super-k-mers, and of more than BUSY, has its windows dealt out one by one.
SHARE = 8192
BUSY = 2000
KEY_BYTES = 16
# Of the compression of packed strings on their way.
LEVEL = 5
BLOBS = "bucket bigint, heads binary, meta binary, refs binary, keys binary, strings binary, sizes array<int>"


class Runs(NamedTuple):
    """Super-k-mers of some texts, one entry each."""

    packed: bytes  # all words of the texts, one space between words of a text
    lead: np.ndarray  # minimiser
    doc: np.ndarray  # text it lies in
    at: np.ndarray  # its first word in the text
    first: np.ndarray  # its first window among the words of all texts
    last: np.ndarray  # the window after its last one
    loose: np.ndarray  # whether one of its windows may equal another one of it
    starts: np.ndarray  # byte where each word starts, of all texts
    ends: np.ndarray
    hashes: np.ndarray  # of each window


def squeezed(raw: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words ``raw[s:e]`` with one space where white space followed, and where each now starts."""
    keep = ~textscan.WHITE[raw]
    followed = e[e < len(raw)]
    keep[followed] = True
    out = raw[keep]
    out[textscan.WHITE[out]] = 32
    return out, (np.cumsum(keep) - 1)[s]


def runs(texts: pa.Array, width: int) -> Iterator[tuple[int, Runs]]:
    """For ranges of texts the first text and the super-k-mers of their ``width``-word windows; every window lies in exactly one."""
    if width <= SEED_WORDS:
        raise ValueError(f"width must be over {SEED_WORDS}")
    raw, offsets = textscan.buffers(texts)
    for low, high in textscan.pieces(offsets):
        at = offsets[low : high + 1]
        part = raw[at[0] : at[-1]]
        if not len(part):
            continue
        s, e, doc = textscan.edges(part, at - at[0])
        if len(s) < width:
            continue
        words = textscan.run_hashes(part, s, e, fold=False)
        seeds = np.zeros(len(words) - SEED_WORDS + 1, dtype=np.uint64)
        for k in range(SEED_WORDS):
            seeds += words[k : k + len(seeds)] * textscan.PLACES[k]
        seeds = textscan.mix(seeds)
        inner = width - SEED_WORDS + 1
        lead = textscan.sliding_least(seeds, inner)
        whole = doc[: len(lead)] == doc[width - 1 :]
        local = np.arange(len(doc)) - np.searchsorted(doc, doc)
        fresh = np.ones(len(lead), dtype=bool)
        fresh[1:] = (lead[1:] != lead[:-1]) | ~whole[:-1]
        fresh |= local[: len(lead)] % RUN == 0
        fresh &= whole
        first = np.flatnonzero(fresh)
        stops = np.flatnonzero(fresh | ~whole)
        last = np.append(stops, len(lead))[np.searchsorted(stops, first, side="right")]
        # equal windows of one run have the minimiser at two places of it, so some seed of it comes twice in the text
        order = np.argsort(seeds, kind="stable")
        twin = (seeds[order[1:]] == seeds[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
        twice = np.zeros(len(seeds) + 1, dtype=np.int64)
        twice[order[1:][twin] + 1] = 1
        twice[order[:-1][twin] + 1] = 1
        twice = np.cumsum(twice)
        loose = twice[last - 1 + inner] > twice[first]
        packed, starts = squeezed(part, s, e)
        yield (
            low,
            Runs(
                packed.tobytes(),
                textscan.mix(lead[first]),  # minima are small numbers; spread them again
                doc[first],
                local[first],
                first,
                last,
                loose,
                starts,
                starts + (e - s),
                textscan.window_hashes(words, width),
            ),
        )


def distinct_texts(batch: pa.RecordBatch) -> tuple[list[bytes], pa.Array, np.ndarray]:
    """Keys and texts of ``batch(key, text)``, copies once, and how often each comes."""
    keys = batch.column(0).to_pylist()
    place: dict[bytes, int] = {}
    row = [place.setdefault(k, len(place)) for k in keys]
    texts = batch.column(1)
    if len(place) < len(row):
        texts = texts.take(pa.array(np.unique(row, return_index=True)[1]))
    return list(place), texts, np.bincount(row, minlength=len(place))


def _frequent(width: int):
    """Minimisers of more than half the allowed share of a partition, and in a row without one the partition's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leads, counts, size = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            _, texts, _ = distinct_texts(batch)
            size += texts.nbytes
            found = [r.lead for _, r in runs(texts, width)]
            fresh, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
            leads, at = np.unique(np.concatenate([leads, fresh]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n]), len(leads)).astype(np.int64)
        total = int(counts.sum())
        often = (counts > total / (2 * SHARE)) & (counts > 1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None, *leads[often].view(np.int64).tolist()], pa.int64()),
                pa.array([total, *counts[often].tolist()], pa.int64()),
                pa.array([size] + [0] * int(often.sum()), pa.int64()),
            ],
            names=["lead", "n", "bytes"],
        )

    return run


def frequent_minimisers(texts: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """Minimisers of more than one in ``SHARE`` super-k-mers, ``SHARE`` of them at most, and the bytes of all texts."""
    parts = texts.mapInArrow(lean(_frequent(width)), "lead bigint, n bigint, bytes bigint")
    summed = materialize(parts.groupBy("lead").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")), "minimisers")
    whole = summed.filter("lead IS NULL").first()
    if whole is None:
        return np.zeros(0, np.uint64), 0
    least = max(BUSY, whole["n"] // SHARE)
    hot = [r.lead for r in summed.filter(F.col("lead").isNotNull() & (F.col("n") > least)).select("lead").collect()]
    return np.sort(np.array(hot, dtype=np.int64).view(np.uint64)), whole["bytes"]


class Held:
    """Super-k-mers of a task on their way to the buckets; equal strings are held once, with the places they come from."""

    def __init__(self) -> None:
        self.index: dict[bytes, int] = {}
        self.heads = array("Q")
        self.counts = array("q")
        self.loose = array("b")
        # of each place: its string, text and first word
        self.string, self.text, self.at = array("i"), array("i"), array("i")
        self.keys: list[bytes] = []
        self.size = 0

    def add(self, string: bytes, head: int, times: int, loose: bool, key: int, at: int) -> None:
        i = self.index.setdefault(string, len(self.heads))
        if i == len(self.heads):
            self.heads.append(head)
            self.counts.append(0)
            self.loose.append(loose)
            self.size += len(string)
        self.counts[i] += times
        self.string.append(i)
        self.text.append(key)
        self.at.append(at)

    def blobs(self, buckets: int) -> Iterator[pa.RecordBatch]:
        """A row for each bucket that something goes to."""
        if not self.heads:
            return
        codec = pa.Codec("zstd", compression_level=LEVEL)
        heads, counts, loose = np.array(self.heads), np.array(self.counts), np.array(self.loose)
        owner = np.array(self.string)
        number = np.bincount(owner, minlength=len(heads))
        begin = np.cumsum(number) - number
        places = np.argsort(owner, kind="stable")
        refs = np.stack([np.array(self.text)[places], np.array(self.at)[places]], axis=1)
        bucket = heads % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        bounds = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0))
        strings = list(self.index)
        for chosen in np.split(order, bounds[1:]):
            text = [strings[i] for i in chosen.tolist()]
            n = number[chosen]
            meta = np.stack([list(map(len, text)), counts[chosen], loose[chosen], 2 * n], axis=1)
            part = refs[np.repeat(begin[chosen] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            used, part[:, 0] = np.unique(part[:, 0], return_inverse=True)
            raw = [meta.astype(np.int32).tobytes(), part.tobytes(), b"".join(text)]
            row = [
                pa.array([int(bucket[chosen[0]])], pa.int64()),
                pa.array([(heads[chosen] >> np.uint64(32)).astype(np.uint32).tobytes()], pa.binary()),
                pa.array([codec.compress(raw[0], asbytes=True)], pa.binary()),
                pa.array([codec.compress(raw[1], asbytes=True)], pa.binary()),
                pa.array([b"".join(self.keys[k] for k in used)], pa.binary()),
                pa.array([codec.compress(raw[2], asbytes=True)], pa.binary()),
                pa.array([list(map(len, raw))], pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(row, names=["bucket", "heads", "meta", "refs", "keys", "strings", "sizes"])


def _dealt(width: int, hot: np.ndarray, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, texts, times = distinct_texts(batch)
            held = Held()
            held.keys = keys
            for low, r in runs(texts, width):
                common = np.isin(r.lead, hot)
                begin, end = r.starts[r.first], r.ends[r.last + width - 2]
                doc = r.doc + low
                columns = (r.lead, begin, end, doc, times[doc], r.at, r.loose, common, r.first, r.last)
                for lead, a, b, d, n, at, loose, busy, i, j in zip(*(c.tolist() for c in columns), strict=True):
                    if not busy:
                        held.add(r.packed[a:b], lead, n, loose, d, at)
                        continue
                    for k in range(i, j):
                        held.add(r.packed[r.starts[k] : r.ends[k + width - 1]], int(r.hashes[k]), n, False, d, at + k - i)
                if held.size > HELD_BYTES:
                    yield from held.blobs(buckets)
                    held = Held()
                    held.keys = keys
            yield from held.blobs(buckets)

    return run


class Bucket:
    """All super-k-mers of a bucket, as far as one of their windows can come twice."""

    def __init__(self, table: pa.Table) -> None:
        codec = pa.Codec("zstd")
        rows = table.to_pylist()
        heads = [np.frombuffer(r["heads"], dtype=np.uint32) for r in rows]
        metas = [
            np.frombuffer(codec.decompress(r["meta"], r["sizes"][0], asbytes=True), dtype=np.int32).reshape(-1, 4).astype(np.int64)
            for r in rows
        ]
        weights = np.concatenate([m[:, 1] for m in metas])
        _, same = np.unique(np.concatenate(heads), return_inverse=True)
        shared = (np.bincount(same, weights)[same] > 1) | (np.concatenate([m[:, 2] for m in metas]) > 0)
        strings: list[bytes] = []
        counts, key, at, refs = [], [], [], []
        done = 0
        for r, meta in zip(rows, metas, strict=True):
            live = np.flatnonzero(shared[done : done + len(meta)])
            done += len(meta)
            if not len(live):
                continue
            text = codec.decompress(r["strings"], r["sizes"][2], asbytes=True)
            ends = np.cumsum(meta[:, 0])
            strings += [text[a:b] for a, b in zip((ends - meta[:, 0])[live].tolist(), ends[live].tolist(), strict=True)]
            counts.append(meta[live, 1])
            places = np.frombuffer(codec.decompress(r["refs"], r["sizes"][1], asbytes=True), dtype=np.int32).reshape(-1, 2)
            chosen = np.repeat(np.isin(np.arange(len(meta)), live), meta[:, 3] // 2)
            key.append(np.frombuffer(r["keys"], dtype=f"V{KEY_BYTES}")[places[chosen, 0]])
            at.append(places[chosen, 1])
            refs.append(meta[live, 3] // 2)
        self.strings = strings
        self.counts = np.concatenate([np.zeros(0, np.int64), *counts])
        self.refs = np.concatenate([np.zeros(0, np.int64), *refs])
        self.key = np.concatenate([np.zeros(0, f"V{KEY_BYTES}"), *key])
        self.at = np.concatenate([np.zeros(0, np.int64), *at]).astype(np.int64)

    def repeated(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """String and place in it of each window whose words come more than once in the bucket, in order."""
        sizes = np.array(list(map(len, self.strings)), dtype=np.int64)
        offsets = np.append(0, np.cumsum(sizes))
        raw = b"".join(self.strings)
        data = np.frombuffer(raw, dtype=np.uint8)
        parts = []
        for low, high in textscan.pieces(offsets):
            edge = offsets[low : high + 1]
            s, e, owner = textscan.edges(data[edge[0] : edge[-1]], edge - edge[0])
            hashes = textscan.window_hashes(textscan.run_hashes(data[edge[0] : edge[-1]], s, e, fold=False), width)
            inside = np.flatnonzero(owner[: len(hashes)] == owner[width - 1 :])
            local = inside - np.searchsorted(owner, owner[inside])
            parts.append((owner[inside] + low, local, hashes[inside], s[inside] + edge[0], e[inside + width - 1] + edge[0]))
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        owner, local, hashes, begin, end = map(np.concatenate, zip(*parts, strict=True))
        marked = repeats(raw, hashes, begin, end, self.counts[owner])
        return owner[marked], local[marked]

    def spans(self, width: int) -> pa.Table:
        """Ranges of words that lie in repeated windows, for every text that holds them."""
        owner, local = self.repeated(width)
        fresh = np.ones(len(owner), dtype=bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (local[1:] > local[:-1] + width)
        head = np.flatnonzero(fresh)
        tail = np.append(head[1:], len(owner))[: len(head)] - 1
        string = owner[head]
        # one row for each place the string comes from
        n = self.refs[string]
        place = np.repeat((np.cumsum(self.refs) - self.refs)[string], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        key = self.key[place]
        first = self.at[place] + np.repeat(local[head], n)
        last = self.at[place] + np.repeat(local[tail] + width, n)
        half = key.view(np.uint64).reshape(-1, 2)
        order = np.lexsort((last, first, half[:, 1], half[:, 0]))
        columns = np.stack([half[:, 0], half[:, 1], first.astype(np.uint64), last.astype(np.uint64)], axis=1)[order]
        once = order[np.append(True, (columns[1:] != columns[:-1]).any(axis=1))[: len(order)]]
        return pa.table({"key": pa.array(key[once].tolist(), pa.binary()), "first": first[once], "last": last[once]})


def repeats(raw: bytes, hashes: np.ndarray, begin: np.ndarray, end: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which windows ``raw[begin:end]`` come more than once, each counted ``counts`` times.

    They are sorted by hash; where several share one, their words are compared, and sorted if they are not all the same.
    """
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    head = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])[: len(ranked)])
    sizes = np.diff(np.append(head, len(ranked)))
    total = np.add.reduceat(counts[order], head) if len(head) else np.zeros(0, np.int64)
    marked = np.zeros(len(order), dtype=bool)
    alone = (sizes == 1) & (total > 1)
    marked[order[head[alone]]] = True
    several = sizes > 1
    for a, n in zip(head[several].tolist(), sizes[several].tolist(), strict=True):
        members = order[a : a + n].tolist()
        words = [raw[begin[i] : end[i]] for i in members]
        if words.count(words[0]) == n:
            marked[members] = True
            continue
        ranks = sorted(range(n), key=words.__getitem__)
        at = 0
        while at < n:
            to = at + 1
            while to < n and words[ranks[to]] == words[ranks[at]]:
                to += 1
            same = [members[k] for k in ranks[at:to]]
            if counts[same].sum() > 1:
                marked[same] = True
            at = to
    return marked


def text_key(text: Column) -> Column:
    """128 bits of a text's SHA-256."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 2 * KEY_BYTES))


def repeated_spans(docs: DataFrame, width: int) -> DataFrame:
    """``key, spans``: ranges of words of each distinct text that lie in windows that come more than once."""
    texts = docs.filter("text IS NOT NULL").select(text_key(F.col("text")).alias("key"), "text")
    hot, size = frequent_minimisers(texts, width)
    buckets = max(1, -(-size // BUCKET_BYTES))
    dealt = texts.mapInArrow(lean(_dealt(width, hot, buckets)), BLOBS)

    def count(table: pa.Table) -> pa.Table:
        release()
        return Bucket(table).spans(width)

    found = dealt.groupBy("bucket").applyInArrow(count, "key binary, first bigint, last bigint")
    return found.groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("spans"))


def without(text: bytes, spans: list[dict] | None) -> tuple[int, int, str]:
    """Words of a text, how many of them the spans cover, and the others joined by one space."""
    words = text.split()
    removed, at, kept = 0, 0, []
    for first, last in sorted((s["first"], s["last"]) for s in spans or ()):
        first = max(first, at)
        if last > first:
            kept += words[at:first]
            removed += last - first
            at = last
    kept += words[at:]
    return len(words), removed, b" ".join(kept).decode()


def remove_repeats(docs: DataFrame, width: int = 35) -> DataFrame:
    """``doc_id, n_words, n_removed, text`` for every row of ``docs(doc_id, text)``, without the words of repeated passages.

    Words are runs without ASCII white space. A window is ``width`` consecutive words of a text; every word goes that lies
    in a window whose words also start anywhere else, in the same text or another. ``text`` holds the other words, joined by one space.

    1. Consecutive windows whose smallest hash of ``SEED_WORDS`` words is the same form a super-k-mer. It travels as one
       packed string to the bucket of that minimiser, so equal windows meet and every window travels once. Tasks hold
       equal strings once, with all their places.
    2. In a bucket only super-k-mers of shared minimisers are opened. Their windows are sorted by hash and confirmed by their words.
    3. The ranges found go back to their texts by the text's digest.

    A minimiser that fills more than one in ``SHARE`` super-k-mers (boilerplate before ever other texts) would fill one
    task; its windows are dealt out one by one, by all their words. At most ``SHARE`` of them reach the driver. Buckets
    grow in number with the text, not in size.

    Every row counts as a document: repeated rows and copies repeat each other and lose all words if they have ``width``
    of them. Null, empty and shorter texts keep every word, a null text has none and gives an empty text; null ids stay. Other columns
    are not read, whatever their names.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # texts too short for a window get different keys, so that many empty ones do not meet in one task
    short = F.coalesce(F.octet_length("text"), F.lit(0)) < 2 * width - 1
    key = F.when(short, text_key(F.concat(F.lit("short:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))).otherwise(text_key(F.col("text")))
    # written apart from the join: an exchange of its own lets Spark split a digest that many copies share
    spans = materialize(repeated_spans(rows, width), "repeated-spans")
    joined = rows.withColumn("key", key).join(spans, "key", "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            done = [without(t.as_py() or b"", s.as_py()) for t, s in zip(texts, batch.column(2), strict=True)]
            n, removed, text = zip(*done, strict=True) if done else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(text, pa.string())],
                names=["doc_id", "n_words", "n_removed", "text"],
            )

    return joined.mapInArrow(lean(run), "doc_id bigint, n_words bigint, n_removed bigint, text string")
