"""Quality grades of documents by cumulative-link regression on hashed text."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from twinline.llm import textscan
from twinline.llm.batches import lean

# Rated documents that the model is fitted on, those of lowest hash: the bound of what the driver holds.
TRAINING_ROWS = 12000
# How many times as many are expected to pass the cheap choice by hash, ahead of the exact one.
MARGIN = 1.1
BUCKETS = 1 << 17
# Rated documents a feature must occur in.
LEAST_DOCUMENTS = 3
# Bytes of a word's beginning that are a feature of their own, for inflected forms.
STEM = 5
EPOCHS, BATCH, STEP, SHRINK = 12, 32, 0.15, 1e-3
# Start of the squared steps seen: keeps the first steps of rare features small.
DAMPING = 0.1
# Steps at least, also for few documents.
LEAST_STEPS = 3000
# Probability of the highest grade from which a document is kept.
KEEP = 0.5

_LETTERS = np.ones(256, dtype=bool)  # breaks: all but letters and bytes of other alphabets
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = False
_MARKS = np.ones(256, dtype=bool)  # breaks: all but ASCII punctuation
_MARKS[33:48] = _MARKS[58:65] = _MARKS[91:97] = _MARKS[123:127] = False


@dataclass(frozen=True)
class Model:
    """Shared weights of hashed features and ordered thresholds; ``P(grade >= k) = sigmoid(w.x - cuts[k - 1])``."""

    weights: np.ndarray
    cuts: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """Probabilities of at least grade 1, 2 and so on."""
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - score[:, None], -50, 50)))


def _level(share: np.ndarray) -> np.ndarray:
    """Shares from 0 to 1 in eleven steps."""
    return np.floor(np.clip(share, 0, 1) * 10).astype(np.uint64)


def features(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For ranges of whole texts: their number, feature ids, and the text of each; a feature counts once a text.

    Features are hashes of lower-cased words and of their beginnings, of runs of punctuation, and of levels of how much a text repeats itself, shouts, or is
    made of marks and digits.
    """
    raw, offsets = textscan.buffers(texts)
    for first, last in textscan.pieces(offsets):
        at = offsets[first : last + 1]
        part, n = raw[at[0] : at[-1]], last - first
        at = at - at[0]
        ids, docs = [], []
        if len(part):
            s, e, owner = textscan.edges(part, at, _LETTERS)
            words = textscan.run_hashes(part, s, e)
            ms, me, marked = textscan.edges(part, at, _MARKS)
            marks = textscan.run_hashes(part, ms, me)
            stems = textscan.run_hashes(part, s, np.minimum(e, s + STEM))
            ids += [words, textscan.mix(stems + np.uint64(7)), textscan.mix(marks + np.uint64(3))]
            docs += [owner, owner, marked]
        else:
            words, owner, marks, marked = (np.zeros(0, np.uint64), np.zeros(0, np.int64)) * 2
        count = np.bincount(owner, minlength=n)
        once = np.unique(words + textscan.mix(owner.astype(np.uint64) + np.uint64(1)), return_index=True)[1]
        distinct = np.bincount(owner[once], minlength=n)
        same = np.zeros(len(words), dtype=bool)
        same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
        place = np.repeat(np.arange(n), np.diff(at))
        upper = np.bincount(place[(part >= 65) & (part <= 90)], minlength=n)
        digits = np.bincount(place[(part >= 48) & (part <= 57)], minlength=n)
        size, some = np.maximum(1, np.diff(at)), np.maximum(1, count)
        levels = (
            distinct / some,
            np.bincount(owner[same], minlength=n) / some,
            np.bincount(marked, minlength=n) / some / 2,
            np.bincount(marked, weights=me - ms, minlength=n) / size * 3 if len(part) else size * 0.0,
            upper / size * 2,
            digits / size * 3,
            np.log1p(count) / 12,
        )
        for k, share in enumerate(levels):
            ids.append(textscan.mix(_level(share) + np.uint64(1000 * (k + 1))))
            docs.append(np.arange(n))
        bucket = (np.concatenate(ids) % np.uint64(BUCKETS)).astype(np.int64)
        pairs = np.unique(np.concatenate(docs) * BUCKETS + bucket)
        yield n, pairs % BUCKETS, pairs // BUCKETS


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for n, ids, docs in features(batch.column(2)):
            bounds = np.searchsorted(docs, np.arange(n + 1))
            found += [ids[a:b].astype("<u4").tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        part = pa.array(np.zeros(len(found), np.int32))
        columns = [part, batch.column(0), batch.column(1), pa.array(found, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "grade", "x"])


def train(x: list[np.ndarray], grade: np.ndarray) -> Model | None:
    """Maximum likelihood by adaptive steps over small batches; None with fewer than two grades."""
    kinds = int(grade.max(initial=0)) + 1
    if len(np.unique(grade)) < 2:
        return None
    spread = np.bincount(np.concatenate(x), minlength=BUCKETS)
    x = [ids[spread[ids] >= LEAST_DOCUMENTS] for ids in x]
    share = np.array([(grade >= k).mean() for k in range(1, kinds)]).clip(1e-3, 1 - 1e-3)
    weights, cuts = np.zeros(BUCKETS), np.sort(-np.log(share / (1 - share)))
    seen, seen_cuts = np.full(BUCKETS, DAMPING), np.full(len(cuts), DAMPING)
    random = np.random.default_rng(5)
    for _ in range(max(EPOCHS, math.ceil(LEAST_STEPS * BATCH / len(x)))):
        order = random.permutation(len(x))
        for first in range(0, len(order), BATCH):
            rows = order[first : first + BATCH]
            ids = np.concatenate([x[r] for r in rows])
            owner = np.repeat(np.arange(len(rows)), [len(x[r]) for r in rows])
            score = np.bincount(owner, weights=weights[ids], minlength=len(rows))
            tails = 1 / (1 + np.exp(np.clip(cuts[None, :] - score[:, None], -50, 50)))
            full = np.column_stack([np.ones(len(rows)), tails, np.zeros(len(rows))])
            y, at = grade[rows], np.arange(len(rows))
            chance = np.maximum(full[at, y] - full[at, y + 1], 1e-9)
            slope = full * (1 - full)
            pull = (slope[at, y] - slope[at, y + 1]) / chance  # of the log-likelihood, by score
            by_cut = np.zeros_like(full)
            by_cut[at, y] -= slope[at, y] / chance
            by_cut[at, y + 1] += slope[at, y + 1] / chance
            used, place = np.unique(ids, return_inverse=True)
            step = np.bincount(place, weights=pull[owner], minlength=len(used)) / len(rows) - SHRINK * weights[used]
            seen[used] += step * step
            weights[used] += STEP * step / np.sqrt(seen[used])
            step = by_cut[:, 1:-1].mean(axis=0)
            seen_cuts += step * step
            cuts = cuts + STEP * step / np.sqrt(seen_cuts)
            cuts = np.maximum.accumulate(cuts + 1e-3 * np.arange(len(cuts)))  # thresholds stay in order
    return Model(weights.astype(np.float32), cuts)


def fit(docs: DataFrame, ratings: DataFrame) -> Model | None:
    """A model of ``ratings(doc_id, grade)`` from the whole texts of ``docs``, on ``TRAINING_ROWS`` rated documents at most.

    These are the rated rows of lowest hash of the id, ties by id, grade and features, so the bound holds however often one id comes.
    They are brought together as hashed features and fitted in one task; only the model reaches the driver.
    Ratings of unknown documents, null or negative grades and null ids are left out; repeated ratings count each. None without two grades.
    """
    rated = ratings.filter("doc_id IS NOT NULL AND grade >= 0").select(F.col("doc_id").alias("rated"), F.col("grade").cast("int"))
    n = rated.count()
    lowest = F.xxhash64("rated") / 2.0**64 + 0.5 < min(1.0, MARGIN * TRAINING_ROWS / max(1, n))
    chosen = docs.join(rated.filter(lowest), F.col("doc_id") == F.col("rated"))
    rows = chosen.select(F.col("doc_id").cast("bigint"), "grade", F.col("text").cast("string"))
    hashed = rows.mapInArrow(lean(_hashed), "part int, doc_id bigint, grade int, x binary")
    sample = hashed.orderBy(F.xxhash64("doc_id"), "doc_id", "grade", "x").limit(TRAINING_ROWS)
    fitted = sample.groupBy("part").applyInArrow(_fitted, "weights binary, cuts binary").first()
    return Model(np.frombuffer(fitted.weights, dtype="<f4"), np.frombuffer(fitted.cuts, dtype="<f8")) if fitted else None


def _fitted(sample: pa.Table) -> pa.Table:
    """A row with the model of hashed rated documents, none without a model."""
    sample = sample.sort_by([("doc_id", "ascending"), ("grade", "ascending"), ("x", "ascending")])
    x = [np.frombuffer(v.as_buffer(), dtype="<u4").astype(np.int64) for v in sample["x"]]
    model = train(x, sample["grade"].to_numpy().astype(np.int64))
    found = [] if model is None else [model]
    weights = pa.array([m.weights.astype("<f4").tobytes() for m in found], pa.binary())
    return pa.table({"weights": weights, "cuts": pa.array([m.cuts.astype("<f8").tobytes() for m in found], pa.binary())})


def rate(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, expected_grade, tails, grade, kept`` for every row of ``docs(doc_id, text)``.

    ``tails`` are the probabilities of at least grade 1, 2 and so on; ``grade`` is the number of them of 0.5 or more, and a
    document is kept if its chance of the highest grade is at least ``KEEP``. Null text counts as empty, and is judged by the levels of an empty text. Repeated
    rows are rated each. Without a model grades are null and all is kept. Other columns are not read.
    """
    schema = "doc_id bigint, expected_grade double, tails array<double>, grade int, kept boolean"
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    if model is None:
        nothing = [F.lit(None).cast(t).alias(c) for c, t in (("expected_grade", "double"), ("tails", "array<double>"), ("grade", "int"))]
        return rows.select("doc_id", *nothing, F.lit(True).alias("kept"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [np.zeros(0)]
            for n, ids, owner in features(batch.column(1)):
                scores.append(np.bincount(owner, weights=model.weights[ids], minlength=n))
            tails = model.tails(np.concatenate(scores))
            grade = (tails >= 0.5).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(tails.sum(axis=1)),
                    pa.array(list(tails), pa.list_(pa.float64())),
                    pa.array(grade.astype(np.int32)),
                    pa.array(tails[:, -1] >= KEEP),
                ],
                names=["doc_id", "expected_grade", "tails", "grade", "kept"],
            )

    return rows.mapInArrow(lean(run), schema)


def select(docs: DataFrame, model: Model | None) -> DataFrame:
    """Rows of ``docs`` that ``rate`` keeps, with all columns, in one pass over the texts."""
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [np.zeros(0)]
            for n, ids, owner in features(batch.column(batch.schema.get_field_index("text"))):
                scores.append(np.bincount(owner, weights=model.weights[ids], minlength=n))
            yield batch.filter(pa.array(model.tails(np.concatenate(scores))[:, -1] >= KEEP))

    return docs.mapInArrow(lean(run), docs.schema)
