"""Corpus BLEU (Papineni et al. 2002) with the mteval-v13a tokenizer and exponential smoothing (Post 2018).

Counting n-grams is a multiset intersection per sentence. It runs on Arrow batches, a block of sentences at a time: tokens
become integers once, an n-gram is the pair of the (n-1)-gram before it and its last token, and only n-grams whose
(n-1)-gram matched are ranked at all. The job is narrow; nine sums leave a batch.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from twinline.functions import chars

# Ship this module's functions with the job, so workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Longest n-gram; the tokenizer's plain replacements in order, the characters that are tokens of their own,
# and the two that are unless they stand between digits.
ORDER = 4
PLAIN = (("<skipped>", ""), ("-\n", ""), ("\n", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"))
SYMBOLS = "!\"#$%&()*+/:;<=>?@[\\]^_`{|}~"
POINTS = ".,"
# Bytes of sentences counted at once; one longer sentence is counted alone.
BLOCK_BYTES = 1 << 20
SUMS = [f"matched_{n}" for n in range(1, ORDER + 1)] + [f"total_{n}" for n in range(1, ORDER + 1)] + ["ref_total_1"]


def _listed(characters: str) -> np.ndarray:
    """Whether a byte is one of these ASCII characters."""
    table = np.zeros(256, dtype=bool)
    table[list(characters.encode())] = True
    return table


def _breaks(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Before which bytes (and, at the end, after the last one) a token ends inside a text; ``first``, ``last`` mark the bytes at texts' ends.

    The tokenizer is stated as replacements from left to right, each of which uses up what it matched. What they
    come to: symbols stand alone; so does a dash after a digit. In a run of points every one stands apart from the next.
    Before the run there is a break unless a single point stands between digits; after it, before a digit, there is one
    only where the pairs (any but a digit, point) that the left-to-right scan forms use up the run's last point.
    """
    n = len(data)
    digit = (data >= 48) & (data <= 57)
    other_before, other_after = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
    other_before[1:] = ~digit[:-1] | first[1:]
    other_after[:-1] = ~digit[1:] | last[:-1]
    alone = _listed(SYMBOLS)[data] | ((data == 45) & ~other_before)
    out = np.zeros(n + 1, dtype=bool)
    out[:-1] |= alone
    out[1:] |= alone
    point = _listed(POINTS)[data]
    goes_on = np.zeros(n, dtype=bool)
    goes_on[1:] = point[1:] & point[:-1] & ~first[1:]
    out[:-1] |= goes_on
    head = np.flatnonzero(point & ~goes_on)
    stop = np.append(goes_on[1:], False)
    tail = np.flatnonzero(point & ~stop)
    length = tail - head + 1
    out[head] |= other_before[head] | other_after[tail] | (length > 1)
    out[tail + 1] |= other_after[tail] | ((length + other_before[head]) % 2 == 0)
    return out


def tokenized(texts: pa.Array, blanks: str) -> tuple[pa.Array, np.ndarray]:
    """Tokens of all texts in order, and the text each belongs to; null is empty. ``blanks`` is the inside of a character class."""
    for old, new in PLAIN:
        texts = pc.replace_substring(texts, old, new)
    texts = pc.fill_null(pc.replace_substring_regex(texts, f"[{blanks}]", " "), "").cast(pa.large_binary())
    _, offsets, raw = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(raw, dtype=np.uint8)[at[0] : at[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = at - at[0]
    first, last = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
    filled = at[:-1] < at[1:]
    first[at[:-1][filled]] = True
    last[at[1:][filled] - 1] = True
    inside = data != 32
    breaks = _breaks(data, first, last)
    start = inside & (first | breaks[:-1])
    start[1:] |= inside[1:] & ~inside[:-1]
    starts = np.flatnonzero(start)
    # the bytes of the tokens, next to each other
    begin = (np.cumsum(inside) - inside)[starts]
    ends = np.append(begin, inside.sum()).astype(np.int64)
    tokens = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data[inside].tobytes())])
    return tokens, np.searchsorted(at[1:], starts, side="right")


def block_sums(hyp: pa.Array, ref: pa.Array, blanks: str) -> np.ndarray:
    """``SUMS`` over the sentences of two equally long arrays."""
    n = len(hyp)
    tokens, text = tokenized(pa.concat_arrays([hyp, ref]), blanks)
    encoded = tokens.dictionary_encode()
    word = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    is_ref = text >= n
    matched, total = [0] * ORDER, [0] * ORDER
    alive = np.arange(len(word))  # where an n-gram starts whose (n-1)-gram is on both sides
    gram = np.where(is_ref, text - n, text)  # of each place so far: what tells its (n-1)-gram and sentence apart
    for k in range(ORDER):
        whole = text[: max(0, len(text) - k)] == text[k:]
        total[k] = int((whole & ~is_ref[: len(whole)]).sum())
        alive = alive[alive < len(whole)]
        alive = alive[whole[alive]]
        _, rank = np.unique(gram[alive] * len(encoded.dictionary) + word[alive + k], return_inverse=True)
        sides = [np.bincount(rank[is_ref[alive] == side], minlength=len(alive)) for side in (False, True)]
        common = np.minimum(*sides)
        matched[k] = int(common.sum())
        gram[alive] = rank
        alive = alive[common[rank] > 0]
    return np.array([*matched, *total, int(is_ref.sum())], dtype=np.int64)


def _summed(blanks: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(SUMS), dtype=np.int64)
        for batch in batches:
            hyp, ref = batch.column(0), batch.column(1)
            sizes = sum(pc.fill_null(pc.binary_length(side), 0).to_numpy(zero_copy_only=False).astype(np.int64) for side in (hyp, ref))
            upto = np.cumsum(sizes)
            at = 0
            while at < len(hyp):
                before = int(upto[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(upto, before + limit, side="right")))
                sums += block_sums(hyp.slice(at, to - at), ref.slice(at, to - at), blanks)
                at = to
            # else a worker keeps what its largest batch took
            del batch, hyp, ref
            pa.default_memory_pool().release_unused()
        yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in sums], names=SUMS)

    return run


def ngram_counts(scored: DataFrame) -> DataFrame:
    """One row of ``matched_n``, ``total_n`` and ``ref_total_1`` summed over all sentences, from ``hyp, ref`` rows; a null side is empty."""
    parts = scored.select("hyp", "ref").mapInArrow(_summed(chars.blank(), BLOCK_BYTES), ", ".join(f"{name} bigint" for name in SUMS))
    return parts.agg(*[F.sum(name).alias(name) for name in SUMS])


def corpus_bleu(scored: DataFrame) -> DataFrame:
    """One row: ``bleu`` (0 to 100, five decimals), ``hyp_len`` and ``ref_len`` in tokens."""
    counts = ngram_counts(scored)
    sums = counts.select(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts.columns])
    sums = sums.withColumnsRenamed({"total_1": "hyp_len", "ref_total_1": "ref_len"})

    logs, halvings = [], F.lit(0)
    for n in range(1, ORDER + 1):
        matched = F.col(f"matched_{n}").cast("double")
        total = (F.col(f"total_{n}") if n > 1 else F.col("hyp_len")).cast("double")
        halvings = halvings + F.when((total > 0) & (matched == 0), 1).otherwise(0)
        precision = F.when(matched > 0, matched / total).otherwise(1 / (F.pow(F.lit(2.0), halvings) * total))
        logs.append(F.when(total > 0, F.log(precision)))
    mean_log = reduce(lambda a, b: a + b, logs) / ORDER
    hyp, ref = F.col("hyp_len").cast("double"), F.col("ref_len").cast("double")
    brevity = F.when(hyp < ref, F.exp(1 - F.try_divide(ref, hyp))).otherwise(F.lit(1.0))
    any_match = reduce(lambda a, b: a | b, [F.col(f"matched_{n}") > 0 for n in range(1, ORDER + 1)])
    score = F.when(any_match & mean_log.isNotNull(), 100 * brevity * F.exp(mean_log)).otherwise(F.lit(0.0))
    return sums.select(F.round(score, 5).alias("bleu"), "hyp_len", "ref_len")


def sentence_lookup(scored: DataFrame, sentence: int, line_no: str = "line_no") -> DataFrame:
    """The aligned row of one 0-based sentence number."""
    return scored.filter(F.col(line_no) == sentence + 1)


def sentence_bleu(scored: DataFrame, sentence: int, line_no: str = "line_no") -> DataFrame:
    """BLEU of one 0-based sentence."""
    return corpus_bleu(sentence_lookup(scored, sentence, line_no))
