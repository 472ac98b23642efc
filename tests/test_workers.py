"""What jobs over whole corpora read, and what a Python worker holds for a batch."""

from __future__ import annotations

import contextlib
import io
import random
import tracemalloc

import pyarrow as pa

from twinline.functions import chars
from twinline.operators import bleu, subword
from workload import views

SF = "/root/testdata/sf0.001"


def _lines(n_bytes: int) -> pa.Array:
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(50000)]
    return pa.array([" ".join(rng.choices(words, k=50)) for _ in range(n_bytes // 325)], pa.string())


def _peak(run) -> float:
    """MB that Python and numpy hold at most while ``run`` goes on."""
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_bleu_holds_little():
    batch = pa.RecordBatch.from_arrays([_lines(3 << 20), _lines(3 << 20)], names=["hyp", "ref"])
    run = bleu._summed(chars.blank(), bleu.BLOCK_BYTES)
    assert _peak(lambda: list(run(iter([batch])))) < 60


def test_segmenting_holds_little(spark):
    ranks = {(a, b): n for n, (a, b) in enumerate((a, b) for a in "abcdefgh" for b in "abcdefgh")}
    run = subword._encoder(subword.Model(ranks), subword.BLOCK_BYTES).func
    lines = _lines(4 << 20)
    assert _peak(lambda: [len(x) for x in run(iter([lines]))]) < 40


def test_vocabulary_reads_the_texts_once(spark):
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        views.model_vocabulary(spark, SF).explain()
    assert shown.getvalue().count("FileScan parquet") == 1


def test_vocabulary_in_one_job(spark):
    merges = spark.createDataFrame([(0, "a", "b"), (1, "ab", "</w>")], "rank bigint, left string, right string")
    known = lambda rows: subword.load_model(merges, vocab=spark.createDataFrame(rows, "token string, freq int")).vocab
    assert known([]) is None
    assert known([("zz", 3)]) == frozenset()
    assert known([("ab", 3), ("ab@@", 2), ("zz", 1), ("b", 1)]) == {"ab", "ab@@"}
