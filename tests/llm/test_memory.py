"""Memory that a Python worker takes for a batch, whose size Spark sets."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from twinline.llm import superkmers, textscan


def _texts(n_bytes: int) -> list[str]:
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(20000)]
    texts, size = [], 0
    while size < n_bytes:
        texts.append(" ".join(words[k] for k in rng.integers(0, len(words), 500)))
        size += len(texts[-1])
    return texts


def _peak(run) -> float:
    """MB that Python and numpy hold at most while ``run`` goes on."""
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_scans_hold_little():
    texts = pa.array(_texts(8 << 20), pa.string())
    textscan._powers.clear()
    assert _peak(lambda: sum(len(x) for x in textscan.shingle_sets(texts, 3))) < 80


def test_super_kmers_hold_little():
    texts = _texts(12 << 20)
    keys = pa.array([n.to_bytes(16) for n in range(len(texts))], pa.binary())
    batch = pa.RecordBatch.from_arrays([keys, pa.array(texts, pa.string())], names=["key", "text"])
    textscan._powers.clear()
    run = superkmers._dealt(35, np.zeros(0, np.uint64), 8)
    assert _peak(lambda: sum(r.num_rows for r in run(iter([batch])))) < 150
