"""Repeated passages, whitening and infill against brute force, with nulls, empty and long texts, ties, repeats and no rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from twinline.llm import bidiagonal, infill, superkmers, textscan, whitening
from twinline.llm.queries import ORACLES

CLASHING = "doc_id bigint, text string, n int, form string, spans int, key string, n_words int"


def passages(seed: int) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcé", k=rng.randint(1, 3)))
    shared = [" ".join(word() for _ in range(12)) for _ in range(3)]
    texts: list[str | None] = [None, "", " \t\n", "one", "a " * 40, "a b c " * 20, "x" * 5000]
    texts.append(" ".join(word() for _ in range(3000)))
    for i in range(60):
        parts = [word() for _ in range(rng.randint(0, 25))]
        parts.insert(rng.randint(0, len(parts)), shared[i % 3].replace(" ", rng.choice([" ", "\n", "\x0b ", "  "])))
        texts.append(rng.choice(["", " "]) + " ".join(parts))
    texts += [texts[20]] * 30  # copies hold a third of the rows
    rows: list[tuple[int | None, str | None]] = list(enumerate(texts))
    return rows + [rows[25], (None, "lone words of a row without an id"), (None, None), (7, "another text of one id")]


def removed(texts: list[str | None], width: int) -> list[tuple[int, int, str]]:
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, 1, "f", 2, "k", 3) for i, t in rows], CLASHING).repartition(3)


def comparable(rows):
    return sorted(map(tuple, rows), key=repr)


SETTINGS = [
    {},
    {"RUN": 2},
    {"BUCKET_BYTES": 200},
    {"BUCKET_BYTES": 500, "HELD_BYTES": 300},
    {"BUSY": 0, "SHARE": 10**9, "BUCKET_BYTES": 300},  # every shared minimiser is dealt out by its windows
    {"BUSY": 5, "SHARE": 200},
]


@pytest.mark.parametrize("setting", SETTINGS)
@pytest.mark.parametrize("width", [6, 9])
def test_repeats(monkeypatch, spark, setting, width):
    for name, value in setting.items():
        monkeypatch.setattr(superkmers, name, value)
    rows = passages(len(setting))
    wanted = [(i, *x) for (i, _), x in zip(rows, removed([t for _, t in rows], width), strict=True)]
    got = superkmers.remove_repeats(clashing(spark, rows), width)
    assert got.columns == ["doc_id", "n_words", "n_removed", "text"]
    assert comparable(got.collect()) == comparable(wanted)


def test_repeats_without_rows(spark):
    assert superkmers.remove_repeats(clashing(spark, [])).collect() == []
    alone = clashing(spark, [(1, None), (2, ""), (3, "a b")])
    assert comparable(superkmers.remove_repeats(alone).collect()) == [(1, 0, 0, ""), (2, 0, 0, ""), (3, 2, 0, "a b")]


def test_every_window_lies_in_one_superkmer():
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdefg", k=n)) for n in (0, 8, 9, 10, 200, 2500)]
    covered = Counter()
    for low, r in superkmers.runs(pa.array(texts), 9):
        for doc, at, first, last in zip(r.doc, r.at, r.first, r.last, strict=True):
            assert 0 < last - first <= superkmers.RUN
            covered.update((doc + low, at + k) for k in range(last - first))
            string = r.packed[r.starts[first] : r.ends[last + 7]].decode()
            assert string == " ".join(texts[doc + low].split()[at : at + last - first + 8])
    assert covered == Counter({(d, i): 1 for d, t in enumerate(texts) for i in range(len(t.split()) - 8)})


def test_windows_of_one_hash_are_told_apart_by_their_words():
    raw = b"aaabbbaaaccc"
    begin = np.array([0, 3, 6, 9])
    same = np.zeros(4, dtype=np.uint64)
    assert superkmers.repeats(raw, same, begin, begin + 3, np.ones(4, np.int64)).tolist() == [True, False, True, False]
    assert superkmers.repeats(raw, same, begin, begin + 3, np.array([1, 2, 1, 1])).tolist() == [True, True, True, False]


def test_busy_minimisers_are_bounded_and_found(spark, monkeypatch):
    monkeypatch.setattr(superkmers, "BUSY", 100)
    monkeypatch.setattr(superkmers, "SHARE", 50)
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    text = lambda: " ".join([*(word() for _ in range(8)), "these same words again", *(word() for _ in range(8))])
    docs = spark.createDataFrame([(str(i).encode(), text()) for i in range(3000)], "key binary, text string").repartition(4)
    hot, size = superkmers.frequent_minimisers(docs, 9)
    assert 1 <= len(hot) <= 50
    assert size > 0


def test_sliding_least():
    values = np.random.default_rng(0).integers(0, 100, 50).astype(np.uint64)
    for width in (1, 2, 3, 5, 8, 50):
        assert textscan.sliding_least(values, width).tolist() == [min(values[i : i + width]) for i in range(51 - width)]


def matrices():
    rng = np.random.default_rng(2)
    w = np.diag(np.abs(np.arange(-10, 11)) + 0.5) + np.diag(np.ones(20), 1)
    q = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    return {
        "random": rng.normal(size=(40, 40)),
        "graded": np.linalg.qr(rng.normal(size=(200, 40)) * np.logspace(0, -9, 40), mode="r"),
        "rank": rng.normal(size=(20, 3)) @ rng.normal(size=(3, 20)),
        "repeated": (q * np.repeat([5.0, 2, 1], 10)) @ q.T,
        "orthogonal": q,
        "glued": np.kron(np.eye(3), w) + np.diag(np.full(62, 1e-10), 1),
        "zero": np.zeros((4, 4)),
        "one": np.array([[-3.0]]),
        "integers": rng.integers(-2, 3, size=(9, 9)).astype(float),
    }


@pytest.mark.parametrize("name", list(matrices()))
def test_bidiagonal_solver(name):
    m = matrices()[name]
    values, right, total = bidiagonal.decompose(m, len(m))
    exact = np.linalg.svd(m, compute_uv=False)
    scale = exact[0] or 1
    assert np.abs(values - exact).max() <= 1e-14 * scale
    assert np.abs(right.T @ right - np.eye(len(m))).max() < 1e-8
    assert np.abs(m.T @ m @ right - right * values**2).max() <= 1e-13 * scale**2
    assert math.isclose(total, (exact**2).sum(), rel_tol=1e-12)


def test_dqds_keeps_small_values_accurate():
    a, b = np.array([1.0, 1e-3, 1e-6, 1e-9]), np.array([1e-1, 1e-4, 1e-7])
    product = np.prod(bidiagonal.singular_values(a, b))
    assert math.isclose(product, np.prod(a), rel_tol=1e-13)  # the determinant, though the values span ten powers of ten


def embeddings(seed: int, n: int = 200, width: int = 6):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=width) * np.arange(1, width + 1)]) for i in range(n)]
    rows += [(n + i, [0.5] * width) for i in range(n // 2)]  # a very common vector
    bad = [(900, None), (901, [1.0, None] + [0.0] * (width - 2)), (902, [math.nan] * width), (903, [math.inf] * width), (904, [3e38] * width)]
    return rows + [rows[3], (None, rows[4][1]), (905, []), (906, [1.0, 2.0])], bad


def expected_whitening(rows, width, k):
    x = np.array([np.floor(64 * np.pad(np.array(v, dtype=float), (0, width - len(v)))) for _, v in rows]).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    values, right = np.linalg.eigh(c.T @ c / n)
    values, right = values[::-1], right[:, ::-1]
    return n, ((n * x - s) ** 2).sum(axis=1), (x - s / n) @ right[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def test_whitening(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)  # several levels of merging
    monkeypatch.setattr(whitening, "BLOCK", 7)
    rows, bad = embeddings(0)
    n, deviation, z, share = expected_whitening(rows, 6, 4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows + bad], "vec_id bigint, embedding array<float>, x string, whitened double")
        got = whitening.whiten(df.repartition(5), components=4).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(rows)
    place = {}
    for k, (i, _) in enumerate(rows):
        place.setdefault(i, k)
    order = [place[r.vec_id] for r in got]
    assert [int(r.deviation) for r in got] == deviation[order].tolist()
    assert {r.n for r in got} == {n}
    mine = np.array([r.whitened for r in got])
    signs = np.sign((mine * z[order]).sum(axis=0))
    assert np.abs(mine * signs - z[order]).max() < 1e-10
    assert np.abs(np.array(got[0].explained) / share - 1).max() < 1e-10
    assert max(r.identity_error for r in got) < 1e-10
    flat = whitening.per_component(whitening.whiten(df, components=4))
    assert flat.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert flat.count() == 4 * len(rows)


def test_whitening_without_variance(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert whitening.per_component(whitening.whiten(spark.createDataFrame([], schema))).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, []), (2, None)], schema)).collect() == []
    same = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert [(r.whitened, r.explained, r.n, int(r.deviation), r.identity_error) for r in same] == [([None, None], [0.0, 0.0], 1, 0, 0.0)] * 2
    line = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [3.0, 6.0])], schema)).collect()
    assert sorted(abs(round(r.whitened[0], 9)) for r in line) == [0.0, round(math.sqrt(1.5), 9), round(math.sqrt(1.5), 9)]
    assert all(r.whitened[1] is None and r.explained[0] == 1.0 for r in line)


def test_exact_deviations_beyond_a_long():
    x = np.array([[2.0**39, -(2.0**39)], [0.0, 1.0]])
    d = whitening.deviations(x, 2**30, [5, -7])
    assert d.tolist() == [[2**69 - 5, -(2**69) + 7], [-5, 2**30 + 7]]
    assert whitening.squared_length(d)[0] == (2**69 - 5) ** 2 + (2**69 - 7) ** 2


def tokens(text: str) -> list[str]:
    return re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.DOTALL)


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_skip_list_reaches_every_rank(fanout):
    rng = random.Random(0)
    for n in (0, 1, 2, 15, 16, 17, 300):
        text = "".join(rng.choices(["ab", "C", " ", "é", "\n", "😀", "9"], k=n))
        units = tokens(text)
        lanes = infill.SkipList(infill.token_widths(text), fanout)
        assert len(lanes) == len(units)
        assert all(units.sum() == len(lanes) for units in lanes.units)
        assert [lanes.points_before(k) for k in range(len(units) + 1)] == [len("".join(units[:k])) for k in range(len(units) + 1)]
        with pytest.raises(IndexError):
            lanes.points_before(len(units) + 1)


def test_tokens_across_slices(monkeypatch):
    text = "abc déf" * 5 + "xyz"
    monkeypatch.setattr(infill, "SLICE", 2)
    assert infill.token_widths(text).tolist() == list(map(len, tokens(text)))


def expected_infill(key, text):
    text = text or ""
    units = tokens(text)
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_infill(spark):
    rng = random.Random(4)
    texts = [None, "", " ", "<P>", "a <S> b", "x<M>", "<P <S<M", "é", "😀" * 30, "word " * 3000, "x" * 70000]
    texts += ["".join(rng.choices(["ab", "C", " ", "é", "\n", "<", ">", "P", "S", "M", "😀"], k=rng.randint(0, 40))) for _ in range(150)]
    rows = list(enumerate(texts)) + [(20, texts[20]), (20, "other text"), (None, "no id here"), (-5, "below zero")]
    got = infill.infill(clashing(spark, rows)).withColumn("back", infill.restored(F.col("output"), F.col("form")))
    wanted = [(i, t or "", *expected_infill(i, t), t or "") for i, t in rows]
    assert comparable(got.collect()) == comparable(wanted)
    assert {w[3] for w in wanted} == {"plain", "psm", "spm"}
    assert infill.infill(clashing(spark, [])).collect() == []


def test_new_queries_with_sql():
    assert {"op11_superkmer_repeats", "op13_skip_list_infill"} <= set(ORACLES)
