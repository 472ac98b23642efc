"""Merging, duplicates, splits, shuffles, mixing, numbering, search and streams."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from twinline.functions import filters
from twinline.operators import merge, mix, numbering, search, selection
from twinline.operators import chain as chains
from twinline.operators.registry import chain, register_augmenter, register_filter, register_transform
from twinline.streaming.clean import preprocess_stream

PAIR = "source string, source_ord int, line_no bigint, aug_ord int, src string, tgt string"


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    sizes = {"s0": 300, "s1": 40, "s2": 7}
    rows = []
    for ord_, (name, size) in enumerate(sizes.items()):
        for n in range(1, size + 1):
            # A third of all rows are copies of one pair.
            pair = ("hot", "pair") if rng.random() < 0.33 else (f"a{rng.randint(0, 120)}", f"b{rng.randint(0, 2)}")
            rows.append((name, ord_, n, 0, *pair))
    return rows


@pytest.mark.parametrize("parts", [1, 6])
def test_dedup_keeps_the_first_and_counts_copies(spark, corpus, parts):
    df = spark.createDataFrame(corpus, PAIR).repartition(parts)
    first, copies = {}, Counter()
    for row in corpus:
        first.setdefault(row[4:], row)
        copies[row[4:]] += 1
    got = merge.dedup_pairs(df).collect()
    assert {tuple(r)[:6] for r in got} == set(first.values()) and len(got) == len(first)
    assert {(r["src"], r["tgt"]): r["copies"] for r in got} == dict(copies)
    one_side = merge.dedup_pairs(df, keys=["src"])
    assert one_side.count() == len({r[4] for r in corpus})
    again = merge.dedup_pairs(merge.dedup_pairs(df).drop("copies")).drop("copies")
    assert again.exceptAll(merge.dedup_pairs(df).drop("copies")).isEmpty()


@pytest.mark.parametrize("n", [0, 1, 17, 10_000])
@pytest.mark.parametrize("parts", [1, 5])
def test_split_is_exact_disjoint_and_repeatable(spark, corpus, n, parts):
    pairs = sorted({r[4:] for r in corpus})
    df = spark.createDataFrame(pairs, "src string, tgt string").repartition(parts)
    got = selection.train_val_split(df, n, seed=5).collect()
    keys = {p: hashlib.md5("\t".join([*p, "5"]).encode()).hexdigest() for p in pairs}
    held_out = set(sorted(pairs, key=keys.get)[:n])
    assert {(r["src"], r["tgt"]) for r in got if r["split"] == "val"} == held_out
    assert len(got) == len(pairs)


def test_validation_size(spark):
    df = spark.createDataFrame([(0,), (4,), (15,), (24_999,), (25_001,), (10**12,)], "n bigint")
    got = [r[0] for r in df.select(merge.validation_size(F.col("n"))).collect()]
    assert got == [int(min(5000, n * 0.2)) for n in (0, 4, 15, 24_999, 25_001, 10**12)]


def test_shuffle_positions(spark, corpus):
    df = spark.createDataFrame(corpus, PAIR)
    got = selection.shuffle_corpus(df, seed=1, unique=["source", "line_no"]).collect()
    keyed = sorted(
        hashlib.md5("\t".join([r[4], r[5], r[0], str(r[2]), "1"]).encode()).hexdigest() + f"|{r[0]}|{r[2]}" for r in corpus
    )
    expected = {tuple(k.split("|")[1:]): n + 1 for n, k in enumerate(keyed)}
    assert {(r["source"], str(r["line_no"])): r["position"] for r in got} == expected


@pytest.mark.parametrize("sigmas", [0, 6])
def test_nth_smallest_key(spark, monkeypatch, sigmas):
    monkeypatch.setattr(selection, "SIGMAS", sigmas)
    monkeypatch.setattr(selection, "SLACK", 0.1 if not sigmas else 8)  # too narrow at first: the search widens
    keys = sorted(hashlib.md5(str(i).encode()).hexdigest() for i in range(700))
    df = spark.createDataFrame([(k,) for k in keys], "key string").repartition(3)
    for n in (1, 2, 350, 699, 700):
        assert selection.nth_smallest_key(df, "key", n) == keys[n - 1]
    assert selection.nth_smallest_key(df, "key", 900) == keys[-1]
    assert selection.nth_smallest_key(df, "key", 0) is selection.nth_smallest_key(df.limit(0), "key", 3) is None
    uneven = df.filter("key < '01'").unionByName(df.filter("key > 'fe'"))  # a search among keys that are not spread evenly
    left = [k for k in keys if k < "01" or k > "fe"]
    assert [selection.nth_smallest_key(uneven, "key", n + 1) for n in range(len(left))] == left


@pytest.mark.parametrize("n", [0, 5, 100, 10_000])
def test_sample_size_is_exact_over_copies(spark, corpus, n):
    df = spark.createDataFrame(corpus, PAIR)
    sample = selection.training_sample(df, ["source", "line_no"], n=n, seed=2)
    rows = sample.collect()
    assert len(rows) == min(n, 2 * len(corpus)) == len({tuple(r) for r in rows})
    assert sample.exceptAll(selection.training_sample(df.repartition(9), ["source", "line_no"], n=n, seed=2)).isEmpty()


def simulate_mix(sizes, weights, stop):
    taken, out, names = Counter(), [], list(sizes)
    while any(taken[n] < sizes[n] for n in names):
        for name in names:
            for _ in range(weights[name]):
                if taken[name] == sizes[name]:
                    if stop == "first_exhausted":
                        return out
                    break
                taken[name] += 1
                out.append((name, taken[name]))
    return out


@pytest.mark.parametrize("stop", mix.STOPS)
@pytest.mark.parametrize(
    ("sizes", "weights"),
    [
        ({"a": 10, "b": 23, "c": 4}, {"a": 1, "b": 5, "c": 2}),
        ({"a": 6, "b": 6}, {"a": 2, "b": 3}),
        ({"a": 3}, {"a": 5}),
        ({"a": 1, "b": 9, "c": 9}, {"a": 1, "b": 1, "c": 4}),
    ],
)
def test_mix_agrees_with_simulation(spark, sizes, weights, stop):
    rows = [(n, o, i, size) for o, (n, size) in enumerate(sizes.items()) for i in range(1, size + 1)]
    df = spark.createDataFrame(rows, "source string, source_ord int, line_no bigint, n_lines bigint").repartition(3)
    got = mix.weighted_mix(df, weights, stop).orderBy("position").collect()
    assert [(r["source"], r["line_no"]) for r in got] == simulate_mix(sizes, weights, stop)
    assert [r["position"] for r in got] == list(range(1, len(got) + 1))


def test_mix_of_many_corpora(spark, monkeypatch):
    rng = random.Random(2)
    sizes = {f"c{n:02}": rng.choice([0, 1, 2, 5, 30, 31, 90]) for n in range(23)}
    weights = {name: rng.randint(1, 6) for name in sizes} | {"absent": 3}
    rows = [(n, o, i, size) for o, (n, size) in enumerate(sizes.items()) for i in range(1, size + 1)]
    df = spark.createDataFrame(rows, "source string, source_ord int, line_no bigint, n_lines bigint").repartition(3)
    monkeypatch.setattr(mix, "SMALL_TABLE", 0)
    got = mix.weighted_mix(df, weights).orderBy("position").collect()
    assert [(r["source"], r["line_no"]) for r in got] == simulate_mix(sizes, weights, "all_exhausted")
    assert [r["position"] for r in got] == list(range(1, len(got) + 1))
    assert mix.weighted_mix(df.limit(0), weights).collect() == []


def test_mix_rejects_bad_settings(spark):
    df = spark.createDataFrame([("a", 0, 1, 1)], "source string, source_ord int, line_no bigint, n_lines bigint")
    for weights, stop in (({}, "all_exhausted"), ({"a": 0}, "all_exhausted"), ({"a": 1}, "never")):
        with pytest.raises(ValueError):
            mix.weighted_mix(df, weights, stop)


@pytest.mark.parametrize("parts", [1, 7])
def test_numbering_over_blocks(spark, parts):
    rng = random.Random(5)
    units = [(rng.choice("xyyyy"), key) for key in rng.sample(range(3000), 500)]
    df = spark.createDataFrame(units, "corpus string, key bigint").repartition(parts)
    expected, seen = {}, Counter()
    for corpus, key in sorted(units, key=lambda u: u[1]):
        seen[corpus] += 1
        expected[corpus, key] = seen[corpus]
    got = numbering.unit_offsets(df, "corpus", "key", F.shiftright("key", 5), F.lit(1)).collect()
    assert {(r["corpus"], r["key"]): r["lines_before"] + 1 for r in got} == expected
    assert {r["unit_lines"] for r in got} == {1}
    assert {r["corpus"]: r["n_lines"] for r in got} == dict(seen)


def test_merge_and_stats(spark, corpus):
    df = spark.createDataFrame(corpus, PAIR).drop("aug_ord")
    spec = chain(augmenters=["lowercase"])
    frames = [(df.filter(F.col("source") == s), spec, w) for s, w in (("s0", None), ("s1", 3), ("s2", None))]
    merged = merge.merge_corpora(frames)
    assert Counter(r["source"] for r in merged.collect()) == {"s0": 300, "s2": 7}
    stats = [tuple(r) for r in merge.merge_stats(merged).orderBy("source_ord").collect()]
    assert stats == [("s0", 0, 300, 300, 61, 246), ("s2", 2, 7, 307, 61, 246)]
    same = merge.preprocess_by_source(df, {"s0": spec, "s1": None, "s2": chain(augmenters=["lowercase"])})
    assert same.exceptAll(merged).isEmpty() and same.count() == 307
    with pytest.raises(ValueError, match="every corpus has a weight"):
        merge.merge_corpora([(df, spec, 1)])


def test_fingerprints(spark):
    names = spark.createDataFrame([("b",), ("a",), ("é",)], "source string")
    current = merge.source_fingerprint(names)
    assert current.head()[0] == hashlib.md5("|".join(sorted(["b", "a", "é"])).encode()).hexdigest()
    empty = spark.createDataFrame([], "fingerprint string")
    assert merge.sources_changed(current, empty).head()["changed"]
    assert not merge.sources_changed(current, current).head()["changed"]
    assert merge.sources_changed(current, merge.source_fingerprint(names.limit(1))).head()["changed"]


def test_find_text(spark):
    rows = [("s", 1, "Say HÉLLO there", "x"), ("s", 2, " hello \r", "Hello"), ("t", 1, "hell", "oh, hello!")]
    df = spark.createDataFrame(rows, "source string, line_no bigint, src string, tgt string")
    hits = {tuple(r)[:3] for r in search.find_text(df, "HeLLo").collect()}
    assert hits == {("s", 2, "src"), ("s", 2, "tgt"), ("t", 1, "tgt")}
    exact = {tuple(r)[:3] for r in search.find_text(df, "HELLO", exact=True).collect()}
    assert exact == {("s", 2, "src"), ("s", 2, "tgt")}
    assert search.find_text(df, " hello", exact=True).isEmpty()
    assert search.find_text(df, "héllo").count() == 1


def test_token_limit(spark):
    rows = [("a b c", "x"), ("a  b", "x y"), ("a b c d", "x"), (" ", "x"), ("a", "")]
    df = spark.createDataFrame(rows, "src string, tgt string")
    assert [tuple(r) for r in selection.max_tokens(df, src=3, tgt=2).collect()] == rows[:2]


def test_user_operators(spark):
    register_filter("starts_with", lambda src, tgt, prefix: src.startswith(prefix))
    register_transform("shout", lambda src, tgt: (F.upper(src), tgt))
    register_augmenter("none", lambda src, tgt: F.lit(None).cast("array<struct<src:string,tgt:string>>"))
    spec = chain(filters=[{"starts_with": {"prefix": "x"}}], transforms=["shout"], augmenters=["none", "lowercase"])
    df = spark.createDataFrame([("xa", "B"), ("a", "B")], "src string, tgt string")
    got = chains.preprocess(df, spec).select("aug", "src", "tgt").collect()
    assert [tuple(r) for r in got] == [(None, "A", "B"), ("lowercase", "a", "b")]
    with pytest.raises(ValueError, match="prefix"):
        chain(filters=["starts_with"])


def test_chain_on_a_stream(spark, tmp_path):
    rows = [("s", " (One", "Uno "), ("s", "Two", "Two"), ("s", "", "x"), ("s", "Yes", "Sì")]
    batch = spark.createDataFrame(rows, "source string, src string, tgt string")
    batch.write.parquet(str(tmp_path / "in"))
    spec = chain(
        filters=["duplicates"],
        transforms=["remove_unpaired_quotes_and_brackets"],
        augmenters=["single_word_punctuation", "lowercase"],
    )
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    query = (
        preprocess_stream(stream, spec)
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    expected = chains.preprocess(batch, spec)
    assert Counter(map(tuple, got.select(expected.columns).collect())) == Counter(map(tuple, expected.collect()))
    with pytest.raises(ValueError):
        preprocess_stream(batch, spec)
    with pytest.raises(ValueError):
        preprocess_stream(stream, chain(filters=[{"top": {"percent": 5}}]))


def test_filters_are_null_safe(spark):
    """A pair is never lost to an unknown comparison: predicates on non-empty text are never null."""
    df = spark.createDataFrame([("a", "b"), ("1", "?"), ("é", "漢")], "src string, tgt string")
    built = [f(F.col("src"), F.col("tgt")) for f in (filters.duplicates, filters.char_length, filters.source_target_ratio,
             filters.uppercase_count_mismatch, filters.contains, filters.digits_ratio, filters.nonalphanum_ratio,
             filters.digits_mismatch, filters.nonalphanum_count_mismatch, filters.characters_count_mismatch,
             filters.first_char_mismatch)]
    assert all(v is not None for row in df.select(*built).collect() for v in row)
