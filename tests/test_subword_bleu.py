"""Subword and BLEU operators against naive models."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from twinline.functions import chars
from twinline.operators import bleu, subword
from twinline.sources import models

SEP = "@@"


def naive_word(word, codes, version, vocab=None):
    """Textbook merging: find the best-ranked pair, join it everywhere, repeat; then undo unknown pieces."""
    rank = {}
    for n, pair in enumerate(codes):
        rank.setdefault(pair, n)
    symbols = list(word) + ["</w>"] if version == (0, 1) else list(word[:-1]) + [word[-1] + "</w>"]
    if len(symbols) == 1:
        return [word]
    while True:
        candidates = [p for p in zip(symbols, symbols[1:]) if p in rank]
        if not candidates:
            break
        best = min(candidates, key=rank.get)
        out, i = [], 0
        while i < len(symbols):
            if tuple(symbols[i : i + 2]) == best:
                out.append(best[0] + best[1])
                i += 2
            else:
                out.append(symbols[i])
                i += 1
        symbols = out
    symbols = symbols[:-1] if symbols[-1] == "</w>" else [*symbols[:-1], symbols[-1].replace("</w>", "")]
    if not vocab:
        return symbols
    origin = {}
    for pair in sorted(rank, key=rank.get, reverse=True):
        origin[pair[0] + pair[1]] = pair

    def undo(piece, final):
        if (piece if final else piece + SEP) in vocab:
            return [piece]
        pair = origin.get(piece + "</w>" if final else piece)
        if pair is None:
            return [piece]
        right = pair[1][:-4] if final else pair[1]
        return undo(pair[0], False) + undo(right, final)

    return [p for piece in symbols[:-1] for p in undo(piece, False)] + undo(symbols[-1], True)


def naive_line(line, codes, version, vocab=None):
    out = []
    for word in line.strip("\r\n ").split(" "):
        if word:
            pieces = naive_word(word, codes, version, vocab)
            out += [p + SEP for p in pieces[:-1]] + [pieces[-1]]
    return out


@pytest.fixture(scope="module")
def setup():
    rng = random.Random(3)
    letters = "abcé漢"
    codes, symbols = [], list(letters) + ["</w>"] + [c + "</w>" for c in letters]
    for _ in range(60):
        left = rng.choice([s for s in symbols if not s.endswith("</w>")])
        right = rng.choice(symbols)
        codes.append((left, right))
        symbols.append(left + right)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(400)]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 8))) for _ in range(300)]
    lines += ["", "  ", " aaa  bb \r", "aaaa aaa aa a", "\r\n"]
    vocab = {s.replace("</w>", "") if s.endswith("</w>") else s + SEP for s in rng.sample(symbols, 30)} - {""}
    return codes, lines, vocab


def _merges(spark, codes):
    rows = [(n + 1, f"{l} {r}") for n, (l, r) in enumerate(codes)]
    return models.read_bpe_codes(spark.createDataFrame(rows, "line_no bigint, line string"))


@pytest.mark.parametrize("version", [(0, 1), (0, 2)])
@pytest.mark.parametrize("with_vocab", [False, True])
def test_encode_agrees_with_naive(spark, setup, version, with_vocab):
    codes, lines, vocab = setup
    known = spark.createDataFrame([(v,) for v in sorted(vocab)], "token string") if with_vocab else None
    model = subword.load_model(_merges(spark, codes), version, known)
    df = spark.createDataFrame([(n, line) for n, line in enumerate(lines)], "id int, text string").repartition(5)
    for row in subword.bpe_encode(df, model).collect():
        expected = naive_line(row["text"], codes, version, vocab if with_vocab else None)
        assert row["pieces"] == expected, row["text"]
    if not with_vocab:
        decoded = subword.bpe_encode(df, model).withColumn("back", subword.bpe_decode(F.col("pieces")))
        for row in decoded.collect():
            assert row["back"] == " ".join(row["text"].strip("\r\n ").split())


def test_encode_line_keeps_edges(spark, setup):
    codes, lines, _ = setup
    model = subword.load_model(_merges(spark, codes))
    texts = [*lines, "  aab ab\r", "\r\n ab", "ab", " ", "a \r b  "]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in subword.bpe_encode_line(df, model).collect():
        text = row["text"]
        core = text.strip("\r\n ")
        head = text[: len(text) - len(text.lstrip("\r\n "))]
        tail = text[len(text.rstrip("\r\n ")) :] if core else ""
        assert row["encoded"] == head + " ".join(naive_line(text, codes, (0, 1))) + tail


def test_glossaries_stay_whole(spark):
    model = subword.load_model(_merges(spark, [("a", "b"), ("1", "9")]), glossaries=("USA", "[0-9]+"))
    assert subword.segment_word("1934USABUSA", model) == ["1934@@", "USA@@", "B@@", "USA"]
    assert subword.segment_word("USA", model) == ["USA"]
    assert subword.segment_word("ab", model) == ["ab"]
    assert subword.segment_word("ab19ab", model) == ["ab@@", "19@@", "ab"]


def test_grouped_glossaries_over_blocks_and_nulls(spark, setup, monkeypatch):
    codes, lines, _ = setup
    pattern = "(a|é)b{1,2}"
    monkeypatch.setattr(subword, "BLOCK_BYTES", 20)
    model = subword.load_model(_merges(spark, codes), (0, 2), glossaries=(pattern, "漢漢"))
    df = spark.createDataFrame([(line,) for line in [*lines, None, "<x>", "\ud7ff 😀b"]], "text string").repartition(3)

    def naive(word):
        spans, at = [], 0
        for m in re.finditer(f"(?:{pattern})|(?:漢漢)", word):
            spans += [(word[at : m.start()], False), (m.group(), True)]
            at = m.end()
        spans.append((word[at:], False))
        pieces = [p for text, whole in spans if text for p in ([text] if whole else naive_word(text, codes, (0, 2)))]
        return [p + SEP for p in pieces[:-1]] + pieces[-1:]

    for row in subword.bpe_encode(df, model).collect():
        words = (row["text"] or "").strip("\r\n ").split(" ")
        assert row["pieces"] == [p for word in words if word for p in naive(word)], row["text"]


def test_unknown_version_and_bad_lines(spark):
    with pytest.raises(NotImplementedError):
        subword.load_model(_merges(spark, [("a", "b")]), version=(0, 3))
    bad = spark.createDataFrame([(1, "a b"), (2, "a b c")], "line_no bigint, line string")
    with pytest.raises(Exception, match="exactly two"):
        models.read_bpe_codes(bad).collect()


def test_codes_header_limit_and_duplicates(spark):
    lines = ["#version: 0.2", "a b", "b c\r", " a b ", "c d"]
    df = spark.createDataFrame([(n + 1, line) for n, line in enumerate(lines)], "line_no bigint, line string")
    assert models.bpe_version(df) == (0, 2)
    got = {(r["left"], r["right"]): r["rank"] for r in models.read_bpe_codes(df).collect()}
    assert got == {("a", "b"): 0, ("b", "c"): 1, ("c", "d"): 3}
    assert models.read_bpe_codes(df, merges=2).count() == 2
    headless = df.filter("line_no > 1").withColumn("line_no", F.col("line_no") - 1)
    assert models.bpe_version(headless) == (0, 1)
    assert {r["rank"] for r in models.read_bpe_codes(headless).collect()} == {0, 1, 3}


def test_vocabularies(spark):
    vocab = spark.createDataFrame([("a@@ 5",), ("b 3\r",), ("c 9",)], "line string")
    assert {tuple(r) for r in models.read_bpe_vocab(vocab, 5).collect()} == {("a@@", 5), ("c", 9)}
    assert models.read_bpe_vocab(vocab).count() == 3
    lines = ["<unk>\t0", "<s>\t0", "▁the\t-3.5", "x -1", "  y \t -2.5  ", "alone", "", "bad\tnumber", "z\tnan", "w\t1e-3"]
    got = dict(map(tuple, models.vocab_to_counts(spark.createDataFrame([(x,) for x in lines], "line string")).collect()))
    assert got == {t: int(math.exp(p) * 1_000_000) + 1 for t, p in (("▁the", -3.5), ("x", -1), ("y", -2.5), ("w", 1e-3))}


def test_sp_decode(spark):
    df = spark.createDataFrame([(["▁Hel", "lo", "▁", "▁x"],), (["a", "▁b"],), ([],)], "p array<string>")
    assert [r[0] for r in df.select(subword.sp_decode(F.col("p"))).collect()] == ["Hello  x", "a b", ""]


# The tokenizer as it is usually stated: replacements by pattern, in order.
PATTERNS = (
    (r"([{-~\[-`!-&(-+:-@/])", r" \1 "),
    (r"([^0-9])([.,])", r"\1 \2 "),
    (r"([.,])([^0-9])", r" \1 \2"),
    (r"([0-9])(-)", r"\1 \2 "),
)


def naive_tokens(text):
    for old, new in bleu.PLAIN:
        text = text.replace(old, new)
    text = f" {text} "
    for pattern, new in PATTERNS:
        text = re.sub(pattern, new, text)
    return text.split()


def naive_bleu(pairs):
    matched, total, hyp_len, ref_len = [0] * 4, [0] * 4, 0, 0
    for hyp, ref in pairs:
        h, r = naive_tokens(hyp), naive_tokens(ref)
        hyp_len, ref_len = hyp_len + len(h), ref_len + len(r)
        for n in range(1, 5):
            hg = Counter(tuple(h[i : i + n]) for i in range(len(h) - n + 1))
            rg = Counter(tuple(r[i : i + n]) for i in range(len(r) - n + 1))
            matched[n - 1] += sum((hg & rg).values())
            total[n - 1] += sum(hg.values())
    if not any(matched) or not all(total):
        return 0.0, hyp_len, ref_len
    logs, halve = 0.0, 1
    for m, t in zip(matched, total):
        if m == 0:
            halve *= 2
        logs += math.log(m / t if m else 1 / (halve * t))
    brevity = 1.0 if hyp_len >= ref_len else math.exp(1 - ref_len / hyp_len)
    return round(100 * brevity * math.exp(logs / 4), 5), hyp_len, ref_len


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text("01.,-a é\n\t\u3000\x1f!/'<&;😀", max_size=14) | st.sampled_from([None, "1..2", "a..5", "a...5", ".5-", "&amp;lt;", "x-\ny"]), max_size=5))
def test_tokens_agree_with_the_patterns(texts):
    tokens, text = bleu.tokenized(pa.array(texts, pa.string()), chars.blank())
    got = [[t.decode() for t, at in zip(tokens.to_pylist(), text) if at == k] for k in range(len(texts))]
    assert got == [naive_tokens(t or "") for t in texts]


def test_blocks_of_any_size_give_the_same_sums(spark, monkeypatch):
    rng = random.Random(3)
    words = ["a", "b", "c.", "1,5", "d-e", "3-"]
    pairs = [tuple(" ".join(rng.choices(words, k=rng.randint(0, 9))) or None for _ in "hr") for _ in range(80)]
    df = spark.createDataFrame(pairs, "hyp string, ref string").repartition(3)
    whole = bleu.ngram_counts(df).first()
    monkeypatch.setattr(bleu, "BLOCK_BYTES", 10)
    assert bleu.ngram_counts(df).first() == whole
    assert bleu.corpus_bleu(df).head()["bleu"] == pytest.approx(naive_bleu([(h or "", r or "") for h, r in pairs])[0], abs=1e-5)
    assert tuple(bleu.corpus_bleu(df.limit(0)).head()) == (0.0, 0, 0)


@pytest.mark.parametrize(
    "pairs",
    [
        [("The cat sat on the mat.", "The cat sat on the mat.")],
        [("the the the the the the the", "the cat is on the mat"), ("a b c", "a b c d e")],
        [("It costs $1,000.50, e.g. 3-4 &amp; more!", 'It costs $1,000.50 "e.g." 3-4 & more!')],
        [("", "x y"), ("a", "a")],
        [("x y z w", "p q r s")],
        [("a b c d x", "a b c y d"), ("a b a b a b", "a b a b")],
    ],
)
def test_bleu_agrees_with_naive(spark, pairs):
    df = spark.createDataFrame([(n, h, r) for n, (h, r) in enumerate(pairs)], "id bigint, hyp string, ref string")
    score, hyp_len, ref_len = naive_bleu(pairs)
    got = bleu.corpus_bleu(df).head()
    assert (got["hyp_len"], got["ref_len"]) == (hyp_len, ref_len)
    assert got["bleu"] == pytest.approx(score, abs=1e-5)


def test_bleu_of_random_text_and_one_sentence(spark):
    rng = random.Random(1)
    words = ["the", "cat", "sat,", "on", "a", "mat.", "3-4", "1,000", "“x”"]

    def text():
        return " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))

    pairs = [(text(), text()) for _ in range(60)] + [("cat " * 400, "the cat " * 300)]
    df = spark.createDataFrame([(n + 1, h, r) for n, (h, r) in enumerate(pairs)], "id bigint, hyp string, ref string")
    assert bleu.corpus_bleu(df).head()["bleu"] == pytest.approx(naive_bleu(pairs)[0], abs=1e-5)
    one = bleu.sentence_bleu(df, 60, "id").head()
    assert one["bleu"] == pytest.approx(naive_bleu(pairs[60:])[0], abs=1e-5)
