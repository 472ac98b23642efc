"""Filters, transforms and augmenters against plain-Python models on random Unicode and on hand-worked pairs."""

from __future__ import annotations

import html
import random
from collections import Counter
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from twinline.functions import augmenters, chars, filters, transforms
from twinline.operators import chain as chains
from twinline.operators.registry import chain

ALPHABET = (
    "aAbBzZ éÉßñ ПриВет ΣσςΩ 漢字かな 0123456789 ²③٣००९½Ⅷ ()[]{}\"“”«»?!:;.,-_&@  　\t ǅʰªǰﬁ İı 𝐀𝟘𝟗😀́‍"
)
EDGE = [
    ("Same", "Same"),
    ("room 0", "room"),
    ("room 5", "room 7"),
    ("x²", "xy"),
    ("Hello", "hello"),
    ('"hi', "hi"),
    ("a [b] [c", "x"),
    (")(", "x"),
    ('"a" "b', "x"),
    ("Yes", "Sì"),
    ("Yes.", "Sì."),
    (".", "."),
    ("ABC", "abc"),
    ("a.b", "ab"),
    ("привет NASA", "hello NASA"),
    ("A &amp; B", "A & B"),
    ("a" * 20, "b" * 21),
    ("000", "٠"),
    ("𝟘", "𝟙"),
    ("“a”“", "«b"),
    ("{[(", "}])"),
]


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(7)

    def text():
        return "".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 14)))

    return EDGE + [(text(), text()) for _ in range(3000)]


@pytest.fixture(scope="module")
def frame(spark, pairs):
    rows = [(n, s, t) for n, (s, t) in enumerate(pairs)]
    return spark.createDataFrame(rows, "id int, src string, tgt string").cache()


def _occurrences(text, predicate):
    return sum(map(predicate, text))


def _symbol(c):
    return c != " " and not c.isalnum()


def _value(text):
    return sum(int(c) for c in text if c.isdecimal())


def _first(s, t):
    if s[0].isalpha() != t[0].isalpha():
        return True
    return s[0].isupper() != t[0].isupper() if s[0].isalpha() else s[0] != t[0]


FILTER_MODELS = {
    "duplicates": (filters.duplicates, {}, lambda s, t: s == t),
    "char_length": (
        filters.char_length,
        {"min": 2, "max": 10},
        lambda s, t: not (2 < len(s) < 10 and 2 < len(t) < 10),
    ),
    "char_length_open": (filters.char_length, {"min": 3}, lambda s, t: len(s) <= 3 or len(t) <= 3),
    "source_target_ratio": (
        filters.source_target_ratio,
        {"min": 0.5, "max": 2},
        lambda s, t: not 0.5 < len(s) / len(t) < 2,
    ),
    "uppercase_count_mismatch": (
        filters.uppercase_count_mismatch,
        {},
        lambda s, t: _occurrences(s, str.isupper) != _occurrences(t, str.isupper),
    ),
    "contains": (filters.contains, {"words": ["a", "字"]}, lambda s, t: any(w in s + "\0" + t for w in ("a", "字"))),
    "contains_nothing": (filters.contains, {}, lambda s, t: False),
    "contains_empty": (filters.contains, {"words": [""]}, lambda s, t: True),
    "digits_ratio": (
        filters.digits_ratio,
        {"max": 0.25},
        lambda s, t: any(_occurrences(x, str.isdigit) / len(x) >= 0.25 for x in (s, t)),
    ),
    "nonalphanum_ratio": (
        filters.nonalphanum_ratio,
        {},
        lambda s, t: any(_occurrences(x, _symbol) / len(x) >= 0.4 for x in (s, t)),
    ),
    "digits_mismatch": (filters.digits_mismatch, {}, lambda s, t: (_value(s) == 0) != (_value(t) == 0)),
    "nonalphanum_count_mismatch": (
        filters.nonalphanum_count_mismatch,
        {},
        lambda s, t: _occurrences(s, _symbol) != _occurrences(t, _symbol),
    ),
    "characters_count_mismatch": (
        filters.characters_count_mismatch,
        {},
        lambda s, t: any(s.count(c) != t.count(c) for c in filters.COMPARED_CHARACTERS),
    ),
    "characters_count_mismatch_list": (
        filters.characters_count_mismatch,
        {"chars": ["aA", "]", "^", "\\", "-", "😀"]},
        lambda s, t: any(s.count(c) != t.count(c) for c in ("aA", "]", "^", "\\", "-", "😀")),
    ),
    "characters_count_mismatch_class": (
        filters.characters_count_mismatch,
        {"chars": "]^\\-&[😀"},
        lambda s, t: any(s.count(c) != t.count(c) for c in "]^\\-&[😀"),
    ),
    "first_char_mismatch": (filters.first_char_mismatch, {}, _first),
    "limit_latin_chars": (
        filters.limit_latin_chars,
        {"s_chset": "Cyrl", "t_chset": "Latn", "max": 3},
        lambda s, t: _occurrences(s, lambda c: c.isascii() and c.isalpha()) > 3,
    ),
    "limit_latin_chars_target": (
        filters.limit_latin_chars,
        {"s_chset": "Latn", "t_chset": "Grek", "max": 1},
        lambda s, t: _occurrences(t, lambda c: c.isascii() and c.isalpha()) > 1,
    ),
    "limit_latin_chars_neither": (
        filters.limit_latin_chars,
        {"s_chset": "Latn", "t_chset": "Latn"},
        lambda s, t: False,
    ),
}


def test_filters_agree_with_python(frame, pairs):
    columns = [build(F.col("src"), F.col("tgt"), **args).alias(name) for name, (build, args, _) in FILTER_MODELS.items()]
    for row in frame.select("id", *columns).collect():
        src, tgt = pairs[row["id"]]
        for name, (_, _, model) in FILTER_MODELS.items():
            assert row[name] == model(src, tgt), (name, src, tgt)


def _balanced(line):
    """Loop model: delete one mark of each kind until the counts agree."""
    for a, b in ("“”", "«»"):
        if (line.count(a) + line.count(b)) % 2:
            line = line.replace(a, "").replace(b, "")
    if line.count('"') % 2:
        at = line.index('"')
        line = line[:at] + line[at + 1 :]
    for kind in ("[]", "()", "{}"):
        while line.count(kind[0]) != line.count(kind[1]):
            for mark in kind:
                line = line.replace(mark, "", 1)
    return line


def _case(s, t):
    if s and t and s[0].isalpha() and t[0].isalpha():
        if s[0].isupper() and not t[0].isupper():
            return s, t[0].upper() + t[1:]
        if s[0].islower() and not t[0].islower():
            return s, t[0].lower() + t[1:]
    return s, t


def _drop(s, t, pieces):
    for piece in pieces:
        s, t = s.replace(piece, ""), t.replace(piece, "")
    return s, t


TRANSFORM_MODELS = {
    "quotes": (transforms.remove_unpaired_quotes_and_brackets, {}, lambda s, t: (_balanced(s), _balanced(t))),
    "chars": (transforms.remove_chars, {"chars": "a(б"}, lambda s, t: _drop(s, t, "a(б")),
    "words": (transforms.remove_chars, {"chars": ["ab", "a", "", "い"]}, lambda s, t: _drop(s, t, ["ab", "a", "い"])),
    "nothing": (transforms.remove_chars, {}, lambda s, t: (s, t)),
    "case": (transforms.first_case_normalize, {}, _case),
    "html": (transforms.recode_html_escape_chars, {}, lambda s, t: (html.unescape(s), html.unescape(t))),
}


def test_transforms_agree_with_python(frame, pairs):
    columns = [
        F.struct(*build(F.col("src"), F.col("tgt"), **args)).alias(name)
        for name, (build, args, _) in TRANSFORM_MODELS.items()
    ]
    for row in frame.select("id", *columns).collect():
        for name, (_, _, model) in TRANSFORM_MODELS.items():
            assert tuple(row[name]) == model(*pairs[row["id"]]), (name, *pairs[row["id"]])


def test_html_references(spark):
    rows = [("A &amp; B", "&lt;b&gt; &#39;x&#x27; &hellip; &amp;quot; &bogus; &"), ("none", None)]
    spec = chain(transforms=["recode_html_escape_chars"])
    got = chains.transform_chain(spark.createDataFrame(rows, "src string, tgt string"), spec.transforms).collect()
    assert [tuple(r) for r in got] == [("A & B", "<b> 'x' … &quot; &bogus; &"), ("none", None)]


def test_html_references_agree_with_python(spark):
    """Every name and every number up to a whole plane and around the edges, then random texts of their parts."""
    rng = random.Random(3)
    names = [f"&{name}{end}" for name in html5 for end in ("", "x&amp", ";")]
    numbers = [*range(0, 0x300), *range(0xD7F0, 0xE010), *range(0xFDC0, 0xFE00), *range(0xFEF0, 0x10010)]
    numbers += [0x1F600, 0x1FFFE, 0x10FFFE, 0x10FFFF, 0x110000, 10**8, 2**64]
    parts = [*"&#;xX019aA mptlgq\n\té<", "amp", "not", "quot", "&#x", "&#", "&#00000000065"]
    mixed = ["".join(rng.choices(parts, k=rng.randint(0, 20))) for _ in range(5000)]
    texts = names + [f"&#{n};" for n in numbers] + [f"a&#X{n:x}" for n in numbers] + mixed
    pairs = spark.createDataFrame(list(enumerate(texts)), "n int, s string")
    recoded = transforms.recode_html_escape_chars(F.col("s"), F.col("s"))[0]
    for row in pairs.select("n", recoded.alias("got")).collect():
        assert row["got"] == html.unescape(texts[row["n"]]), texts[row["n"]]


def _punctuation(s, t, marks="?!."):
    if " " in s or " " in t or not s or not t:
        return []
    out = [(s[:-1], t[:-1]) for m in marks if s[-1] == m == t[-1]]
    if s[-1].isalnum() and s[-1] not in marks and t[-1] not in marks:
        out += [(s + m, t + m) for m in marks]
    return out


def _lowered(s, t):
    return [(s.lower(), t.lower())] if s.lower() != s and t.lower() != t else []


def test_augmenters_agree_with_python(frame, pairs):
    got = frame.select(
        "id",
        augmenters.single_word_punctuation(F.col("src"), F.col("tgt")).alias("marks"),
        augmenters.single_word_punctuation(F.col("src"), F.col("tgt"), chars="¿").alias("other"),
        augmenters.lowercase(F.col("src"), F.col("tgt")).alias("low"),
    )
    for row in got.collect():
        src, tgt = pairs[row["id"]]
        assert [tuple(p) for p in row["marks"]] == _punctuation(src, tgt), (src, tgt)
        assert [tuple(p) for p in row["other"]] == _punctuation(src, tgt, "¿"), (src, tgt)
        assert [tuple(p) for p in row["low"]] == _lowered(src, tgt), (src, tgt)


def test_strip_is_python_strip(spark):
    blanks = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    assert len(blanks) == 29 == len(chars.whitespace())
    texts = [b + "x" + b + "y" + b * 2 for b in blanks] + ["".join(blanks), "", "​x​"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chars.strip(F.col("t")).alias("s"))
    assert all(row["s"] == row["t"].strip() for row in got.collect())


def test_empty_and_missing_sides_are_dropped_uncounted(spark):
    rows = [("s", "", "a"), ("s", " ", "a"), ("s", None, "a"), ("s", "a", None), ("s", " a ", "b"), ("s", "c", "c")]
    df = spark.createDataFrame(rows, "source string, src string, tgt string")
    spec = chain(filters=["duplicates"])
    assert [tuple(r) for r in chains.preprocess(df, spec).select("src", "tgt").collect()] == [("a", "b")]
    report = {(r["source"], r["reason"]): r["removed"] for r in chains.rejection_report(df, spec).collect()}
    assert report == {("s", "duplicates"): 1, ("s", None): 1}


def test_chain_order_and_accounting(frame, pairs):
    """Kept, rejected and empty add up, and each rejection goes to the first filter that matches."""
    specs = [{"contains": {"words": ["a"]}}, "duplicates", {"char_length": {"min": 4}}, "first_char_mismatch", {"char_length": {"min": 5}}]
    spec = chain(filters=specs)
    models = [FILTER_MODELS["contains"][2], FILTER_MODELS["duplicates"][2], None, _first, None]
    models[0] = lambda s, t: "a" in s or "a" in t
    models[2] = lambda s, t: len(s) <= 4 or len(t) <= 4
    models[4] = lambda s, t: len(s) <= 5 or len(t) <= 5
    names = ["contains", "duplicates", "char_length", "first_char_mismatch", "char_length"]
    expected, kept = Counter(), []
    for s, t in ((s.strip(), t.strip()) for s, t in pairs):
        if s and t:
            reason = next((n for n, m in zip(names, models) if m(s, t)), None)
            if reason:
                expected[reason] += 1
            else:
                kept.append((s, t))
    df = frame.withColumn("source", F.lit("x"))
    report = {r["reason"]: r["removed"] for r in chains.rejection_report(df, spec).collect()}
    assert report.pop(None) == sum(expected.values())
    assert report == dict(expected)
    got = [(r["src"], r["tgt"]) for r in chains.preprocess(df, spec).select("src", "tgt").collect()]
    assert Counter(got) == Counter(kept)


def test_augmented_rows_follow_the_transformed_pair(spark):
    df = spark.createDataFrame([(1, "(Yes", "Sì")], "line_no int, src string, tgt string")
    spec = chain(
        transforms=["remove_unpaired_quotes_and_brackets"], augmenters=["single_word_punctuation", "lowercase"]
    )
    got = chains.preprocess(df, spec).orderBy("aug_ord").select("aug_ord", "aug", "src", "tgt").collect()
    assert [tuple(r) for r in got] == [
        (0, None, "Yes", "Sì"),
        (1, "single_word_punctuation", "Yes?", "Sì?"),
        (2, "single_word_punctuation", "Yes!", "Sì!"),
        (3, "single_word_punctuation", "Yes.", "Sì."),
        (4, "lowercase", "yes", "sì"),
    ]


def test_idempotence_and_reversal(frame):
    from twinline.operators.sides import swap_sides

    once = chains.transform_chain(frame, chain(transforms=["remove_unpaired_quotes_and_brackets", "first_case_normalize"]).transforms)
    twice = chains.transform_chain(once, chain(transforms=["remove_unpaired_quotes_and_brackets", "first_case_normalize"]).transforms)
    assert once.exceptAll(twice).isEmpty()
    assert swap_sides(swap_sides(frame)).exceptAll(frame).isEmpty()


@pytest.mark.parametrize(
    ("spec", "n", "kept"),
    [
        ([{"top": {"percent": 0}}], 10, range(1, 2)),
        ([{"top": {"percent": 50}}], 10, range(1, 7)),
        ([{"top": {"percent": 100}}], 10, range(1, 11)),
        ([{"top": {"percent": 29}}], 100, range(1, 30)),
        ([{"excerpt": {"top_percentile": 20, "bottom_percentile": 50}}], 10, range(2, 7)),
        ([{"excerpt": {"top_percentile": 20, "bottom_percentile": 50}}, {"top": {"percent": 80}}], 10, range(2, 10)),
        ([{"top": {"percent": 80}}, {"excerpt": {"top_percentile": 20, "bottom_percentile": 50}}], 10, range(2, 7)),
    ],
)
def test_cuts(spark, spec, n, kept):
    df = spark.range(1, n + 1).select(F.col("id").alias("line_no"), F.lit(n).alias("n_lines"))
    cut = chains.cut_lines(df, chain(filters=["duplicates", *spec]).cuts)
    assert sorted(r["line_no"] for r in cut.collect()) == list(kept)
