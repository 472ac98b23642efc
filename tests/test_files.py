"""Text files: numbering, pairing, exports, discovery, whole builds."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from twinline.__main__ import main as cli
from twinline.operators import chain as chains
from twinline.plans import build, search
from twinline.plans.config import manifest, pipeline_from_config
from twinline.sources import catalogue, scratch, text


def _file(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(path)


def _lines(df):
    return [r["line"] for r in df.orderBy("line_no").collect()]


def test_lines_split_on_lf_only(spark, tmp_path):
    path = _file(tmp_path / "a.txt", "a\r\nb\rc")
    got = text.read_lines(spark, path).orderBy("line_no").collect()
    assert [(r["line_no"], r["line"], r["n_lines"]) for r in got] == [(1, "a\r", 2), (2, "b\rc", 2)]
    assert text.count_lines(spark, path).head()["lines"] == 2


def test_empty_file_and_blank_lines(spark, tmp_path):
    assert text.read_lines(spark, _file(tmp_path / "empty", "")).count() == 0
    assert _lines(text.read_lines(spark, _file(tmp_path / "blank", "\n\nx\n\n"))) == ["", "", "x", ""]


def test_numbers_over_many_blocks_and_files(spark, tmp_path):
    """Small splits, uneven files, lines longer than a split: numbers still follow the text."""
    expected = []
    for n, size in enumerate((700, 3, 1500, 1)):
        lines = [f"{n}:{i}:" + "x" * ((i * 37) % 90 + (900 if i % 251 == 0 else 0)) for i in range(size)]
        _file(tmp_path / "corpus" / f"part-{n:05d}.txt", "\n".join(lines) + "\n")
        expected += lines
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 2000)
    try:
        got = text.read_lines(spark, str(tmp_path / "corpus"))
        assert got.rdd.getNumPartitions() > 10
        rows = got.orderBy("line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r["line_no"] for r in rows] == list(range(1, len(expected) + 1))
    assert [r["line"] for r in rows] == expected
    assert {r["n_lines"] for r in rows} == {len(expected)}


def test_pairing(spark, tmp_path):
    src = _file(tmp_path / "source.txt", "a\nb\nc\n")
    long = _file(tmp_path / "long.txt", "1\n2\n3\n4\n")
    short = _file(tmp_path / "short.txt", "1\n2")

    def pairs(tgt, **options):
        return [(r["src"], r["tgt"]) for r in text.read_parallel(spark, src, tgt, **options).orderBy("line_no").collect()]

    assert pairs(long) == [("a", "1"), ("b", "2"), ("c", "3")]
    assert pairs(short, strict=False) == [("a", "1"), ("b", "2")]
    with pytest.raises(Exception, match="target ends before source line"):
        pairs(short)


def test_bad_utf8_is_an_error(spark, tmp_path):
    path = _file(tmp_path / "bad", b"ok\n\xff\xfe\n")
    with pytest.raises(Exception, match="INVALID_UTF8|UTF"):
        text.read_lines(spark, path).collect()


def test_parallel_export_aligns(spark, tmp_path):
    rows = [(n, f"s{n}", f"t{n}" if n % 7 else "") for n in range(500)]
    df = spark.createDataFrame(rows, "n int, src string, tgt string").repartition(7)
    split = F.when(F.col("n") % 10 == 0, "val").otherwise("train")
    out = str(tmp_path / "out")
    text.write_parallel(df, out, ["n"], split, parts=5)
    for name, wanted in (("train", [r for r in rows if r[0] % 10]), ("val", [r for r in rows if r[0] % 10 == 0])):
        sides = []
        for side in ("src", "tgt"):
            parts = sorted((tmp_path / "out" / f"file={side}-{name}").glob("part-*"))
            assert len(parts) == 5
            sides.append([p.read_text().split("\n")[:-1] for p in parts])
        assert [list(map(len, s)) for s in sides][0] == [list(map(len, s)) for s in sides][1]
        assert [x for part in sides[0] for x in part] == [r[1] for r in wanted]
        assert [x for part in sides[1] for x in part] == [r[2] for r in wanted]
    with pytest.raises(Exception, match="line feed"):
        text.write_parallel(spark.createDataFrame([(1, "a\nb", "c")], "n int, src string, tgt string"), str(tmp_path / "x"), ["n"])


def test_evaluation_sets(spark, tmp_path):
    _file(tmp_path / "dev" / "eng_Latn.dev", " Hello \nBye\n")
    _file(tmp_path / "dev" / "ita_Latn.dev", "Ciao\nAddio")
    sets = text.read_eval_set(spark, str(tmp_path), "en", "dev").unionByName(
        text.read_eval_set(spark, str(tmp_path), "it", "dev")
    )
    got = text.eval_pairs(sets, "it", "en", "dev").orderBy("line_no").collect()
    assert [tuple(r) for r in got] == [(1, "Ciao", " Hello "), (2, "Addio", "Bye")]
    for lang, split in (("en", "test"), ("xx", "dev")):
        with pytest.raises(ValueError):
            text.read_eval_set(spark, str(tmp_path), lang, split)


def test_hypotheses_in_order(spark, tmp_path):
    df = spark.createDataFrame([(n, f"line {n}") for n in range(1, 200)], "line_no int, hyp string").repartition(5)
    text.write_hypotheses(df, str(tmp_path / "h"))
    assert _lines(text.read_lines(spark, str(tmp_path / "h"))) == [f"line {n}" for n in range(1, 200)]


def test_discovery_uses_file_names_only(spark, tmp_path):
    root = tmp_path / "my-source-target"
    for name in ("one/source.txt", "one/Target.TXT", "one/readme", "two/x.en", "two/x.IT", "two/old/x.en", "two/old/source"):
        _file(root / name, "x\n")
    root, folders = root, f"{root}/*"
    got = {
        r["folder"].rsplit("/", 1)[1]: r for r in catalogue.discover_corpora(spark, folders, "en", "it").collect()
    }
    assert set(got) == {"one", "two"}
    [alone] = catalogue.discover_corpora(spark, f"{root}/two", "en", "it").collect()
    assert alone == got["two"]
    assert got["one"]["src_path"].endswith("one/source.txt") and got["one"]["tgt_path"].endswith("one/Target.TXT")
    assert not got["one"]["src_by_lang"] and got["two"]["src_by_lang"] and got["two"]["tgt_by_lang"]
    _file(root / "with blank+%20" / "source", "")
    _file(root / "with blank+%20" / "target", "x\n")
    [odd] = catalogue.discover_corpora(spark, f"{root}/with blank*", "en", "it").collect()
    assert odd["folder"].endswith("/with blank+%20") and text.count_lines(spark, odd["src_path"]).count() == 1
    _file(root / "two" / "y.en", "x\n")
    with pytest.raises(Exception, match="exactly one"):
        catalogue.discover_corpora(spark, folders, "en", "it").collect()
    loose = catalogue.discover_corpora(spark, folders, "en", "it", strict=False).filter("src_path IS NULL")
    assert loose.count() == 1


def test_catalogue_lookup(spark, capsys):
    rows = [(2, "News", "en", "it", "u2"), (1, "News", "en", "it", "u1"), (3, "news", "en", "it", "u3"), (4, "One", "en", "de", "u4")]
    listing = spark.createDataFrame(rows, "pos int, corpus string, src_lang string, tgt_lang string, url string")
    assert catalogue.resolve_corpus(listing, "News", "en", "it") == "u1"
    assert "2 entries" in capsys.readouterr().out
    with pytest.raises(LookupError):
        catalogue.resolve_corpus(listing, "One", "en", "it")
    wanted = listing.filter("corpus = 'One'")
    assert [tuple(r) for r in catalogue.resolve_corpora(listing, wanted).collect()] == [("One", "en", "de", "u4", 1)]


@pytest.fixture()
def configured(tmp_path):
    """Two plain corpora, one found by language endings, one weighted."""
    _file(tmp_path / "a" / "source.txt", "".join(f"Hello number {n}\n" for n in range(40)) + "Same\n(open\n")
    _file(tmp_path / "a" / "target.txt", "".join(f"Ciao numero {n}\n" for n in range(40)) + "Same\naperto\n")
    _file(tmp_path / "b" / "x.en", "Hello number 1\nYes\n\n")
    _file(tmp_path / "b" / "x.it", "Ciao numero 1\nSì\nvuoto\n")
    _file(tmp_path / "w" / "source.txt", "raw\n raw \n")
    _file(tmp_path / "w" / "target.txt", "crudo\ncrudo\n")
    conf = {
        "from": {"name": "English", "code": "en"},
        "to": {"name": "Italian", "code": "it"},
        "version": "1.0",
        "filters": ["duplicates"],
        "transforms": ["remove_unpaired_quotes_and_brackets"],
        "sources": [
            f"file://{tmp_path}/a",
            {"source": "b-corpus", "augmenters": ["lowercase"]},
            {"source": f"file://{tmp_path}/w", "weight": 2},
        ],
    }
    return conf, {"b-corpus": str(tmp_path / "b")}


def test_whole_build(spark, tmp_path, configured):
    conf, folders = configured
    plan = pipeline_from_config(json.dumps(conf))
    corpora = build.read_corpora(spark, plan, folders)
    built = build.build_corpus(spark, plan, corpora)
    pairs = built.pairs.cache()
    # 41 pairs from a, 2 from b with 2 lowercased; one pair occurs in both.
    stats = {r["source"]: r for r in built.stats.collect()}
    assert (stats[plan.corpora[0].name]["added"], stats["b-corpus"]["added"]) == (41, 4)
    assert {r["validation_size"] for r in stats.values()} == {9} and {r["training_size"] for r in stats.values()} == {36}
    got = {(r["src"], r["tgt"]): r for r in pairs.collect()}
    assert len(got) == 44 and ("open", "aperto") in got and ("Same", "Same") not in got
    assert got["Hello number 1", "Ciao numero 1"]["source"] == plan.corpora[0].name
    assert got["Hello number 1", "Ciao numero 1"]["copies"] == 2
    assert sum(r["split"] == "val" for r in got.values()) == 9
    assert [r["src"] for r in built.weighted.orderBy("line_no").collect()] == ["raw", " raw "]

    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    assert build.run(spark, plan, corpora, out, state)
    assert not build.run(spark, plan, corpora, out, state)
    written = text.read_parallel(spark, f"{out}/file=src-val", f"{out}/file=tgt-val")
    assert {(r["src"], r["tgt"]) for r in written.collect()} == {k for k, r in got.items() if r["split"] == "val"}
    sample = build.sentence_sample(built, plan)
    assert sample.count() == 2 * (44 - 9 + 2) and sample.filter("text = ' raw '").count() == 1
    with_copies = build.build_corpus(spark, plan, corpora, remove_duplicates=False).pairs
    assert with_copies.count() == 45 and with_copies.filter("split = 'val'").count() == 9


def test_reversed_build(spark, configured):
    conf, folders = configured
    plan = pipeline_from_config(conf, reverse=True)
    assert (plan.src_lang, plan.tgt_lang) == ("it", "en")
    corpora = build.read_corpora(spark, plan, folders)
    first = {name: df.filter("line_no = 1").select("src", "tgt").head() for name, df in corpora.items()}
    assert tuple(first[plan.corpora[0].name]) == ("Ciao numero 0", "Hello number 0")
    assert tuple(first["b-corpus"]) == ("Ciao numero 1", "Hello number 1")


def test_failed_build_is_not_remembered(spark, tmp_path, configured):
    conf, folders = configured
    conf["filters"] = [{"contains": {"words": [""]}}]
    plan = pipeline_from_config(conf)
    corpora = build.read_corpora(spark, plan, folders)
    for _ in range(2):
        with pytest.raises(ValueError, match="no sources merged"):
            build.run(spark, plan, corpora, str(tmp_path / "o"), str(tmp_path / "s"))


def test_only_weighted_corpora_use_the_evaluation_set(spark, configured):
    conf, folders = configured
    conf["sources"] = [{"source": "b-corpus", "weight": 1}]
    plan = pipeline_from_config(conf)
    corpora = build.read_corpora(spark, plan, folders)
    with pytest.raises(ValueError, match="evaluation set"):
        build.build_corpus(spark, plan, corpora)
    dev = spark.createDataFrame([(1, "a", "b")], "line_no bigint, src string, tgt string")
    built = build.build_corpus(spark, plan, corpora, evaluation=dev)
    assert [tuple(r) for r in built.pairs.collect()] == [(1, "a", "b", "val")]
    assert built.weighted.count() == 3


def test_configuration_rules(spark):
    base = {"from": {"code": "en"}, "to": {"code": "ru"}, "filters": ["duplicates"]}
    entry = {"source": "x", "filters": [{"char_length": {"min": 1}}, {"limit_latin_chars": {"max": 3}}]}
    plan = pipeline_from_config({**base, "sources": ["x", {"source": "y", "weight": 2}, entry]})
    assert [c.name for c in plan.corpora] == ["x", "y"]
    assert [op.name for op in plan.corpora[0].chain.filters] == ["duplicates", "char_length", "limit_latin_chars"]
    assert plan.corpora[0].chain.filters[2].args == {"s_chset": "Latn", "t_chset": "Cyrl", "max": 3}
    assert plan.weights == {"y": 2} and plan.chains["y"] is None and not plan.all_weighted
    rows = manifest(spark, plan).orderBy("source_ord").collect()
    assert [(r["name"], r["weight"], len(r["filters"])) for r in rows] == [("x", None, 3), ("y", 2, 1)]
    for bad in (
        ["nonsense"],
        [{"char_length": {"least": 1}}],
        [{"top": {}}],
        ["top"],
        [{"duplicates": {}, "contains": {}}],
    ):
        with pytest.raises(ValueError):
            pipeline_from_config({**base, "sources": [{"source": "x", "filters": bad}]})
    with pytest.raises(ValueError, match="'source' key"):
        pipeline_from_config({**base, "sources": [{"weight": 1}]})
    with pytest.raises(LookupError):
        build.corpus_folder(plan, "https://example.org/x.zip", {}, None)


def test_scratch_follows_the_session_setting(spark):
    root = spark.conf.get(scratch.SETTING, None)
    assert scratch.scratch_root(spark) == (root.rstrip("/") if root else spark.conf.get(scratch.SETTING))
    first, second = (scratch.fresh_path(spark, "x") for _ in range(2))
    assert first != second


def test_search_in_files(spark, tmp_path):
    src, tgt = _file(tmp_path / "s", "One\nHELLO you\n"), _file(tmp_path / "t", " hello \nDue\nhello extra")
    files = {"a": (src, tgt), "b": (tgt, src)}
    hits = {tuple(r) for r in search.find_in_files(spark, files, "Hello").collect()}
    assert hits == {
        ("a", "src", 2, "HELLO you"), ("a", "tgt", 1, " hello "), ("a", "tgt", 3, "hello extra"),
        ("b", "tgt", 2, "HELLO you"), ("b", "src", 1, " hello "), ("b", "src", 3, "hello extra"),
    }
    assert search.find_in_files(spark, files, "HELLO", exact=True).count() == 2


def test_command_line(spark, tmp_path, configured, capsys):
    conf, folders = configured
    config = _file(tmp_path / "conf.json", json.dumps(conf))
    folder = [f"--folder={name}={path}" for name, path in folders.items()]
    build_args = ["build", "--config", config, *folder, "--out", str(tmp_path / "cli"), "--state", str(tmp_path / "st")]
    cli(build_args)
    cli(build_args)
    cli(["find", "--config", config, *folder, "--text", "yes"])
    cli(["bleu", "--hyp", f"{folders['b-corpus']}/x.en", "--ref", f"{folders['b-corpus']}/x.en", "--sentence", "0"])
    out = capsys.readouterr().out
    assert "written to" in out and "no changes in sources" in out
    assert "b-corpus (src):2 => Yes" in out
    assert "hypothesis> Hello number 1" in out and "BLEU score:" in out


def test_build_writes_the_weighted_corpora(spark, tmp_path, configured):
    conf, folders = configured
    _file(tmp_path / "w" / "source.txt", "raw\n raw \n" + "x " * 200 + "\nthird\nfourth\n")
    _file(tmp_path / "w" / "target.txt", "crudo\ncrudo\ny\nterzo\nquarto\n")
    conf["filters"] = ["duplicates", {"char_length": {"min": 3}}]
    out = str(tmp_path / "out")
    folder = [f"--folder={name}={path}" for name, path in folders.items()]
    args = ["build", *folder, "--out", out, "--state", str(tmp_path / "st"), "--config"]
    cli([*args, _file(tmp_path / "c.json", json.dumps(conf))])
    mix = text.read_parallel(spark, f"{out}/file=src-mix", f"{out}/file=tgt-mix").orderBy("line_no").collect()
    train = text.read_parallel(spark, f"{out}/file=src-train", f"{out}/file=tgt-train").collect()
    weighted = [("raw", "crudo"), (" raw ", "crudo"), ("third", "terzo"), ("fourth", "quarto")]
    got = [(r["src"], r["tgt"]) for r in mix]
    assert sorted(got) == sorted([*weighted, *((r["src"], r["tgt"]) for r in train)])  # the line of 200 words is too long
    assert [got[i] for i in (1, 2, 4, 5)] == weighted  # one merged pair, then two of the corpus
    sample = [r["value"] for r in spark.read.text(f"{out}/file=sample").collect()]
    assert len(sample) == 2 * (len(train) + 5) and " raw " in sample
    report = spark.read.json(f"{out}/file=rejections").collect()
    plan = pipeline_from_config(json.dumps(conf))
    corpora = build.read_corpora(spark, plan, folders)
    wanted = [chains.rejection_report(corpora[c.name], c.chain) for c in plan.corpora if c.weight is None]
    assert sorted((r["source"], str(r["reason"]), r["removed"]) for r in report if "reason" in r) == sorted(
        (r["source"], str(r["reason"]), r["removed"]) for df in wanted for r in df.collect()
    )
    assert {r["source"] for r in report} >= {conf["sources"][0]} and all(r["removed"] > 0 for r in report)

    conf["sources"] = [conf["sources"][2]]
    for code, line in (("en", "dev"), ("it", "prova")):
        _file(tmp_path / "eval" / "devtest" / f"{text.languages.codes()[code]}.devtest", f"{line}\n")
    cli([*args, _file(tmp_path / "all.json", json.dumps(conf)), "--evaluation", str(tmp_path / "eval")])
    rows = text.read_parallel(spark, f"{out}/file=src-val", f"{out}/file=tgt-val").collect()
    assert [(r["src"], r["tgt"]) for r in rows] == [("dev", "prova")]
    rows = text.read_parallel(spark, f"{out}/file=src-mix", f"{out}/file=tgt-mix").orderBy("line_no").collect()
    assert [(r["src"], r["tgt"]) for r in rows] == weighted


def test_part_files_are_read_by_number_and_counted_when_empty(spark, tmp_path):
    for n, content in ((99999, "a\nb\n"), (100000, "c\n"), (7, ""), (100001, "d\ne")):
        _file(tmp_path / "parts" / f"part-{n:05d}.txt", content)
    rows = text.read_lines(spark, str(tmp_path / "parts")).orderBy("line_no").collect()
    assert [r["line"] for r in rows] == ["a", "b", "c", "d", "e"]
    counts = {r["file"].rsplit("/", 1)[1]: r["lines"] for r in text.count_lines(spark, str(tmp_path / "parts")).collect()}
    assert counts == {"part-00007.txt": 0, "part-99999.txt": 2, "part-100000.txt": 1, "part-100001.txt": 2}


def test_a_finished_export_takes_the_place_of_an_earlier_one(spark, tmp_path, configured):
    out = str(tmp_path / "out")
    for words in (["x", "y"], ["z"]):
        new = tmp_path / f"new-{words[0]}"
        for word in words:
            _file(new / f"{word}.txt", word)
        scratch.put_in_place(spark, str(new), out)
        assert sorted(f.name for f in (tmp_path / "out").iterdir() if not f.name.startswith(".")) == sorted(f"{w}.txt" for w in words)
    assert sorted(f.name for f in tmp_path.iterdir() if f.name.startswith(("out", "new"))) == ["out"]

    conf, folders = configured
    plan = pipeline_from_config(conf)
    corpora = build.read_corpora(spark, plan, folders)
    broken = {**corpora, "b-corpus": corpora["b-corpus"].withColumn("tgt", F.raise_error(F.concat("src", F.lit(" is bad"))).cast("string"))}
    with pytest.raises(Exception, match="is bad"):
        build.run(spark, plan, broken, out, str(tmp_path / "state"))
    assert (tmp_path / "out" / "z.txt").exists()  # what was there before
    assert build.run(spark, plan, corpora, out, str(tmp_path / "state"))
    assert not (tmp_path / "out" / "z.txt").exists()
    stats = {r["source"]: r for r in spark.read.json(f"{out}/file=stats").collect()}
    assert stats["b-corpus"]["added"] == 4 and stats["b-corpus"]["training_size"] == 36


def test_changed_operators_count_where_asked(spark, tmp_path, configured):
    conf, folders = configured
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def ran(filters, **options):
        plan = pipeline_from_config({**conf, "filters": filters})
        return build.run(spark, plan, build.read_corpora(spark, plan, folders), out, state, **options)

    assert ran(["duplicates"], operators=True) and not ran(["duplicates"], operators=True)
    assert ran([], operators=True) and ran([]) and not ran(["duplicates"])


def test_named_corpora_and_searches_that_go_on(spark, tmp_path, configured, capsys):
    conf, folders = configured
    named = _file(tmp_path / "catalogue", f"Other\ten\tit\t/nowhere\nBooks\ten\tit\t{tmp_path}/a\n\nBooks\ten\tde\t/nowhere\n")
    _file(tmp_path / "empty" / "note", "x")
    conf["sources"] = ["opus://Books", "missing", {"source": "b-corpus"}, f"file://{tmp_path}/empty", f"file://{tmp_path}/none"]
    config = _file(tmp_path / "named.json", json.dumps(conf))
    cli(["find", "--config", config, f"--folder=b-corpus={folders['b-corpus']}", "--catalogue", named, "--text", "Hello number 1"])
    out = capsys.readouterr().out
    assert "opus://Books (src):2 => Hello number 1" in out and "b-corpus (src):1 => Hello number 1" in out
    assert "cannot search missing" in out and f"cannot search file://{tmp_path}/empty" in out and f"cannot search file://{tmp_path}/none" in out
    table = str(tmp_path / "hits")
    cli(["find", "--config", config, "--catalogue", named, "--text", "Hello number 1", "--out", table])
    assert spark.read.parquet(table).filter("source = 'opus://Books' AND side = 'src'").count() > 0
    with pytest.raises(Exception, match="not four fields"):
        catalogue.read_catalogue(spark, _file(tmp_path / "bad", "a\tb\n")).collect()


def test_an_export_takes_the_place_of_an_earlier_one(spark, tmp_path):
    out = str(tmp_path / "out")
    for words in (["x", "y"], ["z"]):
        pairs = spark.createDataFrame([(i, w, w + "2") for i, w in enumerate(words)], "n int, src string, tgt string")
        text.write_parallel(pairs, out, ["n"], "train", mode="overwrite")
    rows = text.read_parallel(spark, f"{out}/file=src-train", f"{out}/file=tgt-train").collect()
    assert [(r["src"], r["tgt"]) for r in rows] == [("z", "z2")]
