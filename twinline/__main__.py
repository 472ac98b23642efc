"""Command line: ``python -m twinline build|find|bleu``. Run it through ``spark-submit`` on a cluster."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from twinline.operators import bleu
from twinline.plans import build, search
from twinline.plans.config import Plan, pipeline_from_config
from twinline.sources import catalogue, text


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="twinline")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("build", "find"):
        command = commands.add_parser(name)
        command.add_argument("--config", default="model-config.json")
        command.add_argument("--reverse", action="store_true", help="exchange the two languages")
        command.add_argument(
            "--folder", action="append", default=[], metavar="SOURCE=PATH", help="where a remote source was put"
        )
        command.add_argument("--catalogue", metavar="FILE", help="corpus, languages and folder of named corpora, tab-separated")
    commands.choices["build"].add_argument("--out", required=True)
    commands.choices["build"].add_argument("--state", required=True, help="table remembering the last build")
    commands.choices["build"].add_argument(
        "--evaluation", metavar="ROOT", help="evaluation set whose devtest is for validation where all corpora are weighted"
    )
    commands.choices["build"].add_argument("--operators", action="store_true", help="build anew when only operators changed, too")
    commands.choices["find"].add_argument("--out", help="write the matches there as a table instead of printing them")
    commands.choices["find"].add_argument("--text", required=True)
    commands.choices["find"].add_argument("--exact", action="store_true")
    score = commands.add_parser("bleu")
    score.add_argument("--hyp", required=True)
    score.add_argument("--ref", required=True)
    score.add_argument("--sentence", type=int, help="score one sentence, counted from 0")
    return parser


def _plan(args: argparse.Namespace) -> tuple[Plan, dict[str, str]]:
    plan = pipeline_from_config(Path(args.config).read_text(encoding="utf-8"), args.reverse)
    return plan, dict(entry.rsplit("=", 1) for entry in args.folder)


def _listing(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    return catalogue.read_catalogue(spark, args.catalogue) if args.catalogue else None


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName("twinline").getOrCreate()
    if args.command == "build":
        plan, folders = _plan(args)
        corpora = build.read_corpora(spark, plan, folders, _listing(spark, args))
        evaluation = None
        if plan.all_weighted and args.evaluation:
            sides = [text.read_eval_set(spark, args.evaluation, lang, "devtest") for lang in (plan.src_lang, plan.tgt_lang)]
            evaluation = text.eval_pairs(sides[0].unionByName(sides[1]), plan.src_lang, plan.tgt_lang, "devtest")
        ran = build.run(spark, plan, corpora, args.out, args.state, args.operators, evaluation=evaluation)
        print(f"written to {args.out}" if ran else "no changes in sources")
    elif args.command == "find":
        plan, folders = _plan(args)
        sides, wrong = search.readable(spark, plan, folders, _listing(spark, args))
        for name, reason in wrong.items():
            print(f"cannot search {name}: {reason}")
        if not sides:
            return
        hits = search.find_in_files(spark, sides, args.text, args.exact)
        if args.out:
            hits.write.parquet(args.out)
            return
        for hit in hits.toLocalIterator():
            print(f"{hit['source']} ({hit['side']}):{hit['line_no']} => {hit['text']}")
    else:
        scored = text.read_parallel(spark, args.hyp, args.ref).select(
            "line_no", F.col("src").alias("hyp"), F.col("tgt").alias("ref")
        )
        if args.sentence is not None:
            scored = bleu.sentence_lookup(scored, args.sentence)
            for row in scored.collect():
                print(f"reference> {row['ref']}\nhypothesis> {row['hyp']}")
        print(f"BLEU score: {bleu.corpus_bleu(scored).head()['bleu']}")


if __name__ == "__main__":
    main()
