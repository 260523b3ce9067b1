"""``python -m corpusloom.cli curate|chat ...``"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from corpusloom.functions.names import parse_upweights
from corpusloom.logs import setup_logging
from corpusloom.operators.chat import TEMPLATE
from corpusloom.plans import chatprep, curate
from corpusloom.sources import readers


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="corpusloom")
    stages = out.add_subparsers(dest="stage", required=True)
    one = stages.add_parser("curate", help="deduplicate records of source code")
    one.add_argument("input", help="table with a name column, code and accuracy")
    one.add_argument("--out", default="curation_output")
    one.add_argument("--format", default="parquet")
    one.add_argument("--code-column", help="the first of nn_code and code that the table has, unless named")
    one.add_argument("--include", action="append", default=[], help="prefix of names to keep; may be repeated")
    one.add_argument("--prefer", "--prefer-prefix-order", action="append", default=[], help="prefixes preferred among exact copies, in order; the includes unless given")
    one.add_argument("--min-per-prefix", type=int, default=1)
    one.add_argument("--keep-per-family", type=int, default=5)
    one.add_argument("--lex-fractal", "--lex-thresh-fractal", type=float, default=0.97)
    one.add_argument("--topup", "--topup-prefix", action="append", default=[])
    one.add_argument("--topup-per-prefix", type=int, default=10)
    one.add_argument("--topup-lex-max", type=float, default=0.85)
    one.add_argument("--topup-struct-max", type=float, default=0.60)
    one.add_argument("--upweight", action="append", default=[], help="PREFIX:FACTOR for sampling_weights.csv")
    one.add_argument("--retrieval", choices=("exact", "lsh"), default="exact")
    one.add_argument("--code-dir", "--dump-accepted-code-dir", default="accepted_code", help="folder under --out for the code of kept records")
    one.add_argument("--single-files", action="store_true", help="write single JSON documents instead of folders of JSON lines")
    two = stages.add_parser("chat", help="build chat examples from the code of kept records")
    two.add_argument("source_dir", nargs="?", default="curation_output/accepted_code")
    two.add_argument("--out", default="curation_output/chat_data")
    two.add_argument("--seed", type=int, default=42)
    for flags in (("--infill",), ("--group-by-source",), ("--fix-fences",), ("--require-parse", "--drop-unparseable"), ("--require-module",), ("--drop-report",)):
        two.add_argument(*flags, action=argparse.BooleanOptionalAction, default=True)
    two.add_argument("--render", action="store_true", help="also write the messages rendered by a template")
    two.add_argument("--template", default=TEMPLATE, help="a message's role and content go into its two %%s")
    for stage in (one, two):
        stage.add_argument("-v", "--verbose", action="store_true")
    return out


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    setup_logging(a.verbose)
    spark = SparkSession.builder.appName(f"corpusloom-{a.stage}").getOrCreate()
    if a.stage == "curate":
        given = lambda values: [v.strip() for v in values if v.strip()]
        config = curate.Curation(
            given(a.include), given(a.prefer) or None, a.min_per_prefix, a.keep_per_family, lexical_fractal=a.lex_fractal, topup_prefixes=given(a.topup) or None,
            topup_per_prefix=a.topup_per_prefix, topup_lexical=a.topup_lex_max, topup_structural=a.topup_struct_max, retrieval=a.retrieval,
        )
        table = readers.table(spark, a.input, a.format)
        code = a.code_column or next(c for c in ("nn_code", "code") if c in table.columns)
        result = curate.curate(readers.source_rows(table, code), config)
        curate.write_artifacts(result, a.out, config, parse_upweights(a.upweight), a.code_dir, a.single_files)
    else:
        chatprep.run(spark, chatprep.ChatPrep(a.source_dir, a.out, a.seed, infill=a.infill, group_by_source=a.group_by_source, fix_fences=a.fix_fences, require_parse=a.require_parse, require_module=a.require_module, drop_report=a.drop_report, render=a.render, template=a.template))


if __name__ == "__main__":
    main()
