"""Command line: ``python -m stocktake ingest|build|ask|raw|history ...``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from stocktake.plans.bronze import VersionedTable, batch_summary, compare_versions
from stocktake.plans.build import build_layers, check_layers, current_bronze, open_layers
from stocktake.plans.ingest import run_bronze
from stocktake.plans.quality import ChecksFailed, require_passed, summary
from stocktake.plans.reports import QUESTIONS, count_by_value, raw_defects
from stocktake.session import build_session

SHOWN = 1000


def report(df: DataFrame, to: str | None) -> None:
    """All rows as CSV below a path, if one is given; on the screen only the first ones."""
    if to:
        df.write.option("header", True).csv(to)
    else:
        df.show(SHOWN, truncate=False)
        print(f"the first {SHOWN} rows at most; --to PATH writes all")


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    print(f"{run_bronze(spark, args.raw, args.bronze)} new version(s)")


def build(spark: SparkSession, args: argparse.Namespace) -> None:
    checks = check_layers(build_layers(current_bronze(spark, args.bronze), args.layers))
    checks.filter("situacao <> 'PASS'").show(SHOWN, truncate=False)
    summary(checks).show()
    require_passed(checks)


def ask(spark: SparkSession, args: argparse.Namespace) -> None:
    report(QUESTIONS[args.question](open_layers(spark, args.layers)), args.to)


def raw(spark: SparkSession, args: argparse.Namespace) -> None:
    bronze = current_bronze(spark, args.bronze)
    columns = ["numero_patrimonio", "valor_atual", "situacao_bem", "_arquivo_origem"]
    raw_defects(bronze.register, columns, "numero_patrimonio").show(truncate=False)
    count_by_value(bronze.readings, "origem_leitura", "leituras").show(SHOWN, truncate=False)


def history(spark: SparkSession, args: argparse.Namespace) -> None:
    table = VersionedTable(spark, args.table)
    report(table.history_report(), args.to)
    if "exercicio" in table.snapshot().columns:
        compared = compare_versions(table, lambda df: batch_summary(df, ["exercicio"]), args.version)
        compared.orderBy("versao", "exercicio").show(SHOWN, truncate=False)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="stocktake")
    commands = parser.add_subparsers(required=True)

    def command(run, *arguments: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(run.__name__)
        for argument in arguments:
            sub.add_argument(argument)
        sub.set_defaults(run=run)
        return sub

    command(ingest, "raw", "bronze")
    command(build, "bronze", "layers")
    asked = command(ask, "layers")
    asked.add_argument("question", choices=sorted(QUESTIONS))
    asked.add_argument("--to")
    command(raw, "bronze")
    told = command(history, "table")
    told.add_argument("--version", type=int)
    told.add_argument("--to")
    args = parser.parse_args(argv)
    try:
        args.run(build_session(), args)
    except ChecksFailed as failed:
        print(f"checks failed: {failed}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
