"""Command line: ``spark-submit`` this module or run ``python -m galecast <command> <root> ...``."""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession

from galecast.model import LEVELS, FilterSpec
from galecast.operators.batches import batch_params
from galecast.plans import pipeline, serving, states, warehouse
from galecast.plans.warehouse import Lake


def show(names: list[str], rows: Iterable[Row]) -> None:
    """Tab-separated lines, written as they arrive."""
    print(*names, sep="\t")
    for row in rows:
        print(*("" if value is None else value for value in row), sep="\t")


def deliver(df: DataFrame, out: str | None, limit: int | None) -> None:
    """All rows in their order, streamed partition by partition to the screen or written as CSV.

    Only an explicit limit cuts them, and says how many it leaves out.
    """
    if limit is not None:
        left = max(df.count() - limit, 0)
        df = df.limit(limit)
        print(f"{left} more rows are left out", file=sys.stderr)
    if out:
        df.write.mode("errorifexists").csv(out, header=True)
    else:
        show(df.columns, df.toLocalIterator(prefetchPartitions=True))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="galecast", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, help_text: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=help_text)
        sub.add_argument("root", help="root folder of the tables")
        sub.add_argument("--run", help="run identifier (default: the latest)")
        return sub

    bronze = command("requests", "store a city list and write the request parameters of its batches")
    bronze.add_argument("--cities", required=True, help="CSV file")
    bronze.add_argument("--out", required=True, help="folder for the parameters (JSON lines)")
    stored = command("bronze", "match stored responses to the run's cities")
    stored.add_argument("--payloads", required=True, help="JSON lines: batch_no, attempt, payload")
    for name in ("silver", "run"):
        sub = command(name, "clean a run" if name == "silver" else "silver, gold and load")
        if name == "run":
            sub.add_argument("--pending", action="store_true", help="every run that is not loaded yet")
        sub.add_argument("--whole-document", action="store_true", help="Bronze holds one JSON array per file")
    command("gold", "score a run")
    command("load", "load a run into the warehouse")
    upkeep = command("upkeep", "merge the files of dates that consist of many loads")
    upkeep.add_argument("--most-loads", type=int, default=warehouse.MOST_LOADS)
    upkeep.add_argument("--remove", action="store_true", help="also remove folders that no reader needs any more")

    def reading(name: str, help_text: str) -> argparse.ArgumentParser:
        sub = command(name, help_text)
        sub.add_argument("--out", help="folder for the whole answer (CSV) instead of the screen")
        sub.add_argument("--limit", type=int, help="at most so many rows")
        return sub

    reading("check", "list what breaks the constraints of the stored tables")
    reading("query", "answer one of the six questions").add_argument("question", choices=states.QUESTIONS)
    sql = reading("sql", "run SQL over villes and previsions")
    sql.add_argument("text")
    panel = reading("panel", "show a dashboard panel under a selection")
    panel.add_argument("panel", choices=[*serving.PANELS, "options"])
    panel.add_argument("--city", action="append", default=[])
    panel.add_argument("--days", type=int, choices=(3, 7))
    panel.add_argument("--date", action="append", default=[])
    panel.add_argument("--level", action="append", default=[], choices=LEVELS)
    return top


def answer(spark: SparkSession, lake: Lake, args: argparse.Namespace) -> DataFrame:
    """The result of a reading command."""
    known = warehouse.contents(spark, lake)
    cities, current = warehouse.current_cities(spark, lake, known), warehouse.latest_facts(spark, lake, known)
    if args.command == "query":
        return states.QUESTIONS[args.question](warehouse.figures(spark, lake, known), cities)
    if args.command == "check":
        return warehouse.constraint_report(spark, lake)
    if args.command == "sql":
        warehouse.register_views(spark, lake)
        return spark.sql(args.text)
    if not known.latest:
        raise ValueError("the warehouse holds no forecasts")
    if args.panel == "options":
        return serving.filter_options(current, cities)
    spec = FilterSpec(tuple(args.city), args.days, tuple(args.date), tuple(args.level))
    if args.panel in states.PANELS:
        return states.PANELS[args.panel](warehouse.figures(spark, lake, known).select(cities, spec), cities)
    return serving.PANELS[args.panel](serving.select_forecasts(current, cities, spec, version=None), cities)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(name)s: %(message)s")
    spark = SparkSession.builder.appName("galecast").getOrCreate()
    lake = Lake(args.root)
    if args.command == "requests":
        run = args.run or pipeline.new_run()
        pipeline.store_cities(spark, args.cities, lake, run)
        batch_params(pipeline.plan_requests(spark, lake, run)).write.json(args.out)
        print(run)
    elif args.command == "bronze":
        run = args.run or pipeline.latest_common_run(spark, lake.bronze_cities)
        payloads = spark.read.schema("batch_no bigint, attempt int, payload string").json(args.payloads)
        print(pipeline.store_forecasts(spark, payloads, lake, run))
    elif args.command == "silver":
        print(pipeline.build_silver(spark, lake, args.run, args.whole_document))
    elif args.command == "gold":
        print(pipeline.build_gold(spark, lake, args.run))
    elif args.command == "load":
        print(pipeline.load_warehouse(spark, lake, args.run))
    elif args.command == "upkeep":
        print(len(warehouse.merge_files(spark, lake, args.most_loads)), "dates merged")
        if args.remove:
            print(warehouse.remove_unused(spark, lake), "folders removed")
    elif args.command == "run" and args.pending:
        print(pipeline.run_pending(spark, lake, args.whole_document))
    elif args.command == "run":
        print(pipeline.run_all(spark, lake, args.run, args.whole_document))
    else:
        deliver(answer(spark, lake, args), args.out, args.limit)


if __name__ == "__main__":
    main()
