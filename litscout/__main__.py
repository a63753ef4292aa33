"""python -m litscout: list and run queries, and search a published index."""

from __future__ import annotations

import argparse
import json

from litscout.engine import Engine
from litscout.operators.search import Filter, Request
from litscout.plans import catalog, reports
from litscout.session import default_directory, session


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="litscout")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("queries", help="names of the registered queries")
    run = commands.add_parser("run", help="run a query over a data directory and write or show it")
    run.add_argument("name")
    run.add_argument("--data", default=default_directory())
    run.add_argument("--out")
    status = commands.add_parser("status", help="report on the state of a collection, as JSON")
    status.add_argument("--data", default=default_directory())
    find = commands.add_parser("search", help="search a published index")
    find.add_argument("index")
    find.add_argument("query", nargs="?", default="")
    find.add_argument("--filter", action="append", default=[], metavar="FAMILY=KEY[,KEY…]")
    find.add_argument("--all", action="store_true", help="every key of a filter, not any")
    find.add_argument("--limit", type=int, default=10)
    find.add_argument("--cursor")
    given = parser.parse_args(arguments)
    if given.command == "queries":
        print("\n".join(sorted(catalog.QUERIES)))
        return
    spark = session("local[*]")
    if given.command == "run":
        df = catalog.QUERIES[given.name](spark, given.data)
        df.write.parquet(given.out) if given.out else df.show(truncate=False)
        return
    if given.command == "status":
        print(json.dumps(reports.base_status(spark, given.data), default=str, sort_keys=True, indent=1))
        return
    filters = {family: Filter(tuple(keys.split(",")), given.all) for family, keys in (f.split("=", 1) for f in given.filter)}
    page, envelope = Engine(spark, given.index).search(Request(given.query, filters, limit=given.limit, cursor=given.cursor))
    for line in page.drop("search_text").toJSON().collect():  # a page
        print(line)
    print(json.dumps(envelope))


if __name__ == "__main__":
    main()
