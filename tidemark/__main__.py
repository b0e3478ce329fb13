"""``python -m tidemark list`` and ``python -m tidemark run QUERY --input DIR [--output DIR]``."""

from __future__ import annotations

import argparse
import sys

from .plans import catalogue


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark", description="Run a registered query over a folder of Parquet tables.")
    what = p.add_subparsers(dest="what", required=True)
    what.add_parser("list", help="the queries by name")
    run = what.add_parser("run", help="one query")
    run.add_argument("query", choices=sorted(catalogue.QUERIES), metavar="QUERY")
    run.add_argument("--input", required=True, help="folder of the tables")
    run.add_argument("--output", help="folder for the rows as Parquet; without it the first are shown")
    run.add_argument("--rows", type=int, default=20, help="how many are shown")
    run.add_argument("--explain", action="store_true", help="show the plan instead")
    return p


def main(arguments: list[str] | None = None) -> int:
    """Exit code 0; argparse ends with 2 on a wrong usage, such as an option without its value."""
    a = parser().parse_args(arguments)
    if a.what == "list":
        print("\n".join(sorted(catalogue.QUERIES)))
        return 0
    from pyspark.sql import SparkSession

    df = catalogue.QUERIES[a.query](SparkSession.builder.appName(f"tidemark {a.query}").getOrCreate(), a.input.rstrip("/"))
    if a.explain:
        df.explain("formatted")
    elif a.output:
        df.write.parquet(a.output)
    else:
        df.show(a.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
