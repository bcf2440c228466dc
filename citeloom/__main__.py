"""Command line: one operation on canonical tables, its result as JSON lines.

    python -m citeloom --root DIR --action scholar_profile --name "..."
    python -m citeloom --root DIR --action raw --api paper_info --params '{"ids": ["p1"]}'
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from citeloom.plans.registry import Engine
from citeloom.plans.workflows import FAILED, Result
from citeloom.sources.tables import Tables

#: Workflow: the options that it takes.
ACTIONS = {
    "scholar_profile": ("name",),
    "paper_deep_dive": ("title", "keyword", "author", "order"),
    "org_analysis": ("org",),
    "venue_papers": ("venue", "year", "size"),
    "paper_qa": ("query", "topic_high", "topic_middle", "sci_flag", "sort_citation", "sort_year", "author_id", "org_id", "venue_ids", "size"),
    "patent_search": ("query", "page", "size"),
    "scholar_patents": ("name",),
}
FLAGS = ("sci_flag", "sort_citation", "sort_year")
NUMBERS = ("year", "size", "page")
DEFAULTS = {"size": 10, "page": 0, "order": "n_citation"}
#: Where the operation or its parameter has another name.
OPERATION = {"patent_search": "patent_details"}
PARAMETER = {("venue_papers", "size"): "limit"}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="citeloom", description="Query linked scholarly tables.")
    p.add_argument("--root", required=True, help="folder of the canonical Parquet tables")
    p.add_argument("--action", required=True, choices=[*ACTIONS, "raw"])
    for option in sorted({o for options in ACTIONS.values() for o in options}):
        if option in FLAGS:
            p.add_argument(f"--{option}", action="store_true", default=None)
        else:
            p.add_argument(f"--{option}", type=int if option in NUMBERS else str, default=DEFAULTS.get(option))
    p.add_argument("--api", help="operation, for raw")
    p.add_argument("--params", default="{}", help="its parameters as JSON, for raw")
    return p


def call(args: argparse.Namespace) -> tuple[str, dict]:
    """Operation and parameters of the parsed options."""
    if args.action == "raw":
        if not args.api:
            raise ValueError("raw needs --api")
        return args.api, json.loads(args.params)
    given = {o: getattr(args, o) for o in ACTIONS[args.action]}
    if args.action == "paper_deep_dive" and not (given["title"] or given["keyword"]):
        raise ValueError("paper_deep_dive needs --title or --keyword")
    if args.action == "paper_qa":
        if given["sort_citation"] and given["sort_year"]:
            raise ValueError("the two sorts exclude each other")
        if not any(given[o] for o in ("query", "topic_high", "author_id", "org_id", "venue_ids")):
            raise ValueError("paper_qa needs a query, topics or a filter")
    elif args.action not in ("paper_deep_dive",) and not given[ACTIONS[args.action][0]]:
        raise ValueError(f"{args.action} needs --{ACTIONS[args.action][0]}")
    params = {PARAMETER.get((args.action, k), k): v for k, v in given.items() if v is not None}
    return OPERATION.get(args.action, args.action), params


def show(result: DataFrame | Result) -> None:
    sections = result.sections if isinstance(result, Result) else {"data": result}
    for name, df in sections.items():
        for row in df.toJSON().toLocalIterator():
            print(json.dumps({"section": name, "row": json.loads(row)}, ensure_ascii=False))


def main(argv: list[str] | None = None) -> int:
    p = parser()
    args = p.parse_args(argv)
    try:
        name, params = call(args)
    except ValueError as e:
        p.error(str(e))
    spark = SparkSession.builder.getOrCreate()
    outcome = Engine(Tables(spark, args.root)).attempt(name, **params)
    if outcome.status == FAILED:
        print(json.dumps({"section": "status", "row": {"status": FAILED, "error": outcome.error}}, ensure_ascii=False), file=sys.stderr)
        return 1
    if isinstance(outcome.result, Result):
        for query, status in outcome.result.status.items():
            print(json.dumps({"section": "status", "row": {"query": query, "status": status, "chain": outcome.result.chain[query]}}, ensure_ascii=False), file=sys.stderr)
    else:
        print(json.dumps({"section": "status", "row": {"status": outcome.status, "chain": [name]}}, ensure_ascii=False), file=sys.stderr)
    show(outcome.result)
    return 0


if __name__ == "__main__":
    sys.exit(main())
