"""Commands over a store: ``python -m brindle.cli --store FOLDER COMMAND ...``.

    run --inbox FOLDER --as-of DAY          one scheduled run of all feeds, or of those named
    task FEED STEP --inbox FOLDER --as-of   one step of a feed, from what the store holds
    dags                                    the graphs and their tasks
    query NAME --tables FOLDER [--rows N]   run a registered query
    queries                                 names of all queries
    freshness | issues | loads FEED         what the store says
    held FEED [--rule ID]                   rows in quarantine, by rule
    accept FEED LOAD --reason TEXT          take a blocked load in at the next run
    waive FEED LOAD --reason TEXT           publish without a blocked load
    evidence FOLDER                         what the last run did, as CSV, JSON and text
    docs FOLDER [--check]                   dictionary and rule catalogue; --check only compares
"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .sources.state import Store

STEPS = ("land", "load", "check_files", "stage", "merge", "gate", "publish")


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="brindle")
    out.add_argument("--store", default="store")
    out.add_argument("--reference", help="folder of JSON files in place of the network's reference data")
    commands = out.add_subparsers(dest="command", required=True)
    for name in ("queries", "freshness", "issues", "dags"):
        commands.add_parser(name)
    q = commands.add_parser("query")
    q.add_argument("name")
    q.add_argument("--tables", required=True)
    q.add_argument("--rows", type=int, default=20)
    for name in ("run", "task"):
        p = commands.add_parser(name)
        if name == "task":
            p.add_argument("feed")
            p.add_argument("step", choices=STEPS)
        else:
            p.add_argument("--feeds", nargs="*")
        p.add_argument("--inbox", required=True)
        p.add_argument("--as-of", required=True, type=date.fromisoformat)
        p.add_argument("--year", type=int, default=0)
        p.add_argument("--closed-after", type=date.fromisoformat, default=date.max)
    for name in ("loads", "held"):
        p = commands.add_parser(name)
        p.add_argument("feed")
        if name == "held":
            p.add_argument("--rule")
    for name in ("accept", "waive"):
        p = commands.add_parser(name)
        p.add_argument("feed")
        p.add_argument("load")
        p.add_argument("--reason", required=True)
    commands.add_parser("evidence").add_argument("folder")
    d = commands.add_parser("docs")
    d.add_argument("folder")
    d.add_argument("--check", action="store_true")
    return out


def _docs(folder: str, check: bool) -> int:
    """Write the dictionary and the rule catalogue of all feeds, or say which are out of date."""
    from .feeds import feeds
    from .plans import described

    contracts = [f.contract for f in feeds().values()]
    texts = {"dictionary.md": described.dictionary(contracts), "rules.md": described.catalogue(contracts)}
    old = [n for n, text in texts.items() if described.stale(os.path.join(folder, n), text)]
    if not check:
        os.makedirs(folder, exist_ok=True)
        for name in old:
            with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
                f.write(texts[name])
    print("\n".join(old) or "up to date")
    return int(check and bool(old))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    said = parser().parse_args(argv)
    if said.command == "docs":
        return _docs(said.folder, said.check)
    from . import catalog

    if said.command == "queries":
        print("\n".join(sorted(catalog.QUERIES)))
        return 0
    spark = spark or SparkSession.builder.appName("brindle").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if said.command == "query":
        if said.name not in catalog.QUERIES:
            print(f"no query {said.name}", file=sys.stderr)
            return 2
        catalog.QUERIES[said.name](spark, said.tables).show(said.rows, truncate=False)
        return 0
    from . import evidence, pipeline
    from .feeds import feeds
    from .plans import graphs
    from .reference import Reference

    store, ref = Store(spark, said.store), Reference.load(said.reference)
    if said.command == "dags":
        known = [pipeline.feed_graph(spark, f, "", store, date(2000, 1, 1), "") for f in feeds(ref).values()] + [graphs.measures_graph(store), graphs.monitoring_graph(store, date(2000, 1, 1))]
        for g in known:
            print(f"{g.name}: " + ", ".join(t.name for t in g.order()))
        return 0
    if said.command == "run":
        done = pipeline.run_all(spark, said.inbox, store, said.as_of, ref, said.feeds or None, year=said.year, closed_after=said.closed_after)
        print(f"{done['run']}: {done['status']}", *done["failed"], sep="\n")
        return int(done["status"] != "success")
    if said.command == "task":
        feed = feeds(ref, said.year, said.closed_after)[said.feed]
        print(getattr(pipeline.FeedRun(spark, feed, said.inbox, store, said.as_of, f"task_{said.as_of}", None, ref), said.step)())
        return 0
    if said.command in ("accept", "waive"):
        try:
            pipeline.decide(store, said.feed, said.command, said.load, said.reason)
        except pipeline.DecisionError as e:
            print(e, file=sys.stderr)
            return 2
        return 0
    if said.command == "evidence":
        print("\n".join(evidence.write(store, said.folder)))
        return 0
    if said.command == "loads":
        rows = pipeline.loads(store, said.feed).orderBy("extract_date", "load_id").select("load_id", "state", "rule", "reason", "rows_raw", "rows_passed", "rows_quarantined")
        rows.show(100, truncate=False)
        return int(rows.isEmpty())
    table = f"{said.feed}_quarantine" if said.command == "held" else said.command
    if not store.exists(table):
        print(f"nothing yet: {table}")
        return 1
    rows = store.read(table)
    if said.command == "held":
        rows = rows.where("q_status = 'held'").select(F.explode(F.split("rule_ids", ",")).alias("rule"), "load_id")
        rows = (rows.where(F.col("rule") == said.rule) if said.rule else rows).groupBy("rule", "load_id").count().orderBy("rule", "load_id")
    rows.show(100, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
