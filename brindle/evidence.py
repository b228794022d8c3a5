"""What a run did, written for people: reconciliation, outcomes of rules, measures, a manifest.

Everything here is a few rows a load, rule or measure, streamed through the driver. No time of day is
written, so that the same run gives the same bytes.
"""

from __future__ import annotations

import csv
import hashlib
import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pipeline
from .feeds import feeds
from .sources.state import Store


def to_csv(rows: DataFrame, path: Path, order: Sequence[str]) -> int:
    """One CSV file in the given order, a null as nothing, lines ended by LF; how many rows."""
    n = 0
    with path.open("w", encoding="utf-8", newline="") as f:
        out = csv.writer(f, lineterminator="\n")
        out.writerow(rows.columns)
        for r in rows.orderBy(*order).toLocalIterator():
            out.writerow(["" if v is None else v for v in r])
            n += 1
    return n


def write(store: Store, folder: str) -> list[str]:
    """Write the evidence of what the store holds; the names of the files."""
    at = Path(folder)
    at.mkdir(parents=True, exist_ok=True)
    known = [n for n in feeds() if store.exists(f"{n}_loads")]
    lines, counts = ["# Run summary", ""], {}
    for name in known:
        held = pipeline.loads(store, name).select(
            F.lit(name).alias("feed"), "name", "source", "extract_date", "state", "rule", "reason", *(f"rows_{c}" for c in pipeline.COUNTS)
        )
        counts[f"{name}_loads.csv"] = to_csv(held, at / f"{name}_loads.csv", ["extract_date", "name"])
        states = {r.state: r.n for r in held.groupBy("state").agg(F.count("*").alias("n")).collect()}
        lines.append(f"* {name}: " + ", ".join(f"{n} {s}" for s, n in sorted(states.items())))
        for r in held.where("state = 'blocked'").orderBy("name").toLocalIterator():
            lines.append(f"  * {r.name} is blocked by {r.rule}: {r.reason}")
        if store.exists(f"{name}_outcomes"):
            told = store.read(f"{name}_outcomes").groupBy("rule_id", "action", "outcome").agg(F.count("*").alias("loads"), F.sum("rows_failed").alias("rows_failed"))
            counts[f"{name}_rules.csv"] = to_csv(told, at / f"{name}_rules.csv", ["rule_id", "outcome"])
    for name, order in {"measure_summary": ["measure_id", "site_id"], "freshness": ["feed"], "issues": ["issue"]}.items():
        if store.exists(name):
            counts[f"{name}.csv"] = to_csv(store.read(name), at / f"{name}.csv", order)
    last = store.read("published", pipeline.PUBLISHED).groupBy("feed", "table").agg(F.max_by("rows", "at").alias("rows"), F.max_by("print", "at").alias("print"))
    tables = {f"{r.feed}.{r.table}": {"rows": r.rows, "print": r["print"]} for r in last.collect()}
    (at / "summary.md").write_text("\n".join(lines) + "\n", encoding="utf-8")
    digests = {n: hashlib.sha256((at / n).read_bytes()).hexdigest() for n in [*counts, "summary.md"]}
    (at / "manifest.json").write_text(json.dumps({"files": digests, "rows": counts, "published": tables}, indent=1, sort_keys=True) + "\n", encoding="utf-8")
    return sorted([*digests, "manifest.json"])
