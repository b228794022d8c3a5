"""Texts made from contracts and the catalog: data dictionary, rule catalogue, lineage."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..catalog.oracle import PIECES, needs
from ..model import TABLES
from .contracts import Contract


def dictionary(contracts: Iterable[Contract]) -> str:
    lines = ["# Data dictionary"]
    for c in contracts:
        lines += ["", f"## {c.feed}", "", f"Key: {', '.join(c.natural_key)}.", "", "| column | classification |", "|-|-|"]
        lines += [f"| {name} | {kind} |" for name, kind in c.columns.items()]
    return "\n".join(lines) + "\n"


def catalogue(contracts: Iterable[Contract]) -> str:
    contracts = list(contracts)
    by_action: dict[str, int] = {}
    lines = []
    for c in contracts:
        lines += ["", f"## {c.feed}", "", "| rule | type | action | retried |", "|-|-|-|-|"]
        for r in c.rules:
            by_action[r.action] = by_action.get(r.action, 0) + 1
            lines.append(f"| {r.id} | {r.type} | {r.action} | {'yes' if r.retryable else ''} |")
    total = ", ".join(f"{k} {n}" for k, n in sorted(by_action.items()))
    return "\n".join(["# Rules", "", f"{sum(by_action.values())} rules: {total}.", *lines]) + "\n"


def lineage(spark: SparkSession) -> DataFrame:
    """(piece, needs): what each named table or piece of the catalog reads."""
    edges = [(name, of) for name, sql in {**TABLES, **PIECES}.items() for of in needs(sql) if of != name]
    return spark.createDataFrame(edges, "piece string, needs string")


def stale(path: str, text: str) -> bool:
    """Whether a written file differs from what would be written now."""
    try:
        with open(path, encoding="utf-8") as f:
            return f.read() != text
    except FileNotFoundError:
        return True
