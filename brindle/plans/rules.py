"""Rules compiled to columns: one pass over a staged feed finds everything that any rule finds.

A staged row has its typed columns, their originals as ``<name>_raw``, and load_id, row_num and
extract_date. All findings of a row are one array, so rules cost no scans of their own; only a key
conflict needs a window, and a roster a join. A rule fails where its condition is true, never
where it is null.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import ABSENT, row_hash
from .contracts import Contract, Rule

FINDING = "array<struct<rule_id:string,action:string,detail:string>>"


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")


def condition(rule: Rule, contract: Contract, year: int, closed_after: date) -> tuple[Column, Column]:
    """When a row rule fails, and the detail of its finding."""
    p = rule.params
    c = p.get("column")
    said = F.col(c).cast("string") if c else F.lit(None).cast("string")
    if rule.type == "required":
        blank = [(n, _blank(n)) for n in p["columns"]]
        return F.array_contains(F.array(*(b for _, b in blank)), True), F.concat_ws(",", *(F.when(b, n) for n, b in blank))
    if rule.type in ("parse", "mapped"):
        return F.col(c).isNull() & ~_blank(f"{c}_raw"), F.col(f"{c}_raw")
    if rule.type == "not_future":
        return F.col(c) > F.col("extract_date"), said
    if rule.type == "in_reference":
        return F.col(c).isNotNull() & ~F.col(c).isin(*p["values"]), said
    if rule.type == "on_roster":
        return F.col(c).isNotNull() & ~F.col("on_roster"), said
    if rule.type == "key_conflict":
        return F.col("versions") > 1, F.concat_ws(":", *(F.col(k).cast("string") for k in contract.natural_key))
    if rule.type == "closed_period":
        return (F.year(c) == year) & (F.col("extract_date") > F.lit(closed_after)), said
    if rule.type == "expression":
        return F.expr(p["fail_when"]), F.expr(p["detail"]).cast("string") if "detail" in p else F.lit(None).cast("string")
    raise ValueError(f"{rule.id}: {rule.type} is no row rule")


def _found(rule: Rule, when: Column, detail: Column) -> Column:
    return F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(rule.id).alias("rule_id"), F.lit(rule.action).alias("action"), detail.alias("detail")))


def repaired(staged: DataFrame, contract: Contract) -> DataFrame:
    """Repairs in order, each found with the value before it."""
    out = staged.withColumn("findings", F.array().cast(FINDING))
    for rule in (r for r in contract.rules if r.type == "repair"):
        when = F.coalesce(F.expr(rule.params["when"]), F.lit(False))
        detail = F.col(rule.params.get("detail") or next(iter(rule.params["set"]))).cast("string")
        out = out.withColumn("findings", F.when(when, F.array_append("findings", F.struct(F.lit(rule.id).alias("rule_id"), F.lit("repair").alias("action"), detail.alias("detail")))).otherwise(F.col("findings")))
        for c, value in rule.params["set"].items():
            out = out.withColumn(c, F.when(when, F.expr(value)).otherwise(F.col(c)))
    return out


def evaluated(staged: DataFrame, contract: Contract, roster: DataFrame | None = None, year: int = 0, closed_after: date = date.max) -> DataFrame:
    """The staged rows, repaired and hashed, with all their findings.

    ``roster`` has a row for each known patient_id; without one every patient is unknown. It is
    joined by a shuffle unless Spark sees that it is small.
    """
    out = repaired(staged, contract)
    kinds = {r.type for r in contract.row_rules}
    if "on_roster" in kinds:
        column = next(r.params["column"] for r in contract.row_rules if r.type == "on_roster")
        if roster is None:
            out = out.withColumn("on_roster", F.lit(False))
        else:
            known = roster.select(F.col("patient_id").alias("known_id")).distinct()
            out = out.join(known, F.col(column) == F.col("known_id"), "left").withColumn("on_roster", F.col("known_id").isNotNull()).drop("known_id")
    if "key_conflict" in kinds:
        # Dealt by key before rows are hashed: the digests would be half of what is shuffled.
        out = out.repartition(*contract.natural_key)
    out = out.withColumn("row_hash", row_hash(contract.hash_columns or contract.columns))
    if "key_conflict" in kinds:
        # Windows hold nulls equal; two versions have a lowest and a highest hash that differ.
        same = Window.partitionBy("load_id", *contract.natural_key)
        out = out.withColumn("versions", F.when(F.min("row_hash").over(same) != F.max("row_hash").over(same), 2).otherwise(1))
    found = F.array(*(_found(r, *condition(r, contract, year, closed_after)) for r in contract.row_rules))
    out = out.withColumn("findings", F.concat("findings", F.filter(found, lambda f: f.isNotNull())))
    return out.drop("on_roster", "versions")


def findings(rows: DataFrame) -> DataFrame:
    """A row for each finding. An outer explode: Spark copies no filter below it."""
    out = rows.select("load_id", "row_num", F.explode_outer("findings").alias("f")).where("f is not null")
    return out.select("load_id", "row_num", "f.rule_id", "f.action", "f.detail")


def outcomes(rows: DataFrame, contract: Contract, accepted: Sequence[str] = ()) -> DataFrame:
    """A row for each load and row rule: rows tested, rows failed, and what came of it.

    A rule that blocks, or whose share of failing rows is above its limit, stops its load, unless a
    steward accepted the load.
    """
    tested = rows.groupBy("load_id").agg(F.count("*").alias("rows_tested"))
    failed = findings(rows).groupBy("load_id", "rule_id").agg(F.count_distinct("row_num").alias("rows_failed"))
    of_rule = rows.sparkSession.createDataFrame([(r.id, r.action, float(r.params.get("block_if_rate_over", 2.0 if r.action != "block" else -1.0))) for r in contract.rules if not r.of_file], "rule_id string, action string, most double")
    out = tested.crossJoin(F.broadcast(of_rule)).join(failed, ["load_id", "rule_id"], "left").withColumn("rows_failed", F.coalesce("rows_failed", F.lit(0).cast("long")))
    over = (F.col("rows_failed") > 0) & (F.col("rows_failed") > F.col("most") * F.col("rows_tested"))
    by_action = F.when(F.col("action") == "repair", "repaired").when(F.col("action") == "warn", "warn").otherwise("quarantined")
    what = F.when(F.col("rows_failed") == 0, "pass").when(over & F.col("load_id").isin(*accepted), "overridden").when(over, "blocked").otherwise(by_action)
    return out.select("load_id", "rule_id", "action", "rows_tested", "rows_failed", what.alias("outcome"))


def with_status(rows: DataFrame, blocked: DataFrame) -> DataFrame:
    """Rows with status pass, quarantine or blocked, and the ids of the rules that hold them."""
    held = F.filter("findings", lambda f: f["action"] == "quarantine")
    ids = F.array_join(F.array_sort(F.array_distinct(F.transform(held, lambda f: f["rule_id"]))), ",")
    # A row for each stopped load: joined by shuffle, all rows would be dealt by their few loads.
    stopped = F.broadcast(blocked.select(F.col("load_id").alias("stopped")).distinct())
    out = rows.join(stopped, F.col("load_id") == F.col("stopped"), "left")
    status = F.when(F.col("stopped").isNotNull(), "blocked").when(F.size(held) > 0, "quarantine").otherwise("pass")
    return out.withColumn("dq_status", status).withColumn("rule_ids", F.nullif(ids, F.lit(""))).drop("stopped")


def counters(rows: DataFrame) -> DataFrame:
    """Row counts of each load by status; none pass or are held where the load is stopped."""
    has = lambda action: F.exists("findings", lambda f: f["action"] == action)
    n = lambda c, name: F.count_if(c).alias(name)
    return rows.groupBy("load_id").agg(
        F.count("*").alias("rows_staged"), n(F.col("dq_status") == "pass", "rows_passed"), n(F.col("dq_status") == "quarantine", "rows_quarantined"),
        n(F.col("dq_status") == "blocked", "rows_blocked"), n(has("repair"), "rows_repaired"), n(has("warn"), "rows_warned"),
    )


# --- rules over files


def date_format(rows: DataFrame, columns: Sequence[str], formats: Sequence[str]) -> DataFrame:
    """By load, how many dates each format reads and the one that reads most (the earlier of equal ones)."""
    read = [F.sum(sum(F.try_to_timestamp(F.trim(c), F.lit(f)).isNotNull().cast("long") for c in columns)).alias(f"f{i}") for i, f in enumerate(formats)]
    out = rows.groupBy("load_id").agg(*read)
    best = F.array_max(F.array(*(F.struct(F.col(f"f{i}").alias("n"), F.lit(-i).alias("i")) for i in range(len(formats)))))
    return out.select("load_id", *(F.col(f"f{i}").alias(f"parsed_{i}") for i in range(len(formats))), (-best["i"]).alias("format_no"))


def volume(loads: DataFrame, min_ratio: float, max_ratio: float, least: int, last: int = 4) -> DataFrame:
    """Rows of each delivery over the median of the last deliveries before it."""
    before = Window.partitionBy("feed").orderBy("extract_date").rowsBetween(-last, -1)
    out = loads.withColumn("before", F.array_sort(F.collect_list("rows_raw").over(before)))
    n = F.size("before")
    middle = (F.try_element_at("before", F.floor((n + 1) / 2).cast("int")) + F.try_element_at("before", (F.floor(n / 2) + 1).cast("int"))) / 2
    out = out.withColumn("baseline", F.when(n > 0, middle))
    share = F.col("rows_raw") / F.col("baseline")
    status = F.when(F.col("baseline").isNull() | (F.col("baseline") < least), "skipped").when((share < min_ratio) | (share > max_ratio), "blocked").otherwise("pass")
    return out.select("feed", "extract_date", "rows_raw", "baseline", status.alias("outcome"))


def completeness(rows: DataFrame, column: str, missing: Sequence[str], min_share: float) -> DataFrame:
    there = F.col(column).isNotNull() & ~F.col(column).isin(*missing) if missing else F.col(column).isNotNull()
    out = rows.groupBy("load_id").agg(F.count("*").alias("rows_tested"), F.count_if(there).alias("rows_present"))
    return out.withColumn("outcome", F.when(F.col("rows_present") < F.col("rows_tested") * min_share, "warn").otherwise("pass"))


__all__ = ["ABSENT", "completeness", "condition", "counters", "date_format", "evaluated", "findings", "outcomes", "repaired", "volume", "with_status"]
