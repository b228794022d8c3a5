"""Scheduled runs of feeds: from files in an inbox to published tables.

All state is in the store. A load (one file that was taken up) has a state:

    landed -> loaded -> merged -> published        duplicate: same bytes as an earlier file
               |  ^ accept
               v  |
             blocked -> waived, or superseded by a file that was delivered again

Each step takes up every load that is in its state, whichever run left it there, and commits once:
what it wrote and the new states become visible together, so a run that dies is taken up where it
was, and no row is lost or counted twice. Rows always come from the raw text. A stopped load keeps
its feed from being published, not from being merged; a steward lets it in (accept) or does without
it (waive). Rows in quarantine that may pass later are evaluated again with new rows, when the
roster or the reference data changed.

Loads are as many as files, so those that are open are decided on by the driver; rows never are.
Logs (raw rows, findings, outcomes, states) only grow; what is held and what is clean is replaced.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Sequence
from datetime import UTC, date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .feeds import CARRIED, Feed, feeds
from .functions.scalars import parsed_date
from .operators import merge
from .plans import dag, rules
from .plans.contracts import layout_scores
from .reference import Reference
from .sources import files
from .sources.state import Store

# The states of loads.
OPEN = ("landed", "loaded")
#: States of loads whose rows are part of the feed.
IN = ("merged", "published")
COUNTS = ("raw", "misshapen", "staged", "passed", "quarantined", "blocked", "repaired", "warned", "inserted", "updated", "unchanged", "deduped", "removed")
LOADS = (
    "seq long, load_id string, source string, name string, path string, place string, length long, modified timestamp, sha256 string, arrival_date date, extract_date date, redelivery int, "
    "layout int, format_no int, max_event_date date, state string, rule string, reason string, run string, " + ", ".join(f"rows_{c} long" for c in COUNTS)
)
FINDINGS = "load_id string, row_num int, rule_id string, action string, detail string, run string"
OUTCOMES = "load_id string, rule_id string, action string, rows_tested long, rows_failed long, outcome string, detail string, run string"
DECISIONS = "feed string, action string, load_id string, reason string, at timestamp"
PUBLISHED = "feed string, table string, run string, rows long, print string, changed boolean, at timestamp"
#: Which version of a row is the later one.
ORDER = ("extract_date", "arrival_date", "load_id", "row_num")


class DecisionError(ValueError):
    """A steward's decision that can't be taken."""


def _rows(spark: SparkSession, said: Sequence[dict], schema: str) -> DataFrame:
    names = [x.split()[0] for x in schema.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in said], schema)


def loads(store: Store, feed: str) -> DataFrame:
    """Every load of a feed as it is now: the last line of each in the log."""
    log = store.read(f"{feed}_loads", LOADS)
    last = log.groupBy("load_id").agg(F.max_by(F.struct("*"), "seq").alias("r"))
    return last.select("r.*")


def decide(store: Store, feed: str, action: str, load_id: str, reason: str) -> None:
    """Take a blocked load in after all (accept), or publish without it (waive)."""
    if not reason.strip():
        raise DecisionError("a decision needs a reason")
    held = loads(store, feed).where(F.col("load_id") == load_id).collect()
    if not held or held[0].state != "blocked":
        raise DecisionError(f"{load_id} is not a blocked load")
    if action == "accept" and held[0].layout is None:
        raise DecisionError(f"{load_id} was never loaded, its layout is not registered: register it, or waive the file")
    now = datetime.now(UTC).replace(tzinfo=None)
    state = {"accept": "loaded", "waive": "waived"}[action]
    line = held[0].asDict() | {"seq": time.time_ns(), "state": state, "reason": f"{held[0].reason} ({action}: {reason})"}
    decision = {"feed": feed, "action": action, "load_id": load_id, "reason": reason, "at": now}
    store.publish({}, {f"{feed}_loads": _rows(store.spark, [line], LOADS), "decisions": _rows(store.spark, [decision], DECISIONS)})


def decisions(store: Store, action: str, feed: str | None = None) -> list[str]:
    """Loads whose latest decision is of this kind."""
    held = store.read("decisions", DECISIONS)
    held = held.where(F.col("feed") == feed) if feed else held
    last = held.groupBy("feed", "load_id").agg(F.max_by("action", "at").alias("action"))
    return sorted(r.load_id for r in last.where(F.col("action") == action).select("load_id").collect())


class FeedRun:
    """The steps of one run of one feed, each of them durable by itself."""

    def __init__(
        self, spark: SparkSession, feed: Feed, inbox: str, store: Store, as_of: date, run_id: str, roster: DataFrame | None = None, ref: Reference | None = None
    ):
        self.spark, self.feed, self.inbox, self.store = spark, feed, inbox, store
        self.as_of, self.run_id, self.ref = as_of, run_id, ref or Reference()
        self.contract, self.name = feed.contract, feed.contract.feed
        self._roster = roster

    # --- helpers

    def table(self, what: str, schema: str | None = None) -> DataFrame:
        return self.store.read(f"{self.name}_{what}", schema)

    def held(self, *states: str) -> list[dict]:
        """Loads in these states, in the order in which they came."""
        rows = loads(self.store, self.name).where(F.col("state").isin(*states)).collect()
        return sorted((r.asDict() for r in rows), key=lambda r: (r["extract_date"], r["arrival_date"], r["redelivery"], r["load_id"]))

    def _lines(self, said: Sequence[dict]) -> DataFrame:
        at = time.time_ns()
        return _rows(self.spark, [r | {"seq": at + i, "run": self.run_id} for i, r in enumerate(said)], LOADS)

    @property
    def roster(self) -> DataFrame | None:
        if self._roster is not None:
            return self._roster
        return self.store.read("patients").select("patient_id") if self.store.exists("patients") else None

    def basis(self) -> str:
        """What rows in quarantine wait for: the roster and the reference data."""
        known = self.roster
        if known is None:
            return f"-:{self.ref.digest}"
        return ":".join(map(str, known.agg(*merge.content_print(known.select("patient_id"))).first())) + f":{self.ref.digest}"

    # --- files

    def new_files(self) -> DataFrame:
        """Files that arrived and that no load is of, by path, length and time."""
        found = files.deliveries(files.listed(self.spark, self.inbox, "*.csv"), self.contract.sources, self.as_of)
        known = self.table("loads", LOADS).select("path", "length", "modified").distinct()
        return found.join(known, ["path", "length", "modified"], "left_anti")

    def land(self) -> dict:
        """Copy new files to the store, never over others, and register them; each is read once."""
        new = [r.asDict() for r in self.new_files().collect()]
        too_large = [r["name"] for r in new if r["length"] > files.LARGEST]
        if too_large:
            raise ValueError(f"files of more than {files.LARGEST} bytes: {', '.join(too_large)}")
        if not new:
            return {}
        digests = {r.path: r.sha256 for r in files.contents(self.spark, [r["path"] for r in new]).select("path", F.sha2("content", 256).alias("sha256")).collect()}
        same = self.table("loads", LOADS).select("sha256", "name").join(F.broadcast(self.spark.createDataFrame([(d,) for d in set(digests.values())], "sha256 string")), "sha256")  # as many as new files
        before = {r.sha256: r.name for r in same.groupBy("sha256").agg(F.min("name").alias("name")).collect()}
        lines = []
        for r in sorted(new, key=lambda r: (r["arrival"], r["extract_date"], r["redelivery"], r["name"])):
            digest = digests[r["path"]]
            line = {**r, "arrival_date": r["arrival"], "sha256": digest, "load_id": f"{r['name']}@{digest[:12]}", "state": "landed"}
            if digest in before:
                # A line of its own, whatever the name: the first one's state stays.
                line |= {"load_id": f"{line['load_id']}+{hashlib.sha256(r['path'].encode()).hexdigest()[:8]}", "state": "duplicate", "reason": f"same bytes as {before[digest]}"}
            else:
                line["place"] = files.landed(self.spark, r["path"], f"{self.store.root}/lake/{self.name}/{r['source']}/{r['extract_date']}", r["name"], digest)
                before[digest] = r["name"]
            lines.append(line)
        self.store.append(f"{self.name}_loads", self._lines(lines))
        return {r["name"]: r["state"] for r in lines}

    def load(self) -> dict:
        """Take up the rows of landed files as text; files of unknown layouts are blocked."""
        waiting = self.held("landed")
        if not waiting:
            return {}
        rows = files.csv_rows(files.contents(self.spark, [r["place"] for r in waiting]))
        meta = F.broadcast(self.spark.createDataFrame([(r["place"], r["load_id"], r["source"]) for r in waiting], "path string, load_id string, source string"))  # as many as new files
        rows = rows.join(meta, "path").persist()
        try:
            heads = rows.where("row_num = 0").select(F.col("load_id").alias("file"), "source", "header")
            found = {r.file: r for r in layout_scores(heads, self.contract.sources).collect()}
            known = [(i, r.version) for i, r in found.items() if r.version is not None]
            counts = {r.load_id: r for r in rows.groupBy("load_id").agg(F.count_if(F.col("row_num") > 0).alias("raw"), F.count_if((F.col("row_num") > 0) & (F.col("width") != F.size("header"))).alias("bad")).collect()}
            grown: dict[str, DataFrame] = {}
            if known:
                layouts = F.broadcast(self.spark.createDataFrame(known, "load_id string, layout int"))
                good, bad = files.canonical(rows.join(layouts, "load_id"), self.contract)
                grown = {f"{self.name}_raw": good, f"{self.name}_findings": bad.withColumn("run", F.lit(self.run_id))}
            lines = []
            for r in waiting:
                said = found[r["load_id"]]
                if said.version is None:
                    reason = f"unknown layout; most like {said.closest} ({said.score:.2f}), missing: {said.missing or '-'}, unexpected: {said.unexpected or '-'}"
                    lines.append(r | {"state": "blocked", "rule": "LAYOUT", "reason": reason})
                else:
                    n = counts[r["load_id"]]
                    lines.append(r | {"state": "loaded", "layout": said.version, "rows_raw": n.raw, "rows_misshapen": n.bad})
            self._archive(lines)
            self.store.publish({}, grown | {f"{self.name}_loads": self._lines(lines)})
        finally:
            rows.unpersist()
        return {r["name"]: r["state"] for r in lines}

    def _archive(self, lines: Sequence[dict]) -> None:
        """Keep the clean table as it was before the first file of another layout."""
        before = {(r.source, r.layout) for r in loads(self.store, self.name).where("layout is not null").select("source", "layout").distinct().collect()}
        fresh = {(r["source"], r["layout"]) for r in lines if r.get("layout") and r["state"] == "loaded"} - before
        if self.store.exists(f"{self.name}_clean") and any(s in {b for b, _ in before} for s, _ in fresh):
            version = max(v for _, v in fresh)
            self.store.snapshot(f"{self.name}_clean", f"{self.name}_before_layout_{version}")

    # --- rules over files

    def raw(self, load_ids: Sequence[str]) -> DataFrame:
        return self.table("raw").where(F.col("load_id").isin(*load_ids))

    def check_files(self) -> dict:
        """Date format, newest event and volume of each load that is to be staged; too small a file is blocked."""
        waiting = self.held("loaded")
        if not waiting:
            return {}
        c, accepted = self.contract, set(decisions(self.store, "accept", self.name))
        formats = {}
        newest = {}
        if c.date_columns:
            raw = self.raw([r["load_id"] for r in waiting])
            found = rules.date_format(raw, c.date_columns, c.date_formats)
            formats = {r.load_id: r for r in found.collect()}
            if c.time_column:
                of = lambda f: F.max(parsed_date(c.time_column, f))
                seen = raw.groupBy("load_id").agg(*(of(f).alias(f"f{i}") for i, f in enumerate(c.date_formats)))
                newest = {r.load_id: r for r in seen.collect()}
        lines, told = [], []
        for r in waiting:
            i = r["load_id"]
            no = formats[i].format_no if i in formats else 0
            line = r | {"format_no": no}
            if i in newest and (last := newest[i][f"f{no}"]) is not None:
                line["max_event_date"] = min(last, date.fromordinal(r["extract_date"].toordinal() - 1))
            for rule in c.of_type("date_format", "volume"):
                outcome, detail = "pass", None
                if rule.type == "date_format" and no:
                    outcome, detail = "warn", f"dates are written as {c.date_formats[no]}; read so throughout"
                elif rule.type == "volume":
                    outcome, detail = self._volume(rule, r)
                    if outcome == "blocked" and i in accepted:
                        outcome = "overridden"
                    if outcome == "blocked" and line["state"] == "loaded":
                        line |= {"state": "blocked", "rule": rule.id, "reason": detail}
                failed = r["rows_raw"] if outcome in ("warn", "blocked", "overridden") else 0
                told.append({"load_id": i, "rule_id": rule.id, "action": rule.action, "rows_tested": r["rows_raw"], "rows_failed": failed, "outcome": outcome, "detail": detail, "run": self.run_id})
            lines.append(line)
        self.store.publish({}, {f"{self.name}_outcomes": _rows(self.spark, told, OUTCOMES), f"{self.name}_loads": self._lines(lines)})
        return {r["name"]: r["state"] for r in lines}

    def _volume(self, rule, load: dict) -> tuple[str, str]:
        """Rows of a load beside the median of the last four of its source that came in; of a feed that grows the first is none of them."""
        past = loads(self.store, self.name).where((F.col("source") == load["source"]) & (F.col("load_id") != load["load_id"]) & F.col("rows_raw").isNotNull())
        order = ("extract_date", "arrival_date", "load_id")
        if not self.contract.snapshot:
            first = past.agg(F.min(F.struct(*order)).alias("f")).first().f
            past = past.where(F.col("load_id") != first.load_id) if first else past
        usable = past.where(F.col("state").isin(*IN)).orderBy(*(F.desc(x) for x in order)).limit(4)
        usual = usable.agg(F.percentile("rows_raw", 0.5).alias("m")).first().m
        if usual is None or usual < rule.params.get("min_baseline_rows", 0):
            return "skipped", "no earlier delivery to compare with"
        share = load["rows_raw"] / usual
        detail = f"{load['rows_raw']} rows where {usual:g} are usual"
        apart = share < rule.params.get("min_ratio", 0) or share > rule.params.get("max_ratio", float("inf"))
        return ("blocked" if rule.action == "block" else "warn") if apart else "pass", detail

    # --- rules over rows

    def recheck(self) -> DataFrame | None:
        """Rows in quarantine whose rules may all pass by now; none while nothing changed that they wait for."""
        if self.contract.snapshot or not self.store.exists(f"{self.name}_quarantine"):
            return None
        said = self.table("basis", "basis string").collect()
        if said and said[0].basis == self.basis():
            return None
        return self.table("quarantine").where("q_status = 'held' and retryable").select("load_id", "row_num")

    def stage(self) -> dict:
        """Type and judge every row of the waiting loads, and of the quarantine what may pass now."""
        waiting = self.held("loaded")
        again = self.recheck()
        if not waiting and again is None:
            return {}
        raw = self.table("raw") if self.store.exists(f"{self.name}_raw") else None
        if raw is None:
            return {}
        parts = []
        if waiting:
            parts.append(self.raw([r["load_id"] for r in waiting]).withColumn("candidate", F.lit("new")))
        if again is not None:
            parts.append(raw.join(again, ["load_id", "row_num"], "left_semi").withColumn("candidate", F.lit("retry")))
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        meta = loads(self.store, self.name).select("load_id", "source", "extract_date", "arrival_date", F.coalesce("format_no", F.lit(0)).alias("format_no"))
        rows = rows.join(meta, "load_id").select(*self.contract.text_columns, *CARRIED)
        done = rules.evaluated(self.feed.typed(rows, self.ref), self.contract, self.roster, self.feed.year, self.feed.closed_after)
        accepted = decisions(self.store, "accept", self.name)
        # Written once: all that follows reads the rows with what was found.
        self.store.publish({f"{self.name}_staging": done})
        done = self.table("staging")
        fresh = done.where("candidate = 'new'")
        outcome = rules.outcomes(fresh, self.contract, accepted)
        told = outcome.select("load_id", "rule_id", "action", "rows_tested", "rows_failed", "outcome", F.lit(None).cast("string").alias("detail"), F.lit(self.run_id).alias("run"))
        for rule in self.contract.of_type("completeness"):
            p = rule.params
            share = rules.completeness(fresh, p["column"], p.get("missing_values", ()), p["min_share"])
            detail = F.concat(F.col("rows_present").cast("string"), F.lit(" of "), F.col("rows_tested").cast("string"), F.lit(" recorded"))
            told = told.unionByName(
                share.select("load_id", F.lit(rule.id).alias("rule_id"), F.lit(rule.action).alias("action"), "rows_tested", (F.col("rows_tested") - F.col("rows_present")).alias("rows_failed"), "outcome", detail.alias("detail"), F.lit(self.run_id).alias("run"))
            )
        ids = self.spark.createDataFrame([(r["load_id"],) for r in waiting], "load_id string")
        self.store.publish({f"{self.name}_told": told, f"{self.name}_waiting": ids})  # of this run; added to all outcomes when it is merged
        stopped = {r.load_id: r.rule_id for r in self.store.read(f"{self.name}_told").where("outcome = 'blocked'").groupBy("load_id").agg(F.min("rule_id").alias("rule_id")).collect()}
        return {"staged": [r["load_id"] for r in waiting], "stopped": stopped, "rechecked": again is not None}

    # --- merge

    def merge(self) -> dict:
        """Rows that pass become part of the feed, others are held; states, counts and findings with them."""
        if not self.store.exists(f"{self.name}_told"):
            return {}
        judged = {r.load_id for r in self.table("waiting").collect()}
        waiting = {r["load_id"]: r for r in self.held("loaded") if r["load_id"] in judged}
        staged = self.table("staging").where(F.col("candidate").eqNullSafe("retry") | F.col("load_id").isin(*waiting))
        told = self.store.read(f"{self.name}_told")
        stopped = told.where("outcome = 'blocked'").select("load_id")
        rows = rules.with_status(staged, stopped)
        counts = {r.load_id: r.asDict() for r in rules.counters(rows.where("candidate = 'new'")).collect()}
        passing = rows.where("dq_status = 'pass'")
        made, changes, per_load = self._incremental(passing) if not self.contract.snapshot else self._snapshots(rows, waiting)
        why = {r.load_id: r.rule_id for r in told.where("outcome = 'blocked'").groupBy("load_id").agg(F.min("rule_id").alias("rule_id")).collect()}
        lines, merged = [], []
        for i, r in waiting.items():
            line = r | {k: v for k, v in counts.get(i, {"rows_staged": 0, "rows_passed": 0, "rows_quarantined": 0, "rows_blocked": 0, "rows_repaired": 0, "rows_warned": 0}).items() if k in r}
            if i in why:
                n = told.where((F.col("load_id") == i) & (F.col("rule_id") == why[i])).first()
                line |= {"state": "blocked", "rule": why[i], "reason": f"{n.rows_failed} of {n.rows_tested} rows fail {why[i]}"}
            else:
                line |= {"state": "merged"} | {f"rows_{k}": per_load.get(i, {}).get(k, 0) for k in ("inserted", "updated", "unchanged", "deduped", "removed")}
                merged.append((r["source"], r["extract_date"]))
            lines.append(line)
        # A stopped file is done with once one of its extract came in.
        for r in self.held("blocked"):
            if r["load_id"] not in waiting and (r["source"], r["extract_date"]) in merged:
                lines.append(r | {"state": "superseded", "reason": f"{r['reason']} (delivered again)"})
        found = rules.findings(rows).withColumn("run", F.lit(self.run_id))
        grown = {f"{self.name}_findings": found, f"{self.name}_outcomes": told}
        if lines:
            grown[f"{self.name}_loads"] = self._lines(lines)
        replaced = {f"{self.name}_clean": made, f"{self.name}_quarantine": self._quarantine(rows, stopped)}
        replaced[f"{self.name}_basis"] = self.spark.createDataFrame([(self.basis(),)], "basis string")
        self.store.publish(replaced, grown, gone=[f"{self.name}_{x}" for x in ("staging", "told", "waiting")])
        return changes

    def _clean_columns(self) -> list[str]:
        return [*self.contract.columns, "row_hash", *(c for c in ORDER if c not in self.contract.columns)]

    def _incremental(self, passing: DataFrame) -> tuple[DataFrame, dict, dict]:
        """The clean table with the batch's latest versions; a later version is never overwritten by an earlier one."""
        key = list(self.contract.natural_key)
        ranked = Window.partitionBy(*key).orderBy(*(F.desc(c) for c in ORDER))
        batch = passing.select(*self._clean_columns(), "candidate", F.row_number().over(ranked).alias("rn"))
        best = batch.where("rn = 1").drop("rn")
        old = self.table("clean") if self.store.exists(f"{self.name}_clean") else best.drop("candidate").limit(0)
        both = merge.classified(old, best, key)
        newer = F.struct(*(F.col(f"n.{c}") for c in ORDER)) > F.struct(*(F.col(f"o.{c}") for c in ORDER))
        both = both.withColumn("change", F.when((F.col("change") == "updated") & ~newer, "unchanged").otherwise(F.col("change")))
        told = both.where("n is not null").groupBy(F.col("n.load_id").alias("load_id"), F.col("n.candidate").alias("candidate"), "change").agg(F.count("*").alias("n"))
        twice = batch.where("rn > 1").groupBy("load_id", "candidate").agg(F.count("*").alias("n")).select("load_id", "candidate", F.lit("deduped").alias("change"), "n")
        changes, per_load = self._counted(told.unionByName(twice))
        take = F.when(F.col("change").isin("inserted", "updated"), F.col("n").dropFields("candidate")).otherwise(F.col("o"))
        return both.select(take.alias("r")).select("r.*"), changes, per_load

    @staticmethod
    def _counted(told: DataFrame) -> tuple[dict, dict]:
        changes: dict[str, int] = {}
        per_load: dict[str, dict[str, int]] = {}
        for r in told.collect():  # a few rows a load
            name = r.change if r.candidate == "new" else f"released_{r.change}"
            changes[name] = changes.get(name, 0) + r.n
            if r.candidate == "new":
                per_load.setdefault(r.load_id, {})[r.change] = r.n
        return changes, per_load

    def _snapshots(self, rows: DataFrame, waiting: dict[str, dict]) -> tuple[DataFrame, dict, dict]:
        """One snapshot after the other into the history; rows that are held keep their last good version."""
        key, c = self.contract.natural_key[0], self.contract
        tracked = [x for x in c.columns if x != key]
        past = self.table("clean") if self.store.exists(f"{self.name}_clean") else None
        changes: dict[str, int] = {}
        per_load: dict[str, dict[str, int]] = {}
        for i, r in waiting.items():
            mine = rows.where(F.col("load_id") == i)
            if mine.where("dq_status = 'blocked'").limit(1).count():
                continue
            passing = mine.where("dq_status = 'pass'")
            snapshot = merge.latest(passing, [key], ["row_num"])
            n = {"deduped": passing.count() - snapshot.count()}
            if past is None:
                n["inserted"] = snapshot.count()
            else:
                now = past.where("is_current").select(key, "row_hash")
                fresh = snapshot.select(key, merge.row_hash([key, *tracked]).alias("row_hash"))
                kinds = merge.classified(now, fresh, [key]).join(mine.select(F.col(key).alias("there")).distinct(), F.col(key) == F.col("there"), "left")
                kinds = kinds.where("change <> 'missing' or there is null").groupBy("change").agg(F.count("*").alias("n"))
                n |= {("removed" if x.change == "missing" else x.change): x.n for x in kinds.collect()}
            past = merge.history(past, snapshot, key, tracked, F.lit(r["extract_date"]), held=mine.where(F.col(key).isNotNull()))
            # Each version is written, so that the plan doesn't grow with the snapshots.
            self.store.publish({f"{self.name}_next": past})
            past = self.table("next")
            per_load[i] = n
            for k, v in n.items():
                changes[k] = changes.get(k, 0) + v
        if past is None:
            past = merge.history(None, rows.limit(0), key, tracked, F.lit(self.as_of))
        return past, changes, per_load

    def _quarantine(self, rows: DataFrame, stopped: DataFrame) -> DataFrame:
        """Rows held: those of this run, and earlier ones as they are now."""
        key = [k for k in self.contract.natural_key if k not in ORDER]
        again = {r.id for r in self.contract.rules if r.retryable}
        why = F.array_join(F.transform(F.filter("findings", lambda f: f["action"] == "quarantine"), lambda f: F.concat_ws(": ", f["rule_id"], f["detail"])), "; ")
        failed = F.split("rule_ids", ",")
        may = F.forall(failed, lambda r: r.isin(*again)) if again else F.lit(False)
        now = rows.where("dq_status = 'quarantine'").select(
            *key, "load_id", "row_num", "candidate", "rule_ids", F.coalesce(may, F.lit(False)).alias("retryable"), why.alias("detail"), F.lit("held").alias("q_status"),
            F.lit(self.run_id).alias("first_run"), F.lit(self.run_id).alias("last_run"), F.lit(None).cast("string").alias("released_run"),
        )
        if not self.store.exists(f"{self.name}_quarantine"):
            return now.drop("candidate")
        at = ["load_id", "row_num"]
        old = self.table("quarantine").join(now.where("candidate = 'new'").select(*at), at, "left_anti")
        passed = rows.where("candidate = 'retry' and dq_status = 'pass'").select(*at, F.lit(True).alias("ok"))
        still = now.where("candidate = 'retry'").select(*at, F.col("rule_ids").alias("r"), F.col("retryable").alias("t"), F.col("detail").alias("d"))
        out = old.join(passed, at, "left").join(still, at, "left")
        waits = F.col("q_status") == "held"
        gone = F.lit(False)
        if self.contract.snapshot:
            fresh = rows.where("candidate = 'new'").select("load_id").distinct().join(stopped.select("load_id").distinct(), "load_id", "left_anti").limit(1).count()
            gone = F.lit(bool(fresh))
        status = F.when(waits & F.col("ok"), "released").when(waits & gone, "superseded").otherwise(F.col("q_status"))
        touched = waits & (F.coalesce("ok", F.lit(False)) | F.col("r").isNotNull() | gone)
        out = out.withColumns({
            "released_run": F.when(waits & F.col("ok"), self.run_id).otherwise(F.col("released_run")), "last_run": F.when(touched, self.run_id).otherwise(F.col("last_run")),
            "rule_ids": F.coalesce("r", "rule_ids"), "retryable": F.coalesce("t", "retryable"), "detail": F.coalesce("d", "detail"), "q_status": status,
        })
        return out.drop("ok", "r", "t", "d").unionByName(now.where("candidate = 'new'").drop("candidate"))

    # --- gate and publish

    def reconciliation(self) -> DataFrame:
        """Whether every row of each load that was merged and not yet published is accounted for once."""
        z = lambda c: F.coalesce(f"rows_{c}", F.lit(0))
        held = loads(self.store, self.name).where("state = 'merged'")
        return held.select(
            "load_id", "name", *(f"rows_{c}" for c in COUNTS), (z("raw") == z("staged") + z("misshapen")).alias("raw_adds_up"), (z("staged") == z("passed") + z("quarantined")).alias("staged_adds_up"),
            (z("passed") == z("inserted") + z("updated") + z("unchanged") + z("deduped")).alias("passed_adds_up"),
        )

    def gate(self) -> dict:
        """HOLD while a load is blocked or counts don't add up, else PUBLISH; NOTHING if nothing waits."""
        reasons = [f"{r['name']} is blocked by {r['rule']}: {r['reason']}" for r in self.held("blocked")]
        reasons += [f"{r.name}: rows don't add up" for r in self.reconciliation().where("not (raw_adds_up and staged_adds_up and passed_adds_up)").collect()]
        waits = loads(self.store, self.name).where("state = 'merged'").limit(1).count() or self._released()
        return {"decision": "HOLD" if reasons else "PUBLISH" if waits else "NOTHING", "reasons": reasons}

    def _released(self) -> bool:
        if not self.store.exists(f"{self.name}_quarantine"):
            return False
        return self.table("quarantine").where((F.col("q_status") == "released") & (F.col("released_run") == self.run_id)).limit(1).count() > 0

    def publish(self) -> dict[str, bool]:
        """Replace the feed's tables, all of them or none; which of them changed."""
        clean = self.table("clean")
        tables = self.feed.curate(clean, self.ref) if self.feed.curate else {self.name: clean}
        last = self.store.read("published", PUBLISHED).where(F.col("feed") == self.name).groupBy("table").agg(F.max_by("print", "at").alias("print"))
        before = {r.table: r.print for r in last.collect()}
        now = datetime.now(UTC).replace(tzinfo=None)
        # Written once under names of their own, so that the prints and the tables are of the same rows.
        self.store.publish({f"next_{name}": df for name, df in tables.items()})
        ready = {name: self.store.read(f"next_{name}") for name in tables}
        prints = {name: df.agg(*merge.content_print(df)).first() for name, df in ready.items()}
        told = [{"feed": self.name, "table": n, "run": self.run_id, "rows": p.rows, "print": f"{p.rows}:{p.xor}:{p.sum}", "changed": before.get(n) != f"{p.rows}:{p.xor}:{p.sum}", "at": now} for n, p in prints.items()]
        lines = [r | {"state": "published"} for r in self.held("merged")]
        grown = {"published": _rows(self.spark, told, PUBLISHED)}
        if lines:
            grown[f"{self.name}_loads"] = self._lines(lines)
        self.store.adopt({name: f"next_{name}" for name in tables}, grown)
        return {r["table"]: r["changed"] for r in told}

    # --- all of it

    def outstanding(self) -> dict[str, int]:
        """What there is to do, from state alone."""
        held = {r.state: r.n for r in loads(self.store, self.name).groupBy("state").agg(F.count("*").alias("n")).collect()}
        again = self.recheck()
        return {
            "new": self.new_files().count(), "landed": held.get("landed", 0), "unfinished": held.get("loaded", 0),
            "publishable": 0 if held.get("blocked") else held.get("merged", 0), "recheck": again.count() if again is not None else 0,
        }

    def run(self) -> dict:
        """All steps in order."""
        landed = self.land()
        self.load()
        self.check_files()
        staged = self.stage()
        changes = self.merge() if staged else {}
        gate = self.gate()
        changed = self.publish() if gate["decision"] == "PUBLISH" else {}
        mine = loads(self.store, self.name).where(F.col("run") == self.run_id).collect()
        return {"files": landed, "loads": [r.asDict() for r in mine], "changes": changes, **gate, "published": changed}


def run_feed(spark: SparkSession, feed: Feed, inbox: str, store: Store, as_of: date, run_id: str, roster: DataFrame | None = None, ref: Reference | None = None) -> dict:
    """One run of one feed; what came in, what was stopped, merged and decided."""
    return FeedRun(spark, feed, inbox, store, as_of, run_id, roster, ref).run()


def feed_graph(
    spark: SparkSession, feed: Feed, inbox: str, store: Store, as_of: date, run_id: str, roster: Callable[[], DataFrame] | None = None,
    ref: Reference | None = None, downstream: Sequence[str] = ("measures",),
) -> dag.Dag:
    """The run as tasks: look for work, take files up, judge, merge, gate, publish or hold, trigger what follows."""
    one = FeedRun(spark, feed, inbox, store, as_of, run_id, roster() if roster else None, ref)

    def keep(name: str, step: Callable[[], dict]) -> Callable[[dict], dict]:
        def run(context: dict) -> dict:
            context.setdefault(feed.contract.feed, {})[name] = out = step()
            return out

        return run

    def changed(context: dict) -> Sequence[str]:
        return [*downstream] if any(context[feed.contract.feed]["publish"].values()) else []

    t = dag.Task
    return dag.Dag(
        feed.contract.feed,
        [
            t("sense", lambda _: any(one.outstanding().values()), kind="sensor"),
            t("land", keep("land", one.land), ("sense",)),
            t("load", keep("load", one.load), ("land",)),
            t("check_files", keep("check_files", one.check_files), ("load",)),
            t("stage", keep("stage", one.stage), ("check_files",)),
            t("merge", keep("merge", one.merge), ("stage",)),
            t("gate", keep("gate", one.gate), ("merge",)),
            t("branch", lambda c: "publish" if c[feed.contract.feed]["gate"]["decision"] == "PUBLISH" else "hold", ("gate",), kind="branch"),
            t("publish", keep("publish", one.publish), ("branch",)),
            t("hold", lambda c: c[feed.contract.feed]["gate"]["reasons"], ("branch",)),
            t("trigger", changed, ("publish",), kind="trigger"),
            t("report", lambda c: c.get(feed.contract.feed, {}), ("publish", "hold"), "all_done"),
        ],
    )


TASKS = "run string, graph string, task string, state string, tries int, error string, started string, seconds double"


def run_all(
    spark: SparkSession, inbox: str, store: Store, as_of: date, ref: Reference | None = None, only: Sequence[str] | None = None, downstream: bool = True,
    year: int = 0, closed_after: date = date.max,
) -> dict:
    """One scheduled run: every feed in order, the measures if anything changed, and the monitoring.

    The outcome of each task is kept in the store; the run's number follows those of its day.
    """
    from .plans import graphs

    seen = store.read("tasks", TASKS).where(F.col("run").startswith(as_of.isoformat())).select("run").distinct().count()
    run_id = f"{as_of.isoformat()}_{seen + 1:02d}"
    context: dict = {"run_id": run_id}
    told: list[dict] = []
    done: dict[str, dict] = {}
    known = feeds(ref, year, closed_after)
    for name, feed in known.items():
        if only is None or name in only:
            done[name] = dag.run(feed_graph(spark, feed, inbox, store, as_of, run_id, None, ref), context, record=told.append)
    if downstream:
        wanted = ("patients", "appointments", "patient_conditions", "pharmacy_fills", "screening_events", "lab_results")
        if "measures" in context.get("triggered", ()) and all(map(store.exists, wanted)):
            done["measures"] = dag.run(graphs.measures_graph(store), context, record=told.append)
        seen_loads = reduce(DataFrame.unionByName, [loads(store, n).select(F.lit(n).alias("feed"), "extract_date", "max_event_date", F.col("state").isin("published", "waived", "superseded", "duplicate").alias("done")) for n in known])
        store.publish({"loads_seen": seen_loads.where("extract_date is not null")})
        done["monitoring"] = dag.run(graphs.monitoring_graph(store, as_of), context, record=told.append)
    store.append("tasks", _rows(spark, [{"run": run_id} | r for r in told], TASKS))
    failed = [f"{g}.{t}" for g, tasks in done.items() for t, r in tasks.items() if r["state"] in (dag.FAILED, dag.UPSTREAM_FAILED)]
    return {"run": run_id, "graphs": done, "failed": failed, "status": "failed" if failed else "success"}
