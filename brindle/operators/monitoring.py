"""Freshness of deliveries, restatement of measures, and error summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import normalised_error


def freshness(loads: DataFrame, as_of: Column, cadence: int, grace: int) -> DataFrame:
    """For each feed, when its next delivery was due, and whether loads are stuck.

    ``loads`` has feed, extract_date, max_event_date and done. The newest event counts up to the
    day before its extract.
    """
    event = F.least(F.max("max_event_date"), F.date_sub(F.max("extract_date"), 1))
    out = loads.groupBy("feed").agg(F.max("extract_date").alias("last_extract"), event.alias("newest_event"), F.count_if(~F.col("done")).alias("unfinished"))
    due = F.date_add("last_extract", cadence)
    timing = F.when(as_of < due, "ON_TIME").when(as_of <= F.date_add(due, grace), "DUE").otherwise("LATE")
    return out.select(
        "feed", "last_extract", "newest_event", due.alias("expected"), timing.alias("timing"), F.when(F.col("unfinished") > 0, "STUCK").otherwise("OK").alias("work"),
        F.datediff(as_of, "newest_event").cast("long").alias("days_behind"), ((timing == "LATE") | (F.col("unfinished") > 0)).alias("stale"),
    )


def restated(history: DataFrame, key: str, run: str, value: str) -> DataFrame:
    """Each key's last value beside that of the run before."""
    w = Window.partitionBy(key).orderBy(F.desc(run))
    held = history.withColumn("n", F.row_number().over(w)).where("n <= 2")
    pick = lambda n, c: F.max(F.when(F.col("n") == n, F.col(c)))
    out = held.groupBy(key).agg(pick(1, run).alias(run), pick(1, value).alias("value"), pick(2, value).alias("before"))
    return out.withColumn("restated", F.coalesce(F.col("value") != F.col("before"), F.lit(False)))


def distinct_errors(messages: DataFrame, column: str) -> DataFrame:
    """Error messages that differ by more than numbers and bracketed details, with an example."""
    return messages.groupBy(normalised_error(column).alias("error")).agg(F.count("*").alias("n"), F.min(column).alias("example"))


def run_summary(outcomes: DataFrame, found: DataFrame) -> DataFrame:
    """By rule: loads it passed, warned in or stopped, its findings, and an example without numbers."""
    by_rule = outcomes.groupBy("rule_id", "action").agg(
        F.count_if(F.col("outcome") == "pass").alias("loads_passed"), F.count_if(F.col("outcome") == "blocked").alias("loads_blocked"), F.sum("rows_failed").alias("rows_failed")
    )
    example = found.groupBy(F.col("rule_id").alias("r")).agg(F.min(normalised_error("detail")).alias("example"))
    return by_rule.join(example, F.col("rule_id") == F.col("r"), "left").drop("r")


def attention(fresh: DataFrame, issues: DataFrame, changed: DataFrame) -> DataFrame:
    """What someone has to act on, and what is to be watched."""
    rows = [
        fresh.where("stale").select(F.lit("action").alias("list"), F.concat(F.lit("feed "), F.col("feed"), F.lit(" is "), F.lower("timing"), F.lit(", work "), F.lower("work")).alias("what")),
        issues.where("status = 'open'").select(F.lit("action").alias("list"), F.concat(F.lit("open issue "), F.col("issue"), F.lit(", peak "), F.col("peak").cast("string")).alias("what")),
        changed.where("restated").select(F.lit("watch").alias("list"), F.concat(F.lit("restated "), F.col("measure")).alias("what")),
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def outstanding(known: DataFrame, loads: DataFrame, held: DataFrame) -> DataFrame:
    """Work that a run would find, from state alone: files landed, loads unfinished, rows to check again."""
    count = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("work"), "n")
    return count(known.where("status = 'landed'"), "landed").unionByName(count(loads.where("not adds_up or rows_blocked > 0"), "unfinished")).unionByName(count(held.where("q_status = 'held'"), "recheck"))
