"""Keyed differences: upserts, history of type 2, quarantine, synchronised documents, issues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import row_hash


def latest(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by the given columns, the greatest first."""
    w = Window.partitionBy(*key).orderBy(*(F.desc(c) for c in order))
    return rows.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def _joined(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Old and new side by side as structs ``o`` and ``n``, by key; null keys are equal."""
    side = lambda df, name: df.select(*(F.col(k).alias(f"{name}_{k}") for k in key), F.struct("*").alias(name))
    same = [F.col(f"o_{k}").eqNullSafe(F.col(f"n_{k}")) for k in key]
    out = same[0]
    for s in same[1:]:
        out = out & s
    return side(old, "o").join(side(new, "n"), out, "full_outer")


def change(old_hash: Column, new_hash: Column) -> Column:
    return F.when(old_hash.isNull(), "inserted").when(new_hash.isNull(), "missing").when(old_hash != new_hash, "updated").otherwise("unchanged")


def classified(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """A row for each key of either table, with what the new one changes. Both have row_hash."""
    out = _joined(old, new, key).withColumn("change", change(F.col("o.row_hash"), F.col("n.row_hash")))
    return out.select(*(F.coalesce(f"n_{k}", f"o_{k}").alias(k) for k in key), "change", "o", "n")


def upserted(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """The old table with new and changed rows taken over; what the batch lacks stays."""
    out = classified(old, new, key)
    keep = F.when(F.col("change").isin("inserted", "updated"), F.col("n")).otherwise(F.col("o"))
    return out.select(keep.alias("r")).select("r.*")


def history(past: DataFrame | None, snapshot: DataFrame, key: str, tracked: Sequence[str], on: Column, held: DataFrame | None = None) -> DataFrame:
    """One snapshot merged into a history of type 2.

    Changed rows are closed the day before and opened anew; rows that the snapshot lacks are closed
    and marked as removed, unless their key is in ``held`` (it was delivered, but quarantined).
    """
    fresh = snapshot.select(key, *tracked, row_hash([key, *tracked]).alias("row_hash"))
    opened = lambda df: df.select(key, *tracked, "row_hash", on.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"), F.lit(False).alias("removed"))
    if past is None:
        return opened(fresh)
    now, closed = past.where("is_current"), past.where("not is_current")
    both = classified(now.select(key, "row_hash"), fresh.select(key, "row_hash"), [key]).select(key, "change")
    if held is not None:
        waits = held.select(F.col(key).alias("_held")).distinct()
        both = both.join(waits, F.col(key) == F.col("_held"), "left").withColumn("change", F.when((F.col("change") == "missing") & F.col("_held").isNotNull(), "unchanged").otherwise(F.col("change"))).drop("_held")
    now = now.join(both, key)
    ends = F.col("change").isin("updated", "missing")
    now = now.withColumns({"valid_to": F.when(ends, F.date_sub(on, 1)).otherwise(F.col("valid_to")), "is_current": ~ends, "removed": F.col("change") == "missing"}).drop("change")
    started = fresh.join(both.where("change in ('inserted', 'updated')").select(key), key, "left_semi")
    return closed.unionByName(now.select(closed.columns)).unionByName(opened(started))


def reconciled(loads: DataFrame) -> DataFrame:
    """Whether each load's counts add up."""
    adds = F.col("rows_staged") == F.col("rows_passed") + F.col("rows_quarantined") + F.col("rows_blocked")
    return loads.withColumn("adds_up", adds)


def gate(loads: DataFrame) -> DataFrame:
    """HOLD a feed of which a load is stopped or doesn't add up, else PUBLISH."""
    bad = (F.col("rows_blocked") > 0) | ~F.col("adds_up")
    out = loads.groupBy("feed").agg(F.count("*").alias("loads"), F.count_if(bad).alias("bad_loads"))
    return out.withColumn("decision", F.when(F.col("bad_loads") > 0, "HOLD").otherwise("PUBLISH"))


def quarantine(held: DataFrame, passing: DataFrame, waiting: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows held before: released where they pass now, superseded where a newer version waits, else held."""
    mark = lambda df, name: df.select(*key).distinct().withColumn(name, F.lit(True))
    out = held.join(mark(passing, "_ok"), list(key), "left").join(mark(waiting, "_new"), list(key), "left")
    status = F.when(F.col("_ok"), "released").when(F.col("_new"), "superseded").otherwise("held")
    return out.withColumn("q_status", status).drop("_ok", "_new")


def synchronised(old: DataFrame, new: DataFrame, partial: bool = False) -> DataFrame:
    """Documents (id, body) by what a new build does to them; a partial build deletes none."""
    out = classified(old.withColumn("row_hash", F.md5("body")), new.withColumn("row_hash", F.md5("body")), ["id"])
    gone = "unchanged" if partial else "deleted"
    return out.select("id", F.when(F.col("change") == "missing", gone).otherwise(F.col("change")).alias("change"))


def register(known: DataFrame, current: DataFrame, on: Column) -> DataFrame:
    """Issues (issue, size) opened, kept with their peak, resolved, or opened again."""
    k = known.select(F.col("issue").alias("k"), "opened", "peak", "status", "resolved")
    out = k.join(current, F.col("k") == F.col("issue"), "full_outer")
    here, before = F.col("issue").isNotNull(), F.col("k").isNotNull() & (F.col("status") == "open")
    return out.select(
        F.coalesce("issue", "k").alias("issue"), F.when(here & ~before, on).otherwise(F.col("opened")).alias("opened"),
        F.when(here & before, F.greatest("peak", "size")).when(here, F.col("size")).otherwise(F.col("peak")).alias("peak"),
        F.when(here, "open").otherwise("resolved").alias("status"), F.when(here, F.lit(None).cast("date")).when(before, on).otherwise(F.col("resolved")).alias("resolved"),
    )


def content_hash(rows: DataFrame) -> Column:
    """For small tables: md5 over the sorted md5s of all rows. To be aggregated over row_hash."""
    return F.md5(F.array_join(F.array_sort(F.collect_list("row_hash")), ""))


def content_print(rows: DataFrame) -> list[Column]:
    """For tables of any size: a count and order-free sums of row hashes."""
    h = F.xxhash64(*[F.col(c) for c in sorted(rows.columns)])
    return [F.count("*").alias("rows"), F.bit_xor(h).alias("xor"), F.sum((h % 1_000_003).cast("decimal(38,0)")).alias("sum")]
