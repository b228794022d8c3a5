"""Streams over several files: late rows, repeated keys, rows that wait, and files that come between runs."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from brindle.streaming import flows

SCHEMA = "k string, ts timestamp, value double, id long"


@pytest.fixture
def inbox(spark, tmp_path):
    class Inbox:
        path = str(tmp_path / "in")

        def drop(self, *rows):
            spark.createDataFrame([(k, datetime(2024, 1, d), v, i) for k, d, v, i in rows], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

        def stream(self):
            return flows.arriving(spark, self.path, "*.parquet", spark.createDataFrame([], SCHEMA), files_at_once=1)

    return Inbox()


def test_a_late_row_does_not_replace_a_later_one(spark, inbox, tmp_path):
    go = lambda: {r.k: (r.ts.day, r.value, r.id) for r in flows.merged(inbox.stream(), str(tmp_path / "w"), "t", ["k"], ["ts"]).collect()}
    inbox.drop(("a", 2, 5.0, 1), ("b", 1, 1.0, 2))
    assert go() == {"a": (2, 5.0, 1), "b": (1, 1.0, 2)}
    inbox.drop(("a", 1, 9.0, 3), ("b", 3, 1.5, 2), ("c", 1, 0.0, 4))  # late; changed in a double only; new
    inbox.drop(("b", 3, 7.0, 9))  # as late as what is there: the first stays
    assert go() == {"a": (2, 5.0, 1), "b": (3, 1.5, 2), "c": (1, 0.0, 4)}
    assert go() == {"a": (2, 5.0, 1), "b": (3, 1.5, 2), "c": (1, 0.0, 4)}  # nothing new


def test_sliding_windows_and_first_rows(spark, inbox, tmp_path):
    inbox.drop(("a", 2, 1.0, 1), ("a", 3, 1.0, 2))
    inbox.drop(("a", 1, 1.0, 3), ("b", 2, 1.0, 4))
    slid = flows.run_to_table(flows.tumbling_counts(inbox.stream(), "ts", "2 days", "k", late="30 days", slide="1 day"), str(tmp_path / "s"))
    assert {(r.window_start.day, r.k): r.n for r in slid.where("k = 'a'").collect()} == {(31, "a"): 1, (1, "a"): 2, (2, "a"): 2, (3, "a"): 1}
    first = flows.run_to_table(flows.once(inbox.stream(), "ts", "k", late="30 days"), str(tmp_path / "f"), "append")
    assert sorted(r.k for r in first.collect()) == ["a", "b"]


def test_late_rows_are_announced_and_held_rows_wait(spark, inbox, tmp_path):
    inbox.drop(("a", 2, 1.0, 1), ("x", 9, 1.0, 2))
    inbox.drop(("a", 1, 1.0, 3), ("y", 9, 1.0, 4))
    rows, late = flows.announced(inbox.stream(), str(tmp_path / "l"), F.col("ts") < F.lit(datetime(2024, 1, 5)), "closed")
    assert rows.count() == 4 and sorted((r.id, r.reason, r.batch) for r in late.collect()) == [(1, "closed", 0), (3, "closed", 1)]

    def passes(df, before):
        known = df.select("k") if before is None else df.select("k").unionByName(before.select("k"))
        has_y = known.where("k = 'y'").limit(1).count() > 0
        return df.withColumn("ok", (F.col("k") != "x") | F.lit(has_y))

    passed, held = flows.retried(inbox.stream(), str(tmp_path / "r"), passes)
    assert sorted(r.id for r in passed.collect()) == [1, 2, 3, 4] and held.count() == 0
