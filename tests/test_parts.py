"""Claims judged part by part: the rows of SQL, little shuffled, and shuffles that go with their part."""

import os
import time

import pytest
from pyspark.sql import functions as F

from brindle import catalog
from brindle.catalog import feeds
from brindle.model import Tables
from brindle.sources import work

from .compare import TABLES, differences

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def in_parts(monkeypatch):
    monkeypatch.setattr(work, "PART_BYTES", 30_000)


def exchanges(df):
    """What the plan shuffles, before it is run."""
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]


def differs(spark, name, sf_dir=SMALL):
    return differences(spark, str(sf_dir), name, catalog.QUERIES[name], catalog.ORACLE_SQL[name])


def test_claims_are_judged_in_parts_and_kept_by_key(spark, in_parts):
    t = Tables(spark, SMALL)
    assert work.parts(t.lineitem) == 3
    rows = feeds.evaluated(t)
    assert "row_hash" in rows.columns and exchanges(rows.groupBy("claim_id", "claim_status").count()) == []
    assert all(not differs(spark, name) for name in ("row_hash", "rule_key_conflict", "dangling_references"))


def test_lines_of_two_orders_with_one_id_are_in_one_part(spark, in_parts, tmp_path):
    """Line 11 of an order has the id of line 1 of the next: their claims conflict if they are of one load."""
    for t in TABLES:
        if t != "lineitem":
            os.symlink(f"{SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    far = lines.where("l_linenumber = 1 and l_orderkey % 2 = 0").withColumns({"l_linenumber": F.lit(11), "l_orderkey": F.col("l_orderkey") - 1})
    lines.unionByName(far).write.parquet(str(tmp_path / "lineitem.parquet"))
    assert work.parts(Tables(spark, str(tmp_path)).lineitem) > 2
    assert not differs(spark, "row_hash", tmp_path) and not differs(spark, "rule_key_conflict", tmp_path)


@pytest.fixture
def no_small_tables(spark):
    """No table is joined by broadcast because it happens to be small."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", ["row_status", "load_counters", "reconciliation", "gate_decisions"])
def test_rows_are_not_dealt_by_load(spark, in_parts, no_small_tables, name):
    plan = catalog.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join [load_id" in x and "[stopped" in x]
    assert joins and all("BroadcastHashJoin" in x for x in joins)
    assert not differs(spark, name)


def test_the_latest_rows_take_no_shuffle_by_key(spark, in_parts, no_small_tables):
    assert [x for x in exchanges(catalog.QUERIES["latest_by_key"](spark, SMALL)) if "claim_id" in x] == []
    assert not differs(spark, "latest_by_key")


def test_held_rows_are_judged_again_without_the_others(spark, in_parts):
    t = Tables(spark, SMALL)
    assert feeds._rechecked(t).count() == feeds._held(t).count() > 0
    assert not {x for x in t.__dict__ if x.endswith("typed_claims")}
    assert not differs(spark, "recheck_release")


def test_transitions_of_held_rows_equal_sql(spark, in_parts, no_small_tables):
    """All that is joined are held rows: the plan reads no table of all claims."""
    plan = catalog.QUERIES["quarantine_transitions"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "/held" in plan and "/evaluated" not in plan and "brindle_evaluated" not in plan
    assert not differs(spark, "quarantine_transitions")


def test_judged_claims_leave_no_shuffle_behind(spark, in_parts):
    def left():
        folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in folders for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_")}

    before = left()
    rows = feeds.evaluated(Tables(spark, SMALL))
    for _ in range(50):
        if not (more := left() - before):
            break
        time.sleep(0.1)
    assert not more and rows.count() > 0
    assert not differs(spark, "dangling_references")
