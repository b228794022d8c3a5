"""The gate holds a copy for each kind of leak, and releases a clean one."""

import os
import time

from pyspark.sql import functions as F

from brindle import catalog
from brindle.operators import deid, leakgate
from brindle.sources import work
from brindle.sources.state import Store

from .compare import TABLES, differences

CLASSES = {"name": "direct_identifier", "site_id": "clinical"}


def test_paths_that_a_policy_leaves_out(spark):
    docs = spark.sql("select '1' as _id, named_struct('name', 'x', 'site_id', 's') as a, array(named_struct('name', 'y', 'odd', 1)) as b, map('k', named_struct('name', 'z')) as c")
    assert leakgate.uncovered(docs, CLASSES, {"a.name": "name"}) == ["b[].name", "b[].odd", "c.*.name"]
    assert leakgate.uncovered(docs, CLASSES | {"odd": "clinical"}, {"a.name": "name", "b[].name": "name", "c.*.name": "name"}) == []


def test_release_or_hold(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    checks = leakgate.gate([leakgate.said(spark, "names", 0), leakgate.said(spark, "streets", 2)])
    assert leakgate.release(store, checks, {"copy": spark.range(3)}) == "hold: streets" and not store.exists("copy")
    assert leakgate.release(store, leakgate.gate([leakgate.said(spark, "names", 0)]), {"copy": spark.range(3)}) == "release" and store.read("copy").count() == 3


def test_values_found_in_any_string(spark):
    people = spark.createDataFrame([("00000007", "Ann", "Poe", "5551234567", "Ann@x.org", "12 Oak-St. Road")], "patient_id string, first_name string, last_name string, phone string, email string, street string")
    docs = spark.sql("""select 'X' as _id, named_struct('first_name', 'ann', 'last_name', 'Poe') as who, 'call 5551234567 or ann@X.org, 12 oak st road, number 00000007' as note
        union all select 'Y', named_struct('first_name', 'Ann', 'last_name', 'Lee'), 'call 55512345678 or 100000007, 12 oak street'""")
    real = leakgate.real_values(people)
    assert {r.value for r in real.where("kind = 'street'").collect()} == {"12 oak st road"}
    got = {r.check: r.found for c in leakgate.text_checks([docs], real) for r in c.collect()}
    assert got == {"record numbers": 1, "e-mail addresses": 1, "phone numbers": 1, "names": 1, "streets": 1}


def test_runs_that_cant_be_real_are_not_shuffled(spark):
    """Every real run passes the sieve, of 200,000 others less than one in twenty; runs of several lengths are those of each."""
    real = spark.sql("select concat(id, ' oak', id, ' road') as value from range(5000)")
    passes = deid.sieve(real)
    assert real.where(passes(F.col("value"))).count() == 5000
    assert spark.sql("select concat(id, ' elm', id, ' road') as run from range(200000)").where(passes(F.col("run"))).count() < 10_000
    texts = spark.sql("select id, concat('at ', id, ' Oak', id, ' road, or ', id, ' elm', id, ' road or so') as text from range(6000)")
    every = deid.word_runs(texts, 2).unionByName(deid.word_runs(texts, 3))
    assert sorted(deid.word_runs(texts, (2, 3)).collect()) == sorted(every.collect())
    found = deid.word_runs(texts, (2, 3), passes)
    assert 5000 <= found.count() < every.count() / 15 and deid.leaks(found, real, "run").count() == 5000


def test_a_sieve_of_nothing_passes_nothing(spark):
    assert spark.range(99).where(deid.sieve(spark.createDataFrame([], "value string"))(F.col("id").cast("string"))).count() == 0


def test_what_was_written_leaves_no_shuffle_behind(spark, tmp_path):
    def left():
        folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in folders for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_")}

    before = left()
    rows = work.written(spark.range(1000).repartition(3, "id"), "x")
    for _ in range(50):
        if not (more := left() - before):
            break
        time.sleep(0.1)
    assert not more and rows.count() == 1000


def test_a_digest_that_reads_like_a_record_number_is_no_leak(spark):
    """Only as the whole word that the transforms made: the number by itself, or in another word, is found."""
    docs = spark.sql("""select 'X6b00004513c1a2f9' as _id, 'mx00004513@copy.example' as note union all select 'b', 'MRN00004513' union all select 'c', 'X6b00004513c1a2f9y'
        union all select 'd', 'X6b00004513c1a2f9 00004513' union all select 'e', '100004513'""")
    real, made = spark.sql("select 'record' as kind, '00004513' as value"), spark.sql("select explode(array('X6b00004513c1a2f9', 'mx00004513')) as value")
    found = lambda *m: sorted(r.id for r in leakgate.numbers_found(leakgate.texts_of(docs), 8, real, *m).collect())
    assert found() == ["X6b00004513c1a2f9", "b", "c", "d"]
    assert found(made) == ["b", "c", "d"]


def test_gate_equals_sql_where_digests_and_shifts_meet_real_values(spark, tmp_path):
    """84182's surrogate holds 4513's number; 7301 has no visit and moves one day, and its copy another day for the plant."""
    sf_dir = "/root/testdata/sf0.001"
    for t in TABLES:
        if t != "customer":
            os.symlink(f"{sf_dir}/{t}.parquet", tmp_path / f"{t}.parquet")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    more = customers.where("c_custkey < 3").withColumn("c_custkey", F.element_at(F.array(*map(F.lit, (84182, 4513, 7301))), (F.col("c_custkey") + 1).cast("int")).cast("long"))
    customers.unionByName(more).write.parquet(str(tmp_path / "customer.parquet"))
    assert differences(spark, str(tmp_path), "leak_gate", catalog.QUERIES["leak_gate"], catalog.ORACLE_SQL["leak_gate"]) == ""
