"""Marts and monitoring as graphs, and the commands."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from brindle import catalog, cli
from brindle.catalog import measures as marts
from brindle.model import Tables
from brindle.operators import curate
from brindle.plans import dag, graphs
from brindle.sources.state import Store


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    t, out = Tables(spark, "/root/testdata/sf0.01"), Store(spark, str(tmp_path_factory.mktemp("store")))
    out.publish({"patients": t.patients, "appointments": curate.appointments(t.appointments), "patient_conditions": marts.conditions(t), "pharmacy_fills": marts.fills(t), "screening_events": marts.events(t), "lab_results": marts.labs(t)})
    return out


def test_measures_graph(spark, store):
    done = dag.run(graphs.measures_graph(store), {"run_id": "r1"})
    assert {k: v["state"] for k, v in done.items()} == dict.fromkeys(done, "success"), {k: v["error"] for k, v in done.items() if v["error"]}
    want = catalog.QUERIES["measure_summary"](spark, "/root/testdata/sf0.01")
    assert sorted(map(tuple, store.read("measure_summary").collect())) == sorted(map(tuple, want.collect()))
    assert store.read("measure_history").count() == want.count()


def test_a_broken_test_stops_the_history(store):
    bad = store.read("measure_summary").withColumn("denominator", F.when(F.col("site_id") == "ALL", -1).otherwise(F.col("denominator")).cast("long"))
    graph = graphs.measures_graph(store)
    tasks = [t if t.name != "measure_summary" else dag.Task(t.name, lambda _: store.publish({"measure_summary": bad}), t.after) for t in graph.tasks]
    done = dag.run(dag.Dag("measures", tasks), {"run_id": "r2"})
    assert (done["test_clinics_add_up"]["state"], done["history"]["state"]) == ("failed", "upstream_failed") and "Broken" in done["test_clinics_add_up"]["error"]


def test_monitoring_graph(spark, store):
    seen = [("a", date(2024, 1, 1), date(2024, 1, 5), True), ("b", date(2024, 1, 8), date(2024, 1, 7), True), ("c", date(2024, 1, 8), date(2024, 1, 6), False)]
    store.publish({"loads_seen": spark.createDataFrame(seen, "feed string, extract_date date, max_event_date date, done boolean")})
    done = dag.run(graphs.monitoring_graph(store, date(2024, 1, 10)), {})
    fresh = {r.feed: (r.timing, r.work, r.newest_event.day) for r in store.read("freshness").collect()}
    assert fresh == {"a": ("LATE", "OK", 31), "b": ("ON_TIME", "OK", 7), "c": ("ON_TIME", "STUCK", 6)}
    assert {x[1] for x in done["attention"]["result"] if "issue" in x[1]} == {"open issue a, peak 10", "open issue c, peak 4"}
    store.publish({"loads_seen": store.read("loads_seen").withColumn("done", F.lit(True))})
    dag.run(graphs.monitoring_graph(store, date(2024, 1, 10)), {})
    assert {r.issue: r.status for r in store.read("issues").collect()} == {"a": "open", "c": "resolved"}


def test_commands(spark, store, tmp_path, capsys):
    assert cli.main(["queries"]) == 0 and "measure_summary" in capsys.readouterr().out
    assert cli.main(["query", "no"] + ["--tables", "x"], spark) == 2
    assert cli.main(["query", "current_patients", "--tables", "/root/testdata/sf0.001", "--rows", "1"], spark) == 0
    assert cli.main(["--store", store.root, "accept", "labs", "L1", "--reason", "checked by phone"], spark) == 2
    assert cli.main(["--store", store.root, "loads", "labs"], spark) == 1 and cli.main(["--store", store.root, "held", "labs"], spark) == 1
    assert cli.main(["--store", store.root, "dags"], spark) == 0 and "labs: sense, land" in capsys.readouterr().out
    assert cli.main(["--store", store.root, "evidence", str(tmp_path / "evidence")], spark) == 0
    assert (tmp_path / "evidence/measure_summary.csv").read_text().startswith("measure_id,")
    docs = str(tmp_path / "docs")
    assert [cli.main(["docs", docs, "--check"]), cli.main(["docs", docs]), cli.main(["docs", docs, "--check"])] == [1, 0, 0]
