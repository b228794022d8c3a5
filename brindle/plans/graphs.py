"""The marts and the monitoring as task graphs whose tasks publish tables of a store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import measures, merge, monitoring
from ..sources.state import Store
from . import dag

#: A model: the tables it reads, and the function that makes it of them.
MODELS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "patient_facts": (("patients", "appointments", "patient_conditions"), measures.patient_facts),
    "pdc": (("pharmacy_fills",), measures.days_covered),
    "measure_patient_results": (("patient_facts", "appointments", "screening_events", "lab_results", "pdc"), measures.patient_results),
    "measure_summary": (("measure_patient_results",), measures.summary),
    "measure_equity": (("measure_patient_results", "patient_facts"), measures.equity),
    "appointment_windows": (("patients", "appointments"), measures.appointment_windows),
    "appointment_period_comparison": (("appointments",), measures.period_comparison),
    "care_gaps": (("patients", "measure_patient_results", "appointment_windows", "screening_events"), measures.care_gaps),
}

#: Tests of models: rows that break them.
TESTS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "clinics_add_up": (("measure_summary",), measures.clinics_not_adding_up),
    "inverse_measures": (("measure_patient_results",), measures.controlled_and_poor),
    "no_single_suppressed": (("measure_equity",), measures.single_hidden_cells),
    "small_cells_hidden": (("measure_equity",), measures.small_cells_shown),
    "patients_unique": (("patient_facts",), lambda df: df.groupBy("patient_id").count().where("count > 1")),
    "keys_not_null": (("measure_patient_results",), lambda df: df.where("patient_id is null or measure_id is null")),
    "rates_between": (("measure_summary",), lambda df: df.where("rate < 0 or rate > 1")),
    "results_have_patients": (("measure_patient_results", "patient_facts"), lambda a, b: a.join(b.select("patient_id"), "patient_id", "left_anti")),
}


class Broken(AssertionError):
    """A test of a model found rows."""


def measures_graph(store: Store) -> dag.Dag:
    """A task for each model after those it reads, a task for each test, and the history after all.

    A model that fails stops all that reads it; the tables published before stay as they are.
    """

    def make(name: str) -> Callable[[dict], str]:
        reads, fn = MODELS[name]
        return lambda _: store.publish({name: fn(*map(store.read, reads))})[name]

    def check(name: str) -> Callable[[dict], int]:
        reads, fn = TESTS[name]

        def run(_: dict) -> int:
            if n := fn(*map(store.read, reads)).count():
                raise Broken(f"{name}: {n} rows")
            return 0

        return run

    def remember(context: dict) -> None:
        row = store.read("measure_summary").withColumn("run", F.lit(context.get("run_id", "")))
        store.append("measure_history", row)

    tasks = [dag.Task(name, make(name), tuple(r for r in reads if r in MODELS)) for name, (reads, _) in MODELS.items()]
    tasks += [dag.Task(f"test_{name}", check(name), reads) for name, (reads, _) in TESTS.items()]
    tasks.append(dag.Task("history", remember, ("measure_summary", *(f"test_{n}" for n in TESTS))))
    return dag.Dag("measures", tasks)


def monitoring_graph(store: Store, as_of, cadence: int = 7, grace: int = 0) -> dag.Dag:
    """Freshness, issues and what needs attention, from the store's state alone."""
    day = F.lit(as_of)

    def fresh(_: dict) -> None:
        loads = store.read("loads_seen")  # feed, extract_date, max_event_date, done
        store.publish({"freshness": monitoring.freshness(loads, day, cadence, grace)})

    def issues(_: dict) -> None:
        now = store.read("freshness").where("stale").select(F.col("feed").alias("issue"), F.col("days_behind").alias("size"))
        known = store.read("issues") if store.exists("issues") else store.spark.createDataFrame([], "issue string, opened date, peak long, status string, resolved date")
        store.publish({"issues": merge.register(known, now, day)})

    def changed(_: dict) -> None:
        if not store.exists("measure_history"):
            raise dag.Skip
        rows = store.read("measure_history").where("site_id = 'ALL'").select(F.col("measure_id").alias("measure"), "run", F.col("rate").alias("value"))
        store.publish({"restatements": monitoring.restated(rows, "measure", "run", "value")})

    def lists(_: dict) -> list:
        moved = store.read("restatements") if store.exists("restatements") else store.spark.createDataFrame([], "measure string, restated boolean")
        return [tuple(r) for r in monitoring.attention(store.read("freshness"), store.read("issues"), moved).collect()]  # a few lines to read

    return dag.Dag("monitoring", [dag.Task("freshness", fresh), dag.Task("issues", issues, ("freshness",)), dag.Task("restatements", changed, rule="all_done"), dag.Task("attention", lists, ("issues", "restatements"), "none_failed_min_one_success")])
