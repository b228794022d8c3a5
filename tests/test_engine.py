"""Functions, contracts, state, sources, task graph and whole runs on small, spelt-out cases."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from brindle import pipeline
from brindle.feeds import CARRIED, Feed
from brindle.functions import scalars as S
from brindle.operators import deid, documents, measures, merge
from brindle.plans import dag, rules
from brindle.plans.contracts import Contract, ContractError, Layout, Rule, Source, layout_scores
from brindle.sources import files
from brindle.sources.state import Store

CONTRACT = Contract(
    feed="fills", natural_key=("fill_id",), hash_columns=("fill_id", "patient_id", "days"),
    columns={"fill_id": "operational", "patient_id": "direct_identifier", "days": "clinical"},
    rules=(
        Rule("F-1", "repair", "repair", {"when": "patient_id rlike '^[0-9]{1,7}$'", "set": {"patient_id": "lpad(patient_id, 8, '0')"}}),
        Rule("F-2", "required", "quarantine", {"columns": ["fill_id", "patient_id"]}),
        Rule("F-3", "expression", "quarantine", {"fail_when": "days_raw is not null and days is null", "detail": "days_raw", "block_if_rate_over": 0.5}),
        Rule("F-4", "on_roster", "quarantine", {"column": "patient_id"}, retryable=True),
        Rule("F-5", "key_conflict", "quarantine"),
    ),
    sources=(Source("fills", r"^fills_(?P<extract>[0-9]{8})(?:_r(?P<redelivery>[0-9]+))?\.csv$", (Layout(1, {"Fill": "fill_id", "MRN": "patient_id", "Days": "days"}),)),),
)


def typed(rows):
    days = S.text("days")
    return rows.select(S.text("fill_id").alias("fill_id"), S.text("patient_id").alias("patient_id"), days.alias("days_raw"), S.whole_number(days).alias("days"), "load_id", "row_num", "extract_date", "candidate")


def one(spark, column, **values):
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


def test_functions(spark):
    cases = [
        (S.text(F.lit("  ")), None), (S.text(F.lit(" a ")), "a"), (S.whole_number(F.lit("2.5")), None), (S.whole_number(F.lit("-7")), -7), (S.whole_number(F.lit("7\n")), None),
        (S.parsed_date(F.lit("2026-2-3"), "y-M-d"), date(2026, 2, 3)), (S.parsed_date(F.lit("2/30/2026"), "M/d/y"), None), (S.mapped({"P": "paid"}, F.lit(" p")), "paid"), (S.mapped({"P": "paid"}, F.lit("x")), None),
        (S.ratio(F.lit(201), F.lit(400), 3), 0.503), (S.ratio(F.lit(1), F.lit(0), 3), None), (S.ratio(F.lit(2), F.lit(3), 4), 0.6667),
        (S.masked(F.lit("a 1234567 b_1234567 123456 12345678")), "a ####### b_1234567 123456 ########"), (S.normalised_error(F.lit("x [1,2]  y 12345678")), "x [] y ########"),
        (S.slug(F.lit(" St. Mary's -- East ")), "st-mary-s-east"), (S.street_key(F.lit("12 Oak-St., #4")), "12 oak st 4"), (S.shifted_dates(F.lit("on 2024-03-01, not 2024-99-01"), F.lit(-1)), "on 2024-02-29, not 2024-99-01"),
        (S.age_on(F.lit(date(1990, 3, 2)), F.lit(date(2020, 3, 1))), 29), (S.age_on(F.lit(date(1990, 3, 1)), F.lit(date(2020, 3, 1))), 30),
    ]
    for column, want in cases:
        assert one(spark, column) == want, (column, want)


def test_contracts_are_checked():
    bad = {"feed": "x", "natural_key": ["k"], "columns": {"a": "secret"}, "rules": [{"id": "1", "type": "odd", "action": "warn"}, {"id": "1", "type": "parse", "action": "stop", "params": {}}]}
    with pytest.raises(ContractError, match="k: key is no column") as e:
        Contract.from_dict(bad)
    assert all(x in str(e.value) for x in ("1: stands twice", "unknown type odd", "unknown action stop", "1: lacks column", "a: unclassified"))
    with pytest.raises(ContractError, match="snapshot"):
        Contract("x", (), {}, (Rule("1", "on_roster", "quarantine", {"column": "a"}, retryable=True),), snapshot=True)


def test_layouts_are_matched_by_name(spark):
    heads = [("a", ["Days", "MRN", "Fill"]), ("b", ["Days", "MRN", "Fill", "Fill"]), ("c", ["Fill", "Patient", "Days"]), ("d", [])]
    df = spark.createDataFrame([(f, "fills", h) for f, h in heads], "file string, source string, header array<string>")
    got = {r.file: (r.version, r.closest, round(r.score, 3), r.missing, r.unexpected) for r in layout_scores(df, CONTRACT.sources).collect()}
    assert got == {"a": (1, 1, 1.0, "", ""), "b": (None, 1, 1.0, "", ""), "c": (None, 1, 0.5, "MRN", "Patient"), "d": (None, 1, 0.0, "Days,Fill,MRN", "")}


def test_nulls_pass_all_rules_but_required(spark):
    rows = spark.createDataFrame([(None, None, None, None, "l", 1, date(2024, 1, 1))], "fill_id string, patient_id string, days_raw string, days int, load_id string, row_num int, extract_date date")
    got = rules.findings(rules.evaluated(rows, CONTRACT, spark.createDataFrame([("1",)], "patient_id string"))).collect()
    assert [(r.rule_id, r.detail) for r in got] == [("F-2", "fill_id,patient_id")]


def test_store_publishes_all_or_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.publish({"a": spark.range(3), "b": spark.range(1)})
    store.publish({"a": store.read("a").unionByName(spark.range(2))})  # from its own old version
    with pytest.raises(Exception, match="(?i)divi"):
        store.publish({"b": spark.range(9), "a": spark.range(1).select((F.lit(1) / (F.col("id") - F.col("id"))).alias("id"))})
    store.append("log", spark.range(1))
    store.append("log", spark.range(1))
    assert [Store(spark, str(tmp_path)).read(t).count() for t in ("a", "b", "log")] == [5, 1, 2]


def test_csv_is_read_exactly(spark, tmp_path):
    day = tmp_path / "2024-01-05"
    day.mkdir()
    (day / "fills_20240104.csv").write_bytes('﻿Fill , MRN,Days\r\n1,2,"a\nb"\r\n\r\n3,4\r\n"x, y",5,6,7\r\n'.encode())
    found = files.discovered(spark, str(tmp_path), "*.csv", with_content=True)
    assert found.first().arrival == date(2024, 1, 5)
    rows = files.csv_rows(found)
    assert [(r.row_num, r.width, r.fields[0]) for r in rows.orderBy("row_num").collect()] == [(0, 3, "Fill"), (1, 3, "1"), (3, 2, "3"), (4, 4, "x, y")]
    of_load = rows.withColumns({"load_id": F.lit("L"), "source": F.lit("fills"), "layout": F.lit(1)})
    good, bad = files.canonical(of_load, CONTRACT)
    assert [(r.fill_id, r.patient_id, r.days) for r in good.collect()] == [("1", "2", "a\nb")]
    assert [r.detail for r in bad.orderBy("row_num").collect()] == ["2 fields, 3 expected", "4 fields, 3 expected"]
    first = files.landed(spark, found.first().path, str(tmp_path / "lake"), "x.csv", found.first().sha256)
    (day / "fills_20240104.csv").write_text("other")
    other = files.contents(spark, [found.first().path]).select(F.sha2("content", 256).alias("d")).first().d
    assert files.landed(spark, found.first().path, str(tmp_path / "lake"), "x.csv", other) != first and len(list((tmp_path / "lake").glob("x*.csv"))) == 2


def test_graphs():
    t = lambda n, *after, run=lambda c: True, **k: dag.Task(n, run, after, **k)
    states = lambda *tasks: {k: v["state"] for k, v in dag.run(dag.Dag("g", [*tasks]), {}, sleep=lambda s: None).items()}
    assert states(t("a", run=lambda c: 1 / 0, retries=2), t("b", "a"), t("c", "b", rule="all_done")) == {"a": "failed", "b": "upstream_failed", "c": "success"}
    assert states(t("s", run=lambda c: False, kind="sensor"), t("x", "s"), t("y"), t("z", "x", "y", rule="none_failed_min_one_success")) == {"s": "skipped", "x": "skipped", "y": "success", "z": "success"}
    assert states(t("k", run=lambda c: "m", kind="branch"), t("m", "k"), t("n", "k")) == {"k": "success", "m": "success", "n": "skipped"}
    polls = iter([False, False, True])
    assert states(t("s", run=lambda c: next(polls), kind="sensor", wait=1, patience=5), t("x", "s")) == {"s": "success", "x": "success"}
    context, told = {}, []
    dag.run(dag.Dag("g", [t("go", run=lambda c: ["measures"], kind="trigger")]), context, record=told.append)
    assert context["triggered"] == ["measures"] and (told[0]["graph"], told[0]["task"], told[0]["state"]) == ("g", "go", "success")
    for bad in ([t("a", "b"), t("b", "a")], [t("a", "no")], [t("a"), t("a")], [t("a", rule="odd")]):
        with pytest.raises(dag.DagError):
            dag.Dag("g", bad).order()


def test_early_refills_carry_forward(spark):
    day = lambda m, d: date(1998, m, d)
    fills = [(1, "p", day(12, 1), "x", "c", 10), (2, "p", day(12, 6), "x", "c", 10), (3, "p", day(12, 8), "y", "c", 2), (4, "q", day(12, 1), "x", "c", 31), (5, "r", day(12, 31), "x", "c", 90), (6, "r", day(12, 30), "x", "c", 1)]
    df = spark.createDataFrame(fills, "claim_id long, patient_id string, fill_date date, drug_name string, drug_class string, days_supply int")
    got = {r.patient_id: (r.days_covered, r.period_days, r.adherent) for r in measures.days_covered(df).collect()}
    assert got == {"p": (20, 31, False), "r": (2, 2, True)}


def test_history_keeps_held_rows(spark):
    snap = lambda *rows: spark.createDataFrame([*rows], "id string, site string")
    on = lambda d: F.lit(date(2024, 1, d))
    past = merge.history(None, snap(("a", "x"), ("b", "x"), ("c", "x")), "id", ["site"], on(1))
    past = merge.history(past, snap(("a", "y")), "id", ["site"], on(8), held=snap(("c", "?")))
    got = {(r.id, r.site, r.valid_from.day, r.valid_to and r.valid_to.day, r.is_current, r.removed) for r in past.collect()}
    assert got == {("a", "x", 1, 7, False, False), ("a", "y", 8, None, True, False), ("b", "x", 1, 7, False, True), ("c", "x", 1, None, True, False)}


def test_paths_into_documents(spark):
    df = spark.sql("select named_struct('m', map('k', named_struct('h', array(named_struct('d', 1), named_struct('d', null))))) as a")
    got = documents.at_path(df, "a.m.*.h[].d", lambda c: c + 1).first()
    assert [x.d for x in got.a.m["k"].h] == [2, None]
    with pytest.raises(ValueError, match="no field"):
        documents.at_path(df, "a.z", lambda c: c)


def test_surrogates_are_remembered(spark):
    none = spark.createDataFrame([], "kind string, value string, surrogate string")
    values = lambda *v: spark.createDataFrame([(x,) for x in v], "value string")
    make = lambda rng: str(rng.randrange(20))
    first = deid.surrogates(none, values("a", "b", "a", None), "k", 1, make, forbidden=["3"])
    more = deid.surrogates(first, values("c", "a"), "k", 1, make, forbidden=["3"])
    said = {r.value: r.surrogate for r in more.collect()}
    assert len(said) == 3 == len(set(said.values())) and "3" not in said.values()
    assert {r.value: r.surrogate for r in first.collect()}.items() <= said.items()


def test_planted_defects_are_caught_and_nothing_else(spark, tmp_path):
    from dataclasses import replace

    from brindle import synth
    from brindle.catalog.feeds import CLAIMS, STATUS

    inbox = synth.write(tmp_path / "in", weeks=3, rows=120)
    other = synth.write(tmp_path / "again", weeks=3, rows=120)
    assert other == inbox and all((tmp_path / "again" / d.name / f.name).read_bytes() == f.read_bytes() for d in (tmp_path / "in").iterdir() for f in d.iterdir())
    names = ["claim_id", "member_mrn", "fill_date", "drug_name", "days_supply", "claim_status"]
    layout = Layout(1, {n: "patient_id" if n == "member_mrn" else n for n in names})
    rules_ = tuple(replace(r, params={k: v for k, v in r.params.items() if k != "block_if_rate_over"}) for r in CLAIMS.rules)
    contract = replace(CLAIMS, sources=(Source("claims", CLAIMS.sources[0].file_pattern, (layout,)),), rules=rules_)

    def as_types(rows, _):
        days = S.text("days_supply")
        return rows.select(
            S.text("claim_id").alias("claim_id"), S.text("patient_id").alias("patient_id"), S.text("fill_date").alias("fill_date_raw"), S.parsed_date("fill_date", "y-M-d").alias("fill_date"), F.lower(S.text("drug_name")).alias("drug_name"),
            days.alias("days_supply_raw"), S.whole_number(days).alias("days_supply"), S.text("claim_status").alias("claim_status_raw"), S.mapped(STATUS, "claim_status").alias("claim_status"), *CARRIED,
        )

    store = Store(spark, str(tmp_path / "store"))
    roster = spark.createDataFrame([(p,) for p in inbox.patients], "patient_id string")
    feed = Feed(contract, as_types, year=1997, closed_after=date(1998, 1, 15))
    for n, name in enumerate(inbox.files):
        day = date.fromisoformat(f"{name[7:11]}-{name[11:13]}-{name[13:15]}")
        done = pipeline.run_feed(spark, feed, str(tmp_path / "in"), store, day, f"run{n}", roster)
        assert done["decision"] == "PUBLISH" and [x["state"] for x in done["loads"]] == ["published"]
    found = {(r.load_id.split("@")[0], r.row_num, r.rule_id) for r in store.read("claims_findings").select("load_id", "row_num", "rule_id").distinct().collect()}
    assert found == inbox.planted
    assert store.read("claims").count() == inbox.good


def test_alerts_never_fail(tmp_path):
    from brindle.sources.alerts import Alerts

    def broken(url, body):
        raise OSError("no network")

    assert Alerts(str(tmp_path / "a.jsonl"), "http://x", broken).tell("warning", "late") is False
    sent = []
    assert Alerts(str(tmp_path / "a.jsonl"), "http://x", lambda u, b: sent.append(b)).tell("info", "done", n=1) is True
    assert len(sent) == 1 and len((tmp_path / "a.jsonl").read_text().splitlines()) == 3


def test_described(spark, tmp_path):
    from brindle.catalog.feeds import CLAIMS
    from brindle.plans import described

    assert "| patient_id | direct_identifier |" in described.dictionary([CLAIMS])
    assert "10 rules: quarantine 8, repair 1, warn 1." in described.catalogue([CLAIMS])
    from brindle.feeds import feeds

    assert "63 rules: block 5, quarantine 39, repair 6, warn 13." in described.catalogue([f.contract for f in feeds().values()])
    assert {("summary", "results"), ("claims", "lines")} <= {tuple(r) for r in described.lineage(spark).collect()}
    assert described.stale(str(tmp_path / "no"), "x")
