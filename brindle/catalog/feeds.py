"""Typing, rules, loads, merging and history over the claims feed and the roster snapshots."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import feeds as network
from .. import model
from ..functions import scalars as S
from ..model import Tables, landed, shared
from ..operators import merge
from ..plans import rules
from ..plans.contracts import Contract, Layout, Rule, Source
from ..reference import Reference
from ..sources import work
from . import query
from .oracle import PIECES

STATUS = {"P": "P", "PAID": "P", "R": "R", "REVERSED": "R"}
DRUGS = [f"brand#{i}" for i in range(1, 26)]
CLAIMS = Contract(
    feed="claims", natural_key=("claim_id", "claim_status"), hash_columns=("claim_id", "claim_status", "patient_id", "fill_date", "drug_name", "days_supply"),
    columns={"claim_id": "operational", "patient_id": "direct_identifier", "fill_date": "direct_identifier", "drug_name": "clinical", "days_supply": "clinical", "claim_status": "operational"},
    rules=(
        Rule("C-001", "repair", "repair", {"when": "patient_id rlike '^[0-9]{1,7}$'", "set": {"patient_id": "lpad(patient_id, 8, '0')"}}),
        Rule("C-002", "required", "quarantine", {"columns": ["claim_id", "patient_id", "fill_date_raw", "drug_name", "days_supply_raw", "claim_status_raw"]}),
        Rule("C-003", "parse", "quarantine", {"column": "fill_date"}),
        Rule("C-004", "expression", "quarantine", {"fail_when": "days_supply_raw is not null and (days_supply is null or days_supply < 1 or days_supply > 365)", "detail": "days_supply_raw", "block_if_rate_over": 0.028}),
        Rule("C-005", "mapped", "quarantine", {"column": "claim_status"}),
        Rule("C-006", "in_reference", "quarantine", {"column": "drug_name", "values": DRUGS}),
        Rule("C-007", "not_future", "quarantine", {"column": "fill_date"}),
        Rule("C-008", "on_roster", "quarantine", {"column": "patient_id"}, retryable=True),
        Rule("C-009", "key_conflict", "quarantine"),
        Rule("C-010", "closed_period", "warn", {"column": "fill_date"}),
    ),
    sources=(Source("claims", r"^claims_(?P<extract>[0-9]{8})\.csv$", (Layout(1, {"claim_id": "claim_id", "member_mrn": "patient_id", "fill_date": "fill_date"}), Layout(2, {"claim_id": "claim_id", "member_mrn": "patient_id", "fill_date": "fill_date", "drug_name": "drug_name"}))),),
)


@shared
def typed_claims(t: Tables) -> DataFrame:
    day = F.when(F.col("source") == "B", S.parsed_date("fill_date", "M/d/y")).otherwise(S.parsed_date("fill_date", "y-M-d"))
    days = S.text("days_supply")
    return t.claims_text.select(
        S.text("claim_id").alias("claim_id"), S.text("member_mrn").alias("patient_id"), S.text("fill_date").alias("fill_date_raw"), day.alias("fill_date"),
        F.lower(S.text("drug_name")).alias("drug_name"), days.alias("days_supply_raw"), S.whole_number(days).alias("days_supply"),
        S.text("claim_status").alias("claim_status_raw"), S.mapped(STATUS, "claim_status").alias("claim_status"), "load_id", "row_num", "extract_date",
    )


@shared
def evaluated(t: Tables) -> DataFrame:
    """The staged claims, judged part by part and kept by key, as their merge wants them.

    A claim's versions have its line's id, so they are in one part. The hash of a row follows from its
    columns and takes more room than they do: it isn't kept but made again.
    """
    of = work.parts(t.lineitem)
    made = (rules.evaluated(typed_claims(Tables(t.spark, t.sf_dir, (i, of))), CLAIMS, t.patients, model.YEAR, model.CLOSED_AFTER).drop("row_hash") for i in range(of))
    return work.gathered(made, "evaluated", CLAIMS.natural_key).withColumn("row_hash", S.row_hash(CLAIMS.hash_columns))


def stopped(t: Tables, accepted: tuple[str, ...] = ()) -> DataFrame:
    return rules.outcomes(evaluated(t), CLAIMS, accepted).where("outcome = 'blocked'").select("load_id")


@shared
def judged(t: Tables) -> DataFrame:
    return rules.with_status(evaluated(t), stopped(t))


PIECES |= {
    "staged_raw": """
        select nullif(trim(claim_id), '') as claim_id, nullif(trim(member_mrn), '') as mrn, nullif(trim(fill_date), '') as fill_date_raw,
            case when source = 'B' then cast(try_strptime(trim(fill_date), '%m/%d/%Y') as date) else cast(try_strptime(trim(fill_date), '%Y-%m-%d') as date) end as fill_date,
            lower(nullif(trim(drug_name), '')) as drug_name, nullif(trim(days_supply), '') as days_supply_raw, case when regexp_full_match(trim(days_supply), '-?[0-9]+') then cast(trim(days_supply) as integer) end as days_supply,
            nullif(trim(claim_status), '') as claim_status_raw, case upper(trim(claim_status)) when 'P' then 'P' when 'PAID' then 'P' when 'R' then 'R' when 'REVERSED' then 'R' end as claim_status, load_id, row_num, extract_date from claims_text""",
    "staged_fixed": "select *, case when regexp_full_match(mrn, '[0-9]{1,7}') then lpad(mrn, 8, '0') else mrn end as patient_id from staged_raw",
    "staged": "select *, md5(concat_ws('|', coalesce(claim_id, '~'), coalesce(claim_status, '~'), coalesce(patient_id, '~'), coalesce(cast(fill_date as varchar), '~'), coalesce(drug_name, '~'), coalesce(cast(days_supply as varchar), '~'))) as row_hash from staged_fixed",
    "conflicts": "select load_id, claim_id, claim_status from staged group by all having count(distinct row_hash) > 1",
    "found": f"""
        select load_id, row_num, 'C-001' as rule_id, 'repair' as action, mrn as detail from staged where mrn <> patient_id
        union all select load_id, row_num, 'C-002', 'quarantine', concat_ws(',', case when claim_id is null then 'claim_id' end, case when patient_id is null then 'patient_id' end, case when fill_date_raw is null then 'fill_date_raw' end, case when drug_name is null then 'drug_name' end, case when days_supply_raw is null then 'days_supply_raw' end, case when claim_status_raw is null then 'claim_status_raw' end)
            from staged where claim_id is null or patient_id is null or fill_date_raw is null or drug_name is null or days_supply_raw is null or claim_status_raw is null
        union all select load_id, row_num, 'C-003', 'quarantine', fill_date_raw from staged where fill_date is null and fill_date_raw is not null
        union all select load_id, row_num, 'C-004', 'quarantine', days_supply_raw from staged where days_supply_raw is not null and coalesce(days_supply not between 1 and 365, true)
        union all select load_id, row_num, 'C-005', 'quarantine', claim_status_raw from staged where claim_status is null and claim_status_raw is not null
        union all select load_id, row_num, 'C-006', 'quarantine', drug_name from staged where drug_name not in ({', '.join(f"'{d}'" for d in DRUGS)})
        union all select load_id, row_num, 'C-007', 'quarantine', cast(fill_date as varchar) from staged where fill_date > extract_date
        union all select load_id, row_num, 'C-008', 'quarantine', s.patient_id from staged s where s.patient_id is not null and not exists (select 1 from patients p where p.patient_id = s.patient_id)
        union all select s.load_id, row_num, 'C-009', 'quarantine', concat_ws(':', s.claim_id, s.claim_status) from staged s join conflicts c on c.load_id = s.load_id and c.claim_id is not distinct from s.claim_id and c.claim_status is not distinct from s.claim_status
        union all select load_id, row_num, 'C-010', 'warn', cast(fill_date as varchar) from staged where year(fill_date) = {model.YEAR} and extract_date > date '{model.CLOSED_AFTER}'""",
    "load_rows": "select load_id, count(*) as rows_tested from staged group by load_id",
    "rule_list": "select * from (values " + ", ".join(f"('{r.id}', '{r.action}', {r.params.get('block_if_rate_over', 2.0)})" for r in CLAIMS.rules) + ") t(rule_id, action, most)",
    "outcomes": """
        select l.load_id, r.rule_id, r.action, l.rows_tested, coalesce(f.n, 0) as rows_failed, case when coalesce(f.n, 0) = 0 then 'pass' when f.n > cast(most as double) * rows_tested then 'blocked' when r.action = 'repair' then 'repaired' when r.action = 'warn' then 'warn' else 'quarantined' end as outcome
        from load_rows l join rule_list r on true left join (select load_id, rule_id, count(distinct row_num) as n from found group by all) f on f.load_id = l.load_id and f.rule_id = r.rule_id""",
    "row_marks": "select load_id, row_num, string_agg(distinct rule_id, ',' order by rule_id) filter (action = 'quarantine') as rule_ids, bool_or(action = 'repair') as fixed, bool_or(action = 'warn') as warned from found group by all",
    "judged": """
        select s.load_id, s.row_num, s.claim_id, s.claim_status, s.patient_id, s.extract_date, s.row_hash, m.rule_ids, coalesce(m.fixed, false) as fixed, coalesce(m.warned, false) as warned,
            case when s.load_id in (select load_id from outcomes where outcome = 'blocked') then 'blocked' when m.rule_ids is not null then 'quarantine' else 'pass' end as dq_status
        from staged s left join row_marks m on m.load_id = s.load_id and m.row_num = s.row_num""",
    "counted": "select load_id, count(*) as rows_staged, count(*) filter (dq_status = 'pass') as rows_passed, count(*) filter (dq_status = 'quarantine') as rows_quarantined, count(*) filter (dq_status = 'blocked') as rows_blocked, count(*) filter (fixed) as rows_repaired, count(*) filter (warned) as rows_warned from judged group by load_id",
    "roster_rows": "select extract_no, extract_date, patient_id, site_id, care_manager_name, md5(concat_ws('|', patient_id, site_id, care_manager_name)) as row_hash from snapshots",
}

# --- typing and rules

_TYPED = "claim_id, patient_id, fill_date_raw, fill_date, drug_name, days_supply_raw, days_supply, claim_status_raw, claim_status, load_id, row_num, extract_date"
query("typed_claims", f"select {_TYPED.replace('patient_id', 'mrn as patient_id')} from staged_raw")(typed_claims)
query("repairs_applied", "select load_id, row_num, patient_id, mrn as before from staged where mrn <> patient_id")(
    lambda t: evaluated(t).where("exists(findings, f -> f.action = 'repair')").select("load_id", "row_num", "patient_id", F.get("findings", 0)["detail"].alias("before"))
)
query("row_hash", "select load_id, row_num, row_hash, concat_ws('|', coalesce(claim_id, '~'), coalesce(claim_status, '~')) as natural_key from staged")(
    lambda t: evaluated(t).select("load_id", "row_num", "row_hash", S.natural_key(CLAIMS.natural_key).alias("natural_key"))
)
query("rule_findings", "select load_id, row_num, rule_id, action, detail from found")(lambda t: rules.findings(evaluated(t)))
for _name, _id in {"rule_required": "C-002", "rule_parse": "C-003", "rule_expression": "C-004", "rule_mapped": "C-005", "rule_in_reference": "C-006", "rule_not_future": "C-007", "rule_on_roster": "C-008", "rule_key_conflict": "C-009", "rule_closed_period": "C-010"}.items():
    query(_name, f"select load_id, row_num, detail from found where rule_id = '{_id}'")(lambda t, i=_id: rules.findings(evaluated(t)).where(F.col("rule_id") == i).select("load_id", "row_num", "detail"))
query("findings_scorecard", "select rule_id, action, count(*) as findings, count(distinct load_id) as loads, min(detail) as example from found group by all")(
    lambda t: rules.findings(evaluated(t)).groupBy("rule_id", "action").agg(F.count("*").alias("findings"), F.count_distinct("load_id").alias("loads"), F.min("detail").alias("example"))
)
query("escalation_outcomes", "select * from outcomes")(lambda t: rules.outcomes(evaluated(t), CLAIMS))
query("escalation_overridden", "select load_id, rule_id, case when outcome = 'blocked' and load_id = 'L1998B' then 'overridden' else outcome end as outcome from outcomes")(
    lambda t: rules.outcomes(evaluated(t), CLAIMS, ["L1998B"]).select("load_id", "rule_id", "outcome")
)
query("row_status", "select load_id, row_num, dq_status, rule_ids from judged")(lambda t: judged(t).select("load_id", "row_num", "dq_status", "rule_ids"))
query("load_counters", "select * from counted")(lambda t: rules.counters(judged(t)))
query("reconciliation", "select *, rows_staged = rows_passed + rows_quarantined + rows_blocked as adds_up from counted")(lambda t: merge.reconciled(rules.counters(judged(t))))
query("gate_decisions", "select 'claims' as feed, count(*) as loads, count(*) filter (rows_blocked > 0) as bad_loads, case when count(*) filter (rows_blocked > 0) > 0 then 'HOLD' else 'PUBLISH' end as decision from counted")(
    lambda t: merge.gate(merge.reconciled(rules.counters(judged(t))).withColumn("feed", F.lit("claims")))
)
query("date_format_detect", "select load_id, a as parsed_0, b as parsed_1, case when b > a then 1 else 0 end as format_no from (select load_id, count(try_strptime(trim(fill_date), '%Y-%m-%d')) as a, count(try_strptime(trim(fill_date), '%m/%d/%Y')) as b from claims_text group by load_id) x")(
    lambda t: rules.date_format(t.claims_text, ["fill_date"], ["y-M-d", "M/d/y"])
)
query("completeness_share", "select load_id, count(*) as rows_tested, count(*) filter (drug_name <> 'unlisted') as rows_present, case when count(*) filter (drug_name <> 'unlisted') < count(*) * cast(0.985 as double) then 'warn' else 'pass' end as outcome from staged group by load_id")(
    lambda t: rules.completeness(typed_claims(t), "drug_name", ["unlisted"], 0.985)
)
query("volume_baseline", """
    select feed, extract_date, rows_raw, baseline, case when baseline is null or baseline < 10 then 'skipped' when rows_raw / baseline < 0.8 or rows_raw / baseline > 1.25 then 'blocked' else 'pass' end as outcome
    from (select feed, extract_date, rows_raw, median(rows_raw) over (partition by feed order by extract_date rows between 4 preceding and 1 preceding) as baseline from deliveries) x""")(
    lambda t: rules.volume(t.deliveries, 0.8, 1.25, 10)
)
query("code_map_lookup", "select upper(trim(claim_status)) as raw_value, case upper(trim(claim_status)) when 'P' then 'P' when 'PAID' then 'P' when 'R' then 'R' when 'REVERSED' then 'R' end as canonical, count(*) as n from claims_text group by all")(
    lambda t: t.claims_text.groupBy(F.upper(F.trim("claim_status")).alias("raw_value"), S.mapped(STATUS, "claim_status").alias("canonical")).agg(F.count("*").alias("n"))
)

# --- merge and state

query("latest_by_key", "select claim_id, claim_status, load_id, row_num, row_hash from judged where dq_status = 'pass' qualify row_number() over (partition by claim_id, claim_status order by extract_date desc, row_num desc) = 1")(
    lambda t: merge.latest(judged(t).where("dq_status = 'pass'"), ["claim_id", "claim_status"], ["extract_date", "row_num"]).select("claim_id", "claim_status", "load_id", "row_num", "row_hash")
)
TRACKED = ("site_id", "care_manager_name")


def roster(t: Tables, no: int) -> DataFrame:
    return t.snapshots.where(F.col("extract_no") == no).select("patient_id", *TRACKED, S.row_hash(["patient_id", *TRACKED]).alias("row_hash"))


_CLASSES = "select coalesce(n.patient_id, o.patient_id) as patient_id, case when o.patient_id is null then 'inserted' when n.patient_id is null then 'missing' when o.row_hash <> n.row_hash then 'updated' else 'unchanged' end as change from (select * from roster_rows where extract_no = 1) o full join (select * from roster_rows where extract_no = 2) n on n.patient_id = o.patient_id"
query("upsert_classify", _CLASSES)(lambda t: merge.classified(roster(t, 1), roster(t, 2), ["patient_id"]).select("patient_id", "change"))
query("upsert_result", "select patient_id, site_id, care_manager_name, row_hash from roster_rows where extract_no = 2 union all select patient_id, site_id, care_manager_name, row_hash from roster_rows o where extract_no = 1 and not exists (select 1 from roster_rows n where n.extract_no = 2 and n.patient_id = o.patient_id)")(
    lambda t: merge.upserted(roster(t, 1), roster(t, 2), ["patient_id"])
)


@shared
def scd2(t: Tables) -> DataFrame:
    out = None
    for no in (1, 2, 3):
        part = t.snapshots.where(F.col("extract_no") == no)
        on = F.date_add(F.lit("1998-01-31").cast("date"), 28 * (no - 1))
        out = merge.history(out, part.select("patient_id", *TRACKED), "patient_id", TRACKED, on)
    return out


PIECES["versions"] = """
    select a.patient_id, a.site_id, a.care_manager_name, a.row_hash, a.extract_no, a.extract_date,
        b.row_hash as before_hash, c.row_hash as after_hash from roster_rows a
    left join roster_rows b on b.patient_id = a.patient_id and b.extract_no = a.extract_no - 1 left join roster_rows c on c.patient_id = a.patient_id and c.extract_no = a.extract_no + 1"""
PIECES["runs"] = "select *, sum(cast(before_hash is distinct from row_hash as integer)) over (partition by patient_id order by extract_no) as run from versions"
PIECES["scd2"] = """
    select patient_id, any_value(site_id) as site_id, any_value(care_manager_name) as care_manager_name, row_hash, min(extract_date) as valid_from, case when max(extract_no) < 3 then cast(max(extract_date) + 27 as date) end as valid_to,
        max(extract_no) = 3 as is_current, max(extract_no) < 3 and arg_max(after_hash is null, extract_no) as removed from runs group by patient_id, run, row_hash"""
query("scd2_history", "select * from scd2")(scd2)
query("scd2_change_counts", "select valid_from, count(*) as opened, count(*) filter (removed) as removed, count(*) filter (is_current) as is_current from scd2 group by valid_from")(
    lambda t: scd2(t).groupBy("valid_from").agg(F.count("*").alias("opened"), F.count_if("removed").alias("removed"), F.count_if("is_current").alias("is_current"))
)
query("attribution_history", "select patient_id, site_id, care_manager_name, valid_from, valid_to, is_current, removed from scd2")(
    lambda t: scd2(t).select("patient_id", *TRACKED, "valid_from", "valid_to", "is_current", "removed")
)


@shared
def _held(t: Tables) -> DataFrame:
    """Rows held by the roster rule only, as they were typed and repaired."""
    held = judged(t).where("rule_ids = 'C-008'")
    return landed(held.drop("findings", "row_hash", "dq_status", "rule_ids"), "held")


@shared
def _rechecked(t: Tables) -> DataFrame:
    """Those rows judged again by all rules, with a roster to which some of their patients have come."""
    held = _held(t)
    came = held.where("cast(substr(patient_id, 8, 1) as int) < 5").select("patient_id")
    rows = rules.evaluated(held, CLAIMS, t.patients.select("patient_id").unionByName(came), model.YEAR, model.CLOSED_AFTER)
    return landed(rules.with_status(rows, t.spark.createDataFrame([], "load_id string")), "rechecked")


query("quarantine_transitions", "select claim_id, claim_status, load_id, row_num, case when cast(substr(patient_id, 8, 1) as integer) < 5 then 'released' when row_num % 3 = 0 then 'superseded' else 'held' end as q_status from judged where rule_ids = 'C-008'")(
    lambda t: merge.quarantine(_held(t), _rechecked(t).where("dq_status = 'pass'"), _held(t).where("row_num % 3 = 0"), ["load_id", "row_num"]).select("claim_id", "claim_status", "load_id", "row_num", "q_status")
)
query("recheck_release", "select load_id, count(*) as rechecked, count(*) filter (cast(substr(patient_id, 8, 1) as integer) < 5) as released from judged where rule_ids = 'C-008' group by load_id")(
    lambda t: _rechecked(t).groupBy("load_id").agg(F.count("*").alias("rechecked"), F.count_if(F.col("dq_status") == "pass").alias("released"))
)
query("superseded_loads", "select a.load_id, b.load_id as by_load from deliveries a join deliveries b on a.feed = b.feed and b.extract_date = a.extract_date + 1 where a.rows_passed < a.rows_raw and b.rows_passed = b.rows_raw")(
    lambda t: t.deliveries.where("rows_passed < rows_raw").alias("a").join(t.deliveries.where("rows_passed = rows_raw").alias("b"), (F.col("a.feed") == F.col("b.feed")) & (F.col("b.extract_date") == F.date_add("a.extract_date", 1))).select("a.load_id", F.col("b.load_id").alias("by_load"))
)
_PRINT = "select extract_no, md5(string_agg(row_hash, '' order by row_hash)) as content_hash, count(*) as n from roster_rows group by extract_no"
query("content_hash_changed", f"select a.extract_no, a.n, a.content_hash, coalesce(a.content_hash <> b.content_hash, true) as changed from ({_PRINT}) a left join ({_PRINT}) b on b.extract_no = a.extract_no - 1")(
    lambda t: _prints(t)
)


def _prints(t: Tables) -> DataFrame:
    rows = t.snapshots.withColumn("row_hash", S.row_hash(["patient_id", *TRACKED]))
    held = rows.groupBy("extract_no").agg(merge.content_hash(rows).alias("content_hash"), F.count("*").alias("n"))
    before = held.select((F.col("extract_no") + 1).alias("extract_no"), F.col("content_hash").alias("before"))
    return held.join(before, "extract_no", "left").select("extract_no", "n", "content_hash", F.coalesce(F.col("content_hash") != F.col("before"), F.lit(True)).alias("changed"))


# --- the network's feeds over text made of the tables

_REF = Reference()


def _carried(text: DataFrame, row_num: str, extract: str) -> DataFrame:
    """What the pipeline adds to raw rows; columns that a layout lacks are nulls."""
    return text.select(
        "*", F.lit("L1").alias("load_id"), F.col(row_num).alias("row_num"), F.lit("s").alias("source"), F.lit(1).alias("layout"), F.lit(extract).cast("date").alias("extract_date"),
        F.lit(extract).cast("date").alias("arrival_date"), F.lit(0).alias("format_no"), F.lit("new").alias("candidate"),
    )


@shared
def _typed_roster(t: Tables) -> DataFrame:
    return landed(network.typed_roster(_carried(t.roster_text, "k", "1999-01-31"), _REF), "roster")


def _cases(name: str, c: str) -> str:
    """A code map as SQL."""
    return f"case upper(trim({c})) " + " ".join(f"when '{code}' then '{value}'" for code, value in _REF.mapping(name).items()) + " end"


_SITE_LIST = ", ".join(f"'{i}'" for i in _REF.site_ids)
PIECES |= {
    "roster_typed": f"""
        select k as row_num, nullif(trim(patient_id), '') as patient_id, nullif(trim(last_name), '') as last_name, birth_date as birth_date_raw, cast(try_strptime(birth_date, '%Y-%m-%d') as date) as birth_date, trim(sex) as sex_raw,
            {_cases('sex', 'sex')} as sex, case when ({_cases('ethnicity', 'ethnicity')}) = 'Hispanic or Latino' then 'Hispanic or Latino' else coalesce({_cases('race', 'race')}, 'Unknown') end as race_ethnicity,
            {_cases('language', 'language')} as language, case when trim(language) = '' then 'Unknown' else coalesce(case ({_cases('language', 'language')}) when 'en' then 'English' when 'es' then 'Spanish' end, 'Other') end as language_group,
            nullif(regexp_extract(zip, '^([0-9]{{5}})', 1), '') as zip, phone as phone_raw, case when length(regexp_replace(phone, '[^0-9]', '', 'g')) = 10 then regexp_replace(phone, '[^0-9]', '', 'g') end as phone,
            nullif(payer_type, '') as payer_type_raw, {_cases('payer_type', 'payer_type')} as payer_type, nullif(upper(replace(problem_list, ' ', '')), '') as problem_list, site_id from roster_text""",
    "roster_found": f"""
        select row_num, 'ROS-002' as rule_id, 'repair' as action, patient_id as detail from roster_typed where regexp_full_match(patient_id, '[0-9]{{1,7}}')
        union all select row_num, 'ROS-003', 'quarantine', 'last_name' from roster_typed where last_name is null
        union all select row_num, 'ROS-005', 'quarantine', birth_date_raw from roster_typed where birth_date is null
        union all select row_num, 'ROS-006', 'quarantine', cast(birth_date as varchar) from roster_typed where birth_date > date '1999-01-31' or birth_date < date '1900-01-01'
        union all select row_num, 'ROS-007', 'repair', site_id from roster_typed where site_id <> upper(site_id)
        union all select row_num, 'ROS-008', 'quarantine', upper(site_id) from roster_typed where upper(site_id) not in ({_SITE_LIST})
        union all select row_num, 'ROS-009', 'quarantine', sex_raw from roster_typed where sex is null and sex_raw <> ''
        union all select row_num, 'ROS-011', 'warn', phone_raw from roster_typed where phone is null
        union all select row_num, 'ROS-013', 'warn', payer_type_raw from roster_typed where payer_type is null and payer_type_raw is not null""",
    "labs_judged": """
        select *, case when unit = '%' and analyte = 'HBA1C' or unit = 'mg/dL' and analyte = 'LDL' then round(number, 1) when unit = 'mmol/mol' and analyte = 'HBA1C' then round(number * cast(0.09148 as decimal(6, 5)) + cast(2.152 as decimal(4, 3)), 1) end as std
        from (select lab_result_id, loinc_code, trim(result) as said, case loinc_code when '13457-7' then 'LDL' when '4548-4' then 'HBA1C' when '59261-8' then 'HBA1C' end as analyte,
            coalesce(nullif(trim(units), ''), case loinc_code when '13457-7' then 'mg/dL' when '4548-4' then '%' when '59261-8' then 'mmol/mol' end) as unit, try_cast(regexp_replace(trim(result), '^[<>] ?', '') as decimal(10, 2)) as number from labs_coded) x""",
}
query("typed_roster", "select row_num, patient_id, last_name, birth_date, sex, race_ethnicity, language, language_group, zip, phone, payer_type, problem_list, site_id from roster_typed")(
    lambda t: _typed_roster(t).select("row_num", "patient_id", "last_name", "birth_date", "sex", "race_ethnicity", "language", "language_group", "zip", "phone", "payer_type", "problem_list", "site_id")
)
query("roster_findings", "select row_num, rule_id, action, detail from roster_found")(
    lambda t: rules.findings(rules.evaluated(_typed_roster(t), network.feeds(_REF)["roster"].contract)).drop("load_id")
)


@shared
def _labs_found(t: Tables) -> DataFrame:
    missing = [F.lit(None).cast("string").alias(c) for c in ("specimen_id", "abnormal_flag")]
    text = t.labs_coded.select("lab_result_id", "patient_id", F.col("collected_date").cast("string").alias("collected_date"), "loinc_code", "result", "units", *missing)
    typed = network.typed_labs(_carried(text, "lab_result_id", "2002-01-31"), _REF)
    return rules.findings(rules.evaluated(landed(typed, "labs"), network.feeds(_REF)["labs"].contract, t.patients))


query("labs_findings", """
    select lab_result_id as row_num, 'LAB-007' as rule_id, loinc_code as detail from labs_judged where analyte is null
    union all select lab_result_id, 'LAB-008', said from labs_judged where said <> '' and number is null
    union all select lab_result_id, 'LAB-009', unit from labs_judged where analyte is not null and not coalesce(analyte = 'LDL' and unit = 'mg/dL' or analyte = 'HBA1C' and unit in ('%', 'mmol/mol'), false)
    union all select lab_result_id, 'LAB-010', concat_ws(' ', analyte, said, unit) from labs_judged where std < case analyte when 'LDL' then 10 else 3 end or std > case analyte when 'LDL' then 400 else 20 end""")(
    lambda t: _labs_found(t).select("row_num", "rule_id", "detail")
)
