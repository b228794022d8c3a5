"""Comparison SQL in DuckDB's dialect, built from named pieces."""

from __future__ import annotations

import re

from .. import model

Y0, Y1, AS_OF = (f"date '{d.isoformat()}'" for d in (model.YEAR_START, model.YEAR_END, model.AS_OF))


def ratio(n: str, d: str, digits: int) -> str:
    ten = 10**digits
    return f"case when {d} > 0 then cast((2 * {ten} * cast({n} as bigint) + {d}) // (2 * {d}) as double) / {ten}.0 end"


def _whole(c: str) -> str:
    return f"case when regexp_full_match(nullif(trim({c}), ''), '-?[0-9]+') then cast(nullif(trim({c}), '') as integer) end"


def _sum(parts) -> str:
    return " + ".join(parts)


_SCORED, _DOMAINS = [*model.PHQ9, *model.GAD7], model.SDOH5
_BAD = {c: f"(trim({c}) <> '' and coalesce(({_whole(c)}) not between 0 and 3, true))" for c in _SCORED} | {c: f"(trim({c}) <> '' and upper(trim({c})) not in ('Y', 'N', 'D'))" for c in _DOMAINS}
_have = lambda cs: _sum(f"cast({c} is not null as integer)" for c in cs)


def _event(name: str, items: list[str], total: str, positive: str, flag: str) -> str:
    n = len(items)
    return (
        f"select screening_id, patient_id, screen_date, '{name}' as instrument, {_have(items)} as items_answered, {n} as items_expected, {_have(items)} = {n} as complete, "
        f"case when {_have(items)} = {n} then {total} end as total_score, {positive} as positive, {flag} as safety_flag from screens where {_have(items)} > 0"
    )


_TOTAL = {k: _sum(f"coalesce({c}, 0)" for c in cs) for k, cs in (("PHQ9", model.PHQ9), ("GAD7", model.GAD7))}
_NEEDS = _sum(f"coalesce(cast({c} = 'Y' as integer), 0)" for c in _DOMAINS)
_values = lambda rows: ", ".join("(" + ", ".join(repr(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)

#: Pieces by name; each may read the presented tables and other pieces.
PIECES = {
    "prefixes": f"select * from (values {_values(model.CONDITIONS)}) t(prefix, condition_group)",
    "bands": f"select * from (values {_values(model.BANDS)}) t(instrument, least, most, severity_band)",
    "definitions": "select * from (values " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in model.MEASURES) + ") t(measure_id, measure_name, direction)",
    "codes": "select patient_id, unnest(string_split(problem_list, ';')) as icd10_code from patients where problem_list <> ''",
    "conditions": "select distinct patient_id, icd10_code, condition_group from codes join prefixes on starts_with(icd10_code, prefix)",
    "fills": "select claim_id, patient_id, fill_date, drug_name, drug_class, days_supply from claims where claim_status = 'P' and claim_id not in (select claim_id from claims where claim_status = 'R')",
    "labs_typed": """
        select lab_result_id, patient_id, collected_date, analyte, units, result, case when regexp_full_match(trim(result), '[<>] ?[0-9.]+') then substr(trim(result), 1, 1) end as censor,
            try_cast(regexp_replace(trim(result), '^[<>] ?', '') as decimal(10, 2)) as result_value, units in ('%', 'mmol/mol') or analyte = 'LDL' as unit_known,
            cast(case when units = 'mmol/mol' then round(try_cast(regexp_replace(trim(result), '^[<>] ?', '') as decimal(10, 2)) * cast(0.09148 as decimal(6, 5)) + cast(2.152 as decimal(4, 3)), 1)
                when units = '%' or analyte = 'LDL' then round(try_cast(regexp_replace(trim(result), '^[<>] ?', '') as decimal(10, 2)), 1) end as decimal(10, 1)) as value_std
        from labs_text""",
    "labs": "select lab_result_id, patient_id, collected_date, analyte, value_std as value, censor, row_number() over (partition by patient_id, analyte order by collected_date desc, lab_result_id desc) = 1 as is_most_recent from labs_typed where value_std is not null",
    "screens_typed": "select screening_id, patient_id, screen_date, "
    + ", ".join(f"case when ({_whole(c)}) between 0 and 3 then ({_whole(c)}) end as {c}" for c in _SCORED)
    + ", "
    + ", ".join(f"nullif(upper(trim({c})), '') as {c}" for c in _DOMAINS)
    + f", {_sum(f'cast({_BAD[c]} as integer)' for c in _SCORED)} as bad_items, concat_ws('; ', "
    + ", ".join(f"case when {_BAD[c]} then '{c}=' || trim({c}) end" for c in _SCORED)
    + f") as bad_items_detail, {_sum(f'cast({_BAD[c]} as integer)' for c in _DOMAINS)} as bad_domains from screens_text",
    "screens": "select * from screens_typed where bad_items = 0 and bad_domains = 0",
    "events_made": " union all ".join(
        [
            _event("PHQ9", model.PHQ9, _TOTAL["PHQ9"], f"case when {_have(model.PHQ9)} = 9 then {_TOTAL['PHQ9']} >= 10 end", f"{_have(model.PHQ9)} = 9 and coalesce(phq9_q9, 0) > 0"),
            _event("GAD7", model.GAD7, _TOTAL["GAD7"], f"case when {_have(model.GAD7)} = 7 then {_TOTAL['GAD7']} >= 10 end", "false"),
            _event("SDOH5", model.SDOH5, _NEEDS, f"{_NEEDS} > 0", "false"),
        ]
    ),
    "screen_events": """
        select e.*, severity_band, complete and row_number() over (partition by patient_id, e.instrument, complete order by screen_date desc, screening_id desc) = 1 as is_most_recent
        from events_made e left join bands b on b.instrument = e.instrument and total_score >= least and total_score <= most""",
    "facts": f"""
        select p.patient_id, site_id, care_manager_name, sex, race_ethnicity, language_group, payer_type, age as age_my_end,
            case when age < 18 then '0-17' when age < 40 then '18-39' when age < 65 then '40-64' else '65+' end as age_band, coalesce(visits, 0) as completed_visits_my, coalesce(visits, 0) > 0 as active_my,
            {', '.join(f"list_contains(coalesce(groups, []), '{g}') as {n}" for g, n in (('diabetes_t2', 'has_diabetes'), ('hypertension', 'has_hypertension'), ('hyperlipidemia', 'has_hyperlipidemia'), ('depression', 'has_depression')))}
        from (select *, cast(date_diff('year', birth_date, {Y1}) as integer) as age from patients) p
        left join (select patient_id, count(*) as visits from appointments where status = 'completed' and year(appt_date) = {model.YEAR} group by patient_id) v on v.patient_id = p.patient_id
        left join (select patient_id, list(condition_group) as groups from conditions group by patient_id) c on c.patient_id = p.patient_id""",
    "year_fills": f"select f.*, row_number() over (partition by patient_id, drug_class, drug_name order by fill_date, claim_id) as i from fills f where year(fill_date) = {model.YEAR}",
    "eligible": "select patient_id, drug_class, min(fill_date) as index_date from year_fills group by all having count(distinct fill_date) > 1",
    "covered_days": f"""
        select e.patient_id, e.drug_class, e.index_date, count(distinct d.day) as days_covered from eligible e
        left join (select patient_id, drug_class, unnest(generate_series(starts, starts + days_supply - 1, interval 1 day))::date as day from chained) d
            on d.patient_id = e.patient_id and d.drug_class = e.drug_class and d.day between e.index_date and {Y1} group by e.patient_id, e.drug_class, e.index_date""",
    "pdc": f"""
        select patient_id, drug_class, index_date, days_covered, period_days, {ratio('days_covered', 'period_days', 3)} as pdc, 5 * days_covered >= 4 * period_days as adherent
        from (select *, date_diff('day', index_date, {Y1}) + 1 as period_days from covered_days) x""",
    "chained": """
        with recursive walk as (
            select patient_id, drug_class, drug_name, i, days_supply, fill_date as starts from year_fills where i = 1
            union all
            select f.patient_id, f.drug_class, f.drug_name, f.i, f.days_supply, greatest(f.fill_date, w.starts + w.days_supply) from walk w
            join year_fills f on f.patient_id = w.patient_id and f.drug_class = w.drug_class and f.drug_name = w.drug_name and f.i = w.i + 1)
        select * from walk""",
    "first_positive": f"select patient_id, min(screen_date) as index_date from screen_events where complete and instrument = 'PHQ9' and total_score >= 10 and screen_date between {Y0} and date '{model.YEAR}-12-01' group by patient_id",
    "contacts": "select patient_id, appt_date as day from appointments where status = 'completed' union select patient_id, screen_date from screen_events where complete and instrument = 'PHQ9'",
    "followed": "select p.patient_id, min(c.day) as first_contact from first_positive p join contacts c on c.patient_id = p.patient_id and c.day between p.index_date + 1 and p.index_date + 30 group by p.patient_id",
    "year_screens": f"select patient_id, instrument, count(*) as n from screen_events where complete and year(screen_date) = {model.YEAR} group by all",
    "latest_a1c": f"select patient_id, arg_max(value, (collected_date, lab_result_id)) as v from labs where analyte = 'HBA1C' and year(collected_date) = {model.YEAR} group by patient_id",
    "diabetics": "select f.patient_id, f.site_id, v, coalesce('latest ' || v || '%', 'no HbA1c in the year') as detail from facts f left join latest_a1c l on l.patient_id = f.patient_id where has_diabetes and active_my and age_my_end between 18 and 75",
    "results": """
        select 'DEP_SCREEN' as measure_id, f.patient_id, f.site_id, coalesce(n, 0) > 0 as numerator, coalesce(n, 0) || ' complete PHQ-9' as detail from facts f left join year_screens s on s.patient_id = f.patient_id and instrument = 'PHQ9' where active_my and age_my_end >= 12
        union all select 'SDOH_SCREEN', f.patient_id, f.site_id, coalesce(n, 0) > 0, coalesce(n, 0) || ' complete social-needs screen' from facts f left join year_screens s on s.patient_id = f.patient_id and instrument = 'SDOH5' where active_my and age_my_end >= 18
        union all select 'DEP_FOLLOWUP', p.patient_id, f.site_id, first_contact is not null, 'positive ' || index_date || coalesce('; follow-up ' || first_contact, '; no follow-up within 30 days') from first_positive p join facts f on f.patient_id = p.patient_id left join followed u on u.patient_id = p.patient_id
        union all select 'DM_A1C_TESTED', patient_id, site_id, v is not null, detail from diabetics
        union all select 'DM_A1C_CONTROLLED', patient_id, site_id, coalesce(v < 8, false), detail from diabetics
        union all select 'DM_A1C_POOR', patient_id, site_id, coalesce(v > 9, true), detail from diabetics
        union all select case drug_class when 'diabetes_oral' then 'PDC_DIABETES' when 'ras_antagonist' then 'PDC_RAS' else 'PDC_STATIN' end, d.patient_id, f.site_id, adherent, 'PDC ' || cast(pdc as decimal(4, 3)) || ' (' || days_covered || ' of ' || period_days || ' days)' from pdc d join facts f on f.patient_id = d.patient_id""",
    "summary": f"""
        select r.measure_id, measure_name, direction, s as site_id, count(*) as denominator, count(*) filter (numerator) as numerator, {ratio('count(*) filter (numerator)', 'count(*)', 4)} as rate
        from (select *, unnest([site_id, '{model.ALL_SITES}']) as s from results) r join definitions d on d.measure_id = r.measure_id group by all""",
    "strata": "select patient_id, stratifier, group_value from (unpivot (select patient_id, race_ethnicity, language_group, payer_type, sex, age_band from facts) on race_ethnicity, language_group, payer_type, sex, age_band into name stratifier value group_value)",
    "cells": "select measure_id, stratifier, group_value, count(*) as d, count(*) filter (numerator) as n from results r join strata s on s.patient_id = r.patient_id group by all",
    "marked": f"select c.*, d < {model.MIN_CELL} or n between 1 and {model.MIN_CELL - 1} or d - n between 1 and {model.MIN_CELL - 1} as prim from cells c",
    "hidden": "select measure_id, stratifier, sum(d) as all_d, sum(n) as all_n, count(*) filter (prim) as hid, arg_min(group_value, (d, group_value)) filter (not prim) as next_group from marked group by all",
    "equity": f"""
        select measure_id, stratifier, group_value, case when not s then d end as denominator, case when not s then n end as numerator, case when not s then {ratio('n', 'd', 4)} end as rate,
            case when not s and all_n > n and all_d > d then {ratio('n * (all_d - d)', '(d * (all_n - n))', 3)} end as relative_rate,
            case when not s then {ratio('d', 'all_d', 4)} end as share_of_denominator, case when not s then {ratio('n', 'all_n', 4)} end as share_of_numerator, s as suppressed,
            case when prim then 'small cell' when s then 'complementary' end as suppression_reason
        from (select m.measure_id, m.stratifier, m.group_value, m.d, m.n, m.prim, cast(h.all_d as bigint) as all_d, cast(h.all_n as bigint) as all_n, m.prim or coalesce(h.hid = 1 and m.group_value = h.next_group, false) as s
            from marked m join hidden h on h.measure_id = m.measure_id and h.stratifier = m.stratifier)""",
    "recent": f"select patient_id, status, appt_date, date_diff('day', appt_date, {AS_OF}) as ago from appointments where status <> 'scheduled' and appt_date <= {AS_OF}",
    "windows": "select p.patient_id, p.site_id, "
    + f"{AS_OF} as as_of_date, "
    + ", ".join(f"w.kept_{d}, w.due_{d}, {ratio(f'w.kept_{d}', f'w.due_{d}', 3)} as kept_rate_{d}" for d in (30, 90, 180))
    + ", coalesce(missed, 0) as no_shows_180, last_completed_visit, coalesce(missed >= 3 or (due_180 >= 3 and 10 * kept_180 < 7 * due_180), false) as frequent_no_show from patients p left join (select patient_id, "
    + ", ".join(f"count(*) filter (status = 'completed' and ago < {d}) as kept_{d}, count(*) filter (ago < {d}) as due_{d}" for d in (30, 90, 180))
    + ", count(*) filter (status = 'no_show' and ago < 180) as missed, max(appt_date) filter (status = 'completed') as last_completed_visit from recent group by patient_id) w on w.patient_id = p.patient_id",
}


def needs(sql: str) -> list[str]:
    said = re.findall(r"\b(?:from|join) \(?([a-z_0-9]+)", sql)
    return list(dict.fromkeys(t for t in said if t in PIECES or t in model.TABLES))


def oracle(select: str) -> str:
    """The statement with all pieces and tables that it needs in front."""
    held: dict[str, str] = {}

    def add(name: str) -> None:
        sql = PIECES.get(name) or model.TABLES[name]
        for t in needs(sql):
            if t not in held and t != name:
                add(t)
        held[name] = sql

    for t in needs(select):
        if t not in held:
            add(t)
    # Materialised: a piece that is read twice is computed once.
    front = ",\n".join(f"{n} as materialized ({sql})" for n, sql in held.items())
    return f"with {front}\n{select}" if held else select
