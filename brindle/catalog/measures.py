"""Curated tables, measures and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import model
from ..model import Tables, landed, shared
from ..operators import curate, measures
from . import query

# --- what the queries build on


@shared
def conditions(t: Tables) -> DataFrame:
    return curate.patient_conditions(t.patients)


@shared
def labs(t: Tables) -> DataFrame:
    return curate.lab_results(curate.typed_labs(t.labs_text))


@shared
def screens(t: Tables) -> DataFrame:
    return curate.clean_screens(landed(curate.typed_screens(t.screens_text), "screens"))


@shared
def events(t: Tables) -> DataFrame:
    return curate.screening_events(screens(t))


@shared
def fills(t: Tables) -> DataFrame:
    return curate.net_fills(t.claims)


@shared
def facts(t: Tables) -> DataFrame:
    return measures.patient_facts(t.patients, t.appointments, conditions(t))


@shared
def covered(t: Tables) -> DataFrame:
    return measures.days_covered(fills(t))


@shared
def results(t: Tables) -> DataFrame:
    return measures.patient_results(facts(t), t.appointments, events(t), labs(t), covered(t))


@shared
def windows(t: Tables) -> DataFrame:
    return measures.appointment_windows(t.patients, t.appointments)


# --- curation

query("current_patients", "select patient_id, patient_name, site_id, care_manager_name, race_ethnicity, sex, language_group, payer_type, birth_date, problem_list from patients")(lambda t: t.patients)
query("patient_conditions", "select * from conditions")(conditions)
query("screening_scores_bands", "select * from screen_events")(events)
query("labs_most_recent", "select * from labs")(labs)
query("net_fills", "select * from fills")(fills)
query("typed_labs_units", "select lab_result_id, analyte, units, censor, result_value, unit_known, value_std from labs_typed")(
    lambda t: curate.typed_labs(t.labs_text).select("lab_result_id", "analyte", "units", "censor", "result_value", "unit_known", "value_std")
)
query("typed_screenings", "select * from screens_typed")(lambda t: curate.typed_screens(t.screens_text))
query("typed_appointments", "select appointment_id, patient_id, site_id, appt_date, status, coalesce(visit_type, 'other') as visit_type, status = 'completed' as is_visit from appointments")(
    lambda t: curate.appointments(t.appointments)
)
_ITEMS = ", ".join([*model.PHQ9, *model.GAD7, *model.SDOH5])
query(
    "screening_items_long",
    "select screening_id, patient_id, screen_date, upper(regexp_extract(item_code, '^(phq9|gad7|sdoh)', 1)) || case when item_code like 'sdoh%' then '5' else '' end as instrument, item_code, response from (unpivot (select screening_id, patient_id, screen_date, "
    + ", ".join(f"cast({c} as varchar) as {c}" for c in [*model.PHQ9, *model.GAD7, *model.SDOH5])
    + f" from screens) on {_ITEMS} into name item_code value response)",
)(lambda t: curate.screening_items(screens(t)))

# --- measures and marts

query("patient_facts", "select * from facts")(facts)
query("pdc", "select * from pdc")(covered)
query("measure_patient_results", "select * from results")(results)
query("measure_summary", "select * from summary")(lambda t: measures.summary(results(t)))
query("measure_equity", "select * from equity")(lambda t: measures.equity(results(t), facts(t)))
query("appointment_windows", "select * from windows")(windows)
query("care_gaps", """
    select p.patient_id, p.site_id, p.care_manager_name, gap, detail from patients p join (
        select patient_id, map {'DEP_FOLLOWUP': 'depression_follow_up_missed', 'DEP_SCREEN': 'depression_screen_due', 'DM_A1C_TESTED': 'hba1c_not_tested', 'DM_A1C_POOR': 'hba1c_poor_control', 'PDC_DIABETES': 'adherence_diabetes_below_80', 'PDC_RAS': 'adherence_ras_below_80', 'PDC_STATIN': 'adherence_statin_below_80', 'SDOH_SCREEN': 'social_needs_screen_due'}[measure_id] as gap, detail
        from results where numerator = (measure_id = 'DM_A1C_POOR') and measure_id <> 'DM_A1C_CONTROLLED'
        union all select patient_id, 'frequent_no_show', no_shows_180 || ' no-shows in 180 days' from windows where frequent_no_show
        union all select patient_id, 'phq9_item9_review', 'self-harm item answered above 0 on ' || max(screen_date) from screen_events where safety_flag group by patient_id) g on g.patient_id = p.patient_id
""")(lambda t: measures.care_gaps(t.patients, results(t), windows(t), events(t)))  # fmt: skip


def _comparison_sql() -> str:
    from .oracle import AS_OF, ratio

    spans = [(f"last {d} days", f"previous {d} days", f"appt_date > {AS_OF} - {d} and appt_date <= {AS_OF}", f"appt_date > {AS_OF} - {2 * d} and appt_date <= {AS_OF} - {d}") for d in (7, 28, 90)]
    y = model.AS_OF.year
    spans.append(("year to date", "same days last year", f"appt_date >= date '{y}-01-01' and appt_date <= {AS_OF}", f"appt_date >= date '{y - 1}-01-01' and appt_date <= date '{y - 1}{model.AS_OF.isoformat()[4:]}'"))
    parts = []
    for a, b, now, then in spans:
        counts = f"count(*) filter (status = 'completed' and {now}) as ka, count(*) filter ({now}) as da, count(*) filter (status = 'completed' and {then}) as kb, count(*) filter ({then}) as db"
        parts.append(f"select scope, scope_id, '{a}' as period_after, '{b}' as period_before, {counts} from (select 'network' as scope, 'ALL' as scope_id, appt_date, status from appointments union all select 'clinic', site_id, appt_date, status from appointments) x where status <> 'scheduled' group by scope, scope_id")
    gap = "abs(ka * db - kb * da)"
    return f"""select scope, scope_id, 'kept_rate' as metric, period_after, period_before, {ratio('ka', 'da', 4)} as value_after, {ratio('kb', 'db', 4)} as value_before,
        case when da * db > 0 then sign(ka * db - kb * da) * ({ratio(gap, '(da * db)', 4)}) end as change, da as appointments_after, db as appointments_before from ({' union all '.join(parts)}) c"""


query("period_comparison", _comparison_sql())(lambda t: measures.period_comparison(t.appointments))

# --- assertions, as counts of rows that break them

counted = lambda df: df.agg(F.count("*").alias("violations"))
query("assert_clinics_sum", "select count(*) as violations from (select measure_id from summary group by measure_id having sum(case when site_id = 'ALL' then denominator else -denominator end) <> 0 or sum(case when site_id = 'ALL' then numerator else -numerator end) <> 0) x")(
    lambda t: counted(measures.clinics_not_adding_up(measures.summary(results(t))))
)
query("assert_inverse_complement", "select count(*) as violations from results a join results b on a.patient_id = b.patient_id where a.measure_id = 'DM_A1C_CONTROLLED' and b.measure_id = 'DM_A1C_POOR' and a.numerator and b.numerator")(
    lambda t: counted(measures.controlled_and_poor(results(t)))
)
query("assert_no_single_suppressed", "select count(*) as violations from (select 1 from equity group by measure_id, stratifier having count(*) filter (suppressed) = 1) x")(
    lambda t: counted(measures.single_hidden_cells(measures.equity(results(t), facts(t))))
)
query("assert_small_cells", f"select count(*) as violations from equity where (not suppressed and (denominator < {model.MIN_CELL} or numerator between 1 and {model.MIN_CELL - 1} or denominator - numerator between 1 and {model.MIN_CELL - 1})) or (suppressed and (denominator is not null or numerator is not null))")(
    lambda t: counted(measures.small_cells_shown(measures.equity(results(t), facts(t))))
)
