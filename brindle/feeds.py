"""The network's five feeds: their contracts, how their text becomes typed columns, what is curated.

A typed row has its columns, originals under ``<name>_raw`` where rules look at them, and what the
pipeline carries (CARRIED). Dates are read by the format that the whole file was found to use.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .functions.scalars import decimal_number, mapped, parsed_date, text, whole_number
from .model import GAD7, PHQ9, SDOH5
from .operators import curate
from .plans.contracts import Contract, Layout, Rule, Source
from .reference import Reference

#: Columns that the pipeline adds to every raw row.
CARRIED = ("load_id", "row_num", "source", "layout", "extract_date", "arrival_date", "format_no", "candidate")
FORMATS = ("y-M-d", "M/d/y")
_PATTERN = r"_(?P<extract>[0-9]{8})(?:_r(?P<redelivery>[0-9]+))?\.csv$"


@dataclass(frozen=True)
class Feed:
    """A contract, its typing, and the tables that are curated from what was merged."""

    contract: Contract
    typed: Callable[[DataFrame, Reference], DataFrame]
    curate: Callable[[DataFrame, Reference], dict[str, DataFrame]] | None = None
    year: int = 0
    closed_after: date = date.max


def day(name: str, formats: Sequence[str] = FORMATS) -> Column:
    return F.coalesce(*(F.when(F.col("format_no") == i, parsed_date(text(name), f)) for i, f in enumerate(formats)))


def _said(*names: str) -> list[Column]:
    return [text(n).alias(n) for n in names]


def _zeros(rule: str) -> Rule:
    """Record numbers whose leading zeros a spreadsheet took are padded again."""
    return Rule(rule, "repair", "repair", {"when": "length(patient_id) < 8 and translate(patient_id, '0123456789', '') = ''", "set": {"patient_id": "lpad(patient_id, 8, '0')"}}, dimension="conformity")


def _volume(rule: str, least: float, rows: int = 0) -> Rule:
    return Rule(rule, "volume", "block", {"min_ratio": least} | ({"min_baseline_rows": rows} if rows else {}), dimension="completeness")


def _known(rule: str) -> Rule:
    return Rule(rule, "on_roster", "quarantine", {"column": "patient_id"}, retryable=True, dimension="integrity")


# --- roster


def typed_roster(rows: DataFrame, ref: Reference) -> DataFrame:
    digits = F.regexp_replace("phone", "[^0-9]", "")
    code = F.regexp_extract(text("zip"), "^([0-9]{5})", 1)
    language = text("language")
    group = F.when(language.isNull(), "Unknown").otherwise(F.coalesce(F.element_at(F.create_map(F.lit("en"), F.lit("English"), F.lit("es"), F.lit("Spanish")), mapped(ref.mapping("language"), language)), F.lit("Other")))
    hispanic = mapped(ref.mapping("ethnicity"), text("ethnicity")) == "Hispanic or Latino"
    race = mapped(ref.mapping("race"), text("race"))
    return rows.select(
        *_said("patient_id", "first_name", "last_name", "race", "ethnicity", "address_line1", "city", "email", "site_id", "pcp_name", "care_manager_name"),
        text("birth_date").alias("birth_date_raw"), day("birth_date").alias("birth_date"), text("sex").alias("sex_raw"), mapped(ref.mapping("sex"), "sex").alias("sex"),
        F.when(hispanic, "Hispanic or Latino").otherwise(F.coalesce(race, F.lit("Unknown"))).alias("race_ethnicity"),
        mapped(ref.mapping("language"), language).alias("language"), group.alias("language_group"), F.nullif(code, F.lit("")).alias("zip"),
        text("phone").alias("phone_raw"), F.when(F.length(digits) == 10, digits).alias("phone"),
        text("payer_type").alias("payer_type_raw"), mapped(ref.mapping("payer_type"), "payer_type").alias("payer_type"),
        F.nullif(F.upper(F.regexp_replace("problem_list", " ", "")), F.lit("")).alias("problem_list"), day("registration_date").alias("registration_date"), *CARRIED,
    )


def _roster(ref: Reference) -> Feed:
    direct, quasi, work = "direct_identifier", "quasi_identifier", "operational"
    names = {
        "MRN": "patient_id", "FIRST_NAME": "first_name", "LAST_NAME": "last_name", "DOB": "birth_date", "SEX": "sex", "RACE": "race", "ETHNICITY": "ethnicity", "PREF_LANGUAGE": "language",
        "ADDRESS1": "address_line1", "CITY": "city", "ZIP": "zip", "PHONE": "phone", "EMAIL": "email", "PAYER_TYPE": "payer_type", "SITE_CODE": "site_id", "PCP": "pcp_name",
        "CARE_MANAGER": "care_manager_name", "PROBLEM_LIST": "problem_list", "REG_DATE": "registration_date",
    }
    contract = Contract(
        feed="roster", natural_key=("patient_id",), snapshot=True, date_columns=("birth_date", "registration_date"), date_formats=FORMATS, published=("patients", "patient_conditions", "patient_attribution_history"),
        columns={
            "patient_id": direct, "first_name": direct, "last_name": direct, "birth_date": direct, "sex": quasi, "race": quasi, "ethnicity": quasi, "race_ethnicity": quasi, "language": quasi, "language_group": quasi,
            "address_line1": direct, "city": quasi, "zip": direct, "phone": direct, "email": direct, "payer_type": quasi, "site_id": work, "pcp_name": work, "care_manager_name": work, "problem_list": "clinical", "registration_date": direct,
        },
        rules=(
            _volume("ROS-001", 0.9), _zeros("ROS-002"),
            Rule("ROS-003", "required", "quarantine", {"columns": ["patient_id", "last_name", "birth_date_raw"]}, dimension="completeness"),
            Rule("ROS-004", "expression", "quarantine", {"fail_when": "length(patient_id) <> 8 or translate(patient_id, '0123456789', '') <> ''", "detail": "patient_id"}, dimension="conformity"),
            Rule("ROS-005", "parse", "quarantine", {"column": "birth_date"}),
            Rule("ROS-006", "expression", "quarantine", {"fail_when": "birth_date > extract_date or birth_date < date '1900-01-01'", "detail": "cast(birth_date as string)"}),
            Rule("ROS-007", "repair", "repair", {"when": "site_id <> upper(site_id)", "set": {"site_id": "upper(site_id)"}}, dimension="conformity"),
            Rule("ROS-008", "in_reference", "quarantine", {"column": "site_id", "values": ref.site_ids}, dimension="integrity"),
            Rule("ROS-009", "mapped", "quarantine", {"column": "sex"}),
            Rule("ROS-010", "key_conflict", "quarantine", dimension="uniqueness"),
            Rule("ROS-011", "expression", "warn", {"fail_when": "phone_raw is not null and phone is null", "detail": "phone_raw"}, dimension="conformity"),
            Rule("ROS-012", "completeness", "warn", {"column": "race_ethnicity", "missing_values": ["Unknown"], "min_share": 0.95}, dimension="completeness"),
            Rule("ROS-013", "mapped", "warn", {"column": "payer_type"}),
        ),
        sources=(Source("ehr_roster", "^roster" + _PATTERN, (Layout(1, names),)),),
    )
    return Feed(contract, typed_roster, _curated_roster)


def _curated_roster(history: DataFrame, ref: Reference) -> dict[str, DataFrame]:
    """Current patients, their conditions, and the history of who looked after them."""
    spark = history.sparkSession
    past = history.select("patient_id", "site_id", "pcp_name", "care_manager_name", "valid_from", "valid_to", "is_current", "removed")
    # Since when the clinic has been the same: the first version after the last one with another clinic.
    w = Window.partitionBy("patient_id").orderBy("valid_from")
    moved = past.withColumn("moved", ~F.lag("site_id").over(w).eqNullSafe(F.col("site_id")) | F.row_number().over(w).eqNullSafe(1))
    since = moved.where("moved").groupBy("patient_id").agg(F.max("valid_from").alias("attributed_since"))
    now = history.where("is_current").withColumn("payer_type", F.coalesce("payer_type", F.lit("unknown")))
    patients = now.drop("race", "ethnicity", "row_hash", "valid_from", "valid_to", "is_current", "removed").join(since, "patient_id", "left")
    codes = now.where("problem_list is not null").select("patient_id", F.explode(F.split("problem_list", ";")).alias("icd10_code")).where("icd10_code <> ''")
    found = codes.join(ref.table(spark, "conditions"), F.col("icd10_code").startswith(F.col("prefix"))).select("patient_id", "icd10_code", "condition_group").distinct()
    return {"patients": patients, "patient_conditions": found, "patient_attribution_history": past}


# --- screenings


def typed_screenings(rows: DataFrame, ref: Reference) -> DataFrame:
    mode = mapped(ref.mapping("admin_mode"), "admin_mode")
    held = rows.select(
        *_said("screening_id", "patient_id"), text("screen_date").alias("screen_date_raw"), day("screen_date").alias("screen_date"), text("admin_mode").alias("admin_mode_raw"), mode.alias("admin_mode"),
        *PHQ9, *GAD7, *SDOH5, *(whole_number(text(f"{i}_total_reported")).alias(f"{i}_total_reported") for i in ("phq9", "gad7")), *CARRIED,
    )
    more = ("screen_date_raw", "admin_mode", "admin_mode_raw", "phq9_total_reported", "gad7_total_reported", *CARRIED)
    return curate.typed_screens(held, keep=("screening_id", "patient_id", "screen_date", *more), reported={"phq9_total_reported": PHQ9, "gad7_total_reported": GAD7})


def _screenings(ref: Reference) -> Feed:
    answers = [*PHQ9, "phq9_total", *GAD7, "gad7_total", *SDOH5]
    names = {"screening_id": "screening_id", "mrn": "patient_id", "screen_date": "screen_date", "admin_mode": "admin_mode"} | {a: f"{a}_reported" if a.endswith("_total") else a for a in answers}
    contract = Contract(
        feed="screenings", natural_key=("screening_id",), date_columns=("screen_date",), date_formats=FORMATS, time_column="screen_date", published=("screening_events", "screening_items"),
        columns={"screening_id": "operational", "patient_id": "direct_identifier", "screen_date": "direct_identifier", "admin_mode": "operational"} | {names[a]: "clinical" for a in answers},
        rules=(
            _volume("SCR-001", 0.25, 40), Rule("SCR-002", "date_format", "warn", dimension="conformity"), _zeros("SCR-003"),
            Rule("SCR-004", "required", "quarantine", {"columns": ["screening_id", "patient_id", "screen_date_raw"]}, dimension="completeness"),
            Rule("SCR-005", "parse", "quarantine", {"column": "screen_date"}), Rule("SCR-006", "not_future", "quarantine", {"column": "screen_date"}),
            Rule("SCR-007", "expression", "quarantine", {"fail_when": "bad_items > 0", "detail": "bad_items_detail", "block_if_rate_over": 0.05}),
            Rule("SCR-008", "expression", "quarantine", {"fail_when": "bad_domains > 0", "detail": "bad_domains_detail"}),
            Rule("SCR-009", "mapped", "quarantine", {"column": "admin_mode"}, retryable=True), _known("SCR-010"), Rule("SCR-011", "key_conflict", "quarantine", dimension="uniqueness"),
            Rule("SCR-012", "expression", "warn", {"fail_when": "total_mismatch <> ''", "detail": "total_mismatch"}, dimension="consistency"),
            Rule("SCR-013", "closed_period", "warn", {"column": "screen_date"}, dimension="timeliness"),
        ),
        sources=(Source("screening_platform", "^screenings" + _PATTERN, (Layout(1, names),)),),
    )
    return Feed(contract, typed_screenings, lambda clean, _: {"screening_events": curate.screening_events(clean), "screening_items": curate.screening_items(clean)})


# --- labs


def typed_labs(rows: DataFrame, ref: Reference) -> DataFrame:
    """The unit is the one sent, or else the code's own; a value has a standard unit only if the unit is known."""
    spark, said = rows.sparkSession, text("result")
    codes, units, limits = (ref.table(spark, t) for t in ("lab_codes", "lab_units", "analytes"))
    out = rows.join(codes, text("loinc_code") == F.col("code"), "left").withColumn("units", F.coalesce(text("units"), F.col("default_unit")))
    out = out.join(units, (F.col("analyte") == F.col("unit_of")) & (F.col("units") == F.col("unit")), "left").join(limits, F.col("analyte") == F.col("limits_of"), "left")
    value = decimal_number(F.regexp_replace(said, "^[<>] ?", ""))
    return out.select(
        *_said("lab_result_id", "patient_id", "loinc_code", "specimen_id", "abnormal_flag"), text("collected_date").alias("collected_date_raw"), day("collected_date").alias("collected_date"), "analyte",
        said.alias("result_raw"), value.alias("result_value"), F.when(value.isNotNull(), F.nullif(F.regexp_extract(said, "^([<>])", 1), F.lit(""))).alias("censor"), "units",
        F.col("conversion").isNotNull().alias("unit_known"), curate.standard(value, F.col("conversion")).alias("value_std"),
        F.col("low").cast("decimal(10,1)").alias("plausible_low"), F.col("high").cast("decimal(10,1)").alias("plausible_high"), *CARRIED,
    )


def _labs(ref: Reference) -> Feed:
    first = {"OrderID": "lab_result_id", "MRN": "patient_id", "Collected": "collected_date", "LOINC": "loinc_code", "TestName": "test_name", "Result": "result", "RefRange": "reference_range", "AbnFlag": "abnormal_flag"}
    second = {
        "accession_id": "lab_result_id", "patient_mrn": "patient_id", "collection_date": "collected_date", "loinc_code": "loinc_code", "test_description": "test_name", "result_value": "result",
        "result_units": "units", "reference_range": "reference_range", "abnormal_flag": "abnormal_flag", "specimen_id": "specimen_id",
    }
    work, clinical = "operational", "clinical"
    contract = Contract(
        feed="labs", natural_key=("lab_result_id",), date_columns=("collected_date",), date_formats=FORMATS, time_column="collected_date", published=("lab_results",),
        columns={
            "lab_result_id": work, "patient_id": "direct_identifier", "collected_date": "direct_identifier", "loinc_code": "reference", "analyte": "reference", "result_raw": clinical, "result_value": clinical,
            "censor": clinical, "units": clinical, "value_std": clinical, "abnormal_flag": clinical, "specimen_id": work,
        },
        rules=(
            _volume("LAB-001", 0.25, 40), Rule("LAB-002", "date_format", "warn", dimension="conformity"), _zeros("LAB-003"),
            Rule("LAB-004", "required", "quarantine", {"columns": ["lab_result_id", "patient_id", "collected_date_raw", "loinc_code", "result_raw"]}, dimension="completeness"),
            Rule("LAB-005", "parse", "quarantine", {"column": "collected_date"}), Rule("LAB-006", "not_future", "quarantine", {"column": "collected_date"}),
            Rule("LAB-007", "in_reference", "quarantine", {"column": "loinc_code", "values": [c[0] for c in ref.lab_codes]}, dimension="conformity"),
            Rule("LAB-008", "expression", "quarantine", {"fail_when": "result_raw is not null and result_value is null", "detail": "result_raw"}),
            Rule("LAB-009", "expression", "quarantine", {"fail_when": "analyte is not null and not unit_known", "detail": "units"}, dimension="conformity"),
            Rule("LAB-010", "expression", "quarantine", {"fail_when": "value_std < plausible_low or value_std > plausible_high", "detail": "concat_ws(' ', analyte, result_raw, units)"}),
            _known("LAB-011"), Rule("LAB-012", "key_conflict", "quarantine", dimension="uniqueness"),
            Rule("LAB-013", "closed_period", "warn", {"column": "collected_date"}, dimension="timeliness"),
        ),
        sources=(Source("reference_lab", "^labs" + _PATTERN, (Layout(1, first), Layout(2, second))),),
    )
    return Feed(contract, typed_labs, lambda clean, _: {"lab_results": curate.lab_results(clean)})


# --- appointments


def typed_appointments(rows: DataFrame, ref: Reference) -> DataFrame:
    return rows.select(
        *_said("appointment_id", "patient_id", "provider_name"), F.upper(text("site_id")).alias("site_id"), text("appt_date").alias("appt_date_raw"), day("appt_date").alias("appt_date"),
        text("visit_type").alias("visit_type_raw"), mapped(ref.mapping("visit_type"), "visit_type").alias("visit_type"),
        text("status").alias("status_raw"), mapped(ref.mapping("appointment_status"), "status").alias("status"), *CARRIED,
    )


def _appointments(ref: Reference) -> Feed:
    clinic = {"APPT_ID": "appointment_id", "MRN": "patient_id", "SITE": "site_id", "APPT_DATE": "appt_date", "VISIT_TYPE": "visit_type", "STATUS": "status", "PROVIDER": "provider_name"}
    mobile = {"visit_id": "appointment_id", "mrn": "patient_id", "host_site": "site_id", "visit_date": "appt_date", "visit_kind": "visit_type", "visit_status": "status"}
    work = "operational"
    contract = Contract(
        feed="appointments", natural_key=("source", "appointment_id"), date_columns=("appt_date",), date_formats=FORMATS, time_column="appt_date", published=("appointments",),
        columns={"source": work, "appointment_id": work, "patient_id": "direct_identifier", "site_id": work, "appt_date": "direct_identifier", "visit_type": work, "status": work, "provider_name": work},
        rules=(
            _volume("APT-001", 0.5, 40), Rule("APT-002", "date_format", "warn", dimension="conformity"), _zeros("APT-003"),
            Rule("APT-004", "required", "quarantine", {"columns": ["appointment_id", "patient_id", "site_id", "appt_date_raw", "status_raw"]}, dimension="completeness"),
            Rule("APT-005", "parse", "quarantine", {"column": "appt_date"}), Rule("APT-006", "mapped", "quarantine", {"column": "status"}, retryable=True, dimension="conformity"),
            Rule("APT-007", "in_reference", "quarantine", {"column": "site_id", "values": ref.site_ids}, dimension="integrity"),
            Rule("APT-008", "expression", "quarantine", {"fail_when": "status in ('completed', 'no_show') and appt_date > extract_date", "detail": "concat(status, ' on ', appt_date)"}),
            _known("APT-009"), Rule("APT-010", "key_conflict", "quarantine", dimension="uniqueness"), Rule("APT-011", "mapped", "warn", {"column": "visit_type"}, dimension="conformity"),
            Rule("APT-012", "closed_period", "warn", {"column": "appt_date"}, dimension="timeliness"),
        ),
        sources=(Source("clinic_scheduling", "^appointments_main" + _PATTERN, (Layout(1, clinic),)), Source("mobile_unit", "^appointments_mobile" + _PATTERN, (Layout(1, mobile),))),
    )
    return Feed(contract, typed_appointments, lambda clean, _: {"appointments": curate.appointments(clean)})


# --- pharmacy


def typed_pharmacy(rows: DataFrame, ref: Reference) -> DataFrame:
    drug = F.lower(text("drug_name"))
    return rows.join(ref.table(rows.sparkSession, "drugs"), drug == F.col("drug"), "left").select(
        *_said("claim_id", "patient_id", "strength"), text("fill_date").alias("fill_date_raw"), day("fill_date").alias("fill_date"), drug.alias("drug_name"), "drug_class",
        text("days_supply").alias("days_supply_raw"), whole_number(text("days_supply")).alias("days_supply"), text("quantity").try_cast("decimal(10,2)").alias("quantity"),
        text("claim_status").alias("claim_status_raw"), mapped(ref.mapping("claim_status"), "claim_status").alias("claim_status"), day("adjudicated_date").alias("adjudicated_date"), *CARRIED,
    )


def _pharmacy(ref: Reference) -> Feed:
    names = {"claim_id": "claim_id", "member_mrn": "patient_id"} | {n: n for n in ("fill_date", "drug_name", "strength", "days_supply", "quantity", "claim_status", "adjudicated_date")}
    work, clinical = "operational", "clinical"
    contract = Contract(
        feed="pharmacy", natural_key=("claim_id", "claim_status"), date_columns=("fill_date", "adjudicated_date"), date_formats=FORMATS, time_column="fill_date", published=("pharmacy_fills", "pharmacy_claims"),
        columns={
            "claim_id": work, "patient_id": "direct_identifier", "fill_date": "direct_identifier", "drug_name": clinical, "drug_class": clinical, "strength": clinical, "days_supply": clinical,
            "quantity": clinical, "claim_status": work, "adjudicated_date": work,
        },
        rules=(
            _volume("RX-001", 0.25, 40), Rule("RX-002", "date_format", "warn", dimension="conformity"), _zeros("RX-003"),
            Rule("RX-004", "required", "quarantine", {"columns": ["claim_id", "patient_id", "fill_date_raw", "drug_name", "days_supply_raw", "claim_status_raw"]}, dimension="completeness"),
            Rule("RX-005", "parse", "quarantine", {"column": "fill_date"}),
            Rule("RX-006", "expression", "quarantine", {"fail_when": "days_supply_raw is not null and coalesce(days_supply not between 1 and 365, true)", "detail": "days_supply_raw"}),
            Rule("RX-007", "mapped", "quarantine", {"column": "claim_status"}), Rule("RX-008", "in_reference", "quarantine", {"column": "drug_name", "values": ref.drug_names}, dimension="conformity"),
            Rule("RX-009", "not_future", "quarantine", {"column": "fill_date"}), _known("RX-010"), Rule("RX-011", "key_conflict", "quarantine", dimension="uniqueness"),
            Rule("RX-012", "closed_period", "warn", {"column": "fill_date"}, dimension="timeliness"),
        ),
        sources=(Source("pharmacy_claims", "^rx_claims" + _PATTERN, (Layout(1, names),)),),
    )
    more = ("strength", "quantity", "adjudicated_date")
    return Feed(contract, typed_pharmacy, lambda clean, _: {"pharmacy_claims": clean.select(*contract.columns), "pharmacy_fills": curate.net_fills(clean, more)})


def feeds(ref: Reference | None = None, year: int = 0, closed_after: date = date.max) -> dict[str, Feed]:
    """All feeds, the roster first since the others look patients up in it."""
    from dataclasses import replace

    ref = ref or Reference()
    made = (_roster(ref), _screenings(ref), _labs(ref), _appointments(ref), _pharmacy(ref))
    return {f.contract.feed: replace(f, year=year, closed_after=closed_after) for f in made}
