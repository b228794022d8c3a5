"""Nested documents from the marts, and transforms along paths into them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ..functions.scalars import slug


def _listed(df: DataFrame, key: str, name: str, *fields: str) -> DataFrame:
    """Rows of a key as a sorted array of structs. A patient or clinic has a bounded number."""
    return df.groupBy(F.col(key).alias("_k")).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))


def patient_documents(patients: DataFrame, appointments: DataFrame, events: DataFrame, labs: DataFrame, gaps: DataFrame, results: DataFrame, contacts: DataFrame | None = None) -> DataFrame:
    """A document for each patient: attribution, contact if given, visits, latest scores and labs, measures, gaps."""
    visits = _listed(appointments.where("status = 'completed'"), "patient_id", "visits", "appt_date", "appointment_id", "visit_type")
    latest = lambda df, by, value: df.where("is_most_recent").groupBy(F.col("patient_id").alias("_k")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(by), F.struct(*value))))).alias(by))
    scores = latest(events, "instrument", ("screen_date", "total_score", "severity_band", "positive"))
    values = latest(labs, "analyte", ("collected_date", "value"))
    met = _listed(results, "patient_id", "measures", "measure_id", "numerator", "detail")
    due = _listed(gaps, "patient_id", "gaps", "gap", "detail")
    out = patients
    for part in (visits, scores.withColumnRenamed("instrument", "screenings"), values.withColumnRenamed("analyte", "labs"), met, due):
        out = out.join(part, F.col("patient_id") == F.col("_k"), "left").drop("_k")
    reached = []
    if contacts is not None:
        out = out.join(contacts.select(F.col("patient_id").alias("_k"), F.struct("first_name", "last_name", "phone", "email", "street", "zip").alias("contact")), F.col("patient_id") == F.col("_k"), "left").drop("_k")
        reached = ["contact"]
    return out.select(
        F.col("patient_id").alias("_id"), *reached, F.struct("site_id", "care_manager_name").alias("attribution"), F.struct("sex", "race_ethnicity", "language_group", "payer_type", "birth_date").alias("demographics"),
        F.coalesce("visits", F.array().cast("array<struct<appt_date:date,appointment_id:bigint,visit_type:string>>")).alias("visits"), "screenings", "labs", "measures", F.coalesce("gaps", F.array().cast("array<struct<gap:string,detail:string>>")).alias("gaps"),
    )


def clinic_documents(sites: DataFrame, facts: DataFrame, summary: DataFrame, gaps: DataFrame) -> DataFrame:
    """A document for each clinic: its size, rates by measure, and open gaps by kind."""
    size = facts.groupBy(F.col("site_id").alias("_k")).agg(F.count("*").alias("patients"), F.count_if("active_my").alias("active"))
    rates = _listed(summary, "site_id", "rates", "measure_id", "denominator", "numerator", "rate")
    kinds = gaps.groupBy("site_id", "gap").agg(F.count("*").alias("n"))
    open_gaps = kinds.groupBy(F.col("site_id").alias("_k")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("gap", "n")))).alias("openGaps"))
    out = sites.withColumn("slug", slug("site_name"))
    for part in (size, rates, open_gaps):
        out = out.join(part, F.col("site_id") == F.col("_k"), "left").drop("_k")
    return out.select(F.col("site_id").alias("_id"), "site_name", "region", "slug", F.coalesce("patients", F.lit(0).cast("long")).alias("patients"), F.coalesce("active", F.lit(0).cast("long")).alias("active"), "rates", "openGaps")


def worklists(gaps: DataFrame) -> DataFrame:
    """A document for each care manager: patients with open gaps, most gaps first, over all clinics."""
    one = gaps.groupBy("care_manager_name", "patient_id", "site_id").agg(F.array_sort(F.collect_list(F.struct("gap", "detail"))).alias("gaps"))
    entry = F.struct((-F.size("gaps")).alias("order"), "patient_id", "site_id", "gaps")
    return one.groupBy(F.col("care_manager_name").alias("_id")).agg(F.array_sort(F.collect_list(entry)).alias("patients"), F.count("*").alias("n_patients"), F.sum(F.size("gaps")).alias("n_gaps"))


def bodies(documents: DataFrame) -> DataFrame:
    """(id, body): documents as canonical JSON, for files and for comparing builds."""
    return documents.select(F.col("_id").alias("id"), F.to_json(F.struct(*documents.columns)).alias("body"))


def along(path: str, kind: DataType, fn: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """A column function that applies ``fn`` at a path such as ``a.*.h[].d`` of a nested type.

    ``.name`` steps into a struct, ``.*`` into every value of a map, ``[]`` into every element.
    """
    if not path:
        return fn
    if path.startswith("[]"):
        if not isinstance(kind, ArrayType):
            raise ValueError(f"{path}: no array")
        step = along(path[2:], kind.elementType, fn)
        return lambda c: F.transform(c, step)
    head, _, _ = path.removeprefix(".").partition(".")
    name, brackets, _ = head.partition("[")
    rest = path.removeprefix(".")[len(name) :]
    if name == "*":
        if not isinstance(kind, MapType):
            raise ValueError(f"{path}: no map")
        step = along(rest, kind.valueType, fn)
        return lambda c: F.transform_values(c, lambda _, v: step(v))
    if not isinstance(kind, StructType) or name not in kind.names:
        raise ValueError(f"{path}: no field {name}")
    step = along(rest, kind[name].dataType, fn)
    return lambda c: F.when(c.isNotNull(), c.withField(name, step(c[name])))


def at_path(documents: DataFrame, path: str, fn: Callable[[Column], Column]) -> DataFrame:
    """The documents with ``fn`` applied at one path."""
    name = path.split(".")[0].split("[")[0]
    return documents.withColumn(name, along(path[len(name) :], documents.schema[name].dataType, fn)(F.col(name)))
