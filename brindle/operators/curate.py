"""From typed rows to curated tables: conditions, labs, screening events and items, net fills."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import model
from ..functions.scalars import decimal_number, full_match, text, whole_number


def small(spark, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A reference table of a fixed number of rows, to be broadcast."""
    return F.broadcast(spark.createDataFrame(list(rows), schema))


def patient_conditions(patients: DataFrame) -> DataFrame:
    """A row for each problem-list code whose prefix stands for a condition group."""
    prefixes = small(patients.sparkSession, model.CONDITIONS, "prefix string, condition_group string")
    codes = patients.where("problem_list <> ''").select("patient_id", F.explode(F.split("problem_list", ";")).alias("icd10_code"))
    return codes.join(prefixes, F.col("icd10_code").startswith(F.col("prefix"))).select("patient_id", "icd10_code", "condition_group").distinct()


def typed_labs(labs: DataFrame) -> DataFrame:
    """Result text as censor mark and number, in the standard unit; unknown units have no value.

    IFCC mmol/mol becomes NGSP per cent in exact decimal arithmetic, rounded half up to a tenth.
    """
    said = text("result")
    number = F.regexp_replace(said, "^[<>] ?", "")
    out = labs.withColumn("censor", F.when(said.rlike(r"^[<>] ?[0-9]+([.][0-9]+)?\z"), F.left(said, F.lit(1))))
    out = out.withColumn("result_value", decimal_number(number))
    plain = (F.col("units") == "%") | ((F.col("analyte") == "LDL") & (F.col("units") == "mg/dL"))
    conversion = F.when(plain, "none").when(F.col("units") == "mmol/mol", "ifcc_to_ngsp")
    return out.withColumn("unit_known", plain | (F.col("units") == "mmol/mol")).withColumn("value_std", standard(F.col("result_value"), conversion))


def standard(value: Column, conversion: Column) -> Column:
    """A number in the standard unit, by how it is converted; null where no conversion is known."""
    percent = F.round(value * F.lit("0.09148").cast("decimal(6,5)") + F.lit("2.152").cast("decimal(4,3)"), 1)
    return F.when(conversion == "none", F.round(value, 1).cast("decimal(10,1)")).when(conversion == "ifcc_to_ngsp", percent.cast("decimal(10,1)"))


def lab_results(labs: DataFrame) -> DataFrame:
    """Labs with a standard value, the latest of each patient and analyte marked."""
    good = labs.where("value_std is not null")
    last = Window.partitionBy("patient_id", "analyte").orderBy(F.desc("collected_date"), F.desc("lab_result_id"))
    return good.select("lab_result_id", "patient_id", "collected_date", "analyte", F.col("value_std").alias("value"), "censor", (F.row_number().over(last) == 1).alias("is_most_recent"))


def typed_screens(
    screens: DataFrame, low: int = 0, high: int = 3, keep: Sequence[str] = ("screening_id", "patient_id", "screen_date"), reported: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Answers as numbers in range, or as Y, N or D; how many are neither blank nor valid.

    ``reported`` names columns with a platform's own totals and the items that they are of; where all
    items are answered and their sum is another, ``total_mismatch`` says so.
    """
    scored, domains = [*model.PHQ9, *model.GAD7], model.SDOH5
    number = {c: whole_number(text(c)) for c in scored}

    def wrong(columns: list[str], valid) -> Column:
        """Name and text of the answers that are given and not valid."""
        said = F.array(*(F.struct(F.lit(c).alias("item"), text(c).alias("said")) for c in columns))
        return F.filter(said, lambda x: x["said"].isNotNull() & ~F.coalesce(valid(x["said"]), F.lit(False)))

    bad = wrong(scored, lambda said: full_match(said, "-?[0-9]+") & said.try_cast("int").between(low, high))
    worse = wrong(domains, lambda said: F.upper(said).isin("Y", "N", "D"))
    told = lambda found: F.array_join(F.transform(found, lambda x: F.concat(x["item"], F.lit("="), x["said"])), "; ")
    more = []
    if reported:
        sums = {name: reduce(add, [F.when(number[c].between(low, high), number[c]) for c in items]) for name, items in reported.items()}
        apart = [F.when(F.col(name) != total, F.concat(F.lit(f"{name} "), F.col(name).cast("string"), F.lit(", items "), total.cast("string"))) for name, total in sums.items()]
        more = [told(worse).alias("bad_domains_detail"), F.concat_ws("; ", *apart).alias("total_mismatch")]
    return screens.select(
        *keep, *(F.when(number[c].between(low, high), number[c]).alias(c) for c in scored),
        *(F.upper(text(c)).alias(c) for c in domains), F.size(bad).alias("bad_items"),
        told(bad).alias("bad_items_detail"), F.size(worse).alias("bad_domains"), *more,
    )


def clean_screens(typed: DataFrame) -> DataFrame:
    """Typed screens without any invalid answer."""
    return typed.where("bad_items = 0 and bad_domains = 0")


def screening_events(screens: DataFrame) -> DataFrame:
    """A row for each instrument that a screen has answers of: its score, band and flags.

    A total needs every answer. One pass: each instrument's answers become an array, the arrays'
    events are made side by side and exploded, instead of one scan each. The explode is an outer
    one because Spark infers no filter from it, whose copies would be as many as answers' subsets.
    """
    spark = screens.sparkSession
    yes = lambda c: (F.col(c) == "Y").cast("int")
    made = lambda name, values, at, safety: F.struct(
        F.lit(name).alias("instrument"), F.array(*values).alias("a"), F.lit(at).cast("int").alias("at"), F.lit(safety).cast("int").alias("safety")
    )
    given = F.array(
        made("PHQ9", map(F.col, model.PHQ9), 10, 8), made("GAD7", map(F.col, model.GAD7), 10, None), made("SDOH5", map(yes, model.SDOH5), None, None)
    )

    def scored(x: Column) -> Column:
        have = F.size(F.filter(x["a"], lambda v: v.isNotNull()))
        total = F.aggregate(x["a"], F.lit(0), lambda s, v: s + F.coalesce(v, F.lit(0)))
        return F.struct(x["instrument"].alias("instrument"), have.alias("have"), F.size(x["a"]).alias("n"), total.alias("total"), x["at"].alias("at"), F.coalesce(F.get(x["a"], x["safety"]), F.lit(0)).alias("safety"))

    out = screens.select("screening_id", "patient_id", "screen_date", F.explode_outer(F.transform(given, scored)).alias("e"))
    out = out.select("screening_id", "patient_id", "screen_date", "e.*").where("have > 0")
    complete = F.col("have") == F.col("n")
    out = out.select(
        "screening_id", "patient_id", "screen_date", "instrument", F.col("have").alias("items_answered"), F.col("n").alias("items_expected"), complete.alias("complete"),
        F.when(complete, F.col("total")).alias("total_score"), F.when(F.col("at").isNull(), F.col("total") > 0).when(complete, F.col("total") >= F.col("at")).alias("positive"),
        (complete & (F.col("safety") > 0)).alias("safety_flag"),
    )
    bands = small(spark, model.BANDS, "band_of string, least int, most int, severity_band string")
    out = out.join(bands, (F.col("instrument") == F.col("band_of")) & F.col("total_score").between(F.col("least"), F.col("most")), "left").drop("band_of", "least", "most")
    last = Window.partitionBy("patient_id", "instrument", "complete").orderBy(F.desc("screen_date"), F.desc("screening_id"))
    return out.withColumn("is_most_recent", F.col("complete") & (F.row_number().over(last) == 1))


def screening_items(screens: DataFrame) -> DataFrame:
    """A row for each answered item."""
    items = [*model.PHQ9, *model.GAD7, *model.SDOH5]
    texts = screens.select("screening_id", "patient_id", "screen_date", *(F.col(c).cast("string").alias(c) for c in items))
    long = texts.unpivot(["screening_id", "patient_id", "screen_date"], items, "item_code", "response").where("response is not null")
    name = F.when(F.col("item_code").startswith("phq9"), "PHQ9").when(F.col("item_code").startswith("gad7"), "GAD7").otherwise("SDOH5")
    return long.withColumn("instrument", name)


def net_fills(claims: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Paid claims that no reversal takes back."""
    back = claims.where("claim_status = 'R'").select("claim_id")
    paid = claims.where("claim_status = 'P'")
    return paid.join(back, "claim_id", "left_anti").select("claim_id", "patient_id", "fill_date", "drug_name", "drug_class", "days_supply", *more)


def appointments(typed: DataFrame) -> DataFrame:
    return typed.withColumn("visit_type", F.coalesce("visit_type", F.lit("other"))).withColumn("is_visit", F.col("status") == "completed")
