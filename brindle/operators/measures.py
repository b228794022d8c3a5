"""Quality measures: patient facts, days covered, results by patient, summaries, equity, gaps."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import model
from ..functions.scalars import age_on, banded, count_if, ratio
from .curate import small


@dataclass(frozen=True)
class Period:
    """The measurement year, and the day that rolling windows end with."""

    start: date = model.YEAR_START
    end: date = model.YEAR_END
    as_of: date = model.AS_OF

    def holds(self, day: str) -> Column:
        return F.col(day).between(F.lit(self.start), F.lit(self.end))


def patient_facts(patients: DataFrame, appointments: DataFrame, conditions: DataFrame, period: Period = Period()) -> DataFrame:
    """A row for each patient: attribution, strata, age at year end, visits in the year, conditions."""
    seen = F.col("status") == "completed"
    visits = appointments.where(seen & period.holds("appt_date")).groupBy("patient_id").agg(F.count("*").alias("visits"))
    groups = {"diabetes_t2": "has_diabetes", "hypertension": "has_hypertension", "hyperlipidemia": "has_hyperlipidemia", "depression": "has_depression"}
    flags = conditions.groupBy("patient_id").agg(*(F.bool_or(F.col("condition_group") == g).alias(name) for g, name in groups.items()))
    age = age_on("birth_date", F.lit(period.end))
    out = patients.join(visits, "patient_id", "left").join(flags, "patient_id", "left")
    return out.select(
        "patient_id", "site_id", "care_manager_name", "sex", "race_ethnicity", "language_group", "payer_type", age.alias("age_my_end"),
        banded(age, [(18, "0-17"), (40, "18-39"), (65, "40-64")], "65+").alias("age_band"),
        F.coalesce("visits", F.lit(0).cast("long")).alias("completed_visits_my"), F.col("visits").isNotNull().alias("active_my"),
        *(F.coalesce(name, F.lit(False)).alias(name) for name in groups.values()),
    )


def days_covered(fills: DataFrame, period: Period = Period()) -> DataFrame:
    """Proportion of days covered by patient and drug class.

    Early refills of a drug start when its supply ends. With supply C before a fill on day f, the
    start is C + the running maximum of f - C: two windows over one partitioning. Supply is turned
    to covered days as intervals: overlapping ones of a class are merged by a running maximum of
    their ends, so no row per day is made.
    """
    start, end = F.lit(period.start), F.lit(period.end)
    fills = fills.where(period.holds("fill_date")).withColumn("day", F.datediff("fill_date", start))
    whole = Window.partitionBy("patient_id", "drug_class")
    spans = fills.withColumn("index_day", F.min("day").over(whole)).withColumn("last_day", F.max("day").over(whole))
    # Two fills on different days: the first and the last day differ.
    spans = spans.where("index_day < last_day")
    order = Window.partitionBy("patient_id", "drug_class", "drug_name").orderBy("day", "claim_id")
    before = F.coalesce(F.sum("days_supply").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.withColumn("before", before).withColumn("at", F.col("before") + F.max(F.col("day") - F.col("before")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    year = F.datediff(end, start) + 1
    spans = spans.withColumn("until", F.least(F.col("at") + F.col("days_supply"), year))
    by_start = Window.partitionBy("patient_id", "drug_class").orderBy("at", "until", "claim_id").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("until") - F.greatest(F.col("at"), F.coalesce(F.max("until").over(by_start), F.lit(0))))
    out = spans.withColumn("fresh", fresh).groupBy("patient_id", "drug_class", "index_day").agg(F.sum("fresh").cast("long").alias("days_covered"))
    out = out.withColumn("period_days", (year - F.col("index_day")).cast("long"))
    return out.select(
        "patient_id", "drug_class", F.date_add(start, F.col("index_day")).alias("index_date"), "days_covered", "period_days",
        ratio("days_covered", "period_days", 3).alias("pdc"), (5 * F.col("days_covered") >= 4 * F.col("period_days")).alias("adherent"),
    )


def patient_results(facts: DataFrame, appointments: DataFrame, screens: DataFrame, labs: DataFrame, covered: DataFrame, period: Period = Period()) -> DataFrame:
    """A row for each patient and measure that they count for: whether it is met, and why.

    The measures that need nothing but a patient's own figures are made side by side from one row
    per patient and exploded.
    """
    done = screens.where("complete")
    in_year = done.where(period.holds("screen_date"))
    screened = in_year.groupBy("patient_id").agg(
        count_if(F.col("instrument") == "PHQ9").alias("phq9"), count_if(F.col("instrument") == "SDOH5").alias("sdoh"),
        F.min(F.when((F.col("instrument") == "PHQ9") & (F.col("total_score") >= 10) & (F.col("screen_date") <= F.lit(date(period.end.year, 12, 1))), F.col("screen_date"))).alias("positive_on"),
    )
    a1c = labs.where((F.col("analyte") == "HBA1C") & period.holds("collected_date"))
    a1c = a1c.groupBy("patient_id").agg(F.max_by("value", F.struct("collected_date", "lab_result_id")).alias("a1c"))
    # Contacts within 30 days after the positive screen: equal patients first, then the days.
    contacts = appointments.where("status = 'completed'").select("patient_id", F.col("appt_date").alias("contact"))
    contacts = contacts.unionByName(done.where("instrument = 'PHQ9'").select("patient_id", F.col("screen_date").alias("contact")))
    positive = screened.where("positive_on is not null").select("patient_id", "positive_on")
    after = F.datediff("contact", "positive_on")
    followed = positive.join(contacts, "patient_id").where(after.between(1, 30)).groupBy("patient_id").agg(F.min("contact").alias("contact"))
    one = facts.join(screened, "patient_id", "left").join(a1c, "patient_id", "left").join(followed, "patient_id", "left")

    def entry(measure: str, counts: Column, met: Column, detail: Column) -> Column:
        return F.when(counts, F.struct(F.lit(measure).alias("measure_id"), met.alias("numerator"), detail.alias("detail")))

    n = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    diabetic = F.col("has_diabetes") & F.col("active_my") & F.col("age_my_end").between(18, 75)
    latest = F.coalesce(F.concat(F.lit("latest "), F.col("a1c").cast("string"), F.lit("%")), F.lit("no HbA1c in the year"))
    when = F.concat(F.lit("positive "), F.col("positive_on").cast("string"), F.coalesce(F.concat(F.lit("; follow-up "), F.col("contact").cast("string")), F.lit("; no follow-up within 30 days")))
    entries = F.array(
        entry("DEP_SCREEN", F.col("active_my") & (F.col("age_my_end") >= 12), n("phq9") > 0, F.concat(n("phq9").cast("string"), F.lit(" complete PHQ-9"))),
        entry("DEP_FOLLOWUP", F.col("positive_on").isNotNull(), F.col("contact").isNotNull(), when),
        entry("DM_A1C_TESTED", diabetic, F.col("a1c").isNotNull(), latest),
        entry("DM_A1C_CONTROLLED", diabetic, F.coalesce(F.col("a1c") < 8, F.lit(False)), latest),
        entry("DM_A1C_POOR", diabetic, F.coalesce(F.col("a1c") > 9, F.lit(True)), latest),
        entry("SDOH_SCREEN", F.col("active_my") & (F.col("age_my_end") >= 18), n("sdoh") > 0, F.concat(n("sdoh").cast("string"), F.lit(" complete social-needs screen"))),
    )
    held = one.select("patient_id", "site_id", F.explode_outer(F.filter(entries, lambda e: e.isNotNull())).alias("e")).where("e is not null").select("patient_id", "site_id", "e.*")
    name = F.when(F.col("drug_class") == "diabetes_oral", "PDC_DIABETES").when(F.col("drug_class") == "ras_antagonist", "PDC_RAS").otherwise("PDC_STATIN")
    of = F.concat(F.lit("PDC "), F.col("pdc").cast("decimal(4,3)").cast("string"), F.lit(" ("), F.col("days_covered").cast("string"), F.lit(" of "), F.col("period_days").cast("string"), F.lit(" days)"))
    drugs = covered.join(facts.select("patient_id", "site_id"), "patient_id").select("patient_id", "site_id", name.alias("measure_id"), F.col("adherent").alias("numerator"), of.alias("detail"))
    return held.unionByName(drugs)


def definitions(spark) -> DataFrame:
    return small(spark, model.MEASURES, "measure_id string, measure_name string, direction string")


def summary(results: DataFrame) -> DataFrame:
    """Rates by clinic and for the network."""
    held = results.join(definitions(results.sparkSession), "measure_id")
    out = held.groupingSets([["measure_id", "measure_name", "direction", "site_id"], ["measure_id", "measure_name", "direction"]], "measure_id", "measure_name", "direction", "site_id").agg(
        F.grouping("site_id").alias("every"), F.count("*").alias("denominator"), count_if(F.col("numerator")).alias("numerator")
    )
    site = F.when(F.col("every") == 1, model.ALL_SITES).otherwise(F.col("site_id"))
    return out.select("measure_id", "measure_name", "direction", site.alias("site_id"), "denominator", "numerator", ratio("numerator", "denominator", 4).alias("rate"))


STRATA = ("race_ethnicity", "language_group", "payer_type", "sex", "age_band")


def equity(results: DataFrame, facts: DataFrame, least: int = model.MIN_CELL) -> DataFrame:
    """Measures by stratum, with small cells hidden, and one more where one alone is hidden."""
    long = facts.unpivot(["patient_id"], list(STRATA), "stratifier", "group_value").where("group_value is not null")
    counts = results.select("measure_id", "patient_id", "numerator").join(long, "patient_id")
    counts = counts.groupBy("measure_id", "stratifier", "group_value").agg(F.count("*").alias("d"), count_if(F.col("numerator")).alias("n"))
    all_groups = Window.partitionBy("measure_id", "stratifier")
    small_cell = (F.col("d") < least) | F.col("n").between(1, least - 1) | (F.col("d") - F.col("n")).between(1, least - 1)
    held = counts.withColumns({"all_d": F.sum("d").over(all_groups), "all_n": F.sum("n").over(all_groups), "primary": small_cell})
    by_size = Window.partitionBy("measure_id", "stratifier", "primary").orderBy("d", "group_value")
    held = held.withColumns({"hidden": F.sum(F.col("primary").cast("int")).over(all_groups), "place": F.row_number().over(by_size)})
    hide = F.col("primary") | ((F.col("hidden") == 1) & (F.col("place") == 1))
    shown = lambda c: F.when(~F.col("suppressed"), c)
    rest_n, rest_d = F.col("all_n") - F.col("n"), F.col("all_d") - F.col("d")
    return held.withColumn("suppressed", hide).select(
        "measure_id", "stratifier", "group_value", shown(F.col("d")).alias("denominator"), shown(F.col("n")).alias("numerator"),
        shown(ratio("n", "d", 4)).alias("rate"), shown(F.when(rest_n > 0, ratio(F.col("n") * rest_d, F.col("d") * rest_n, 3))).alias("relative_rate"),
        shown(ratio("d", "all_d", 4)).alias("share_of_denominator"), shown(ratio("n", "all_n", 4)).alias("share_of_numerator"), "suppressed",
        F.when(F.col("primary"), "small cell").when(F.col("suppressed"), "complementary").alias("suppression_reason"),
    )


def appointment_windows(patients: DataFrame, appointments: DataFrame, period: Period = Period(), days: tuple[int, ...] = (30, 90, 180)) -> DataFrame:
    """Kept rates of each patient over rolling windows (as-of - N, as-of]."""
    as_of = F.lit(period.as_of)
    due = appointments.where(F.col("status").isin("completed", "no_show") & (F.col("appt_date") <= as_of))
    ago = F.datediff(as_of, "appt_date")
    kept = F.col("status") == "completed"
    longest = max(days)
    figures = [a for d in days for a in (count_if(kept & (ago < d)).alias(f"kept_{d}"), count_if(ago < d).alias(f"due_{d}"))]
    held = due.groupBy("patient_id").agg(*figures, count_if(~kept & (ago < longest)).alias("missed"), F.max(F.when(kept, F.col("appt_date"))).alias("last_completed_visit"))
    out = patients.select("patient_id", "site_id").join(held, "patient_id", "left")
    rates = [c for d in days for c in (F.col(f"kept_{d}"), F.col(f"due_{d}"), ratio(f"kept_{d}", f"due_{d}", 3).alias(f"kept_rate_{d}"))]
    often = (F.col("missed") >= 3) | ((F.col(f"due_{longest}") >= 3) & (10 * F.col(f"kept_{longest}") < 7 * F.col(f"due_{longest}")))
    return out.select("patient_id", "site_id", as_of.alias("as_of_date"), *rates, F.coalesce("missed", F.lit(0).cast("long")).alias(f"no_shows_{longest}"), "last_completed_visit", F.coalesce(often, F.lit(False)).alias("frequent_no_show"))


def period_comparison(appointments: DataFrame, period: Period = Period(), days: tuple[int, ...] = (7, 28, 90)) -> DataFrame:
    """Kept rates of a period and of the one before, for the network and each clinic.

    All periods' counts come from one aggregation with grouping sets; the rows of the periods are
    then set out of each group's row.
    """
    as_of = F.lit(period.as_of)
    year_start = F.trunc(as_of, "year")
    day, kept = F.col("appt_date"), F.col("status") == "completed"
    ago = F.datediff(as_of, day)
    spans = [(f"last {d} days", f"previous {d} days", ago.between(0, d - 1), ago.between(d, 2 * d - 1)) for d in days]
    spans.append(("year to date", "same days last year", day.between(year_start, as_of), day.between(F.add_months(year_start, -12), F.add_months(as_of, -12))))
    sums = [a for i, (_, _, now, then) in enumerate(spans) for a in (count_if(kept & now).alias(f"ka{i}"), count_if(now).alias(f"da{i}"), count_if(kept & then).alias(f"kb{i}"), count_if(then).alias(f"db{i}"))]
    due = appointments.where(F.col("status").isin("completed", "no_show"))
    held = due.groupingSets([["site_id"], []], "site_id").agg(F.grouping("site_id").alias("every"), *sums)
    rows = F.array(*(F.struct(F.lit(a).alias("period_after"), F.lit(b).alias("period_before"), *(F.col(f"{x}{i}").alias(x) for x in ("ka", "da", "kb", "db"))) for i, (a, b, _, _) in enumerate(spans)))
    out = held.select("every", "site_id", F.explode_outer(rows).alias("r")).select("every", "site_id", "r.*")
    both = F.col("da") * F.col("db")
    gap = F.col("ka") * F.col("db") - F.col("kb") * F.col("da")
    change = F.when(both > 0, F.signum(gap.cast("double")) * ratio(F.abs(gap), both, 4))
    return out.select(
        F.when(F.col("every") == 1, "network").otherwise("clinic").alias("scope"), F.when(F.col("every") == 1, model.ALL_SITES).otherwise(F.col("site_id")).alias("scope_id"),
        F.lit("kept_rate").alias("metric"), "period_after", "period_before", ratio("ka", "da", 4).alias("value_after"), ratio("kb", "db", 4).alias("value_before"),
        change.alias("change"), F.col("da").alias("appointments_after"), F.col("db").alias("appointments_before"),
    )


# The gap that a measure's result opens, and whether by meeting it.
GAPS = {
    "DEP_FOLLOWUP": ("depression_follow_up_missed", False),
    "DEP_SCREEN": ("depression_screen_due", False),
    "DM_A1C_POOR": ("hba1c_poor_control", True),
    "DM_A1C_TESTED": ("hba1c_not_tested", False),
    "PDC_DIABETES": ("adherence_diabetes_below_80", False),
    "PDC_RAS": ("adherence_ras_below_80", False),
    "PDC_STATIN": ("adherence_statin_below_80", False),
    "SDOH_SCREEN": ("social_needs_screen_due", False),
}


def care_gaps(patients: DataFrame, results: DataFrame, windows: DataFrame, screens: DataFrame) -> DataFrame:
    """Open gaps by patient: measures unmet, frequent no-shows, and item 9 to be reviewed."""
    spark = patients.sparkSession
    open_by = small(spark, [(m, g, met) for m, (g, met) in GAPS.items()], "measure_id string, gap string, numerator boolean")
    parts = [
        results.join(open_by, ["measure_id", "numerator"]).select("patient_id", "gap", "detail"),
        windows.where("frequent_no_show").select("patient_id", F.lit("frequent_no_show").alias("gap"), F.concat(F.col("no_shows_180").cast("string"), F.lit(" no-shows in 180 days")).alias("detail")),
        screens.where("safety_flag").groupBy("patient_id").agg(F.max("screen_date").alias("d")).select("patient_id", F.lit("phq9_item9_review").alias("gap"), F.concat(F.lit("self-harm item answered above 0 on "), F.col("d").cast("string")).alias("detail")),
    ]
    return reduce(DataFrame.unionByName, parts).join(patients.select("patient_id", "site_id", "care_manager_name"), "patient_id").select("patient_id", "site_id", "care_manager_name", "gap", "detail")


# --- assertions: each returns the rows that break it


def clinics_not_adding_up(summed: DataFrame) -> DataFrame:
    every = F.col("site_id") == model.ALL_SITES
    both = summed.groupBy("measure_id").agg(*(F.sum(F.when(c, F.col(v))).alias(f"{n}_{v}") for c, n in ((every, "network"), (~every, "clinic")) for v in ("denominator", "numerator")))
    return both.where("clinic_denominator <> network_denominator or clinic_numerator <> network_numerator")


def controlled_and_poor(results: DataFrame) -> DataFrame:
    met = results.where(F.col("numerator") & F.col("measure_id").isin("DM_A1C_CONTROLLED", "DM_A1C_POOR"))
    return met.groupBy("patient_id").agg(F.count("*").alias("n")).where("n > 1").select("patient_id")


def single_hidden_cells(by_stratum: DataFrame) -> DataFrame:
    return by_stratum.groupBy("measure_id", "stratifier").agg(count_if(F.col("suppressed")).alias("n")).where("n = 1")


def small_cells_shown(by_stratum: DataFrame, least: int = model.MIN_CELL) -> DataFrame:
    n, d = F.col("numerator"), F.col("denominator")
    shown = ~F.col("suppressed") & ((d < least) | n.between(1, least - 1) | (d - n).between(1, least - 1))
    leak = F.col("suppressed") & F.coalesce("denominator", "numerator", "rate", "relative_rate", "share_of_denominator", "share_of_numerator").isNotNull()
    return by_stratum.where(shown | leak)
