"""Documents, de-identification, leak search, monitoring, sources and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import model
from ..functions import scalars as S
from ..model import Tables, landed, shared
from ..operators import deid, documents, leakgate, measures, merge, monitoring
from ..plans import rules
from ..plans.contracts import layout_scores
from ..sources import files
from ..streaming import flows
from . import feeds, query
from . import measures as marts
from .oracle import PIECES

MEASURE_IDS = [m for m, _, _ in model.MEASURES]
YEAR_END = "date '1998-12-31'"


def _texts(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))


@shared
def _results(t: Tables) -> DataFrame:
    return landed(marts.results(t), "results")  # read by gaps, documents and the extract


@shared
def gaps(t: Tables) -> DataFrame:
    return landed(measures.care_gaps(t.patients, _results(t), marts.windows(t), marts.events(t)), "gaps")


PIECES |= {
    "gap_names": "select * from (values " + ", ".join(f"('{m}', '{g}', {str(met).lower()})" for m, (g, met) in measures.GAPS.items()) + ") t(measure_id, gap, met)",
    "gaps": """
        select p.patient_id, p.site_id, p.care_manager_name, gap from patients p join (
            select patient_id, gap from results r join gap_names g on g.measure_id = r.measure_id and g.met = r.numerator
            union all select patient_id, 'frequent_no_show' from windows where frequent_no_show
            union all select distinct patient_id, 'phq9_item9_review' from screen_events where safety_flag) g on g.patient_id = p.patient_id""",
    "texts": "select doc_id as id, coalesce(text, '') as text from documents",
    "wide": "select patient_id, " + ", ".join(f"bool_or(measure_id = '{m}') as {m.lower()}_eligible, bool_or(measure_id = '{m}' and numerator) as {m.lower()}_met" for m in MEASURE_IDS) + " from results group by patient_id",
    "extract": f"""
        select sha256('extract/' || f.patient_id) as record_id, case when age_my_end < 90 then cast(year(p.birth_date) as integer) end as birth_year, case when age_my_end < 90 then cast(age_my_end as varchar) else '90+' end as age,
            case when substr(f.patient_id, 3, 3) in ('000', '001') then '000' else substr(f.patient_id, 3, 3) end as area3, f.sex, age_band, f.payer_type,
            {', '.join(f'coalesce({m.lower()}_{k}, false) as {m.lower()}_{k}' for m in MEASURE_IDS for k in ('eligible', 'met'))}
        from facts f join patients p on p.patient_id = f.patient_id left join wide w on w.patient_id = f.patient_id""",
    "event_days": "select user_id, event_type, value, cast(ts as date) as day from events",
}

# --- documents


@shared
def _patient_documents(t: Tables) -> DataFrame:
    return documents.patient_documents(t.patients, t.appointments, marts.events(t), marts.labs(t), gaps(t), _results(t))


query("patient_documents_flat", """
    select p.patient_id as _id, p.site_id, coalesce(v.n, 0) as visits, v.last as last_visit, coalesce(g.names, '') as gaps, coalesce(m.n, 0) as measures, s.total_score as phq9, l.value as a1c
    from patients p left join (select patient_id, count(*) as n, max(appt_date) as last from appointments where status = 'completed' group by patient_id) v on v.patient_id = p.patient_id
    left join (select patient_id, string_agg(gap, ',' order by gap) as names from gaps group by patient_id) g on g.patient_id = p.patient_id left join (select patient_id, count(*) as n from results group by patient_id) m on m.patient_id = p.patient_id
    left join (select * from screen_events where is_most_recent and instrument = 'PHQ9') s on s.patient_id = p.patient_id left join (select * from labs where is_most_recent and analyte = 'HBA1C') l on l.patient_id = p.patient_id""")(
    lambda t: _patient_documents(t).select(
        "_id", "attribution.site_id", F.size("visits").cast("long").alias("visits"), F.try_element_at("visits", F.lit(-1))["appt_date"].alias("last_visit"), F.array_join(F.transform("gaps", lambda g: g["gap"]), ",").alias("gaps"),
        F.coalesce(F.when(F.col("measures").isNotNull(), F.size("measures")), F.lit(0)).cast("long").alias("measures"), F.try_element_at("screenings", F.lit("PHQ9"))["total_score"].alias("phq9"), F.try_element_at("labs", F.lit("HBA1C"))["value"].alias("a1c"),
    )
)
query("clinic_documents_flat", """
    select s.site_id as _id, site_name, region, trim(regexp_replace(lower(site_name), '[^a-z0-9]+', '-', 'g'), '-') as slug, coalesce(f.n, 0) as patients, coalesce(f.a, 0) as active, coalesce(r.n, 0) as rates, coalesce(g.names, '') as open_gaps
    from sites s left join (select site_id, count(*) as n, count(*) filter (active_my) as a from facts group by site_id) f on f.site_id = s.site_id left join (select site_id, count(*) as n from summary group by site_id) r on r.site_id = s.site_id
    left join (select site_id, string_agg(gap || '=' || n, ',' order by gap) as names from (select site_id, gap, count(*) as n from gaps group by all) x group by site_id) g on g.site_id = s.site_id""")(
    lambda t: documents.clinic_documents(t.sites, marts.facts(t), measures.summary(_results(t)), gaps(t)).select(
        "_id", "site_name", "region", "slug", "patients", "active", F.coalesce(F.when(F.col("rates").isNotNull(), F.size("rates")), F.lit(0)).cast("long").alias("rates"),
        F.coalesce(F.array_join(F.transform(F.map_entries("openGaps"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ","), F.lit("")).alias("open_gaps"),
    )
)
query("worklists_flat", "select care_manager_name as _id, count(distinct patient_id) as n_patients, count(*) as n_gaps, count(distinct site_id) as sites from gaps group by care_manager_name")(
    lambda t: documents.worklists(gaps(t)).select("_id", "n_patients", F.col("n_gaps").cast("long").alias("n_gaps"), F.size(F.array_distinct(F.transform("patients", lambda p: p["site_id"]))).cast("long").alias("sites"))
)
_SYNC = feeds._CLASSES.replace("'missing'", "'deleted'")
query("document_sync_counts", f"select change, count(*) as n from ({_SYNC}) x group by change")(lambda t: _synchronised(t))


def _synchronised(t: Tables) -> DataFrame:
    body = lambda no: t.snapshots.where(F.col("extract_no") == no).select(F.col("patient_id").alias("id"), F.to_json(F.struct("site_id", "care_manager_name")).alias("body"))
    return merge.synchronised(body(1), body(2)).groupBy("change").agg(F.count("*").alias("n"))


# --- de-identification and leaks

query("date_shift_intervals", "select patient_id, shift, min(appt_date) + shift as first_shifted, max(appt_date) + shift as last_shifted, date_diff('day', min(appt_date), max(appt_date)) as days_between from (select *, -(cast('0x' || substr(md5(patient_id), 1, 6) as integer) % 180) - 1 as shift from appointments) x group by patient_id, shift")(
    lambda t: _shifted(t)
)


def _shifted(t: Tables) -> DataFrame:
    moved = t.appointments.withColumn("shift", deid.shift_days("patient_id")).withColumn("day", F.date_add("appt_date", F.col("shift")))
    out = moved.groupBy("patient_id", "shift").agg(F.min("day").alias("first_shifted"), F.max("day").alias("last_shifted"))
    return out.withColumn("days_between", F.datediff("last_shifted", "first_shifted").cast("long"))


@shared
def _extract(t: Tables) -> DataFrame:
    return deid.safe_harbor(marts.facts(t), t.patients, _results(t), MEASURE_IDS, F.lit(model.YEAR_END), ["000", "001"])


query("safe_harbor_extract", "select * from extract")(_extract)
for _name, _columns in {"group_sizes_birth_year": ["birth_year", "sex", "area3"], "group_sizes_age_band": ["age_band", "sex", "area3"]}.items():
    _by = ", ".join(_columns)
    query(_name, f"select '{','.join(_columns)}' as columns, count(*) as n_groups, min(n) as smallest, cast(sum(case when n < {model.MIN_CELL} then n else 0 end) as bigint) as records_below, cast(sum(n) as bigint) as records from (select {_by}, count(*) as n from extract group by {_by}) x")(
        lambda t, c=_columns: deid.group_sizes(_extract(t), c, model.MIN_CELL)
    )
query("leak_email", "select distinct id, lower(unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]+'))) as token from texts")(lambda t: deid.email_tokens(_texts(t)))
query("leak_digits", "select distinct id, token, token in (select patient_id from patients) as real from (select id, unnest(regexp_extract_all(text, '[0-9]+')) as token from texts) x where length(token) >= 7")(
    lambda t: _digits(t)
)


def _digits(t: Tables) -> DataFrame:
    found = deid.digit_tokens(_texts(t), 7)
    real = deid.leaks(found, t.patients.select(F.col("patient_id").alias("value"))).select("id", "token", F.lit(True).alias("real"))
    return found.join(real, ["id", "token"], "left").withColumn("real", F.coalesce("real", F.lit(False)))


def _runs_sql(n: int) -> str:
    words = r"regexp_extract_all(lower(text), '[\p{L}0-9]+')"
    runs = lambda table, key: f"select distinct {key}, array_to_string(w[i : i + {n - 1}], ' ') as run from (select {key}, w, unnest(range(1, len(w) - {n - 2})) as i from (select {key}, {words} as w from {table}) y where len(w) >= {n}) z"
    return f"select id, count(*) as runs from ({runs('texts', 'id')}) a where run in (select run from ({runs('benchmark', 'item_id')}) b) group by id"


for _name, _n in {"leak_name_bigrams": 2, "leak_word_runs": 8}.items():
    query(_name, _runs_sql(_n))(
        lambda t, n=_n: deid.shared_runs(_texts(t), t.benchmark.select(F.col("item_id").alias("id"), "text"), n).groupBy("id").agg(F.count("*").alias("runs"))
    )
query("dangling_references", "select load_id, count(*) as rows, count(distinct patient_id) as patients from staged s where patient_id is not null and patient_id not in (select patient_id from patients) group by load_id")(
    lambda t: deid.dangling(feeds.evaluated(t).where("patient_id is not null"), t.patients, "patient_id").groupBy("load_id").agg(F.count("*").alias("rows"), F.count_distinct("patient_id").alias("patients"))
)
query("mask_identifiers", """
    select id, md5(array_to_string(list_transform(list_zip(pieces, runs), lambda x: coalesce(x[1], '') || case when length(x[2]) >= 7 and not ends_with(coalesce(x[1], ''), '_') then repeat('#', length(x[2])) else coalesce(x[2], '') end), '')) as masked_md5
    from (select id, string_split_regex(text, '[0-9]+') as pieces, regexp_extract_all(text, '[0-9]+') as runs from texts) y""")(
    lambda t: _texts(t).select("id", F.md5(S.masked("text")).alias("masked_md5"))
)
query("crosswalk_surrogates")(
    lambda t: deid.surrogates(t.spark.createDataFrame([], "kind string, value string, surrogate string"), t.sites.select(F.col("site_id").alias("value")), "site", 7, lambda rng: f"site-{rng.randrange(10**6):06d}")
)

# --- monitoring

query("freshness_report", """
    select feed, e as last_extract, v as newest_event, cast(e + 1 as date) as expected, case when date '2024-01-31' < e + 1 then 'ON_TIME' when date '2024-01-31' <= e + 2 then 'DUE' else 'LATE' end as timing, case when u > 0 then 'STUCK' else 'OK' end as work,
        date_diff('day', v, date '2024-01-31') as days_behind, date '2024-01-31' > e + 2 or u > 0 as stale
    from (select feed, max(extract_date) as e, cast(least(max(max_event_date), max(extract_date) - 1) as date) as v, count(*) filter (rows_passed <> rows_raw) as u from deliveries group by feed) x""")(
    lambda t: monitoring.freshness(t.deliveries.withColumn("done", F.col("rows_passed") == F.col("rows_raw")), F.lit("2024-01-31").cast("date"), 1, 1)
)


def _issues(t: Tables, day: str) -> DataFrame:
    return t.deliveries.where(F.col("extract_date") == F.lit(day).cast("date")).where("rows_passed < rows_raw").select(F.col("feed").alias("issue"), (F.col("rows_raw") - F.col("rows_passed")).alias("size"))


query("issue_register", """
    select coalesce(c.issue, k.issue) as issue, case when c.issue is not null and k.issue is null then date '2024-01-11' else k.opened end as opened, case when c.issue is not null and k.issue is not null then greatest(k.size, c.size) else coalesce(c.size, k.size) end as peak,
        case when c.issue is null then 'resolved' else 'open' end as status, case when c.issue is null then date '2024-01-11' end as resolved
    from (select feed as issue, rows_raw - rows_passed as size, date '2024-01-10' as opened from deliveries where extract_date = date '2024-01-10' and rows_passed < rows_raw) k
    full join (select feed as issue, rows_raw - rows_passed as size from deliveries where extract_date = date '2024-01-11' and rows_passed < rows_raw) c on c.issue = k.issue""")(
    lambda t: merge.register(
        _issues(t, "2024-01-10").select("issue", F.lit("2024-01-10").cast("date").alias("opened"), F.col("size").alias("peak"), F.lit("open").alias("status"), F.lit(None).cast("date").alias("resolved")), _issues(t, "2024-01-11"), F.lit("2024-01-11").cast("date")
    )
)
query("measure_restatement", """
    select site_id as measure, 3 as run, c as value, b as before, coalesce(c <> b, false) as restated
    from (select site_id, count(*) filter (appt_date <= date '1998-11-30') as b, count(*) filter (appt_date <= date '1998-12-31') as c from appointments where status = 'completed' group by site_id) x""")(
    lambda t: _restated(t)
)


def _restated(t: Tables) -> DataFrame:
    done = t.appointments.where("status = 'completed'")
    counts = done.groupBy("site_id").agg(*(F.count_if(F.col("appt_date") <= F.lit(d).cast("date")).alias(f"r{i}") for i, d in enumerate(("1998-10-31", "1998-11-30", "1998-12-31"), 1)))
    runs = counts.unpivot(["site_id"], ["r1", "r2", "r3"], "run", "value").select(F.col("site_id").alias("measure"), F.substring("run", 2, 1).cast("int").alias("run"), "value")
    return monitoring.restated(runs, "measure", "run", "value")


query("distinct_errors", "select 'load ######## [] failed at ' || event_type as error, count(*) as n, min('load ' || (event_id + 10000000) || ' [' || props || ']  failed at ' || event_type) as example from events group by event_type")(
    lambda t: monitoring.distinct_errors(t.events.select(F.concat(F.lit("load "), (F.col("event_id") + 10_000_000).cast("string"), F.lit(" ["), F.col("props"), F.lit("]  failed at "), F.col("event_type")).alias("message")), "message")
)

# --- sources

def _headers(t: Tables) -> DataFrame:
    """A header for each supplier: columns are left out, renamed, added and repeated by its key."""
    k = F.col("s_suppkey")
    said = [F.lit("claim_id"), F.when(k % 5 != 0, "member_mrn"), F.when(k % 3 == 0, "filled_on").otherwise("fill_date"), F.when(k % 2 == 0, "drug_name"), F.when(k % 7 == 0, "claim_id")]
    return t.supplier.select(k.alias("file"), F.lit("claims").alias("source"), F.filter(F.array(*said), lambda x: x.isNotNull()).alias("header"))


query("layout_match_scores", """
    with h as (select s_suppkey as file, list_filter(['claim_id', case when s_suppkey % 5 <> 0 then 'member_mrn' end, case when s_suppkey % 3 = 0 then 'filled_on' else 'fill_date' end,
        case when s_suppkey % 2 = 0 then 'drug_name' end, case when s_suppkey % 7 = 0 then 'claim_id' end], lambda x: x is not null) as h from supplier),
    l as (select * from (values (1, ['claim_id', 'fill_date', 'member_mrn']), (2, ['claim_id', 'drug_name', 'fill_date', 'member_mrn'])) t(version, names)),
    s as (select file, h, version, names, cast(len(list_intersect(h, names)) as double) / len(list_distinct(list_concat(h, names))) as score from h join l on true)
    select file, case when list_sort(h) = names then version end as version, version as closest, round(score, 6) as score, array_to_string(list_sort(list_filter(names, lambda x: not list_contains(h, x))), ',') as missing,
        array_to_string(list_sort(list_distinct(list_filter(h, lambda x: not list_contains(names, x)))), ',') as unexpected
    from s qualify row_number() over (partition by file order by score desc, version desc) = 1""")(
    lambda t: layout_scores(_headers(t), feeds.CLAIMS.sources).drop("source").withColumn("score", F.round("score", 6))
)
query("canonical_union_layouts", "select claim_id, member_mrn as patient_id, fill_date, case when source = 'B' then drug_name end as drug_name, case when source = 'B' then 2 else 1 end as layout from claims_text")(
    lambda t: _union(t)
)


def _union(t: Tables) -> DataFrame:
    raw, out = t.claims_text, None
    for layout, source in zip(feeds.CLAIMS.sources[0].layouts, "AB", strict=True):
        canon = {v: k for k, v in layout.columns.items()}
        part = raw.where(F.col("source") == source).select(*(F.col(canon[c]).alias(c) if c in canon else F.lit(None).cast("string").alias(c) for c in ("claim_id", "patient_id", "fill_date", "drug_name")), F.lit(layout.version).alias("layout"))
        out = part if out is None else out.unionByName(part)
    return out


query("scan_feed_inventory")(lambda t: files.discovered(t.spark, t.sf_dir, "*.parquet").select("name", "length", "sha256"))

# --- streams: events in files by user, so that later files bring rows of earlier days


def _delivered(t: Tables, parts: int = 3) -> DataFrame:
    folder = flows.delivered(t.events, f"{flows.work_folder(t.spark)}/in", F.pmod("event_id", F.lit(parts)), parts)
    return flows.arriving(t.spark, folder, "*.parquet", t.events, files_at_once=1)


query("stream_tumbling_counts", "select date_trunc('day', ts) as window_start, event_type, count(*) as n from events group by all")(
    lambda t: flows.run_to_table(flows.tumbling_counts(_delivered(t), "ts", "1 day", "event_type", late="60 days"), flows.work_folder(t.spark))
)
query("stream_sliding_counts", """
    select date_trunc('day', ts) - to_days(cast(k as integer)) as window_start, event_type, count(*) as n from events, unnest([0, 1, 2]) as u(k) group by all""")(
    lambda t: flows.run_to_table(flows.tumbling_counts(_delivered(t), "ts", "3 days", "event_type", late="60 days", slide="1 day"), flows.work_folder(t.spark))
)
query("stream_incremental_merge", "select user_id, event_id, event_type, value, props, ts from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1")(
    lambda t: flows.merged(_delivered(t), flows.work_folder(t.spark), "users", ["user_id"], ["ts", "event_id"])
)
query("stream_first_of_key", "select user_id, event_type from events group by all")(
    lambda t: flows.run_to_table(flows.once(_delivered(t), "ts", "user_id", "event_type", late="60 days"), flows.work_folder(t.spark), "append").select("user_id", "event_type")
)


def _late(t: Tables) -> DataFrame:
    rows, late = flows.announced(_delivered(t), flows.work_folder(t.spark), F.col("ts") < F.lit("2024-01-10").cast("timestamp"), "closed period")
    return rows.groupBy("event_type").agg(F.count("*").alias("n")).join(late.groupBy(F.col("event_type").alias("e")).agg(F.count("*").alias("late")), F.col("event_type") == F.col("e"), "left").drop("e")


query("stream_late_announced", "select event_type, count(*) as n, count(*) filter (ts < timestamp '2024-01-10') as late from events group by event_type")(_late)


def _retried(t: Tables) -> DataFrame:
    """An event passes once its user's first event, by id, is among those that came."""
    first = t.events.groupBy("user_id").agg(F.min("event_id").alias("first"))

    def passes(rows: DataFrame, before: DataFrame | None) -> DataFrame:
        here = rows.select("event_id") if before is None else rows.select("event_id").unionByName(before.select("event_id"))
        known = first.join(here, F.col("first") == F.col("event_id")).select(F.col("user_id").alias("u"))
        return rows.join(known, F.col("user_id") == F.col("u"), "left").withColumn("ok", F.col("u").isNotNull()).drop("u")

    passed, held = flows.retried(_delivered(t), flows.work_folder(t.spark), passes)
    return passed.agg(F.count("*").alias("passed"), F.count_distinct("event_id").alias("distinct_passed")).crossJoin(held.agg(F.count("*").alias("held")))


query("stream_held_rows", "select count(*) as passed, count(distinct event_id) as distinct_passed, cast(0 as bigint) as held from events")(_retried)

# --- the copy for demonstrations and the gate before it

POLICY = {
    "contact.first_name": "name", "contact.last_name": "name", "contact.phone": "phone", "contact.email": "email", "contact.street": "street", "contact.zip": "zip_same_area",
    "attribution.care_manager_name": "workforce", "demographics.birth_date": "shift_date", "visits[].appt_date": "shift_date", "screenings.*.screen_date": "shift_date", "labs.*.collected_date": "shift_date",
    "measures[].detail": "shift_dates_in_text", "gaps[].detail": "shift_dates_in_text",
}
WORKLISTS = {"_id": "workforce", "patients[].patient_id": "surrogate", "patients[].gaps[].detail": "drop"}
# Classes of the fields of documents.
CLASSES = dict.fromkeys(("first_name", "last_name", "phone", "email", "street", "zip", "care_manager_name", "birth_date", "appt_date", "screen_date", "collected_date", "detail", "patient_id"), "direct_identifier") | dict.fromkeys(
    ("site_id", "sex", "race_ethnicity", "language_group", "payer_type", "appointment_id", "visit_type", "total_score", "severity_band", "positive", "value", "measure_id", "numerator", "gap", "order", "n_patients", "n_gaps"), "clinical"
)
# The columns that an extract for research may have.
ALLOWED = ("record_id", "birth_year", "age", "area3", "sex", "age_band", "payer_type", *(f"{m.lower()}_{k}" for m in MEASURE_IDS for k in ("eligible", "met")))


@shared
def _crosswalk(t: Tables) -> DataFrame:
    """Surrogates by digest: the same in every run, and no draw on the driver at this size."""
    return t.patients.select(F.lit("patient").alias("kind"), F.col("patient_id").alias("value"), leakgate.surrogate(F.col("patient_id")).alias("surrogate"))


@shared
def _made(t: Tables) -> DataFrame:
    return landed(leakgate.made_values(_crosswalk(t), t.addresses, t.patients), "made")


@shared
def _full_documents(t: Tables) -> DataFrame:
    docs = documents.patient_documents(t.patients, t.appointments, marts.events(t), marts.labs(t), gaps(t), _results(t), t.addresses)
    return landed(docs, "documents")


def _last():
    return F.try_element_at("visits", F.lit(-1))["appt_date"]


query("demo_site_copy", """
    select 'X' || substr(sha256('copy/' || p.patient_id), 1, 16) as _id, 'staff' || substr(sha256('copy/staff/' || care_manager_name), 1, 10) as care_manager, birth_date + s as birth_date, v.last + s as last_visit, coalesce(v.n, 0) as visits,
        'name' || substr(sha256('copy/name/' || c.first_name), 1, 10) as first_name, 'm' || substr(sha256('copy/m/' || c.email), 1, 10) || '@copy.example' as email, substr(c.zip, 1, 3) as area, true as phone_changed
    from (select *, -(cast('0x' || substr(md5(patient_id), 1, 6) as integer) % 180) - 1 as s from patients) p join addresses c on c.patient_id = p.patient_id
    left join (select patient_id, count(*) as n, max(appt_date) as last from appointments where status = 'completed' group by patient_id) v on v.patient_id = p.patient_id""")(
    lambda t: leakgate.copied(_full_documents(t), POLICY, _crosswalk(t)).select(
        "_id", F.col("attribution.care_manager_name").alias("care_manager"), "demographics.birth_date", _last().alias("last_visit"), F.size("visits").cast("long").alias("visits"),
        "contact.first_name", "contact.email", F.left("contact.zip", F.lit(3)).alias("area"), ((F.length("contact.phone") == 10) & F.col("contact.phone").startswith("000")).alias("phone_changed"),
    )
)


def _checked(t: Tables, planted: bool) -> DataFrame:
    """The gate over the copy; ``planted`` puts a leak into it for every check."""
    model.land(t, "lines")  # labs and claims are made of them
    docs, known = _full_documents(t), _crosswalk(t)
    copy = leakgate.copied(docs, POLICY, known)
    lists = leakgate.transformed(documents.worklists(gaps(t)), WORKLISTS)
    extract, policy, columns = _extract(t), dict(POLICY), None
    refs = t.patients.select(leakgate.surrogate(F.col("patient_id")).alias("patient_id"))
    if planted:
        every = lambda n, c="_id": F.pmod(F.col(c).cast("int"), F.lit(n)) == 0
        real = docs.where(every(50))
        moved = known.where(every(49, "value")).select(F.col("surrogate").alias("_s"))
        copy = copy.join(moved, F.col("_id") == F.col("_s"), "left")
        # Shifts go back, so one day more never leads to the real date again.
        copy = documents.at_path(copy, "demographics.birth_date", lambda c: F.when(F.col("_s").isNotNull(), F.date_add(c, -1)).otherwise(c)).drop("_s").unionByName(real)
        policy.pop("contact.email")
        refs = refs.join(known.where(every(7, "value")).select(F.col("surrogate").alias("patient_id")), "patient_id", "left_anti")
        extract = extract.withColumns({"age": F.when(F.col("sex") == "M", "90+").otherwise(F.col("age")), "area3": F.when(F.col("sex") == "X", F.concat("area3", F.lit("00"))).otherwise(F.col("area3")), "patient_name": F.lit("x")})
    what = "planted" if planted else "copy"
    copy, lists, extract = (landed(df, f"{what}_{n}") for df, n in ((copy, "patients"), (lists, "worklists"), (extract, "extract")))
    checks = leakgate.text_checks([copy, lists], leakgate.real_values(t.addresses), _made(t))
    checks.append(leakgate._check("every patient differs", leakgate.unchanged(docs, copy, known, ["contact.phone", "contact.email", "contact.last_name", "contact.street"])))
    checks.append(leakgate._check("one shift", leakgate.same_shift(docs, copy, known, F.col("demographics.birth_date"), _last())))
    missing = leakgate.uncovered(docs, CLASSES, policy) + leakgate.uncovered(documents.worklists(gaps(t)), CLASSES, WORKLISTS)
    checks.append(leakgate.said(t.spark, "policy covers paths", len(missing)))
    named = lists.select(F.explode("patients").alias("p")).select(F.col("p.patient_id").alias("patient_id")).distinct()
    checks.append(leakgate._check("references resolve", deid.dangling(named, refs, "patient_id")))
    return leakgate.gate([*checks, *leakgate.extract_checks(extract, columns or ALLOWED)]).select(F.lit(what).alias("of"), "check", "found", "passed")


_TEXTS = ("record numbers", "e-mail addresses", "phone numbers", "names", "streets", "every patient differs")
_CHECKS = (*_TEXTS, "one shift", "policy covers paths", "references resolve", "columns allowed", "ages above 89", "areas of three digits")
PIECES["planted_leaks"] = f"""
    select unnest([{', '.join(f"'{c}'" for c in _TEXTS)}]) as "check", (select count(*) from patients where cast(patient_id as integer) % 50 = 0) as found
    union all select 'one shift', (select count(distinct a.patient_id) from appointments a where status = 'completed' and cast(a.patient_id as integer) % 49 = 0)
    union all select 'policy covers paths', 1 union all select 'columns allowed', 1
    union all select 'references resolve', (select count(distinct patient_id) from gaps where cast(patient_id as integer) % 7 = 0)
    union all select 'ages above 89', (select count(*) from facts where sex = 'M' and age_my_end < 90)
    union all select 'areas of three digits', (select count(*) from facts where sex = 'X')"""
query("leak_gate", """select 'planted' as of, "check", found, found = 0 as passed from planted_leaks union all select 'copy', "check", 0, true from planted_leaks""")(
    lambda t: _checked(t, False).unionByName(_checked(t, True))
)
query("run_summary", """
    select o.rule_id, o.action, count(*) filter (outcome = 'pass') as loads_passed, count(*) filter (outcome = 'blocked') as loads_blocked, cast(sum(rows_failed) as bigint) as rows_failed, any_value(e.example) as example
    from outcomes o left join (select rule_id, min(case when regexp_matches(d, '^[0-9]{7,}$') then repeat('#', length(d)) when regexp_matches(d, '^[0-9]{7,}:.*$') then repeat('#', length(regexp_extract(d, '^[0-9]+'))) || substr(d, length(regexp_extract(d, '^[0-9]+')) + 1) else d end) as example
        from (select rule_id, trim(detail) as d from found) x group by rule_id) e on e.rule_id = o.rule_id group by o.rule_id, o.action""")(
    lambda t: monitoring.run_summary(rules.outcomes(feeds.evaluated(t), feeds.CLAIMS), rules.findings(feeds.evaluated(t)))
)
