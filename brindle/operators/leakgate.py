"""De-identified copies of documents, and the gate before they leave: each check counts what should not be there."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ..functions.scalars import shifted_dates, street_key
from . import deid, documents


def _digits(c: Column, n: int) -> Column:
    """``n`` digits that follow from a value and can't be turned back without the salt."""
    return F.lpad(F.pmod(F.xxhash64(F.lit("copy"), c), F.lit(10**n)).cast("string"), n, "0")


def _mark(c: Column, kind: str, n: int = 10) -> Column:
    return F.concat(F.lit(kind), F.left(F.sha2(F.concat(F.lit(f"copy/{kind}/"), c), 256), F.lit(n)))


#: Transforms by name: a function of the value and of the document's shift in days; null stays null.
TRANSFORMS = {
    "drop": lambda c, shift: F.lit(None).cast("string"),
    "name": lambda c, shift: _mark(c, "name"),
    "workforce": lambda c, shift: _mark(c, "staff"),
    "email": lambda c, shift: F.concat(_mark(c, "m"), F.lit("@copy.example")),
    "phone": lambda c, shift: F.concat(F.lit("000"), _digits(c, 7)),
    "street": lambda c, shift: F.concat(_digits(c, 3), F.lit(" copy street")),
    "zip_same_area": lambda c, shift: F.concat(F.left(c, F.lit(3)), _digits(c, 2)),
    "shift_date": lambda c, shift: F.date_add(c, shift),
    "shift_dates_in_text": lambda c, shift: shifted_dates(c, shift),
    "surrogate": lambda c, shift: surrogate(c),
}


def surrogate(value: Column) -> Column:
    """The record number of the copy: the same for a patient wherever they are named."""
    return F.concat(F.lit("X"), F.left(F.sha2(F.concat(F.lit("copy/"), value), 256), F.lit(16)))


def copied(docs: DataFrame, policy: Mapping[str, str], crosswalk: DataFrame) -> DataFrame:
    """Documents with surrogate ids and the policy's transform at each of its paths.

    ``crosswalk`` has value and surrogate; a document whose id it lacks is left out, so nothing
    leaves by accident. Dates of a document move by one shift, so intervals stay.
    """
    known = crosswalk.select(F.col("value").alias("_known"), F.col("surrogate").alias("_surrogate"))
    out = docs.join(known, F.col("_id") == F.col("_known")).withColumn("_shift", deid.shift_days("_known"))
    for path, name in policy.items():
        shift = F.col("_shift")
        out = documents.at_path(out, path, lambda c, f=TRANSFORMS[name]: f(c, shift))
    return out.withColumn("_id", F.col("_surrogate")).drop("_known", "_surrogate", "_shift")


def transformed(docs: DataFrame, policy: Mapping[str, str]) -> DataFrame:
    """Documents that are of no patient (clinics, worklists): the policy at its paths, without a shift."""
    for path, name in policy.items():
        docs = documents.at_path(docs, path, lambda c, f=TRANSFORMS[name]: f(c, F.lit(0)))
    return docs


# --- what a policy has to cover


def leaves(kind: DataType, at: str = "") -> Iterable[tuple[str, str]]:
    """(path, name of the last field) of every value in a nested type."""
    if isinstance(kind, StructType):
        for f in kind:
            yield from leaves(f.dataType, f"{at}.{f.name}" if at else f.name)
    elif isinstance(kind, ArrayType):
        yield from leaves(kind.elementType, f"{at}[]")
    elif isinstance(kind, MapType):
        yield from leaves(kind.valueType, f"{at}.*")
    else:
        yield at, at.replace("[]", "").rsplit(".", 1)[-1]


def uncovered(docs: DataFrame, classes: Mapping[str, str], policy: Mapping[str, str]) -> list[str]:
    """Paths of identifying fields, by classification, that the policy has no transform for; unclassified ones too."""
    out = []
    for path, name in leaves(docs.schema):
        if path != "_id" and path not in policy and classes.get(name) in (None, "direct_identifier"):
            out.append(path)
    return sorted(out)


# --- the checks


def texts_of(docs: DataFrame) -> DataFrame:
    """(id, text): every string of each document, names of fields included."""
    return docs.select(F.col("_id").alias("id"), F.to_json(F.struct(*docs.columns)).alias("text"))


def _check(name: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("found")).select(F.lit(name).alias("check"), "found")


def said(spark, name: str, found: int) -> DataFrame:
    return spark.createDataFrame([(name, found)], "check string, found long")


#: Streets of so many words are searched for.
STREET_WORDS = (2, 3, 4, 5, 6)
#: Digits of a record number and of a phone number.
RECORD_DIGITS, PHONE_DIGITS = 8, 10


def real_values(contacts: DataFrame) -> DataFrame:
    """(kind, value): what must not be found, written as the search will see it."""
    of = lambda kind, c: contacts.select(F.lit(kind).alias("kind"), c.alias("value"))
    parts = [
        of("record", F.col("patient_id")), of("phone", F.col("phone")), of("email", F.lower("email")), of("name", F.lower(F.concat_ws(" ", "first_name", "last_name"))), of("street", street_key("street")),
    ]
    return reduce(DataFrame.unionByName, parts).where("value <> ''").distinct()


def made_values(crosswalk: DataFrame, contacts: DataFrame, staff: DataFrame) -> DataFrame:
    """(value): the words that the transforms made of real values, of those in which a number might be read."""
    parts = [
        crosswalk.select(F.col("surrogate").alias("value")), staff.select(_mark(F.col("care_manager_name"), "staff").alias("value")),
        *(contacts.select(_mark(F.col(c), kind).alias("value")) for c, kind in (("first_name", "name"), ("last_name", "name"), ("email", "m"))),
    ]
    return reduce(DataFrame.unionByName, parts).where(F.col("value").rlike(f"[0-9]{{{RECORD_DIGITS}}}")).distinct()


def numbers_found(texts: DataFrame, n: int, real: DataFrame, made: DataFrame | None = None) -> DataFrame:
    """(id, token): runs of exactly ``n`` digits that are real values.

    Digests hold runs of digits, and among enough of them some read like a record number. Only a
    whole word that is one of ``made`` is no leak; a number within any other word is found.
    """
    words = deid.tokens(texts, "[A-Za-z0-9]+").where(F.col("token").rlike(f"[0-9]{{{n}}}")).select("id", F.col("token").alias("word"))
    runs = words.select("id", "word", F.explode(F.regexp_extract_all("word", F.lit("([0-9]+)"), F.lit(1))).alias("token")).where(F.length("token") == n)
    found = deid.leaks(runs, real)
    if made is not None:
        found = found.join(made.select(F.col("value").alias("word")), "word", "left_anti")
    return found.select("id", "token").distinct()


def text_checks(docs: Sequence[DataFrame], real: DataFrame, made: DataFrame | None = None) -> list[DataFrame]:
    """Tokens of all strings of all documents that are real values (kind, value).

    A first and a last name stand in fields of their own; what lies between them in the text are
    a field's name and marks, so names are searched in the values one after another. There are as
    many runs of words as words, so only those that may be real are shuffled to meet the real ones.
    """
    texts = reduce(DataFrame.unionByName, map(texts_of, docs))
    bare = texts.withColumn("text", F.regexp_replace("text", r'"[A-Za-z_0-9]+":', " "))
    of = lambda kind: real.where(F.col("kind") == kind)
    said = deid.sieve(real.where("kind in ('name', 'street')").select("value"))
    return [
        _check("record numbers", numbers_found(texts, RECORD_DIGITS, of("record"), made)),
        _check("e-mail addresses", deid.leaks(deid.email_tokens(texts), of("email"))),
        _check("phone numbers", numbers_found(texts, PHONE_DIGITS, of("phone"), made)),
        _check("names", deid.leaks(deid.word_runs(bare, 2, said), of("name"), "run")),
        _check("streets", deid.leaks(deid.word_runs(bare, STREET_WORDS, said), of("street"), "run")),
    ]


def unchanged(before: DataFrame, after: DataFrame, crosswalk: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Documents of the copy whose id, or any of these fields, is what it was."""
    same = lambda a, b: reduce(Column.__or__, [F.col(f"{a}.{f}") == F.col(f"{b}.{f}") for f in fields], F.lit(False))
    old = before.select(F.col("_id").alias("value"), F.struct("*").alias("o"))
    new = after.select(F.col("_id").alias("surrogate"), F.struct("*").alias("n"))
    pairs = old.join(crosswalk.select("value", "surrogate"), "value").join(new, "surrogate").where(same("o", "n")).select("surrogate")
    kept = new.join(old.select(F.col("value").alias("surrogate")), "surrogate", "left_semi").select("surrogate")
    return pairs.unionByName(kept).distinct()


def same_shift(before: DataFrame, after: DataFrame, crosswalk: DataFrame, day: Column, other: Column) -> DataFrame:
    """Documents of which two dates did not move by one equal, non-zero number of days."""
    old = before.select(F.col("_id").alias("value"), day.alias("d0"), other.alias("e0")).join(crosswalk.select("value", "surrogate"), "value")
    new = after.select(F.col("_id").alias("surrogate"), day.alias("d1"), other.alias("e1"))
    moved, second = F.datediff("d1", "d0"), F.datediff("e1", "e0")
    return old.join(new, "surrogate").where((moved == 0) | (second == 0) | (moved != second))


def extract_checks(extract: DataFrame, allowed: Sequence[str]) -> list[DataFrame]:
    """``allowed``: the columns that the policy names, whatever the extract has."""
    more = [c for c in extract.columns if c not in allowed]
    return [
        said(extract.sparkSession, "columns allowed", len(more)),
        _check("ages above 89", extract.where("(birth_year is not null and age = '90+') or try_cast(age as int) > 89")),
        _check("areas of three digits", extract.where("length(area3) <> 3")),
    ]


def gate(checks: Sequence[DataFrame]) -> DataFrame:
    """All checks' counts, and whether each passes."""
    return reduce(DataFrame.unionByName, checks).withColumn("passed", F.col("found") == 0)


def release(store, checks: DataFrame, tables: Mapping[str, DataFrame]) -> str:
    """Publish the copy if every check passes, all of its tables or none; else what is out stays as it is."""
    failed = [r.check for r in checks.where("not passed").select("check").collect()]  # twelve rows at most
    if failed:
        return "hold: " + ", ".join(sorted(failed))
    store.publish(tables)
    return "release"
