"""Column functions: typing of supplier text, keys and hashes, dates, exact ratios, masking."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

ABSENT = "~"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: Column | str) -> Column:
    """Trimmed; blank is null."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def full_match(c: Column | str, pattern: str) -> Column:
    return col(c).rlike(rf"^(?:{pattern})\z")


def whole_number(c: Column | str) -> Column:
    """An integer only where the text is written as one."""
    return F.when(full_match(c, "-?[0-9]+"), col(c).try_cast("int"))


def decimal_number(c: Column | str, kind: str = "decimal(10,2)") -> Column:
    return F.when(full_match(c, "-?[0-9]+([.][0-9]+)?"), col(c).try_cast(kind))


def parsed_date(c: Column | str, pattern: str) -> Column:
    """A date, or null where the text is none. Patterns take one-digit months and days."""
    return F.to_date(F.try_to_timestamp(text(c), F.lit(pattern)))


def mapped(mapping: Mapping[str, str], c: Column | str) -> Column:
    """The canonical value of an upper-cased, trimmed text; null if it isn't listed."""
    table = F.create_map(*map(F.lit, chain.from_iterable(mapping.items())))
    return F.try_element_at(table, F.upper(F.trim(col(c))))


def as_text(columns: Iterable[str]) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit(ABSENT)) for c in columns]


def row_hash(columns: Iterable[str]) -> Column:
    """md5 of a version of a row. Not for doubles, whose text differs between engines."""
    return F.md5(F.concat_ws("|", *as_text(columns)))


def natural_key(columns: Iterable[str]) -> Column:
    return F.concat_ws("|", *as_text(columns))


def age_on(birth: Column | str, at: Column) -> Column:
    """Whole years; a birthday later in the year doesn't count yet."""
    month_day = lambda d: F.month(d) * 100 + F.dayofmonth(d)
    return F.year(at) - F.year(col(birth)) - (month_day(at) < month_day(col(birth))).cast("int")


def banded(c: Column, bands: Iterable[tuple[int, str]], otherwise: str) -> Column:
    """The name of the first band whose upper end (exclusive) lies above the value."""
    out = None
    for end, name in bands:
        out = F.when(c < end, name) if out is None else out.when(c < end, name)
    return out.otherwise(otherwise)


def ratio(n: Column | str, d: Column | str, digits: int) -> Column:
    """n / d of counts, rounded half up in whole numbers; null where d is not above zero."""
    n, d = col(n).cast("long"), col(d).cast("long")
    above = n * (2 * 10**digits) + d
    whole = (above - F.pmod(above, d * 2)) / (d * 2)  # divides evenly
    return F.when(d > 0, F.round(whole, 0) / F.lit(float(10**digits)))


def masked(c: Column | str, least: int = 7) -> Column:
    """Runs of ``least`` or more digits, unless after an underscore, as so many number signs."""
    c = col(c)
    between = F.split(c, "[0-9]+", -1)
    runs = F.regexp_extract_all(c, F.lit("([0-9]+)"), F.lit(1))
    shown = lambda piece, run: F.concat(
        F.coalesce(piece, F.lit("")),
        F.when((F.length(run) >= least) & ~F.coalesce(piece, F.lit("")).endswith("_"), F.repeat(F.lit("#"), F.length(run))).otherwise(F.coalesce(run, F.lit(""))),
    )
    return F.array_join(F.zip_with(between, runs, shown), "")


def normalised_error(c: Column | str) -> Column:
    """Bracketed details emptied, numbers masked, spaces squeezed: equal errors look alike."""
    return F.trim(F.regexp_replace(F.regexp_replace(masked(c), r"\[[^\]]*\]", "[]"), " +", " "))


def slug(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", "-"), F.lit("-"))


def street_key(c: Column | str) -> Column:
    return F.array_join(F.regexp_extract_all(F.lower(col(c)), F.lit("([a-z0-9]+)"), F.lit(1)), " ")


def shifted_dates(c: Column | str, days: Column) -> Column:
    """ISO dates inside a text, moved by so many days; what is no date stays."""
    c, pattern = col(c), r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
    between, found = F.split(c, pattern, -1), F.regexp_extract_all(c, F.lit(f"({pattern})"), F.lit(1))
    moved = lambda d: F.coalesce(F.date_add(F.to_date(F.try_to_timestamp(d, F.lit("yyyy-MM-dd"))), days).cast("string"), d)
    return F.array_join(F.zip_with(between, found, lambda t, d: F.concat(F.coalesce(t, F.lit("")), F.coalesce(moved(d), F.lit("")))), "")


def count_if(condition: Column) -> Column:
    return F.count_if(condition).cast("long")
