"""De-identified copies, an extract for research, and the search for what should not be in them."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import age_on


def surrogates(known: DataFrame, values: DataFrame, kind: str, seed: int, make, forbidden: Iterable[str] = ()) -> DataFrame:
    """The crosswalk (kind, value, surrogate) with a surrogate for each value that is new to it.

    New values are drawn for in their order by a generator seeded by kind and by how many are known
    already, so a run can be repeated; a draw that is taken or forbidden is drawn again. Draws are
    sequential by nature: only new values come to the driver, a page of them at a time.
    """
    spark = known.sparkSession
    fresh = values.where("value is not null").distinct().join(known.where(F.col("kind") == kind), "value", "left_anti").orderBy("value")
    taken = {r.surrogate for r in known.where(F.col("kind") == kind).select("surrogate").toLocalIterator()} | set(forbidden)
    rng, out = random.Random(f"{seed}/{kind}/{len(taken)}"), []
    for r in fresh.toLocalIterator():
        while (draw := make(rng)) in taken:
            pass
        taken.add(draw)
        out.append((kind, r.value, draw))
    return known.unionByName(spark.createDataFrame(out, known.schema)) if out else known


def shift_days(patient: Column | str, most: int = 180) -> Column:
    """A shift of 1 to ``most`` days back for each patient, the same for all of their dates."""
    drawn = F.conv(F.substring(F.md5(F.col(patient) if isinstance(patient, str) else patient), 1, 6), 16, 10).cast("int")
    return (-(drawn % most) - 1).cast("int")


def safe_harbor(facts: DataFrame, patients: DataFrame, results: DataFrame, measures: Sequence[str], at: Column, small_areas: Sequence[str] = ()) -> DataFrame:
    """A row for each patient without identifiers: years, age to 89, areas of three digits, measures.

    Measures are spread to columns by one conditional aggregation over their results.
    """
    spread = [c for m in measures for c in (F.bool_or(F.col("measure_id") == m).alias(f"{m.lower()}_eligible"), F.bool_or((F.col("measure_id") == m) & F.col("numerator")).alias(f"{m.lower()}_met"))]
    wide = results.groupBy("patient_id").agg(*spread)
    age = age_on("birth_date", at)
    area = F.substring("patient_id", 3, 3)
    out = facts.drop("site_id").join(patients.select("patient_id", "birth_date"), "patient_id").join(wide, "patient_id", "left")
    return out.select(
        F.sha2(F.concat(F.lit("extract/"), F.col("patient_id")), 256).alias("record_id"), F.when(age < 90, F.year("birth_date")).alias("birth_year"), F.when(age >= 90, "90+").otherwise(age.cast("string")).alias("age"),
        F.when(area.isin(*small_areas), "000").otherwise(area).alias("area3") if small_areas else area.alias("area3"), "sex", "age_band", "payer_type",
        *(F.coalesce(c, F.lit(False)).alias(c) for m in measures for c in (f"{m.lower()}_eligible", f"{m.lower()}_met")),
    )


def group_sizes(extract: DataFrame, columns: Sequence[str], least: int) -> DataFrame:
    """How many groups of quasi-identifiers there are, the smallest, and records in small ones."""
    groups = extract.groupBy(*columns).agg(F.count("*").alias("n"))
    out = groups.agg(F.count("*").alias("n_groups"), F.min("n").alias("smallest"), F.sum(F.when(F.col("n") < least, F.col("n")).otherwise(0)).alias("records_below"), F.sum("n").alias("records"))
    return out.select(F.lit(",".join(columns)).alias("columns"), "n_groups", "smallest", "records_below", "records")


# --- the search for leaks: tokens of every text, met with real values


def tokens(texts: DataFrame, pattern: str) -> DataFrame:
    """(id, token): distinct matches of a pattern in each text."""
    found = F.array_distinct(F.regexp_extract_all("text", F.lit(f"({pattern})"), F.lit(1)))
    return texts.select("id", F.explode(found).alias("token"))


def digit_tokens(texts: DataFrame, least: int) -> DataFrame:
    return tokens(texts, "[0-9]+").where(F.length("token") >= least)


def email_tokens(texts: DataFrame) -> DataFrame:
    return tokens(texts, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]+").select("id", F.lower("token").alias("token")).distinct()


def _words(text: str | Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}0-9]+)"), F.lit(1))


#: Bits of a sieve for each of its values, and the most words of 64 bits that it has (8 MB).
SIEVE_BITS, SIEVE_WORDS = 16, 1 << 20


def sieve(values: DataFrame) -> Callable[[Column], Column]:
    """A test that each of the table's values passes, and few others: two bits a value in one bitmap.

    The bitmap's size is bounded, so what passes has yet to meet the values themselves. It keeps
    from a shuffle what can't be among them.
    """
    n, words = values.count(), 1 << 8
    while words < SIEVE_WORDS and words * 64 < n * SIEVE_BITS:
        words *= 2

    def places(c: Column) -> list[tuple[Column, Column]]:
        hashes = (F.xxhash64(c), F.xxhash64(c, F.lit(1)))
        return [(F.pmod(h, F.lit(words)).cast("int"), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(63)).cast("int")) for h in hashes]

    bit = lambda b: F.call_function("shiftleft", F.lit(1).cast("long"), b)
    marks = values.select(F.explode(F.array(*(F.struct(w.alias("at"), bit(b).alias("bits")) for w, b in places(F.col("value"))))).alias("m")).select("m.*")
    every = values.sparkSession.range(words).select(F.col("id").cast("int").alias("at"), F.lit(0).cast("long").alias("bits"))
    held = marks.unionByName(every).groupBy("at").agg(F.bit_or("bits").alias("bits"))
    bitmap = held.agg(F.array_sort(F.collect_list(F.struct("at", "bits")))["bits"].alias("bits")).scalar()

    def passes(c: Column) -> Column:
        (w0, b0), (w1, b1) = places(c)
        return (F.bit_get(F.get(bitmap, w0), b0) == 1) & (F.bit_get(F.get(bitmap, w1), b1) == 1)

    return passes


def word_runs(texts: DataFrame, n: int | Sequence[int], among: Callable[[Column], Column] | None = None) -> DataFrame:
    """(id, run): distinct runs of n lower-case words of each text; of each of several n; only those that pass ``among``."""
    sizes = [n] if isinstance(n, int) else sorted(n)
    held = texts.select("id", _words("text").alias("w")).where(F.size("w") >= sizes[0])
    place = held.select("id", "w", F.explode(F.sequence(F.lit(1), F.size("w") - (sizes[0] - 1))).alias("i"))
    if len(sizes) > 1:
        place = place.select("id", "w", "i", F.explode(F.array(*map(F.lit, sizes))).alias("n")).where(F.col("i") + F.col("n") - 1 <= F.size("w"))
    out = place.select("id", F.array_join(F.slice("w", F.col("i"), F.col("n") if len(sizes) > 1 else F.lit(sizes[0])), " ").alias("run"))
    return (out if among is None else out.where(among(F.col("run")))).distinct()


def shared_runs(texts: DataFrame, real: DataFrame, n: int) -> DataFrame:
    """(id, run): distinct runs of n words that a text shares with a real one (id, text).

    Runs meet as hashes, so the strings of all runs are never shuffled; of the few that meet the
    words themselves are compared.
    """

    def hashed(df: DataFrame) -> DataFrame:
        held = df.select("id", _words("text").alias("w")).where(F.size("w") >= n)
        hashes = held.select("id", "w", F.posexplode(F.transform("w", lambda x: F.xxhash64(x))).alias("i", "h"))
        # The words behind each one, gathered by looking ahead in the array that is there already.
        ahead = [F.get(F.col("w"), F.col("i") + k) for k in range(n)]
        return hashes.where(F.col("i") <= F.size("w") - n).select("id", F.xxhash64(*ahead).alias("h"), F.array_join(F.slice("w", F.col("i") + 1, F.lit(n)), " ").alias("run"))

    known = hashed(real).select(F.col("h").alias("k"), F.col("run").alias("real")).distinct()
    wanted = known.select("k").distinct()
    mine = hashed(texts).join(wanted, F.col("h") == F.col("k"), "left_semi").distinct()
    return mine.join(known, (F.col("h") == F.col("k")) & (F.col("run") == F.col("real")), "left_semi").select("id", "run")


def leaks(found: DataFrame, real: DataFrame, token: str = "token") -> DataFrame:
    """The tokens found that are real values. Neither side is collected."""
    return found.join(real.select(F.col("value").alias(token)).distinct(), token, "left_semi")


def dangling(references: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    return references.join(targets.select(key).distinct(), key, "left_anti")
