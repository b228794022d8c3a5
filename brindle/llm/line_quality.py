"""Quality rules over lines that many documents of one host share, in DataFrame functions only.

Lines are normalised (ASCII letters lowered, digits to 0, white space to single spaces) and hashed
with their host. A line is boilerplate if the number of distinct texts of the host that hold it
reaches MIN_DOCS and SHARE of the host's distinct texts; exact copies of a text count once, so a
text isn't held against its own copies. Boilerplate lines are removed (``cleaned`` gives the texts
without them, the other lines as they were), and a document is rejected
as depleted if fewer than MIN_LEFT words or less than KEEP of its words are left. Some base figures
go with it, and a document that fails them is rejected as well.

Counts are partly summed before every shuffle, so a host or line with a third of all rows costs a
row a task; going back from lines to documents is a join that Spark splits where a line is hot.
Counts shuffle hashes only; texts are shuffled once, to meet the places of their boilerplate lines.

Defined results: a null text has no words and fails the base rules; a null host is a host of its
own (the empty name); rows with a null id are judged like others; repeated rows get equal results;
an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

MIN_DOCS, SHARE = 25, 0.005
MIN_LEFT, KEEP = 10, 0.5
MIN_WORDS, MAX_REPEATED = 10, 20
SYMBOLS = "#*$%&|<>"
WINDOW = 5
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words stand in runs of ``window`` words that occur twice or more."""

    def runs(hashes: Column) -> Column:
        each = F.transform(hashes, lambda h, i: F.xxhash64(h, *(F.get(hashes, i + k) for k in range(1, window))))
        return F.slice(each, 1, F.greatest(F.size(hashes) - (window - 1), F.lit(0)))

    def covered(found: Column) -> Column:
        """``found`` holds runs and places, sorted: those with an equal neighbour occur again."""
        again = F.filter(found, lambda x, i: (x["h"] == F.get(found, i - 1)["h"]) | (x["h"] == F.get(found, i + 1)["h"]))
        places = F.sort_array(F.transform(again, lambda x: x["i"]))
        gaps = lambda p: F.transform(p, lambda x, i: F.when(i == 0, F.lit(window)).otherwise(F.least(F.lit(window), x - F.get(p, i - 1))))
        return F.aggregate(_let(places, gaps), F.lit(0), lambda a, x: a + x)

    def counted(each: Column) -> Column:
        marked = F.sort_array(F.transform(each, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(each)) == F.size(each), 0).otherwise(_let(marked, covered))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: _let(runs(hashes), counted))


def normalised(line: Column) -> Column:
    plain = F.translate(line, _UP + "123456789", _LOW + "0" * 9)
    return F.trim(F.regexp_replace(plain, r"[\x20\x09-\x0D]+", " "))


def base_figures(docs: DataFrame) -> DataFrame:
    """The figures of each row of (id, text, left) by itself; ``left`` is what is left of the text."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.select(
        "id", "left", common.words_of(F.col("text")).alias("words"), lines.alias("lines"),
        F.length(F.translate(text, common.SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    return out.select(
        "id", F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.when(F.col("left").isNull(), F.size("words")).otherwise(F.size(common.words_of(F.col("left")))).cast("long").alias("n_left"),
    )


def _without(
    docs: DataFrame, id_col: str, text_col: str, host_col: str, min_docs: int, share: float
) -> DataFrame:
    """(id, text, left): the rows of ``docs``, and their texts without boilerplate lines (null where there are none)."""
    held = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), F.col(text_col).alias("text")
    ).withColumn("copy", F.xxhash64(F.coalesce("text", F.lit(""))))
    line = held.select("id", "host", "copy", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("place", "line"))
    line = line.select("id", "host", "copy", "place", normalised(F.col("line")).alias("line")).where("line <> ''")
    line = line.select("id", "host", "copy", "place", F.xxhash64("line").alias("hash"))
    # Distinct texts of a host, and of a host that hold a line.
    hosts = held.groupBy("host").agg(F.count_distinct("copy").alias("texts"))
    often = line.groupBy("host", "hash").agg(F.count_distinct("copy").alias("docs")).where(F.col("docs") >= min_docs)
    often = often.join(hosts, "host").where(F.col("docs") >= F.col("texts") * share)
    often = common.written(often.select(F.col("host").alias("h"), F.col("hash").alias("x")), "boilerplate")
    cut = line.join(often, (F.col("host") == F.col("h")) & (F.col("hash") == F.col("x")))
    # Rows that repeat each other name each place once.
    cut = cut.groupBy("id", "host", "copy").agg(F.collect_set("place").alias("places"))
    cut = cut.select(F.col("id").alias("i"), F.col("host").alias("h"), F.col("copy").alias("c"), "places")
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("host") == F.col("h")) & (F.col("copy") == F.col("c"))
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("places", i)), "\n")
    return held.join(cut, same, "left").select("id", "text", F.when(F.col("places").isNotNull(), left).alias("left"))


def cleaned(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE
) -> DataFrame:
    """A row for each row of ``docs``: its id and its text without boilerplate lines."""
    return _without(docs, id_col, text_col, host_col, min_docs, share).select(F.col("id").alias(id_col), F.coalesce("left", "text").alias(text_col))


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_docs: int = MIN_DOCS,
    share: float = SHARE, min_left: int = MIN_LEFT, keep: float = KEEP,
) -> DataFrame:
    """A row for each row of ``docs``: its id, figures, words in boilerplate lines, and verdict."""
    out = base_figures(_without(docs, id_col, text_col, host_col, min_docs, share))
    gone, left = F.col("n_words") - F.col("n_left"), F.col("n_words") - F.col("n_line_words")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    out = out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", gone.alias("n_line_words"), failed.alias("base_failed"))
    return out.withColumn("kept", ~F.col("base_failed") & (left >= min_left) & (left >= F.col("n_words") * keep))


def op1_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "documents"))


def op1_sql() -> str:
    """The same in DuckDB SQL."""
    spaces = r"[\x20\x09-\x0D]+"
    return f"""
    with d as (select doc_id, coalesce(source, '') as host, coalesce(text, '') as t from documents),
    s as (select *, list_filter(string_split_regex(t, '{spaces}'), lambda x: x <> '') as w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls from d),
    p as (select doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) as i from s where len(w) >= {WINDOW}),
    r as (select doc_id, i, count(*) over (partition by doc_id, w[i : i + {WINDOW - 1}]) as n from p),
    c as (select doc_id, count(distinct k) as n from (select doc_id, unnest(range(i, i + {WINDOW})) as k from r where n > 1) group by doc_id),
    l as (select doc_id, host, t, trim(regexp_replace(translate(x, '{_UP}123456789', '{_LOW}000000000'), '{spaces}', ' ', 'g')) as x
        from (select doc_id, host, t, unnest(string_split(t, chr(10))) as x from d)),
    h as (select host, count(distinct t) as texts from d group by host),
    o as (select l.host, x from l join h on l.host = h.host where x <> '' group by l.host, x, texts having count(distinct t) >= {MIN_DOCS} and count(distinct t) >= texts * cast({SHARE} as double)),
    g as (select doc_id, sum(length(l.x) - length(replace(l.x, ' ', '')) + 1) as n from l join o on l.host = o.host and l.x = o.x group by doc_id),
    b as (select s.doc_id, cast(len(w) as bigint) as n_words, cast(length(regexp_replace(t, '{spaces}', '', 'g')) as bigint) as word_chars,
        cast(length(t) - length(regexp_replace(t, '[{SYMBOLS}]', '', 'g')) as bigint) as n_symbols, cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
        cast(coalesce(c.n, 0) as bigint) as n_repeat_words, cast(coalesce(g.n, 0) as bigint) as n_line_words
        from s left join c on s.doc_id = c.doc_id left join g on s.doc_id = g.doc_id)
    select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED} * n_words as base_failed,
        not (n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED} * n_words) and n_words - n_line_words >= {MIN_LEFT}
        and n_words - n_line_words >= n_words * cast({KEEP} as double) as kept from b
    """
