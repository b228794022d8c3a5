"""URL filter: host and path rules first, then a weighted vocabulary of terms.

An Aho-Corasick automaton finds every term of the vocabulary in one walk over the lower-cased
url, in which percent-encoded ASCII letters, digits and hyphens (once) are read as what they stand
for. A hit counts only if no ASCII letter or digit stands right before or after it. Each distinct
term adds its weight; a url whose weights reach ``limit`` is blocked: one strict term (weight
``limit`` or more) or several distinct soft ones (below it). The vocabulary is an argument: a
dictionary, or a table of (term, weight) with up to TERMS rows.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and
is judged by its text (null: none), so null is allowed. Host, path and rules take the url as it is
written. Of a term that the vocabulary table repeats the highest weight counts; null and empty terms
and weights below 1 count nothing. An empty table gives an empty table; a repeated row gives a
repeated row; only the id and url columns are read, so others can't clash.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common

LIMIT = 4
#: The most terms that a vocabulary table may have; it goes to every worker.
TERMS = 200_000
# The vocabulary by weight.
STRICT = ("adult-x", "bestiality", "camgirls", "hardcore", "hentai", "milf", "porn", "porno", "pornstar", "sexcam", "xvideos", "xxx")
STRONG = ("casino", "escort", "nude", "payday", "poker", "sex", "slots", "viagra", "webcam")
WEAK = ("adult", "bet", "bets", "buy", "cheap", "farm", "free", "loan", "pharmacy", "pills", "spam")
VOCABULARY = dict.fromkeys(STRICT, LIMIT) | dict.fromkeys(STRONG, 2) | dict.fromkeys(WEAK, 1)
# Rules as (host and path, verdict).
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
ENCODED = re.compile("%(2D|3[0-9]|[46][1-9A-F]|[57][0-9A])", re.IGNORECASE)
SCHEMA = "host string, path string, rule string, n_strict int, n_soft int, weight int, verdict string"


def split_url(url: str | None) -> tuple[str, str]:
    """The host in lower case and the path; both empty without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, rest = rest[:end].translate(LOWER), rest[end:]
    return host, rest[: min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))]


def by_host(rules: tuple[tuple[str, str], ...]) -> dict[str, list[tuple[str, str, str]]]:
    """Rules as host -> (path, rule, verdict), so that a url looks up only its own suffixes."""
    out: dict[str, list[tuple[str, str, str]]] = {}
    for rule, verdict in rules:
        host, slash, path = rule.partition("/")
        out.setdefault(host, []).append((slash + path, rule, verdict))
    return out


def fitting(host: str, path: str, rules: dict[str, list[tuple[str, str, str]]]) -> tuple[str | None, str | None]:
    """The longest rule that fits the host or a domain above it, and its verdict."""
    best: tuple[str | None, str | None] = (None, None)
    labels = host.split(".") if host else []
    for i in range(len(labels)):
        for start, rule, verdict in rules.get(".".join(labels[i:]), ()):
            if path.startswith(start) and (best[0] is None or len(rule) > len(best[0])):
                best = rule, verdict
    return best


@lru_cache(maxsize=8)
def automaton(terms: tuple[str, ...]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for t in terms:
        a.add_word(t, t)
    a.make_automaton()
    return a


def terms_in(url: str | None, terms: tuple[str, ...]) -> set[str]:
    """The distinct terms that stand in the url between non-alphanumerics."""
    text = ENCODED.sub(lambda m: chr(int(m[1], 16)), url or "").translate(LOWER)
    found = set()
    for last, t in automaton(terms).iter(text):
        first = last - len(t) + 1
        if (first == 0 or text[first - 1] not in ALNUM) and (last + 1 == len(text) or text[last + 1] not in ALNUM):
            found.add(t)
    return found


def vocabulary_of(terms: DataFrame | dict[str, int]) -> dict[str, int]:
    """Terms in lower case with their weights, of a dictionary or of a table of a checked size."""
    if isinstance(terms, DataFrame):
        rows = terms.select("term", "weight").where("term <> '' and weight >= 1").limit(TERMS + 1).collect()
        if len(rows) > TERMS:
            raise ValueError(f"a vocabulary of more than {TERMS} terms")
        said = [(r.term, r.weight) for r in rows]
    else:
        said = [(t, w) for t, w in terms.items() if t and w >= 1]
    out: dict[str, int] = {}
    for t, w in said:
        t = t.translate(LOWER)
        out[t] = max(w, out.get(t, 0))
    return out


def judge(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[tuple[str, str], ...] = RULES,
    vocabulary: DataFrame | dict[str, int] = VOCABULARY, limit: int = LIMIT,
) -> DataFrame:
    """A row for each row of ``pages``: its id, host, path, rule, hits and verdict."""
    vocabulary = vocabulary_of(vocabulary)
    kind = pages.schema[id_col].dataType.simpleString()
    hosts, terms = by_host(rules), tuple(vocabulary)

    def rows(batch: pa.RecordBatch):
        out: dict[str, list] = {k: [] for k in ("host", "path", "rule", "n_strict", "n_soft", "weight", "verdict")}
        for url in batch.column(1).to_pylist():
            host, path = split_url(url)
            rule, verdict = fitting(host, path, hosts)
            weights = [vocabulary[t] for t in terms_in(url, terms)]
            total = sum(weights)
            strict = sum(w >= limit for w in weights)
            values = (host, path, rule, strict, len(weights) - strict, total, verdict or ("block" if total >= limit else "allow"))
            for k, v in zip(out, values, strict=True):
                out[k].append(v)
        yield {id_col: batch.column(0), **out}

    return common.by_batch(pages.select(id_col, url_col), f"`{id_col}` {kind}, {SCHEMA}", rows)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "pages"))


def op3_sql() -> str:
    """The same in DuckDB SQL."""
    up, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    # One code after the other: those with letters first and digits last, so that no code is made of what another left.
    codes = sorted((f"%{ord(c):02X}", c) for c in low + up + "0123456789-")
    codes.sort(key=lambda x: (not x[0][1:].isalpha() and x[0][2].isdigit(), x[1].isdigit(), x[0] if not x[1].isdigit() else -int(x[0][1:])))
    plain = "url"
    for code, c in codes:
        for form in dict.fromkeys((code, code.lower())):
            plain = f"replace({plain}, '{form}', '{c}')"
    hit = lambda t: f"(case when regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') then 1 else 0 end)"
    strict = [t for t, w in VOCABULARY.items() if w >= LIMIT]
    soft = [t for t, w in VOCABULARY.items() if w < LIMIT]
    total = " + ".join(f"{w} * {hit(t)}" for t, w in VOCABULARY.items())

    def whens(value: int) -> str:
        out = []
        for rule in sorted(RULES, key=lambda r: -len(r[0])):
            host, _, path = rule[0].partition("/")
            out.append(f"when (host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '/{path}') then '{rule[value]}'")
        return " ".join(out)

    return f"""
    with a as (select page_id, coalesce(url, '') as url, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
    b as (select page_id, url, regexp_extract(rest, '^[^/?#]*') as raw, rest from a),
    c as (select page_id, translate(raw, '{up}', '{low}') as host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path, translate({plain}, '{up}', '{low}') as low from b),
    d as (select page_id, host, path, case {whens(0)} end as rule, case {whens(1)} end as said, cast({" + ".join(map(hit, strict))} as integer) as n_strict,
        cast({" + ".join(map(hit, soft))} as integer) as n_soft, cast({total} as integer) as weight from c)
    select page_id, host, path, rule, n_strict, n_soft, weight, coalesce(said, case when weight >= {LIMIT} then 'block' else 'allow' end) as verdict from d
    """
