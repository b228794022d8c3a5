"""Personal data by anchor expansion.

An Aho-Corasick automaton walks a text once and stops at anchors only: at-signs, schemes, plus
signs, digits and identifier cues. At each anchor a deterministic parser for its kind expands to
the left and right and validates what it has (octets, Luhn, digit counts, mod 97). The parsers
keep, for each kind, the end of its last match, so spans of a kind don't overlap and the leftmost
match wins; a match that fails validation is passed over as a whole.

Kinds: email, ip, card and phone as the patterns beside their parsers say; ``address``: a url that
carries credentials (scheme://user:secret@host); ``account``: an IBAN that passes mod 97, or 6 to
20 digits after an identifier cue such as ``account no``.

Defined results: a null text is an empty one and has no spans; a null id stays null; repeated rows
give repeated rows; an empty table gives an empty table; other columns are not read, or returned
as they are by ``redact``; offsets count code points and a text of any length is read whole.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone", "address", "account")
BASE = KINDS[:4]
# The anchors, and what is matched from them.
SCHEMES = ("://",)
CUES = ("account", "Account", "ACCOUNT", "acct", "Acct", "ACCT", "iban", "IBAN", "Iban", "passport", "Passport", "PASSPORT", "ssn", "SSN")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
USERINFO = re.compile(r"[^\s/@:?#\"'<>]+:[^\s/@?#\"'<>]+@[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[^\s\"'<>]*)?")
SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{1,15}\Z")
CUED = re.compile(r"(?:\x20?(?:no|number|id|nr))?\.?\x20{0,3}[:#=]?\x20{0,3}([0-9](?:[\x20-]?[0-9]){5,19})(?![0-9])")
IBAN = re.compile(r"\x20{0,3}[:#=]?\x20{0,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


@lru_cache(maxsize=1)
def anchors() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, words in (("@", ("@",)), (":", SCHEMES), ("+", ("+",)), ("0", "0123456789"), ("#", CUES)):
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def _octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 4 and int(digits or 0) <= 255


def spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then by kind as KINDS lists them."""
    found: list[tuple[int, int, int]] = []
    email = ip = card = phone = address = account = 0  # from here on each kind may match
    for last, (anchor, length) in anchors().iter(text):
        at = last - length + 1
        if anchor == "0":
            if at >= ip:
                m = IP.match(text, at)
                ip = m.end() if m else DIGITS.match(text, at).end()
                if m and all(map(_octet, m.groups())):
                    found.append((at, 1, ip))
            if at >= card:
                m = CARD.match(text, at)
                card = m.end() if m else at + 1
                if m:
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        found.append((at, 2, card))
        elif anchor == "@":
            start = at
            while start > email and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                email = m.end()
                found.append((start, 0, email))
        elif anchor == "+":
            if at >= phone and (m := PHONE.match(text, at)):
                phone = m.end()
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append((at, 3, phone))
        elif anchor == ":":
            if at >= address and (m := USERINFO.match(text, at + 3)) and (s := SCHEME.search(text[max(address, at - 16) : at])):
                address = m.end()
                found.append((at - len(s[0]), 4, address))
        elif at >= account and not text[at - 1 : at].isalnum():
            if m := IBAN.match(text, last + 1):
                if not mod97(m[1].replace(" ", "")):
                    continue
            elif not (m := CUED.match(text, last + 1)):
                continue
            account = m.end(1)
            found.append((m.start(1), 5, account))
    found.sort()
    return [(KINDS[k], start, end) for start, k, end in found]


def redacted(text: str, found: list[tuple[str, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by the name of its first one's kind."""
    out, at = [], 0
    for kind, start, end in found:
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: its id and ``found``, its spans with kind, start, end and value."""
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batch: pa.RecordBatch):
        found = []
        for x in batch.column(1):
            text = x.as_py() or ""
            found.append([{"kind": k, "start": s, "end": e, "value": text[s:e]} for k, s, e in spans(text)])
        yield {id_col: batch.column(0), "found": found}

    ddl = f"`{id_col}` {kind}, found array<struct<kind:string,start:int,end:int,value:string>>"
    return common.by_batch(docs.select(id_col, text_col), ddl, rows)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns with every span in the text replaced by its kind; null stays null."""
    schema = docs.schema
    at = schema.names.index(text_col)

    def run(batches):
        for batch in batches:
            texts = [None if (t := x.as_py()) is None else redacted(t, spans(t)) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, batch.schema.field(i).type) if i == at else batch.column(i) for i in range(batch.num_columns)],
                schema=batch.schema,
            )

    return docs.mapInArrow(run, schema)


def digest(found: str, kinds: tuple[str, ...] | None = None):
    """kind:start:end of the spans in ``found``, comma-joined."""
    held = F.filter(found, lambda s: s["kind"].isin(*kinds)) if kinds else F.col(found)
    return F.array_join(F.transform(held, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(common.table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *map(count, KINDS), F.sha2(digest("found", BASE), 256).alias("base_sha256"), digest("found").alias("spans")
    )
