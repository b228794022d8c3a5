"""Language identification by fusing evidence in Bayes' way.

For each language log-probabilities are added up of

* the text: letter trigrams under a model per language, fitted on a bounded sample of each label's rows
  (SAMPLE rows a label, lowest hash of the id first); each byte stands in three trigrams, so a third of
  their sum counts. A further class, ``und``, has every trigram alike: gibberish and
  languages that the sample lacks fall to it, as does a text without letters;
* the declared language (a page's markup, a table's column): right with probability TRUST. Where the
  text models are fitted on the same declarations, as in the registered queries, the two aren't
  independent; accuracy is measured without this evidence, on rows that no model was fitted on;
* the host: how the posterior by text alone of the host's other documents is spread, by grouped
  aggregation over all rows, smoothed towards the address suffix, that towards all rows, and that
  towards an even spread, with KAPPA documents' weight each.

A document is rejected if ``und`` wins or the winner's posterior is below MIN_P.

Text goes to Python once, and scores (a few numbers a document) are written to the shared folder.
Host figures are joined by host, not broadcast, since hosts grow with the data; a host with a third
of all rows is partly summed before the shuffle, and the join is one that Spark can split.

Defined results: a null or empty text, or one without letters, is ``und`` and rejected; a null
declared language, host or suffix is no evidence (a null host is a host of its own); a null id
stays null; repeated rows get equal results; an empty table gives an empty table; without labelled
rows everything is ``und``; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

SAMPLE = 4000
#: A label of fewer rows is no language of its own.
MIN_ROWS = 3
TRUST, KAPPA, MIN_P = 0.9, 5.0, 0.5
BUCKETS = 1 << 16
UND = "und"
_LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def trigrams(text: str) -> np.ndarray:
    """The bucket of each letter trigram of a text; words are set apart by one space."""
    data = b" ".join(text.lower().encode().translate(_LETTERS).split())
    if not data:
        return np.empty(0, np.int64)
    b = np.frombuffer(b" " + data + b" ", np.uint8).astype(np.uint32)
    keys = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return ((keys * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


class TrigramModel:
    """Log-probabilities of trigram buckets by language, ``und`` last."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.languages = [*sorted(counts), UND]
        rows = [np.log((counts[k] + 0.1) / (counts[k].sum() + 0.1 * BUCKETS)) for k in self.languages[:-1]]
        self.table = np.stack([*rows, np.full(BUCKETS, -np.log(BUCKETS))]).astype(np.float32) / 3

    def scores(self, text: str | None) -> list[float] | None:
        at = trigrams(text or "")
        return [float(row[at].sum(dtype=np.float64)) for row in self.table] if len(at) else None


def fitted(docs: DataFrame, sample: int = SAMPLE) -> TrigramModel:
    """A model of the labels of (id, text, declared), of a bounded sample of each label's rows."""
    rows = docs.where("id is not null and declared is not null and text is not null")
    # A label's first ids in each of 64 parts, then of those: no task sorts all of a common label.
    first = lambda df, *keys: df.withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy("h", "id"))).where(F.col("r") <= sample).drop("r")
    ids = rows.select("declared", "id").distinct().withColumn("h", F.xxhash64("id")).withColumn("part", F.pmod("h", F.lit(64)))
    ids = first(first(ids, "declared", "part"), "declared").select(F.col("declared").alias("d"), F.col("id").alias("i"))
    rows = rows.join(ids, (F.col("declared") == F.col("d")) & (F.col("id") == F.col("i")), "left_semi").select("declared", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places: dict[str, list[int]] = {}
            for i, label in enumerate(batch.column(0).to_pylist()):
                places.setdefault(label, []).append(i)
            for label, at in places.items():  # one label's counts at a time
                counts = np.zeros(BUCKETS, np.int64)
                for i in at:
                    counts += np.bincount(trigrams(batch.column(1)[i].as_py()), minlength=BUCKETS)
                there = np.flatnonzero(counts)
                yield pa.RecordBatch.from_pydict({"label": [label] * (len(there) + 1), "bucket": np.append(there, -1).astype(np.int32), "n": np.append(counts[there], len(at))}, schema=pa.schema([("label", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())]))

    found = rows.mapInArrow(count, "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    found = common.written(found, "trigrams")
    known = found.where((F.col("bucket") == -1) & (F.col("n") >= MIN_ROWS)).select("label")
    # As many rows as buckets and languages at most.
    found = found.join(known, "label", "left_semi").toPandas()
    out = {}
    for label, part in found.groupby("label"):
        out[label] = np.zeros(BUCKETS)
        out[label][part.bucket[part.bucket >= 0]] = part.n[part.bucket >= 0]
    return TrigramModel(out)


def _softmax(logs: Column) -> Column:
    high = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - high))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, y: a + y))


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared_col: str | None = "lang", host_col: str | None = "source",
    suffix: Column | None = None, sample: int = SAMPLE, trust: float = TRUST, kappa: float = KAPPA, min_p: float = MIN_P,
    model: TrigramModel | None = None,
) -> DataFrame:
    """A row for each row of ``docs``: its id, a hash of its text, language, posterior and verdict."""
    named = lambda c: F.col(c).cast("string") if c else F.lit(None).cast("string")
    held = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), named(declared_col).alias("declared"), named(host_col).alias("host"),
        (F.lit(None).cast("string") if suffix is None else suffix).alias("suffix"),
    )
    model = model or fitted(held.select("id", "text", "declared"), sample)
    languages, kind = model.languages, docs.schema[id_col].dataType.simpleString()

    def of(batch: pa.RecordBatch) -> Iterator[dict]:
        scores = [model.scores(x.as_py()) for x in batch.column(1)]
        yield {"id": batch.column(0), **{k: batch.column(i) for i, k in ((2, "copy"), (3, "declared"), (4, "host"), (5, "suffix"))}, "logs": scores}

    held = held.select("id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("copy"), "declared", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("suffix", F.lit("")).alias("suffix"))
    scored = common.written(common.by_batch(held, f"id {kind}, copy long, declared string, host string, suffix string, logs array<double>", of), "scores")
    scored = scored.withColumn("alone", F.when(F.col("logs").isNotNull(), _softmax(F.col("logs"))))
    sums = [F.sum(F.get("alone", i)).alias(f"s{i}") for i in range(len(languages))]
    hosts = scored.where("alone is not null").groupBy("suffix", "host").agg(*sums)
    spread = lambda name: F.array(*(F.coalesce(f"s{i}", F.lit(0.0)) for i in range(len(languages)))).alias(name)
    again = lambda df, *keys: df.groupBy(*keys).agg(*(F.sum(f"s{i}").alias(f"s{i}") for i in range(len(languages))))
    suffixes = again(hosts, "suffix").select(F.col("suffix").alias("x"), spread("of_suffix"))
    every = again(hosts).select(spread("of_all"))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, y: a + y)
    smooth = lambda own, above: F.zip_with(own, above, lambda n, p: (n + kappa * p) / (total(own) + kappa))
    even = F.array(*(F.lit(1.0 / len(languages)) for _ in languages))
    priors = hosts.select("suffix", "host", spread("of_host")).join(suffixes, F.col("suffix") == F.col("x")).crossJoin(F.broadcast(every))  # one row
    priors = priors.withColumn("above", smooth(F.col("of_suffix"), smooth(F.col("of_all"), even)))
    priors = common.written(priors.select(F.col("suffix").alias("x"), F.col("host").alias("h"), "of_host", "above"), "priors")
    out = scored.join(priors, (F.col("suffix") == F.col("x")) & (F.col("host") == F.col("h")), "left")
    # The host's other documents: without this one's share.
    others = F.zip_with("of_host", "alone", lambda n, own: F.greatest(n - own, F.lit(0.0)))
    out = out.withColumn("others", others)
    prior = F.transform(smooth(F.col("others"), F.col("above")), lambda p: F.log(p))
    wrong = (1 - trust) / max(1, len(languages) - 1)
    said = F.array(*(F.when(F.col("declared").isin(*languages[:-1]), F.log(F.when(F.col("declared") == k, F.lit(trust)).otherwise(F.lit(wrong)))).otherwise(F.lit(0.0)) for k in languages))
    out = out.withColumn("logs", F.zip_with(F.zip_with("logs", prior, lambda a, b: a + b), said, lambda a, b: a + b))
    out = out.withColumn("posterior", _softmax(F.col("logs")))
    best = F.array_max("posterior")
    name = F.coalesce(F.get(F.array(*map(F.lit, languages)), F.array_position("posterior", best).cast("int") - 1), F.lit(UND))
    out = out.select(F.col("id").alias(id_col), F.col("copy").alias("text_hash"), name.alias("language"), F.round(F.coalesce(best, F.lit(1.0)), 6).alias("probability"))
    return out.withColumn("kept", (F.col("language") != UND) & (F.col("probability") >= min_p))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(common.table(spark, sf_dir, "documents")).drop("text_hash")


def pages_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over ``pages``: markup language, host and address suffix; the model is fitted on the pages' own markup."""
    pages = common.table(spark, sf_dir, "pages")
    plain = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>", " "), r"(?s)<[^>]*>|&[a-z]+;", " ")
    host = F.lower(F.regexp_extract("url", r"://([^/?#]*)", 1))
    pages = pages.select("page_id", plain.alias("text"), F.lower(F.regexp_extract("html", r"""(?i)<html[^>]*\blang=["']?([a-z]+)""", 1)).alias("lang"), host.alias("source"))
    return identify(pages, "page_id", suffix=F.regexp_extract("source", r"([^.]*)$", 1)).drop("text_hash")
