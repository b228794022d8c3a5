"""The corpus pipeline: documents through language ID, near-dedup, substring dedup, PII, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a
DataFrame; all but the last return the columns of ``documents``, and any others that came with
them, unchanged but for ``text`` and ``n_chars``. ``run`` writes each stage's rows as Parquet to
the shared folder and reads them again for the next one.

A row is told apart by its id and its text, so rows of one id with different texts are judged one by
one; rows that are equal in both get equal decisions and stay or go together. A null id is a value
like others here. An empty table gives an empty table at every stage. Columns of any name may stand
beside those that a stage reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import common, langid, minhash, packing, pii, substring


def _same(docs: DataFrame, key: str, copy: str) -> Column:
    """That a row has the id and the text (by its hash) of another table's columns."""
    return F.col("doc_id").eqNullSafe(F.col(key)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(copy))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known.

    A null or empty text, or one without letters, is of no known language and goes; texts of any
    length are judged whole; of languages with equal posteriors the first by name is taken.
    """
    key, copy = common.fresh(docs, "key", "copy")
    good = langid.identify(docs).where("kept").select(F.col("doc_id").alias(key), F.col("text_hash").alias(copy)).distinct()
    return docs.join(good, _same(docs, key, copy), "left_semi")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that of the smallest id.

    Texts without words (null, empty, white space) and rows of a null id are in no class and stay.
    """
    key, copy = common.fresh(docs, "key", "copy")
    kept = minhash.classes(docs).where("kept").select(F.col("doc_id").alias(key), F.col("copy").alias(copy)).distinct()
    return docs.join(kept, _same(docs, key, copy), "left_semi")


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; one of which nothing is left goes.

    A document that loses nothing keeps its text as it is, null and empty ones and those of a null
    id among them; of others the words left are joined by one space. Of equal passages that of the
    smallest id stays.
    """
    key, copy, rest = common.fresh(docs, "key", "copy", "rest")
    cut = substring.dedup(docs).where("removed > 0").select(F.col("doc_id").alias(key), F.col("copy").alias(copy), F.col("kept").alias(rest)).dropDuplicates([key, copy])
    out = docs.join(cut, _same(docs, key, copy), "left").where(F.col(key).isNull() | (F.col(rest) != ""))
    chars = F.when(F.col(key).isNull(), F.col("n_chars")).otherwise(F.length(rest).cast("long"))
    return out.withColumns({"text": F.coalesce(rest, "text"), "n_chars": chars}).select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; a null text stays null, with null characters."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids; a null or empty text is its end id alone, repeated rows are packed one by one."""
    return packing.digests(packing.pack(docs))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("passages", passages),
    ("personal_data", personal_data),
    ("packed", packed),
]

#: SQL can't express a language model, a tokenizer or packing; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
