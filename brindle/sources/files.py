"""Supplier files: discovery, landing, exact CSV, layouts, raw rows, and the sinks."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.contracts import Contract, Source

ROWS = "path string, header array<string>, row_num int, width int, fields array<string>"
#: A file is read as one value; Spark holds none of more bytes.
LARGEST = 2_000_000_000


def listed(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Files below a folder, with their arrival: a date in the path, or else the day they were written.

    Nothing of the files is read.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    dated = F.to_date(F.try_to_timestamp(F.regexp_extract("path", r"/([0-9]{4}-[0-9]{2}-[0-9]{2})/", 1), F.lit("yyyy-MM-dd")))
    arrival = F.coalesce(dated, F.to_date("modificationTime")).alias("arrival")
    return found.select("path", F.regexp_extract("path", "([^/]+)$", 1).alias("name"), arrival, "length", F.col("modificationTime").alias("modified"))


def contents(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, content) of some files, each read once."""
    return spark.read.format("binaryFile").load([*paths]).select("path", "content")


def discovered(spark: SparkSession, folder: str, pattern: str = "*", with_content: bool = False) -> DataFrame:
    """Files below a folder with their checksums; a file of more than LARGEST bytes has none."""
    out = listed(spark, folder, pattern)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    found = found.where(F.col("length") <= LARGEST).select(F.col("path").alias("p"), F.sha2("content", 256).alias("sha256"), *(["content"] if with_content else []))
    return out.join(found, F.col("path") == F.col("p"), "left").drop("p", "modified")


def deliveries(files: DataFrame, sources: Sequence[Source], as_of) -> DataFrame:
    """Files that a source's pattern names and that had arrived: their source, extract date and redelivery."""
    part = lambda s, name: F.regexp_extract("name", s.file_pattern.replace("(?P<", "(?<"), _group_number(s.file_pattern, name)) if f"(?P<{name}>" in s.file_pattern else F.lit("")
    of = lambda make: F.coalesce(*(F.when(F.col("name").rlike(s.file_pattern.replace("(?P<", "(?<")), make(s)) for s in sources))
    out = files.where(F.col("arrival") <= F.lit(as_of)).withColumn("source", of(lambda s: F.lit(s.name))).where("source is not null")
    extract = F.to_date(F.try_to_timestamp(of(lambda s: part(s, "extract")), F.lit("yyyyMMdd")))
    again = F.coalesce(F.nullif(of(lambda s: part(s, "redelivery")), F.lit("")).try_cast("int"), F.lit(0))
    return out.withColumn("extract_date", extract).withColumn("redelivery", again)


def _group_number(pattern: str, name: str) -> int:
    import re

    return re.compile(pattern).groupindex[name]


def landed(spark: SparkSession, path: str, folder: str, name: str, digest: str) -> str:
    """Copy a file to a folder, never over another one; where it lies now.

    The same bytes are not copied again; other bytes of that name get their digest in the name.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new = jvm.org.apache.hadoop.fs.Path
    stem, dot, end = name.rpartition(".")
    source, plain, marked = new(path), new(f"{folder}/{name}"), new(f"{folder}/{stem}.{digest[:8]}{dot}{end}")
    to = plain.getFileSystem(conf)
    target = plain
    if to.exists(plain):
        said = spark.read.format("binaryFile").load(str(plain.toString())).select(F.sha2("content", 256)).first()[0]
        target = plain if said == digest else marked
    if not to.exists(target):
        jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, to, target, False, conf)
    return str(to.makeQualified(target).toString())


def csv_rows(files: DataFrame) -> DataFrame:
    """Every data row of CSV files (path, content), one file a task; its rows are handed on as they are read.

    Rows are numbered from 1 and blank lines count; a row of another width than the header is
    returned as it is, with its width. A mark of byte order and blanks around names are dropped.
    """

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frame = lambda held: pd.DataFrame(held, columns=["path", "header", "row_num", "width", "fields"])
        for part in parts:
            for path, content in zip(part["path"], part["content"], strict=True):
                lines = csv.reader(io.TextIOWrapper(io.BytesIO(content), encoding="utf-8-sig", newline=""))
                header = [h.strip() for h in next(lines, [])]
                # The header is a row of its own, so a file without data rows has one too.
                held = [(path, header, 0, len(header), header)]
                for n, fields in enumerate(lines, 1):
                    if fields:
                        held.append((path, header, n, len(fields), fields))
                    if len(held) >= 5000:
                        yield frame(held)
                        held = []
                yield frame(held)

    return files.select("path", "content").mapInPandas(read, ROWS)


def canonical(rows: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Rows under their canonical names as text, absent columns as nulls; and the rows of wrong width.

    ``rows`` has the columns of ``csv_rows``, and load_id, source and layout (version) of its file;
    every registered layout is a case of one expression, so files of all layouts are read in one pass.
    """
    rows = rows.where("row_num > 0")
    place = lambda name: F.array_position("header", name).cast("int") - 1
    cases = [(s, x, (F.col("source") == s.name) & (F.col("layout") == x.version)) for s in contract.sources for x in s.layouts]

    def column(canon: str):
        said = [F.when(when, F.get("fields", place({v: k for k, v in x.columns.items()}[canon]))) for _, x, when in cases if canon in x.columns.values()]
        return F.coalesce(*said).alias(canon)

    fits = F.col("width") == F.size("header")
    good = rows.where(fits).select(*map(column, contract.text_columns), "load_id", "row_num", "layout")
    shape = F.concat(F.col("width").cast("string"), F.lit(" fields, "), F.size("header").cast("string"), F.lit(" expected"))
    bad = rows.where(~fits).select("load_id", "row_num", F.lit("ROW-SHAPE").alias("rule_id"), F.lit("quarantine").alias("action"), shape.alias("detail"))
    return good, bad


# --- sinks


def to_csv(df: DataFrame, path: str) -> None:
    """One CSV file in a folder, ordered by all columns. For results that people read."""
    df.orderBy(*df.columns).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def to_json_lines(documents: DataFrame, path: str) -> None:
    """Documents as JSON Lines in order of their id."""
    documents.orderBy("_id").write.mode("overwrite").json(path)


def from_json_lines(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)
