"""A folder for what a query writes on its way: shared by the driver and all executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's own switch: whether a query's shuffle files go as soon as it has ended.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def work_folder(spark: SparkSession, kind: str = "work") -> str:
    """A new folder in the place that all executors share; of its own in a local session without one."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="brindle-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return f"{root.rstrip('/')}/{kind}/{uuid.uuid4().hex[:12]}"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile gives its shuffle files back at once; else they stay until the driver's garbage is collected."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREED) if before is None else spark.conf.set(_FREED, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table that was written: computed once, read by column, split over all cores."""
    path = f"{work_folder(df.sparkSession)}/{name}"
    with freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A part is of so many bytes of input at least, and there are so many parts at most, since each reads the input again.
PART_BYTES, MOST_PARTS = 32 << 20, 8


def parts(source: DataFrame) -> int:
    """In how many parts rows that follow from a table's files are made, so that the shuffles of one part alone are on disk."""
    size = int(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(1, min(MOST_PARTS, size // PART_BYTES))


def gathered(made: Iterable[DataFrame], name: str, key: Sequence[str]) -> DataFrame:
    """Rows that are made part by part as one written table, bucketed by key: what goes by the key needs no more shuffle.

    Each part is written, and gives its shuffle files back, before the next is begun.
    """
    path = table = None
    for df in made:
        spark = df.sparkSession
        if path is None:
            path = f"{work_folder(spark)}/{name}"
            table, buckets = f"brindle_{name}_{uuid.uuid4().hex[:12]}", int(spark.conf.get("spark.sql.shuffle.partitions"))
        with freed(spark):
            df.write.mode("append").bucketBy(buckets, *key).option("path", path).option("compression", "zstd").saveAsTable(table)
    return spark.table(table)
