"""Structured Streaming: what arrives is taken up once, and merged, counted or told apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.state import Store
from ..sources.work import work_folder  # noqa: F401 (for those that run streams)


def arriving(spark: SparkSession, folder: str, pattern: str, like: DataFrame, files_at_once: int = 64) -> DataFrame:
    """Parquet files of a folder as a stream; each is read once, whatever fails."""
    return spark.readStream.schema(like.schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_at_once).parquet(folder)


def delivered(rows: DataFrame, folder: str, part, parts: int) -> str:
    """Rows written as ``parts`` files that a stream reads one after the other, ``part`` (a column) saying which.

    Files are taken in the order of their times, so each is written after the one before.
    """
    for i in range(parts):
        rows.where(part == i).coalesce(1).write.mode("append").parquet(folder)
    return folder


def _timed(stream: DataFrame, time: str, late: str) -> DataFrame:
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)


def tumbling_counts(stream: DataFrame, time: str, width: str, *keys: str, late: str = "1 day", slide: str | None = None) -> DataFrame:
    """Counts by window and key; with ``slide`` windows overlap and a row counts in each that holds it.

    Rows later than the watermark are dropped from a window that closed.
    """
    window = F.window(time, width, slide) if slide else F.window(time, width)
    held = _timed(stream, time, late).groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n"))
    return held.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), *keys, "n")


def once(stream: DataFrame, time: str, *keys: str, late: str = "1 day") -> DataFrame:
    """The first row of each key to arrive; what is known of a key is forgotten once the watermark passes it."""
    return _timed(stream, time, late).dropDuplicatesWithinWatermark([*keys])


def _drained(query) -> None:
    query.trigger(availableNow=True).start().awaitTermination()


def run_to_table(stream: DataFrame, folder: str, mode: str = "complete") -> DataFrame:
    """Run all that is there now; in complete mode what the last batch left, else all batches' rows.

    A batch that is run again after a failure overwrites its own rows only.
    """
    spark, out = stream.sparkSession, f"{folder}/out"

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(out if mode == "complete" else f"{out}/batch={batch}")

    _drained(stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint"))
    rows = spark.read.parquet(out)
    return rows if mode == "complete" else rows.drop("batch")


def merged(stream: DataFrame, folder: str, table: str, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Batches merged into a versioned table, of each key the latest row by ``order``, whenever it arrived.

    Old and new rows are ranked together, so a row that comes late never replaces a later one, and
    one that differs in any column is taken if it is the later one; of rows that are equal in order
    the one that came first stays. A batch that is run again gives the same table.
    """
    store = Store(stream.sparkSession, f"{folder}/store")
    latest = Window.partitionBy(*key).orderBy(*(F.desc(c) for c in order), "_new")

    def take(df: DataFrame, batch: int) -> None:
        rows = df.withColumn("_new", F.lit(1))
        if store.exists(table):
            rows = store.read(table).withColumn("_new", F.lit(0)).unionByName(rows)
        store.publish({table: rows.withColumn("_place", F.row_number().over(latest)).where("_place = 1").drop("_place", "_new")})

    _drained(stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{folder}/checkpoint"))
    return store.read(table)


def announced(stream: DataFrame, folder: str, closed, reason: str) -> tuple[DataFrame, DataFrame]:
    """All rows, and those that ``closed`` (a column) says come too late: announced, never dropped."""
    store = Store(stream.sparkSession, f"{folder}/store")

    def take(df: DataFrame, batch: int) -> None:
        late = df.where(closed).withColumn("reason", F.lit(reason)).withColumn("batch", F.lit(batch).cast("long"))
        store.publish({f"rows_{batch}": df, f"late_{batch}": late})

    _drained(stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{folder}/checkpoint"))
    every = [[store.read(t) for t in store.tables() if t.startswith(kind)] for kind in ("rows_", "late_")]
    return tuple(_union(x) for x in every)


def retried(stream: DataFrame, folder: str, passes) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, and those still held: what a batch holds is tried again with every later one.

    ``passes`` is a function of a batch's rows and all rows that passed so far (None at first): a
    DataFrame of the same rows with a boolean ``ok``. Held rows are a table, not operator state, so
    nothing is forgotten however long they wait.
    """
    store = Store(stream.sparkSession, f"{folder}/store")

    def take(df: DataFrame, batch: int) -> None:
        if store.exists("done") and store.read("done").where(F.col("batch") == batch).limit(1).count():
            return  # run again after a failure that came later
        waiting = df.unionByName(store.read("held")) if store.exists("held") else df
        judged = passes(waiting, store.read("passed") if store.exists("passed") else None)
        mark = df.sparkSession.createDataFrame([(batch,)], "batch long")
        store.publish({"held": judged.where("not ok").drop("ok")}, {"passed": judged.where("ok").drop("ok"), "done": mark})

    _drained(stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{folder}/checkpoint"))
    return store.read("passed"), store.read("held")


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
