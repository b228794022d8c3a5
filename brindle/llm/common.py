"""What the operators share: the shared folder, written intermediates, and Arrow helpers.

Intermediates go to the folder that the cluster names in ``spark.checkpoint.dir``: every
executor can read it, and a lost executor takes nothing with it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, [\x20\x09-\x0D].
SPACES = "\t\n\x0b\x0c\r "
#: Rows that a Python worker turns to objects at once.
PART = 500


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="brindle-")
        sc.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/llm/{tag}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, tag: str, codec: str = "zstd") -> DataFrame:
    """The same rows, written to the shared folder and read again: cuts lineage."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, df: DataFrame) -> None:
    """Delete a table that ``written`` made, once nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = shared_root(spark).split(":", 1)[-1].lstrip("/")
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        if root in folder and "/llm/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def _file(spark: SparkSession, path: str):
    """A path, and the file system that it is in."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    at, fs = _file(spark, path)
    fs.delete(at, True)


def read_file(spark: SparkSession, path: str) -> str:
    """A small text file of the shared folder."""
    return "\n".join(r.value for r in spark.read.option("wholetext", True).text(path).collect())


def replace_file(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a small file beside the old one, and put it in its place by one rename."""
    jvm = spark.sparkContext._jvm
    (new, fs), (now, _) = _file(spark, f"{path}.{uuid.uuid4().hex[:8]}"), _file(spark, path)
    stream = fs.create(new)
    stream.write(data)
    stream.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    new, now = fs.makeQualified(new), fs.makeQualified(now)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(new, now, options)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """These names, longer where the table has a column of that name already."""
    held, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in held:
            name += "_"
        held.add(name)
        out.append(name)
    return out


def words_of(text: Column) -> Column:
    """The words [^\\x20\\x09-\\x0D]+ of a text; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def by_batch(
    df: DataFrame, schema: str, rows: Callable[[pa.RecordBatch], Iterator[dict] | Iterator[pa.RecordBatch]]
) -> DataFrame:
    """``mapInArrow`` with a function of one batch that yields lists by column name.

    Batches are handed on in parts of PART rows, so that a worker holds few texts as objects.
    """
    fields = pa.schema(_arrow(df.sparkSession, schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PART):
                for out in rows(batch.slice(at, PART)):
                    yield pa.RecordBatch.from_pydict(out, schema=fields) if isinstance(out, dict) else out
        given_back()

    return df.mapInArrow(run, schema)


def given_back() -> None:
    """Memory that a task used goes back to the system, since its worker waits for the next stage with all it has."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def _arrow(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def utf8(column: pa.Array) -> list[bytes]:
    """A string column as bytes, a null as an empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _grouped(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Runs of equal values in the first column, in parts of at most ``limit`` rows."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        batch = batch if held is None else pa.concat_batches([held, batch])
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy()
        ends = np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys))
        start = 0
        for end in ends:
            last = end == len(keys)
            while end - start >= limit or (not last and end > start):
                n = min(limit, end - start)
                yield batch.slice(start, n)
                start += n
        held = batch.slice(start)
    if held is not None and held.num_rows:
        yield held


def in_groups(
    df: DataFrame, key: str, schema: str, fn: Callable[[pa.RecordBatch], dict | None], limit: int, whole: bool = False
) -> DataFrame:
    """``fn`` over the rows of each key (a long, the first column), in parts of ``limit`` rows.

    ``whole``: a group that would be cut is an error.
    """
    fields = _arrow(df.sparkSession, schema)
    size = 20_000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for part in _grouped(batches, limit):
            if whole and part.num_rows >= limit:
                raise RuntimeError(f"a group of {limit} rows or more")
            out = fn(part)
            if out is not None and len(out[fields.names[0]]):
                waiting.append(out)
                rows += len(out[fields.names[0]])
            if rows >= size:
                yield pa.RecordBatch.from_pydict({k: np.concatenate([w[k] for w in waiting]) for k in fields.names}, schema=fields)
                waiting, rows = [], 0
        if waiting:
            yield pa.RecordBatch.from_pydict({k: np.concatenate([w[k] for w in waiting]) for k in fields.names}, schema=fields)
            del waiting[:]
        given_back()

    return df.repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)
