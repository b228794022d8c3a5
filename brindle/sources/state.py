"""Versioned tables: every write is a new folder, and one pointer file says which ones count.

A table is one folder or several. A publish writes all of its folders first and then replaces the
pointer, so readers see all of the new tables or none; what only grows gets a folder more and is
never rewritten. A run that dies leaves folders that nothing points to.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

#: A table that grew by more folders than this is written as one at its next growth.
FOLDERS = 200


class Store:
    """Tables by name below a root that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)
        self._fs.mkdirs(self._path(self.root))

    @property
    def pointer(self) -> dict[str, list[str]]:
        """The folders of each table's current version."""
        at = self._path(f"{self.root}/CURRENT.json")
        if not self._fs.exists(at):
            return {}
        stream = self._fs.open(at)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def exists(self, table: str) -> bool:
        return table in self.pointer

    def tables(self) -> list[str]:
        return sorted(self.pointer)

    def read(self, table: str, schema: str | None = None) -> DataFrame:
        """A table; one that isn't there is empty if a schema is given for it.

        Folders of one table may have more columns the later they were written.
        """
        folders = self.pointer.get(table)
        if folders:
            return self.spark.read.option("mergeSchema", len(folders) > 1).parquet(*folders)
        if schema is None:
            raise AnalysisException(f"no table {table}")
        return self.spark.createDataFrame([], schema)

    def publish(self, tables: Mapping[str, DataFrame], grown: Mapping[str, DataFrame] | None = None, gone: Sequence[str] = ()) -> dict[str, list[str]]:
        """Replace tables, add to those ``grown``, forget those ``gone``: all at once.

        A table may be computed from its old version.
        """
        held = self.pointer
        for name, df in tables.items():
            held[name] = [self._written(name, df)]
        for name, df in (grown or {}).items():
            if len(held.get(name, ())) >= FOLDERS:
                df = self.spark.read.option("mergeSchema", True).parquet(*held.pop(name)).unionByName(df, allowMissingColumns=True)
            held[name] = [*held.get(name, ()), self._written(name, df)]
        for name in gone:
            held.pop(name, None)
        self._point(held)
        return held

    def append(self, table: str, df: DataFrame) -> None:
        """Add rows to a table that only grows."""
        self.publish({}, {table: df})

    def adopt(self, tables: Mapping[str, str], grown: Mapping[str, DataFrame] | None = None) -> None:
        """Put tables in the place of others, by name, and add to those ``grown``: all at once."""
        more = {name: self._written(name, df) for name, df in (grown or {}).items()}
        held = self.pointer
        for name, ready in tables.items():
            held[name] = held.pop(ready)
        for name, path in more.items():
            held[name] = [*held.get(name, ()), path]
        self._point(held)

    def snapshot(self, table: str, name: str) -> None:
        """Keep the current version of a table under another name; nothing is copied, folders never change."""
        self._point(self.pointer | {name: self.pointer[table]})

    def _written(self, name: str, df: DataFrame) -> str:
        path = f"{self.root}/{name}/v={uuid.uuid4().hex[:12]}"
        df.write.parquet(path)
        return path

    def _point(self, tables: dict[str, list[str]]) -> None:
        """Replace the pointer in one rename."""
        jvm = self.spark.sparkContext._jvm
        new, now = (self._fs.makeQualified(self._path(f"{self.root}/{n}")) for n in (f"CURRENT.{uuid.uuid4().hex[:8]}", "CURRENT.json"))
        stream = self._fs.create(new)
        stream.write(json.dumps(tables, sort_keys=True).encode())
        stream.close()
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), self._conf).rename(new, now, options)
