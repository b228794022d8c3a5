"""Substring dedup with a log-structured index of window fingerprints.

A window is WINDOW consecutive words of a document. A window that also starts in a document with
a smaller id is removed with all its words. The index holds no window of its own but anchors:
among the GRAM-word hashes within a window the smallest, the last of equal ones, is the window's
anchor, so equal windows have equal anchors at equal places. Consecutive windows of one anchor are
one entry: the anchor's hash, a digest of 128 bits of the words that they cover, the document and
the windows. Entries number about 2 / (WINDOW - GRAM + 2) a word.

Each batch of documents is flushed as an immutable run: a table bucketed and sorted by anchor that
holds the first document of each (anchor, digest). Then the batch is merge-joined with all runs,
which stay where they are; only the batch's anchors are shuffled to their buckets:

1. anchors that stand in documents of different ids survive, all others drop out;
2. entries with an equal anchor and digest as one of a smaller document are covered as a whole;
3. of an anchor that stands in several spans each span's first document is verified window by window:
   its text is read again, its windows are digested from their words to 128 bits, and those that a
   smaller document has are covered.

More than FANOUT runs of one level are compacted to one run of the next, which keeps the first
document of each (anchor, digest). The index is a folder: a manifest, replaced by one rename after
what it names was written, lists the runs and the texts, so another session opens it and goes on.

A hot passage costs a row a run and span, since a run holds first documents only, and minima are
combined before they are shuffled. The spans of one anchor are dealt over SALT buckets. What goes
back to the entries of all documents does so by plain shuffled joins, which Spark splits where a key
is hot. Texts are shuffled once, to buckets of their ids, and meet their marks there.

Batches have to come in ascending order of ids; what an earlier batch returned is not revised.

Defined results: a null id is compared with nothing and loses nothing; a null or empty text has no
words; a text shorter than a window loses nothing; rows of one id don't remove each other's windows,
and each of them, equal or not, is judged by its own text; an empty table gives an empty table;
other columns are not read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .shingles import grams, word_hashes

WINDOW, GRAM = 50, 10
#: Runs of a level that are kept side by side, and buckets over which an anchor's spans are dealt.
FANOUT, SALT = 2, 4
#: The query's batches, by ranges of ids: enough of them that runs are compacted.
BATCHES = 4


class Words:
    """The words of a text, and digests of runs of them."""

    def __init__(self, text: bytes):
        self.words = text.split()
        self.joined = b" ".join(self.words)
        self.begin = np.concatenate([[0], np.cumsum(np.fromiter(map(len, self.words), np.int64, len(self.words)) + 1)])

    def digests(self, first: np.ndarray, words: np.ndarray | int) -> np.ndarray:
        """Two longs for each run of ``words`` words from ``first`` on."""
        joined, digest = self.joined, xxhash.xxh3_128_digest
        start, end = self.begin[first].tolist(), (self.begin[first + words] - 1).tolist()
        return np.frombuffer(b"".join([digest(joined[a:b]) for a, b in zip(start, end, strict=True)]), np.int64).reshape(-1, 2)


def entries_of(text: bytes, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(first window, windows, anchor, digest of two longs) of each entry of a document."""
    hashes = word_hashes(text)
    n = len(hashes) - window + 1
    if n <= 0:
        e = np.empty(0, np.int32)
        return e, e, e.astype(np.int64), np.empty((0, 2), np.int64)
    hashes = grams(hashes, gram)
    wide = window - gram + 1
    back = hashes[::-1].copy()  # the first of equal minima is then the last
    at = (wide - 1 - np.lib.stride_tricks.sliding_window_view(back, wide).argmin(axis=1))[::-1] + np.arange(n)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    count = np.diff(np.concatenate([first, [n]]))
    # Equal words have their anchor at an equal place, so the digest needs nothing more.
    return first.astype(np.int32), count.astype(np.int32), hashes[at[first]].view(np.int64), Words(text).digests(first, count + window - 1)


def entries(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """(id, copy, first, n, anchor, high, low) for all documents (id, copy, text)."""
    kind = texts.schema["id"].dataType.simpleString()

    def of(batch: pa.RecordBatch) -> Iterator[dict]:
        found, sizes = [], []
        for x in batch.column(2).cast(pa.binary()):
            found.append(entries_of(x.as_py() or b"", window, gram))
            sizes.append(len(found[-1][0]))
        if found:
            rows = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            first, n, anchor, digest = (np.concatenate(c) for c in zip(*found, strict=True))
            yield {"id": batch.column(0).take(rows), "copy": batch.column(1).take(rows), "first": first, "n": n, "anchor": anchor, "high": digest[:, 0], "low": digest[:, 1]}

    return common.by_batch(texts.select("id", "copy", "text"), f"id {kind}, copy long, first int, n int, anchor long, high long, low long", of)


def windows_of(marks: list[dict], words: int, window: int) -> np.ndarray:
    """The windows that a document's marks name."""
    at = np.concatenate([np.empty(0, np.int64), *(np.arange(m["first"], m["first"] + m["n"]) for m in marks)])
    return np.unique(at[at <= words - window])


def judged(words: list[bytes], covered: np.ndarray, window: int) -> tuple[int, bytes]:
    """How many words the covered windows remove, and those that are left, joined."""
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, covered, 1)
    np.add.at(gone, covered + window, -1)
    gone = np.cumsum(gone[:-1]) > 0
    return int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def _bucket(anchor: str, salt: Column) -> Column:
    return F.xxhash64(F.col(anchor), salt)


class FingerprintIndex:
    """Runs of entries and the texts that they were made of, in a folder that sessions share."""

    def __init__(self, spark: SparkSession, root: str | None = None, window: int = WINDOW, gram: int = GRAM, fanout: int = FANOUT):
        """An index in a new folder. Tables get as many buckets as the session has shuffle partitions."""
        self.spark, self.root = spark, (root or common.shared_path(spark, "index")).rstrip("/")
        self.window, self.gram, self.fanout = window, gram, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[dict] = []  # name, columns, order and level
        self.texts: list[dict] = []

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> FingerprintIndex:
        """The index that another session left in a folder."""
        said = json.loads(common.read_file(spark, f"{root.rstrip('/')}/MANIFEST.json"))
        out = cls(spark, root, said["window"], said["gram"], said["fanout"])
        out.buckets, out.runs, out.texts = said["buckets"], said["runs"], said["texts"]
        return out

    def save(self) -> None:
        """Name what counts; before and after it readers see a whole index."""
        said = {k: getattr(self, k) for k in ("window", "gram", "fanout", "buckets", "runs", "texts")}
        common.replace_file(self.spark, f"{self.root}/MANIFEST.json", json.dumps(said, sort_keys=True).encode())

    # --- tables

    def _put(self, df: DataFrame, by: list[str], order: list[str], tag: str, level: int = 0) -> dict:
        """Write a table bucketed by some columns and sorted in each bucket, if an order is given."""
        name = f"brindle_{tag}_{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/{name}"
        rows = df.repartition(self.buckets, *by).write.bucketBy(self.buckets, *by).option("path", path).option("compression", "zstd")
        if order:
            rows.sortBy(*order).saveAsTable(name)
            return self._table(name, by, order, df, level)
        # A task has one bucket and writes it as rows come; without this Spark would sort texts by bucket first.
        key = "spark.sql.maxConcurrentOutputFileWriters"
        before = self.spark.conf.get(key, "0")
        self.spark.conf.set(key, "2")
        try:
            rows.saveAsTable(name)
        finally:
            self.spark.conf.set(key, before)
        return self._table(name, by, order, df, level)

    @staticmethod
    def _table(name: str, by: list[str], order: list[str], df: DataFrame, level: int) -> dict:
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
        return {"name": name, "by": by, "order": order, "ddl": ddl, "level": level}

    def _get(self, table: dict) -> DataFrame:
        """A table, made known to this session if another one wrote it."""
        name = table["name"]
        if not self.spark.catalog.tableExists(name):
            by, order = ", ".join(table["by"]), f"sorted by ({', '.join(table['order'])})" if table["order"] else ""
            self.spark.sql(
                f"create table {name} ({table['ddl']}) using parquet clustered by ({by}) {order} into {self.buckets} buckets location '{self.root}/{name}'"
            )
        return self.spark.table(name)

    def _drop(self, table: dict) -> None:
        self.spark.sql(f"drop table if exists {table['name']}")
        common.delete(self.spark, f"{self.root}/{table['name']}")

    def drop_runs(self) -> None:
        """Give up the runs, as after a load that nothing will follow; results stay readable."""
        for run in self.runs:
            self._drop(run)
        self.runs = []
        self.save()

    # --- batches

    def add(self, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Index a batch; a row for each of its rows: id, copy, words, removed words and what is left.

        The text that is left is its words joined by one space, in column ``kept``; ``copy`` is the
        xxhash64 of the text (null: of the empty one), which tells rows of one id apart.
        """
        docs = batch.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        docs = docs.select("id", F.xxhash64("text").alias("copy"), "text")
        texts = self._put(docs.where("id is not null"), ["id", "copy"], [], "texts")
        every = common.written(entries(self._get(texts), self.window, self.gram), "entries")
        run = self._put(self._firsts(every), ["bucket"], ["bucket", "high", "low"], "run")
        marks = self._merged(every, run, texts)
        out = self._applied(self._get(texts), marks).unionByName(self._applied(docs.where("id is null"), None))
        self.runs.append(run)
        self.texts.append(texts)
        self.save()
        self.compact()
        return out.withColumnRenamed("id", id_col)

    def _firsts(self, rows: DataFrame) -> DataFrame:
        """The first document and place of each (anchor, digest), and the last document."""
        last = "last" if "last" in rows.columns else "id"
        out = rows.groupBy("anchor", "high", "low").agg(F.min(F.struct("id", "copy", "first", "n")).alias("e"), F.max(last).alias("last"))
        return out.select(_bucket("anchor", F.pmod("low", F.lit(SALT))).alias("bucket"), "anchor", "high", "low", "e.*", "last")

    def compact(self) -> None:
        """Merge the runs of each level that has more than ``fanout`` of them to one of the next."""
        level = 0
        while level <= max((r["level"] for r in self.runs), default=-1):
            part = [r for r in self.runs if r["level"] == level]
            if len(part) > self.fanout:
                merged = self._firsts(reduce(DataFrame.unionByName, map(self._get, part)))
                self.runs = [r for r in self.runs if r["level"] != level]
                self.runs.append(self._put(merged, ["bucket"], ["bucket", "high", "low"], "run", level + 1))
                self.save()
                for r in part:
                    self._drop(r)
            level += 1

    def met(self, run: dict) -> DataFrame:
        """Rows of earlier runs whose anchor the new run has: merge joins by bucket, no run is shuffled."""
        anchors = self._get(run).groupBy("anchor").agg(F.lit(1).alias("one")).select("anchor", F.explode(F.sequence(*(F.lit(i).cast("long") for i in (0, SALT - 1)))).alias("salt"))
        asked = anchors.select(_bucket("anchor", F.col("salt")).alias("b"))
        join = lambda old: old.hint("merge").join(asked, F.col("bucket") == F.col("b")).select(*old.columns)
        return reduce(DataFrame.unionByName, [join(self._get(r)) for r in self.runs])

    def _merged(self, every: DataFrame, run: dict, texts: dict) -> DataFrame:
        """(id, copy, marks): the windows of the batch that are covered."""
        old = common.written(self.met(run), "met") if self.runs else None
        rows = self._get(run).withColumn("new", F.lit(True))
        rows = rows if old is None else rows.unionByName(old.withColumn("new", F.lit(False)))
        span = F.struct("high", "low")
        seen = rows.groupBy("anchor").agg(F.min("id").alias("least"), F.max("last").alias("most"), F.min(span).alias("x"), F.max(span).alias("y"))
        seen = seen.where("least < most").select(F.col("anchor").alias("a"), (F.col("x") != F.col("y")).alias("many"))
        shared = rows.join(seen, F.col("anchor") == F.col("a"))
        firsts = shared.groupBy("anchor", "high", "low").agg(F.min(F.struct("id", "copy", "first", "n", "new")).alias("e"), F.first("many").alias("many"))
        firsts = common.written(firsts, "firsts")
        known = firsts.select(F.col("anchor").alias("a"), F.col("high").alias("h"), F.col("low").alias("l"), F.col("e.id").alias("before"), "many")
        same = (F.col("anchor") == F.col("a")) & (F.col("high") == F.col("h")) & (F.col("low") == F.col("l"))
        found = every.join(known, same).select("id", "copy", "first", "n", (F.col("before") < F.col("id")).alias("covered"), "many")
        found = common.written(found.where("covered or many"), "found")
        covered = found.where("covered").select("id", "copy", "first", "n")
        # All places of a span in its first document, since all of them may be covered window by window.
        asked = found.where("not covered").select("id", "copy", "first", "n").unionByName(firsts.where("many and not e.new").select("e.id", "e.copy", "e.first", "e.n"))
        windows = common.written(self._windows(asked, [*self.texts, texts]), "windows")
        least = windows.groupBy("high", "low").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
        least = least.select(F.col("high").alias("h"), F.col("low").alias("l"), "least")
        verified = windows.join(least, (F.col("high") == F.col("h")) & (F.col("low") == F.col("l"))).where("least < id")
        marks = covered.unionByName(verified.select("id", "copy", "first", F.lit(1).alias("n")))
        # Of earlier documents there may be marks too; they meet no text of this batch.
        marks = marks.groupBy("id", "copy").agg(F.collect_list(F.struct("first", "n")).alias("marks"))
        marks = common.written(marks, "marks")
        for df in (every, old, firsts, found, windows):
            if df is not None:
                common.removed(self.spark, df)
        return marks

    def _windows(self, spans: DataFrame, tables: list[dict]) -> DataFrame:
        """(id, copy, first, high, low): digests of all windows of the spans, from their texts."""
        window = self.window
        asked = spans.groupBy("id", "copy").agg(F.collect_list(F.struct("first", "n")).alias("marks"))
        asked = common.written(asked, "asked")
        kind = spans.schema["id"].dataType.simpleString()

        def digested(batch: pa.RecordBatch) -> Iterator[dict]:
            for i, x in enumerate(common.utf8(batch.column(2))):
                words = Words(x)
                at = windows_of(batch.column(3)[i].as_py(), len(words.words), window)
                digest, row = words.digests(at, window), pa.array(np.full(len(at), i))
                yield {"id": batch.column(0).take(row), "copy": batch.column(1).take(row), "first": at.astype(np.int32), "high": digest[:, 0], "low": digest[:, 1]}

        held = reduce(DataFrame.unionByName, [self._marked(self._get(t), asked, "inner") for t in tables])
        return common.by_batch(held, f"id {kind}, copy long, first int, high long, low long", digested)

    @staticmethod
    def _marked(texts: DataFrame, marks: DataFrame, how: str) -> DataFrame:
        """Texts with their marks; the texts stay in their buckets, the marks come to them."""
        marks = marks.select(F.col("id").alias("i"), F.col("copy").alias("c"), "marks").hint("shuffle_hash")
        return texts.join(marks, (F.col("id") == F.col("i")) & (F.col("copy") == F.col("c")), how).select("id", "copy", "text", "marks")

    def _applied(self, texts: DataFrame, marks: DataFrame | None) -> DataFrame:
        """Each text's words, how many are removed, and what is left."""
        window, kind = self.window, texts.schema["id"].dataType.simpleString()
        if marks is None:
            texts = texts.withColumn("marks", F.lit(None).cast("array<struct<first:int,n:int>>"))
        else:
            # One row of each text is marked; repeated rows get the same marks.
            texts = self._marked(texts, marks, "left")

        def applied(batch: pa.RecordBatch) -> Iterator[dict]:
            out: dict[str, list] = {"words": [], "removed": [], "kept": []}
            for i, x in enumerate(common.utf8(batch.column(2))):
                words, marks = x.split(), batch.column(3)[i].as_py()
                removed, kept = judged(words, windows_of(marks, len(words), window), window) if marks else (0, b" ".join(words))
                for k, v in zip(out, (len(words), removed, kept), strict=True):
                    out[k].append(v)
            yield {"id": batch.column(0), "copy": batch.column(1), **out, "kept": pa.array(out["kept"], pa.binary()).cast(pa.string())}

        return common.by_batch(texts.select("id", "copy", "text", "marks"), f"id {kind}, copy long, words long, removed long, kept string", applied)


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES, window: int = WINDOW, gram: int = GRAM, fanout: int = FANOUT
) -> DataFrame:
    """Load documents into a new index, in ``batches`` ranges of ids, the smaller ids first."""
    index = FingerprintIndex(docs.sparkSession, None, window, gram, fanout)
    cuts = docs.select(F.percentile_approx(id_col, [k / batches for k in range(1, batches)])).first()[0] if batches > 1 else None
    cuts = sorted(set(cuts or []))
    key, out = F.col(id_col), []
    for i, (low, high) in enumerate(zip([None, *cuts], [*cuts, None], strict=True)):
        held = (F.lit(True) if low is None else key > low) & (F.lit(True) if high is None else key <= high)
        out.append(index.add(docs.where(held | key.isNull() if i == 0 else held), id_col, text_col))
    index.drop_runs()
    return reduce(DataFrame.unionByName, out)


def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(common.table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", F.col("words").alias("n_words"), F.col("removed").alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def op2_sql() -> str:
    """The same in DuckDB SQL."""
    return f"""
    with d as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
    v as (select doc_id, i, array_to_string(w[i : i + {WINDOW - 1}], ' ') as run from (select doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) as i from d where len(w) >= {WINDOW}) x),
    f as (select run, min(doc_id) as first from v group by run having count(distinct doc_id) > 1),
    c as (select distinct v.doc_id, unnest(range(i, i + {WINDOW})) as k from v join f on f.run = v.run where f.first < v.doc_id),
    e as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as k from d),
    l as (select e.doc_id, count(c.k) as n_removed, string_agg(case when c.k is null then word end, ' ' order by e.k) as left_over from e left join c on c.doc_id = e.doc_id and c.k = e.k group by e.doc_id)
    select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(left_over, '')) as kept_sha256 from d left join l on l.doc_id = d.doc_id
    """
