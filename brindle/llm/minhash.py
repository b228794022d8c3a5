"""Near-duplicates by DartMinHash signatures and banded joins.

Each distinct five-word shingle of a text is an element of weight 1, however often it stands there:
pairs are verified on shingle sets, so signatures are drawn for sets. An element's region in the
plane of weight and rank is thrown full of hashed darts: for every dyadic strip of weight, darts
come in order of rank with exponential gaps, as of a Poisson process whose randomness is a hash of
(shingle, strip, dart). A dart that lies above the element's weight misses. Every dart belongs to
one of K coordinates by its hash; the signature keeps the earliest dart of each coordinate, so two
texts agree at a coordinate with the probability of their weighted Jaccard similarity, which at
weight 1 is the plain one. Ranks need
to be looked at only up to about K (ln K + 4) / total weight, which a sparse text reaches with few
darts; where a coordinate stays empty, that text's limit is doubled.

Signatures are cut into BANDS bands of ROWS coordinates. Texts with equal words are one class
with the smallest id as representative, so copies are never paired. Among representatives:

1. every member of a band's bucket is paired with the bucket's smallest id;
2. pairs are verified on the texts (plain Jaccard of the shingle sets >= THRESHOLD) and linked;
   components follow;
3. what is left are pairs of one bucket in different components. Buckets of up to SMALL texts yield
   all of those to be verified. Larger ones are joined into families (texts that share a large
   bucket, directly or by others); a family's texts are compared exactly, block by block, texts of
   too different sizes apart, and of the links found a block returns a spanning forest only. A block
   has a SPREADth of its family, BLOCK texts at least and LARGEST at most, and a text goes to each of
   its family's blocks: up to SPREAD * LARGEST texts of a family of like sizes what is shuffled grows
   with their number, beyond that with its square, as the comparing does from the start. Pairs
   within a component need no check, since they can't change a class. Components are then
   computed again over all links.

Two texts at the threshold share no band with a probability of 7e-5 (less above it); nothing else
is lost, and no bucket is cut off.

Defined results: a null id, and a text without words (null, empty, white space), is in no class
but its own (class null for a null id) and is kept; a text of fewer than five words has all its
words as its one shingle; repeated rows get the same class, one row each, and are told apart from
other copies only by their id; of rows of one id with different texts each is judged by its own, but
only one of them (of the smallest digest) can link the id's class to others; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import components
from .shingles import jaccard, mix, shingles, word_hashes

THRESHOLD = 0.8
BANDS, ROWS = 24, 5
#: A bucket of more texts yields no pairs; its family is compared in some SPREAD blocks of BLOCK to LARGEST texts.
SMALL = 64
BLOCK, SPREAD, LARGEST = 512, 16, 2048
#: Elements whose darts are thrown at once.
SLICE = 300_000


def signatures(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, k: int) -> np.ndarray:
    """An n x k array: the earliest dart of each coordinate of each owner with elements."""
    best, out = np.full(n * k, np.inf), np.zeros(n * k, np.uint64)
    total = np.bincount(owner, weights, n)
    limit = np.divide(k * (math.log(k) + 4), total, out=np.zeros(n), where=total > 0)
    todo = total > 0
    while todo.any():
        held = todo[owner]
        for at in range(0, len(elements), SLICE):
            part = slice(at, at + SLICE)
            _throw(elements[part][held[part]], weights[part][held[part]], owner[part][held[part]], limit, best, out, k)
        empty = np.isinf(best.reshape(n, k)).any(axis=1) & todo
        limit[empty] *= 2
        todo = empty
    return out.reshape(n, k)


def _throw(elements, weights, owner, limit, best, out, k) -> None:
    low, width, strip = 0.0, 1.0, 0
    while len(elements):
        e, w, o = elements, weights, owner
        rank, dart = np.zeros(len(e)), np.uint64(0)
        base = mix(e + np.array(strip + 1, np.uint64) * np.uint64(0xD1B54A32D192ED03))
        while len(e):
            dart += np.uint64(1)
            with np.errstate(over="ignore"):
                h = mix(base + dart * np.uint64(0x9E3779B97F4A7C15))
            rank = rank - np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / width
            near = rank < limit[o]
            e, w, o, rank, base, h = e[near], w[near], o[near], rank[near], base[near], h[near]
            where = mix(h ^ np.uint64(0xA0761D6478BD642F))
            hit = low + width * ((where >> np.uint64(32)).astype(np.float64) * 2.0**-32) < w
            at = o[hit] * k + ((where[hit] & np.uint64(0xFFFFFFFF)) % np.uint64(k)).astype(np.int64)
            r = rank[hit]
            np.minimum.at(best, at, r)
            won = best[at] == r
            out[at[won]] = h[hit][won]
        low, width, strip = (1.0, 1.0, 1) if strip == 0 else (low + width, 2 * width, strip + 1)
        more = weights > low
        elements, weights, owner = elements[more], weights[more], owner[more]


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """An n x bands array of hashes, one for each band of each signature."""
    parts = signature.reshape(len(signature), bands, rows)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB), parts.shape[:2]).copy()
    for i in range(rows):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return out


def signed(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    """(id, copy, words, size, high, low, bands): a hash of the text, counts of words and shingles, a digest of the words, the bands."""
    kind = docs.schema[id_col].dataType.simpleString()

    def of(batch: pa.RecordBatch) -> Iterator[dict]:
        at, ids, texts = 0, batch.column(0), batch.column(1).cast(pa.binary())
        while at < batch.num_rows:
            held: dict[str, list] = {"words": [], "size": [], "high": [], "low": []}
            elements, sizes, first = [], [], at
            while at < batch.num_rows and sum(sizes) < SLICE and len(sizes) < 500:
                text = texts[at].as_py() or b""
                words = word_hashes(text)
                digest = xxhash.xxh3_128_intdigest(b" ".join(text.split()))
                found = shingles(words)[0]
                elements.append(found)
                sizes.append(len(found))
                for k, v in zip(held, (len(words), len(found), digest >> 64, digest & (1 << 64) - 1), strict=True):
                    held[k].append(v - (1 << 64) if v >= 1 << 63 else v)
                at += 1
            owner = np.repeat(np.arange(len(sizes)), sizes)
            # Weight 1 each: similarity of signatures is that of the sets, as verified.
            with np.errstate(over="ignore"):
                keys = band_keys(signatures(np.concatenate(elements), np.ones(len(owner)), owner, len(sizes), bands * rows), bands, rows)
            yield {"id": ids.slice(first, at - first), "copy": batch.column(2).slice(first, at - first), **held, "bands": [*keys.view(np.int64)]}

    copies = docs.select(id_col, text_col, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    return common.by_batch(copies, f"id {kind}, copy long, words long, size long, high long, low long, bands array<long>", of)


@lru_cache(maxsize=64)
def _set(text: bytes) -> np.ndarray:
    return shingles(word_hashes(text))[0]


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts' shingle sets have at least this Jaccard similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).cast(pa.binary()), batch.column(3).cast(pa.binary()), strict=True):
                keep.append(jaccard(_set(x.as_py()), _set(y.as_py())) >= threshold)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
        _set.cache_clear()
        common.given_back()

    kind = pairs.schema["a"].dataType.simpleString()
    # Texts meet pairs by shuffles at any size; which side could be broadcast isn't left to chance.
    left = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b")
    both = left.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, f"a {kind}, b {kind}")


def _mixed(labelled: DataFrame) -> DataFrame:
    """(key, id, comp, n): the members of buckets that hold more than one component."""
    members = labelled.select(F.explode("bands").alias("key"), "id", "comp")
    seen = members.groupBy("key").agg(F.min("comp").alias("first"), F.max("comp").alias("last"), F.count("*").alias("n"))
    return members.join(seen.where("first <> last").select(F.col("key").alias("k"), "n"), F.col("key") == F.col("k")).drop("k")


def _pairs(members: DataFrame) -> DataFrame:
    x = members.select("key", F.col("id").alias("a"), F.col("comp").alias("comp_a"))
    y = members.select("key", F.col("id").alias("b"), F.col("comp").alias("comp_b"))
    return x.join(y, "key").where("a < b and comp_a <> comp_b").select("a", "b").distinct()


def forest(sets: list[np.ndarray], comps: list, may: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Links that join components: pairs (i, j) of sets with ``may[i, j]`` and enough similarity."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[at] > 1
    owner, at = owner[shared], at[shared]
    _, at = np.unique(at, return_inverse=True)
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    both = np.zeros((n, n), np.float32)
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, 4096):
        part = slice(*np.searchsorted(at, [low, low + 4096]))
        held = np.zeros((n, 4096), np.float32)
        held[owner[part], at[part] - low] = 1
        both += held @ held.T
    # In whole numbers below 2 ** 24 float32 is exact.
    near = (both >= threshold * (sizes[:, None] + sizes - both) - 1e-6) & may
    root = {c: c for c in comps}

    def top(c):
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    out = []
    for i, j in zip(*np.nonzero(np.triu(near | near.T, 1)), strict=True):
        x, y = top(comps[i]), top(comps[j])
        if x != y and jaccard(sets[i], sets[j]) >= threshold:
            root[x] = y
            out.append((int(i), int(j)))
    return out


def _within_families(large: DataFrame, labelled: DataFrame, texts: DataFrame, threshold: float, block: int) -> DataFrame:
    """(a, b): links across components among the texts of large buckets (key, id)."""
    hubs = large.groupBy("key").agg(F.min("id").alias("hub"))
    nodes = components(large.join(hubs, "key").select(F.col("id").alias("a"), F.col("hub").alias("b")))
    # Similar texts have sizes within the threshold: of the same class, or of the next one.
    step = F.floor(F.log(F.col("size")) / math.log(1 / threshold) + 1e-9).cast("int")
    held = labelled.select("id", "comp", "size").join(nodes, F.col("id") == F.col("node")).select("id", "comp", F.col("component").alias("family"), step.alias("step"))
    held = held.select("id", "comp", "family", F.explode(F.array(F.struct(F.col("step").alias("at"), F.lit(0).alias("guest")), F.struct((F.col("step") + 1).alias("at"), F.lit(1).alias("guest")))).alias("e")).select("id", "comp", "family", "e.*")
    held = common.written(held, "families")
    sizes = held.groupBy("family", "at").agg(F.count("*").alias("n"), F.min("comp").alias("first"), F.max("comp").alias("last"), F.min("guest").alias("home"))
    sizes = sizes.where("first <> last and home = 0").select(F.col("family").alias("f"), F.col("at").alias("s"), "n")
    held = held.join(sizes, (F.col("family") == F.col("f")) & (F.col("at") == F.col("s")))
    rows = F.least(F.lit(max(block, LARGEST)), F.greatest(F.lit(block), F.ceil(F.col("n") / SPREAD)))
    blocks = F.ceil(F.col("n") / rows).cast("int")
    held = held.withColumn("own", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    key = F.xxhash64("family", "at", F.least("own", "with"), F.greatest("own", "with"))
    held = held.select(key.alias("key"), "id", "comp", "guest", "own", (F.col("own") == F.col("with")).alias("alone"))
    held = held.join(texts.hint("merge"), "id").select("key", "id", "comp", "guest", "own", "alone", "text")
    kind = labelled.schema["id"].dataType.simpleString()

    def links(part: pa.RecordBatch) -> dict | None:
        comps = part.column(2).to_pylist()
        if len(set(comps)) < 2:
            return None
        ids, guest, own, alone = (part.column(i).to_numpy(zero_copy_only=False) for i in (1, 3, 4, 5))
        sets = [shingles(word_hashes(x.as_py()))[0] for x in part.column(6).cast(pa.binary())]
        may = (guest[:, None] == 0) | (guest == 0)
        may &= alone[:, None] | (own[:, None] != own)
        found = forest(sets, comps, may, threshold)
        return {"a": ids[[i for i, _ in found]], "b": ids[[j for _, j in found]]} if found else None

    return common.in_groups(held, "key", f"a {kind}, b {kind}", links, 8 * max(block, LARGEST), whole=True)  # hashing deals blocks evenly


def classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, bands: int = BANDS,
    rows: int = ROWS, small: int = SMALL, block: int = BLOCK,
) -> DataFrame:
    """A row for each row of ``docs``: its id, ``copy`` (xxhash64 of its text), ``class_id`` (the smallest id of its class) and ``kept``."""
    spark = docs.sparkSession
    held = common.written(signed(docs, id_col, text_col, bands, rows), "signatures")
    alive = held.where("id is not null and words > 0")
    # Texts of equal words: one class, the smallest id stands for it.
    rep = F.min(F.struct("id", "copy")).alias("r")
    copies = alive.groupBy("high", "low").agg(rep, F.min("size").alias("size"), F.min("bands").alias("bands"))
    reps = copies = common.written(copies.select("high", "low", "r.*", "size", "bands"), "copies")
    if copies.count() > copies.select("id").distinct().count():
        # Of an id's different texts that may stand for classes only the one of the smallest digest does.
        reps = copies.groupBy("id").agg(F.min(F.struct("high", "low", "copy", "size", "bands")).alias("r"))
        reps = common.written(reps.select("id", "r.*"), "reps")
    keys = reps.select("id", F.explode("bands").alias("key"))
    hubs = common.written(keys.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n"), "hubs")
    first = common.written(keys.join(hubs, "key").where("id <> a").select("a", F.col("id").alias("b")).distinct(), "pairs")
    candidates = hubs.select(F.col("a").alias("id")).unionByName(first.select(F.col("b").alias("id"))).distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("copy", F.xxhash64("text"))
    asked = reps.select("id", "copy").join(candidates.hint("merge"), "id", "left_semi").hint("merge")
    texts = common.written(texts.join(asked, ["id", "copy"], "left_semi").select("id", "text"), "texts")
    links = common.written(verified(first, texts, threshold), "links")
    nodes = components(links)
    # Pairs across components.
    labelled = reps.join(candidates, "id", "left_semi").join(nodes, F.col("id") == F.col("node"), "left")
    labelled = common.written(labelled.select("id", F.coalesce("component", "id").alias("comp"), "size", "bands"), "labelled")
    mixed = common.written(_mixed(labelled), "buckets")
    rest = common.written(_pairs(mixed.where(F.col("n") <= small)).join(first, ["a", "b"], "left_anti"), "rest")
    held_texts = texts.join(rest.select(F.explode(F.array("a", "b")).alias("id")).distinct().hint("merge"), "id", "left_semi")
    large = mixed.where(F.col("n") > small).select("key", "id")
    more = verified(rest, held_texts, threshold).unionByName(_within_families(large, labelled, texts, threshold, block))
    more = common.written(more, "links")
    if not more.isEmpty():
        nodes = components(links.unionByName(more))
    comp = reps.join(nodes, F.col("id") == F.col("node")).select("high", "low", "component")
    of_copy = copies.select("high", "low", F.col("id").alias("rep")).join(comp, ["high", "low"], "left")
    of_copy = common.written(of_copy.select("high", "low", F.coalesce("component", "rep").alias("class_id")), "classes")
    out = held.join(of_copy, ["high", "low"], "left")
    class_id = F.when(F.col("words") > 0, F.when(F.col("id").isNotNull(), F.col("class_id"))).otherwise(F.col("id"))
    out = out.select(F.col("id").alias(id_col), "copy", class_id.alias("class_id"))
    for df in (copies, hubs, first, texts, links, labelled, mixed, rest, more):
        common.removed(spark, df)
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("class_id"), F.lit(True)))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(common.table(spark, sf_dir, "documents")).drop("copy")


def op9_sql() -> str:
    """The classes in DuckDB SQL: all pairs that share a shingle, and what is reached from each."""
    return """
    with recursive d as materialized (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
    s as materialized (select distinct doc_id, array_to_string(w[i : i + 4], ' ') as s from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from d where len(w) > 0) x),
    n as materialized (select doc_id, count(*) as n from s group by doc_id),
    p as materialized (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
    k as materialized (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 10 * c >= 8 * (x.n + y.n - c)),
    l as materialized (select a, b from k union all select b, a from k),
    r as (select doc_id as node, doc_id as low from d union select l.b, r.low from r join l on l.a = r.node)
    select node as doc_id, min(low) as class_id, node = min(low) as kept from r group by node
    """
