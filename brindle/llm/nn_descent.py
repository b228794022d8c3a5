"""Linked vectors by NN-descent.

Vectors of equal label, length and bits are one class with the smallest id as representative; only
representatives are compared. Every label's neighbour graph with K neighbours a node starts from
buckets of random hyperplanes (TABLES of them, as fine as the label's own size asks; a label of up
to BUCKET nodes is one bucket) and one random bucket, so that every node has a full list, and is
refined: each node's neighbours and REVERSE times K reverse ones meet, pairs of which one is new to
the node are compared, and each of a pair takes the other up if it is nearer than its own K-th
neighbour and not in its list, until a round improves less than SETTLED of the lists. Threshold
edges of the graph are kept; their components are the result's.

A node whose list is full of neighbours above the threshold is saturated: its list is enlarged to
all of its component, whose members are compared block by block, and only the counts and a spanning
forest leave a block. Recall is audited by label: some AUDIT nodes of each are compared with all of
its rows, and links that aren't within one dense component (those are counted exactly) are looked
up. Where less than RECALL of them is found, over all links or as the mean over nodes, the label is
started again with new planes and twice the K beside the lists so far; a label that still fails
after TRIES is compared whole, block by block, so what the audit finds too low is never returned.

Reverse neighbours that meet at a node are the new ones first, dealt anew each round; the bound
keeps a hub's group small, and what it leaves out is covered by later rounds and seen by the audit.
A list is cut to K by a ranking window, so no row holds all that a hub is offered. Hot buckets are
dealt out by a hash of the id. A component's block has a SPREADth of its rows, ROWS at least and
LARGEST at most; a vector goes to each of its component's blocks, so up to SPREAD * LARGEST members
what is shuffled grows with their number and only the comparing with its square.

Defined results: vectors that are null, empty or zero or hold null or non-finite components, and
those with a null label or id, link with nothing and are components of their own (null for a null
id); repeated rows of one id are one vector, each with its result, and of different vectors of one
id that of the smallest label and digest stands for it; an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .components import components

THRESHOLD = 0.93
K, REVERSE, TABLES, ROUNDS, SETTLED = 8, 2, 4, 8, 0.002
AUDIT, RECALL, TRIES = 256, 0.98, 3
#: Rows of a part of a start bucket or of the audit, and those that a start bucket should hold.
BLOCK, BUCKET = 2048, 128
#: A component's blocks: how many of them, and the bounds of their rows.
SPREAD, ROWS, LARGEST = 32, 1024, 16_384
#: Bucket rows from which a start bucket is dealt out.
HOT = 4096


def _vectors(column: pa.Array) -> np.ndarray:
    """Unit vectors in double precision, of binaries of equal length."""
    raw = column.to_pylist()
    v = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    return v


def _nearest(sims: np.ndarray, k: int) -> np.ndarray:
    """The k columns of the largest values of each row, in any order."""
    return np.argpartition(-sims, k - 1, axis=1)[:, :k] if k < sims.shape[1] else np.broadcast_to(np.arange(sims.shape[1]), sims.shape)


def prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, space, high, low, vec): the vectors that may link; ``space`` tells label and length apart."""

    def of(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {"id": [], "high": [], "low": [], "vec": [], "dims": [], "label": []}
        for i, label, v in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1), strict=True):
            if i is None or label is None or not v.is_valid or not len(v.values) or v.values.null_count:
                continue
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if not np.isfinite(x).all() or not x.any():
                continue
            digest = xxhash.xxh3_128_intdigest(x.tobytes())
            high, low = (np.array([digest >> 64, digest & (1 << 64) - 1], np.uint64)).view(np.int64).tolist()
            x = x / np.abs(x).max()  # no overflow in the squares
            for k, y in zip(out, (i, high, low, (x / np.sqrt(x @ x)).tobytes(), len(x), label), strict=True):
                out[k].append(y)
        yield out

    rows = vectors.select(F.col(id_col), F.col(vector_col), F.col(label_col).cast("string"))
    kind = vectors.schema[id_col].dataType.simpleString()
    out = common.by_batch(rows, f"id {kind}, high long, low long, vec binary, dims int, label string", of)
    return out.select("id", F.xxhash64("label", "dims").alias("space"), "high", "low", "vec")


def _start(nodes: DataFrame, k: int, turn: int = 0) -> DataFrame:
    """(id, other, sim, new): for each node the k nearest of its buckets, which hold some BUCKET rows of its space each."""
    wide = lambda size: max(0, int(np.ceil(np.log2(max(1, size) / BUCKET))))
    bits = wide(nodes.agg(F.max("size")).first()[0] or 0)

    def coded(batch: pa.RecordBatch) -> Iterator[dict]:
        raw = batch.column(2).to_pylist()
        keys = np.zeros((len(raw), TABLES), np.int64)
        by_size: dict[int, list[int]] = {}
        for i, v in enumerate(raw):
            by_size.setdefault(len(v), []).append(i)
        for size, at in by_size.items():
            x = np.frombuffer(b"".join(raw[i] for i in at), np.float64).reshape(len(at), -1)
            planes = np.random.default_rng([20 + size, turn]).standard_normal((size // 8, TABLES, max(1, bits)))
            signs = np.einsum("nd,dtb->ntb", x, planes) > 0
            own = np.array([wide(batch.column(3)[i].as_py()) for i in at])  # by the space's own size
            keys[at] = ((signs * (1 << np.arange(max(1, bits)))).sum(axis=2) if bits else 0) & ((1 << own) - 1)[:, None]
        yield {"id": batch.column(0), "space": batch.column(1), "vec": batch.column(2), "size": batch.column(3), "codes": [*keys]}

    kind = nodes.schema["id"].dataType.simpleString()
    coded_rows = common.by_batch(nodes.select("id", "space", "vec", "size"), f"id {kind}, space long, vec binary, size long, codes array<long>", coded)
    # One random bucket more: a node that is alone in the others has a list all the same.
    chance = nodes.select("id", "vec", "space", "size", F.lit(TABLES).alias("t"), F.pmod(F.xxhash64("id", F.lit(turn)), F.ceil(F.col("size") / BUCKET)).alias("code"))
    # A space of one bucket is compared whole by the first table.
    rows = coded_rows.select("id", "vec", "space", "size", F.posexplode("codes").alias("t", "code")).unionByName(chance).where((F.col("size") > BUCKET) | (F.col("t") == 0))
    rows = rows.select("id", "vec", F.xxhash64("space", "t", "code").alias("key"))
    hot = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT).withColumnRenamed("key", "x")
    rows = rows.join(hot, F.col("key") == F.col("x"), "left")
    salt = F.when(F.col("n").isNotNull(), F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / HOT))).otherwise(F.lit(0))
    rows = rows.select(F.xxhash64("key", salt).alias("key"), "id", "vec")

    def best(part: pa.RecordBatch) -> dict | None:
        if part.num_rows < 2:
            return None
        ids, v = part.column(1).to_numpy(), _vectors(part.column(2))
        sims = v @ v.T
        np.fill_diagonal(sims, -2)
        at = _nearest(sims, min(k, len(ids) - 1))
        return {"id": np.repeat(ids, at.shape[1]), "other": ids[at].ravel(), "sim": np.take_along_axis(sims, at, 1).ravel()}

    return common.in_groups(rows, "key", f"id {kind}, other {kind}, sim double", best, BLOCK).withColumn("new", F.lit(True))


def _lists(edges: DataFrame, k: int) -> DataFrame:
    """(id, near): the k nearest of each id's candidates (id, other, sim, new), nearest first.

    Dealt by id once: pairs found twice are made one, ranked and cut before they are gathered.
    """
    once = edges.repartition("id").groupBy("id", "other").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("sim"), "other"))
    held = once.withColumn("place", place).where(F.col("place") <= k)
    return held.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("sim", "other", "new")), asc=False).alias("near"))


def _edges(graph: DataFrame) -> DataFrame:
    return graph.select("id", F.explode("near").alias("e")).select("id", "e.other", "e.sim", "e.new")


def _round(nodes: DataFrame, graph: DataFrame, k: int, turn: int) -> DataFrame:
    """(id, other, sim, new): what neighbours of a node, met there, offer each other beyond their lists."""
    edges = _edges(graph)
    order = Window.partitionBy("at").orderBy(F.desc("new"), F.xxhash64("member", F.lit(turn)))
    back = edges.select(F.col("other").alias("at"), F.col("id").alias("member"), "new").withColumn("r", F.row_number().over(order)).where(F.col("r") <= REVERSE * k).drop("r")
    meet = edges.select(F.col("id").alias("at"), F.col("other").alias("member"), "new").unionByName(back)
    meet = meet.repartition("at").groupBy("at", "member").agg(F.max("new").alias("new"))
    # Where nothing is new, all pairs have met before.
    meet = meet.withColumn("any", F.max("new").over(Window.partitionBy("at"))).where("any").drop("any")
    full = F.when(F.size("near") >= k, F.get("near", k - 1)["sim"]).otherwise(F.lit(-2.0))
    known = nodes.select("id", "vec").join(graph.select("id", full.alias("worst"), F.transform("near", lambda e: e["other"]).alias("near")), "id", "left")
    kind = nodes.schema["id"].dataType.simpleString()
    known = known.select(F.col("id").alias("member"), "vec", F.coalesce("worst", F.lit(-2.0)).alias("worst"), F.coalesce("near", F.array().cast(f"array<{kind}>")).alias("near"))
    meet = meet.join(known, "member").select(F.xxhash64("at").alias("key"), "member", "vec", "worst", "new", "near")

    def best(part: pa.RecordBatch) -> dict | None:
        ids, v, worst = part.column(1).to_numpy(zero_copy_only=False), _vectors(part.column(2)), part.column(3).to_numpy()
        new, near = part.column(4).to_numpy(zero_copy_only=False), part.column(5)
        sims = v @ v.T
        # Who has whom in the list already.
        listed, owner = near.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(ids)), near.value_lengths().to_numpy())
        by_id = np.argsort(ids, kind="stable")
        at = by_id[np.minimum(np.searchsorted(ids, listed, sorter=by_id), len(ids) - 1)]
        there = ids[at] == listed
        better = (sims > worst[:, None] + 1e-12) & (new[:, None] | new)
        better[owner[there], at[there]] = False
        np.fill_diagonal(better, False)
        if not better.any():
            return None
        # No list can take more than k of them.
        at = _nearest(np.where(better, sims, -2), min(k, len(ids)))
        held = np.take_along_axis(better, at, 1)
        return {"id": np.repeat(ids, at.shape[1])[held.ravel()], "other": ids[at][held], "sim": np.take_along_axis(sims, at, 1)[held]}

    return common.in_groups(meet, "key", f"id {kind}, other {kind}, sim double", best, BLOCK).withColumn("new", F.lit(True))


def _refined(nodes: DataFrame, graph: DataFrame, n: int, k: int, rounds: int) -> DataFrame:
    spark = nodes.sparkSession
    for turn in range(rounds):
        offers = _round(nodes, graph, k, turn)
        met = _edges(graph).withColumn("new", F.lit(False))
        old, graph = graph, common.written(_lists(met.unionByName(offers), k), "graph")
        gained = graph.agg(F.sum(F.size(F.filter("near", lambda e: e["new"])))).first()[0]
        common.removed(spark, old)
        if (gained or 0) <= SETTLED * k * n:
            break
    return graph


def _compared(nodes: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """(id, degree, other): links of all members (id, comp) within their component, block by block.

    Rows of an id come from each pair of blocks; ``other`` is one that the id reaches there.
    """
    sizes = members.groupBy("comp").agg(F.count("*").alias("size")).withColumnRenamed("comp", "c")
    held = members.join(sizes, F.col("comp") == F.col("c")).drop("c").join(nodes.select("id", "m", "vec"), "id")
    rows = F.least(F.lit(LARGEST), F.greatest(F.lit(ROWS), F.ceil(F.col("size") / SPREAD)))
    blocks = F.ceil(F.col("size") / rows).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    # A row goes to every pair of blocks that has its own.
    held = held.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    key = F.xxhash64("comp", F.least("own", "with"), F.greatest("own", "with"))
    held = held.select(key.alias("key"), "id", "vec", "m", F.col("own").alias("side"), (F.col("own") == F.col("with")).alias("alone"))
    kind = nodes.schema["id"].dataType.simpleString()

    def count(part: pa.RecordBatch) -> dict | None:
        ids, v, m = part.column(1).to_numpy(zero_copy_only=False), _vectors(part.column(2)), part.column(3).to_numpy()
        side, alone = part.column(4).to_numpy(), part.column(5)[0].as_py()
        a = np.arange(len(ids)) if alone else np.flatnonzero(side == side.min())
        b = a if alone else np.flatnonzero(side != side.min())
        degree, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
        right = v[b].T
        for at in range(0, len(a), 512):
            x = a[at : at + 512]
            near = v[x] @ right >= threshold
            if alone:
                near[np.arange(len(x)), at + np.arange(len(x))] = False
            degree[x] += near @ m[b]
            if not alone:
                degree[b] += m[x] @ near
            # One link of each row that joins two labels, until none is left.
            while (apart := near & (label[x][:, None] != label[b])).any():
                for i in np.flatnonzero(apart.any(axis=1)):
                    low, high = sorted((label[x[i]], label[b[apart[i].argmax()]]))
                    label[label == high] = low
        return {"id": ids, "degree": degree, "other": ids[label]}

    # Hashing deals blocks evenly; one that is far above its rows would be an error, not be cut.
    return common.in_groups(held, "key", f"id {kind}, degree long, other {kind}", count, 4 * LARGEST, whole=True)


def _degrees(compared: DataFrame) -> DataFrame:
    return compared.groupBy("id").agg(F.sum("degree").alias("degree"))


def _failed(nodes: DataFrame, edges: DataFrame, whole: DataFrame, threshold: float, audit: int, recall: float) -> DataFrame:
    """(space): those in whose sample too few links are found, links within one dense component apart."""
    inside = whole.select(F.col("id").alias("p"), F.xxhash64("comp").alias("in"))
    held = nodes.join(inside, F.col("id") == F.col("p"), "left").select("id", "space", "size", "vec", F.coalesce("in", F.lit(0).cast("long")).alias("in"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    asked = held.where(F.pmod(F.xxhash64("id", F.lit(7)), F.col("size")) < audit).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = held.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn("asked", F.lit(False)).unionByName(asked.withColumn("asked", F.lit(True)))
    rows = rows.select(F.xxhash64("space", "block").alias("key"), "id", "vec", "space", "in", "asked")
    kind = nodes.schema["id"].dataType.simpleString()

    def near(part: pa.RecordBatch) -> dict | None:
        asks = np.array(part.column(5).to_pylist(), bool)
        if not asks.any() or asks.all():
            return None
        ids, v, space, comp = part.column(1).to_numpy(), _vectors(part.column(2)), part.column(3).to_numpy(), part.column(4).to_numpy()
        sure = (comp[asks][:, None] == comp[~asks]) & (comp[~asks] != 0)
        x, y = np.nonzero((v[asks] @ v[~asks].T >= threshold) & ~sure & (ids[asks][:, None] != ids[~asks]))
        return {"a": ids[asks][x], "b": ids[~asks][y], "space": space[asks][x]}

    true = common.in_groups(rows, "key", f"a {kind}, b {kind}, space long", near, 4 * LARGEST, whole=True)
    found = edges.select(F.col("id").alias("x"), F.col("other").alias("y"))
    marked = true.join(found, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")), "left")
    each = marked.groupBy("space", "a").agg(F.count("*").alias("there"), F.count("x").alias("found"))
    each = each.groupBy("space").agg(F.sum("there").alias("there"), F.sum("found").alias("found"), F.avg(F.col("found") / F.col("there")).alias("mean"))
    return common.written(each.where((F.col("found") < recall * F.col("there")) | (F.col("mean") < recall)).select("space"), "failed")


def _linked(graph: DataFrame, k: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(id, other): the graph's links both ways, and (id, comp): the members of components with a saturated list."""
    near = _edges(graph).where(F.col("sim") >= threshold)
    both = common.written(near.select("id", "other").unionByName(near.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct(), "near")
    comp = common.written(components(both, "id", "other"), "components")
    full = graph.where((F.size("near") >= k) & (F.get("near", k - 1)["sim"] >= threshold)).select("id")
    dense = comp.join(full.withColumnRenamed("id", "node"), "node", "left_semi").select(F.col("component").alias("c")).distinct()
    whole = comp.join(dense, F.col("component") == F.col("c"), "left_semi").select(F.col("node").alias("id"), F.col("component").alias("comp"))
    return both, common.written(whole, "dense")


def _listed(nodes: DataFrame, both: DataFrame, whole: DataFrame) -> DataFrame:
    """(id, degree): links by list of the nodes outside dense components."""
    of_list = both.join(whole.select(F.col("id").alias("w")), F.col("id") == F.col("w"), "left_anti")
    return of_list.join(nodes.select(F.col("id").alias("other"), "m"), "other").groupBy("id").agg(F.sum("m").alias("degree"))


def linked(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD,
    k: int = K, rounds: int = ROUNDS, audit: int = AUDIT, recall: float = RECALL,
) -> DataFrame:
    """A row for each row of ``vectors``: its id, ``n_links``, ``component_id`` and ``kept``."""
    one = F.min(F.struct("space", "high", "low", "vec"))
    every = common.written(prepared(vectors, id_col, vector_col, label_col).groupBy("id").agg(one.alias("v")).select("id", "v.*"), "vectors")
    nodes = every.groupBy("space", "high", "low").agg(F.min("id").alias("id"), F.count("*").alias("m"), F.first("vec").alias("vec"))
    sizes = nodes.groupBy("space").agg(F.count("*").alias("size")).withColumnRenamed("space", "s")
    nodes = common.written(nodes.join(sizes, F.col("space") == F.col("s")).drop("s"), "nodes")
    todo, links, degrees, graph = nodes, [], [], None
    for turn in range(TRIES):
        n = todo.count()
        if not n:
            break
        start = _start(todo, k, turn)
        start = start if graph is None else start.unionByName(_edges(graph).join(todo.select("id"), "id", "left_semi"))
        graph = _refined(todo, common.written(_lists(start, k), "graph"), n, k, rounds)
        both, whole = _linked(graph, k, threshold)
        failed = _failed(todo, both, whole, threshold, audit, recall)
        good = todo.join(failed, "space", "left_anti")
        both, whole = (df.join(good.select("id"), "id", "left_semi") for df in (both, whole))
        links.append(both)
        degrees += [_listed(good, both, whole), _degrees(_compared(good, whole, threshold))]
        todo = common.written(todo.join(failed, "space", "left_semi"), "todo")
        k *= 2
    # Labels that failed to the end, whole.
    compared = common.written(_compared(nodes, todo.select("id", F.col("space").alias("comp")), threshold), "compared")
    links.append(compared.select("id", "other"))
    degree = common.written(reduce(DataFrame.unionByName, [*degrees, _degrees(compared)]), "degrees")
    comp = common.written(components(reduce(DataFrame.unionByName, links), "id", "other"), "components")
    rep = nodes.select("space", "high", "low", F.col("id").alias("rep"), "m")
    rep = rep.join(degree.withColumnRenamed("id", "d"), F.col("rep") == F.col("d"), "left").join(comp, F.col("rep") == F.col("node"), "left")
    rep = rep.select("space", "high", "low", (F.coalesce("degree", F.lit(0).cast("long")) + F.col("m") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    good = every.select("id", "space", "high", "low").join(rep, ["space", "high", "low"]).select("id", "n", "c")
    out = vectors.select(F.col(id_col).alias("v")).join(good, F.col("v") == F.col("id"), "left")
    out = out.select(F.col("v").alias(id_col), F.coalesce("n", F.lit(0).cast("long")).alias("n_links"), F.coalesce("c", "v").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(common.table(spark, sf_dir, "embeddings"))


def op7_sql() -> str:
    """Links by brute force in DuckDB SQL, and what is reached from each vector."""
    return f"""
    with recursive v as materialized (select vec_id, label, cast(embedding as double[]) as e from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
    l as materialized (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id where list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
    r as (select vec_id as node, vec_id as low from embeddings union select l.b, r.low from r join l on l.a = r.node),
    c as (select a, count(*) as n from l group by a)
    select node as vec_id, coalesce(any_value(c.n), 0) as n_links, min(low) as component_id, node = min(low) as kept from r left join c on c.a = node group by node
    """
