"""Connected components of a graph of links.

A graph of a checked, small number of edges is solved by union-find in one task; a larger one by
alternating stars. Both give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

ROUNDS = 60
#: Edges that one task may hold: some 30 MB of its memory.
LOCAL = 250_000


def _solved(edges: DataFrame) -> DataFrame:
    """The same by union-find in one task, for edges of a checked number."""
    kind = edges.schema["u"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict = {}

        def top(x):
            while (y := root.setdefault(x, x)) != x:
                root[x] = root[y]
                x = y
            return x

        schema = None
        for batch in batches:
            schema = batch.schema
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                low, high = sorted((top(u), top(v)))
                root[high] = low
        if schema is not None:
            nodes = [*root]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, schema.field(0).type), pa.array([top(x) for x in nodes], schema.field(0).type)], ["node", "component"])

    return common.written(edges.coalesce(1).mapInArrow(run, f"node {kind}, component {kind}"), "components")


def components(edges: DataFrame, a: str = "a", b: str = "b", local: int = LOCAL) -> DataFrame:
    """(node, component): the smallest node reachable from each node of an undirected edge list.

    Beyond ``local`` edges, each round links every node's larger neighbours to the smallest one (large star), then its
    smaller neighbours (small star). Minima are combined before each shuffle, and the edges go
    back to the node by a join that Spark splits where one node has many. The rounds needed grow
    with the logarithm of the largest component; each one's edges are written to the shared
    folder. Null nodes and loops are left out; no edges give no rows.
    """
    spark = edges.sparkSession
    u, v = F.greatest(a, b), F.least(a, b)
    now = edges.where(F.col(a) != F.col(b)).select(u.alias("u"), v.alias("v")).distinct()
    now = common.written(now, "edges")
    if now.count() <= local:
        return _solved(now)
    state = None
    for _ in range(ROUNDS):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"))
        large = both.join(low, F.col("u") == F.col("x")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = common.written(large, "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x")
        joined = large.join(low, F.col("u") == F.col("x"))
        small = joined.select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        small = common.written(small.select("e.*").where("u <> v").distinct(), "edges")
        common.removed(spark, large)
        common.removed(spark, now)
        now = small
        # As many edges and the same sum of their hashes: nothing changed.
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
