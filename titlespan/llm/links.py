"""Connected components of link tables, for nodes of any orderable type."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlespan.llm.common import written

#: Edges that one step of the local contraction holds.
HELD_EDGES = 500_000


def forest(edges: DataFrame) -> DataFrame:
    """Edges `(a, b)`, b the smaller, with the same components but no circles within a task's
    portions: each portion of at most `HELD_EDGES` edges becomes stars around its least nodes."""
    kind = edges.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def root(x):
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up]
                x = up
            return x

        def stars() -> pa.RecordBatch:
            pairs = [(x, root(x)) for x in list(parent)]
            pairs = [p for p in pairs if p[0] != p[1]]
            columns = [pa.array([p[i] for p in pairs], node) for i in (0, 1)]
            return pa.RecordBatch.from_arrays(columns, ["a", "b"])

        node = None
        for batch in batches:
            node = batch.column(0).type
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    low, high = (a, b) if a < b else (b, a)
                    parent[high] = low
            if len(parent) > HELD_EDGES:
                yield stars()
                parent.clear()
        if parent:
            yield stars()

    return edges.select("a", "b").mapInArrow(run, f"a {kind}, b {kind}")


def _hung(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: every node's neighbours (larger ones if `large`, else smaller ones and
    itself) hang on the least of its neighbours and itself.

    Both sides of the join are written tables behind plain exchanges, so that a node with
    very many neighbours is split by the engine.
    """
    if large:
        near = edges.select("a", "b").union(edges.select("b", "a"))
    else:
        near = edges
    least = near.groupBy("a").agg(F.min("b").alias("m"))
    if large:
        least = least.withColumn("m", F.least("a", "m"))
    joined = near.join(written(least, "links-least"), "a")
    if large:
        return joined.filter("b > a").selectExpr("b AS a", "m AS b").distinct()
    moved = joined.filter("b > m").selectExpr("b AS a", "m AS b")
    return moved.union(joined.selectExpr("a", "m AS b")).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other, and none hangs on a node that itself hangs."""
    ends = edges.selectExpr("a AS node", "1 AS hangs", "0 AS holds").union(
        edges.selectExpr("b", "0", "1")
    )
    nodes = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    loose = nodes.filter("hangs > 1 OR hangs = 1 AND holds = 1")
    return loose.limit(1).count() == 0


def components(edges: DataFrame) -> DataFrame:
    """`(node, component)` of every node of `edges(a, b)`; a component's name is its least node.

    Alternates the two star steps until all components are stars, which takes logarithmically
    many rounds; each step is a written table. Loops and repeated edges do no harm; no edges, no rows.
    """
    plain = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = written(forest(plain).distinct(), "links")
    while not _stars(now):
        now = written(_hung(written(_hung(now, large=True), "links"), large=False), "links")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
