"""Connected components by forests within tasks and stars between them.

Each task turns its edges into a forest: every node with the smallest one that it reaches there. One grouping by node then
brings together the few roots that the tasks found for it, at most one from each forest, so a centre with a third of all nodes is
no hot key. Nodes with one root are done. Else all of a node's roots hang on the smallest, edges to a root that got a
smaller one itself go there at once, and what comes out are the next round's edges: never more than before. A round is one
job with one shuffle, written to the shared folder, which also counts the nodes that are not done.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.llm.tables import loose, stored

#: Nodes in a forest; of more edges a task makes several.
FOREST = 500_000
#: Roots with a smaller one that are sent to all tasks; more of them are joined by shuffles.
SENT = 100_000


class Forest(dict):
    """Nodes with a smaller one of their tree, or themselves."""

    def root(self, x: Hashable) -> Hashable:
        up = self.setdefault(x, x)
        while up != x:
            self[x] = self[up]
            x, up = up, self[up]
        return x

    def link(self, u: Hashable, v: Hashable) -> None:
        a, b = self.root(u), self.root(v)
        if a != b:
            self[max(a, b)] = min(a, b)


def forests(edges: DataFrame) -> DataFrame:
    """(node, root) by forest, roots included, from edges (u, v) without nulls."""
    kind = edges.schema["u"].dataType
    schema = T.StructType([T.StructField("node", kind), T.StructField("root", kind)])

    def rows(trees: Forest, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        nodes = list(trees)
        for i in range(0, len(nodes), 10_000):
            part = nodes[i : i + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, kind), pa.array([trees.root(x) for x in part], kind)], names=schema.names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, kind = Forest(), pa.null()
        for batch in batches:
            kind = batch.schema.field(0).type
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                trees.link(u, v)
            if len(trees) > FOREST:
                yield from rows(trees, kind)
                trees.clear()
        yield from rows(trees, kind)

    return edges.select("u", "v").mapInArrow(run, schema)


def _round(edges: DataFrame) -> tuple[DataFrame, int, int]:
    """(node, component, hung, moved), stored: the smallest root found, what hangs on it by this node, and whether the node is
    a root with a smaller one; how many nodes have several roots; how many moved."""
    roots = forests(edges.where(F.col("u") != F.col("v"))).groupBy("node").agg(F.collect_set("root").alias("roots"))
    now = roots.select("node", "roots", F.array_min("roots").alias("component"))
    hung = F.array_except(F.array_union("roots", F.array("node")), F.array("component"))
    now = now.select("node", "component", hung.alias("hung"), (F.array_contains("roots", F.col("node")) & (F.col("node") != F.col("component"))).alias("moved"), (F.size("roots") > 1).alias("open"))
    seen = Observation()
    now = stored(now.observe(seen, F.count_if("open").alias("open"), F.count_if("moved").alias("moved")).drop("open"), "edges")
    return now, seen.get["open"], seen.get["moved"]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of the edges (u, v): component is the smallest node reached. Edges in any
    direction, repeated ones and loops are fine; rows with a null end are left out. No edges give no rows."""
    now, left, moved = _round(edges)
    while left:
        edges = now.select(F.explode("hung").alias("u"), F.col("component").alias("v"))
        if moved:
            up = now.where("moved").select(F.col("node").alias("v"), F.col("component").alias("up"))
            edges = edges.join(F.broadcast(up) if moved <= SENT else loose(up), "v", "left").select("u", F.coalesce("up", "v").alias("v"))
        now, left, moved = _round(edges)
    return now.select("node", "component")
