"""Connected components by minimum-label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import skew
from corpusloom.operators.skew import any_hot, attach
from corpusloom.workspace import Workspace


def symmetric(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Distinct ``(src, dst)`` in both directions, without loops and nulls."""
    e = edges.select(F.col(a).alias("src"), F.col(b).alias("dst")).filter("src is not null and dst is not null and src <> dst")
    return e.union(e.select(F.col("dst"), F.col("src"))).distinct()


class _Labels:
    """Labels ``(node, component, n)`` of a graph, n being the number of rows that join with the node.

    A node that a large share of all edges has, or a label that a large share of all nodes has, is a hot key of the joins
    below. Whether there can be one is known from two counts at the start; then :func:`attach` takes those keys apart.
    """

    def __init__(self, ws: Workspace, start: DataFrame):
        self.ws = ws
        self.table = ws.table(start, "labels")
        n, most = self.table.agg(F.count("*"), F.max("n")).first()
        self.hot_nodes, self.hot_labels = (most or 0) > skew.HOT_ROWS, n > skew.HOT_ROWS

    def onto(self, rows: DataFrame, key: str) -> DataFrame:
        """``rows`` with the component of the node in ``key``."""
        labels = self.table.withColumnRenamed("node", key)
        return attach(rows, labels, [key], "n").drop("n") if self.hot_nodes else rows.join(labels.drop("n"), key)

    def step(self, near: DataFrame) -> bool:
        """One round, where ``near`` has the least label ``m`` in each node's reach; whether anything changed.

        The minimum goes to the node and to the node that is its label, so whole basins are hooked to a lower one at
        once; then each label is replaced by its own label. This takes about log n rounds, also on long chains.
        """
        ws, labels = self.ws, self.table
        seen = labels.join(near, "node")
        offers = seen.select(F.explode(F.array(F.struct("node", F.least("component", "m").alias("c")), F.struct(F.col("component").alias("node"), F.col("m").alias("c")))).alias("o"))
        hooked = offers.select("o.node", "o.c").unionAll(labels.select("node", F.col("component").alias("c"))).groupBy("node").agg(F.min("c").alias("c"))
        if self.hot_labels:
            # the labels in use, each once, look up their own label; what they find is spread over their nodes
            hooked = ws.table(hooked, "hooked")
            used = hooked.groupBy("c").agg(F.count("*").alias("k"))
            roots = ws.table(used.join(hooked.select(F.col("node").alias("c"), F.col("c").alias("r")), "c"), "roots")
            jumped = attach(hooked, roots, ["c"], "k")
        else:
            jumped = hooked.join(hooked.select(F.col("node").alias("c"), F.col("c").alias("r")), "c")
        jumped = jumped.select("node", F.least("c", "r").alias("component"))
        new = jumped.join(labels.select("node", F.col("component").alias("was"), "n"), "node").select("node", "component", "n", (F.col("component") != F.col("was")).alias("changed"))
        table = ws.table(new, "labels")
        ws.drop(labels)
        if self.hot_labels:
            ws.drop(hooked, roots)
        self.table = table.select("node", "component", "n")
        self.table._corpusloom_path = table._corpusloom_path
        return table.filter("changed").limit(1).count() > 0


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", ws: Workspace | None = None) -> DataFrame:
    """``(node, component)`` for every node that has an edge; component is the smallest node it can reach.

    Labels go along the edges as minima with map-side combining. Nothing but counts and whether a row changed comes to
    the driver. Loops, nulls and repeated edges are allowed and change nothing; no edges give no rows.
    """
    ws = ws or Workspace(edges.sparkSession)
    sym = ws.table(symmetric(edges, a, b), "edges")
    start = sym.groupBy("src").agg(F.min("dst").alias("m"), F.count("*").alias("n")).select(F.col("src").alias("node"), F.least("src", "m").alias("component"), "n")
    labels = _Labels(ws, start)
    while labels.step(labels.onto(sym, "dst").groupBy(F.col("src").alias("node")).agg(F.min("component").alias("m"))):
        pass
    ws.drop(sym)
    return labels.table.select("node", "component")


def bipartite_components(members: DataFrame, row: str, entity: str, ws: Workspace | None = None) -> DataFrame:
    """``(row, component)`` where rows that share an entity, directly or through others, share a component.

    Labels go from rows to their entities and back, each time as a minimum with map-side combining, so an
    entity that holds a third of all rows is no hot group: only its minimum is shuffled to it, and what comes
    back is spread with :func:`corpusloom.operators.skew.attach`. Rows without an entity are not returned.
    """
    ws = ws or Workspace(members.sparkSession)
    links = ws.table(members.select(F.col(row).alias("node"), F.col(entity).alias("entity")).dropna().distinct(), "links")
    sizes = ws.table(links.groupBy("entity").agg(F.count("*").alias("k"), F.min("node").alias("c")), "entities")
    hot = any_hot(sizes, "k")

    def back(lows: DataFrame) -> DataFrame:
        spread = attach(links, ws.table(lows, "lows"), ["entity"], "k") if hot else links.join(lows, "entity")
        return spread.groupBy("node")

    start = back(sizes).agg(F.min("c").alias("component"), F.count("*").alias("n")).select("node", "component", "n")
    labels = _Labels(ws, start)
    while True:
        low = labels.onto(links, "node").groupBy("entity").agg(F.min("component").alias("c"))
        if not labels.step(back(low.join(sizes.select("entity", "k"), "entity")).agg(F.min("c").alias("m"))):
            return labels.table.select(F.col("node").alias("row"), "component")
