"""Problem 2: one group identifier for all records that matches link, directly or through others.

Method: peel the giant component by frontier breadth-first joins from the highest-degree vertex, anti-join it away,
and label the remaining small components by minimum propagation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.components import connected_components, symmetric
from corpusloom.operators.skew import any_hot, attach
from corpusloom.workspace import Workspace

#: Levels of breadth-first search. A giant component is shallow; a longer chain is finished by propagation.
BFS_LEVELS = 8


def normal_id(c: Column) -> Column:
    """An id without regard to letter case, surrounding white space and surrounding quotes; blank ones are null."""
    bare = F.regexp_replace(F.lower(c), r"""^[\s\p{Z}\p{Cf}"'`]+|[\s\p{Z}\p{Cf}"'`]+$""", "")
    return F.when(bare != "", bare)


def groups_of(edges: DataFrame, ws: Workspace, levels: int = BFS_LEVELS) -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (columns a, b); component is the smallest node of its group.

    The component of the vertex with most neighbours is peeled by breadth-first joins: each level joins the
    frontier with the edges and anti-joins what was visited. If ``levels`` don't exhaust it, what was visited is
    contracted into one vertex, so the rest is still exact. Other components are labelled by minimum propagation.
    A vertex that a large share of all edges has is a hot key of these joins; :func:`corpusloom.operators.skew.attach` takes it apart.
    """
    sym = ws.table(symmetric(edges), "links")
    degrees = ws.table(sym.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("n")), "degrees")
    hot = any_hot(degrees, "n")
    frontier = ws.table(degrees.orderBy(F.desc("n"), "node").limit(1), "frontier")
    visited = frontier
    if not frontier.count():
        return visited.select("node", F.col("node").alias("component"))

    def onto(rows: DataFrame, nodes: DataFrame, key: str) -> DataFrame:
        """Inner join of edge rows with nodes (node, n, ...) on one end."""
        nodes = nodes.withColumnRenamed("node", key)
        return attach(rows, nodes, [key], "n").drop("n") if hot else rows.join(nodes.drop("n"), key)

    done = False
    for _ in range(levels):
        near = onto(sym, frontier, "src").select(F.col("dst").alias("node")).distinct()
        frontier = ws.table(degrees.join(near.join(visited.select("node"), "node", "left_anti"), "node"), "frontier")
        if not frontier.limit(1).count():
            done = True
            break
        visited = visited.unionAll(frontier)
    giant = ws.table(visited, "giant")
    least = giant.agg(F.min("node")).first()[0]
    outside = ws.table(degrees.join(giant.select("node"), "node", "left_anti"), "outside")
    if done:
        rest = onto(sym, outside, "src")
        return giant.select("node", F.lit(least).alias("component")).unionByName(connected_components(rest, "src", "dst", ws))
    # edges inside are loops of the contracted vertex; the others have an outer end
    marked = ws.table(giant.withColumn("as", F.lit(least)).unionByName(outside.withColumn("as", F.col("node"))), "marked")
    outer = onto(sym, outside, "src")
    rest = onto(outer, marked, "dst").select("src", F.col("as").alias("dst"))
    labels = ws.table(connected_components(rest, "src", "dst", ws), "rest")
    own = labels.filter(F.col("node") == least).select("component").first()
    whole = least if own is None else own[0]
    return giant.select("node", F.lit(whole).alias("component")).unionByName(labels.join(giant.select("node"), "node", "left_anti"))


def consolidated(matches: DataFrame, records: DataFrame, ws: Workspace | None = None) -> DataFrame:
    """``(group_id, id)`` for every record that a match reaches, ids as ``records`` writes them.

    Null and blank ids and rows that match an id with itself link nothing; repeated rows count once. Links run
    through ids that records lacks, but only ids of records are listed; group_id is the smallest of those.
    """
    ws = ws or Workspace(matches.sparkSession)
    named = matches.select(normal_id(F.col("id")).alias("x"), normal_id(F.col("canonical")).alias("y")).filter("x <> y").distinct()
    named = ws.table(named, "matches")
    # ids are long strings; the graph is worked on with numbers. Many rows may name one id, so the numbers are attached
    names = named.select(F.explode(F.array("x", "y")).alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    names = ws.table(names.withColumn("node", F.monotonically_increasing_id()), "names")
    hot = any_hot(names, "n")
    edges = named
    for end, number in (("x", "a"), ("y", "b")):
        numbers = names.select(F.col("name").alias(end), F.col("node").alias(number), "n")
        edges = ws.table(attach(edges, numbers, [end], "n").drop("n"), "numbered") if hot else edges.join(numbers.drop("n"), end)
    edges = edges.select("a", "b")
    labels = groups_of(edges, ws)
    ids = records.select("id", normal_id(F.col("id")).alias("name")).distinct()
    members = ws.table(ids.join(names.drop("n"), "name").join(labels, "node").select("id", "component"), "members")
    groups = ws.table(members.groupBy("component").agg(F.min("id").alias("group_id"), F.count("*").alias("n")), "groups")
    return attach(members, groups, ["component"], "n").select("group_id", "id")


def p2_groups(spark, sf_dir: str) -> DataFrame:
    """Every linked record with its group identifier."""
    return consolidated(spark.read.parquet(f"{sf_dir}/structural_removed.parquet"), spark.read.parquet(f"{sf_dir}/records.parquet"))


def p2_found(spark, sf_dir: str) -> DataFrame:
    return p2_groups(spark, sf_dir).filter("id <> group_id").distinct()
