"""Search on any graph given as edges (src, dst): hops from a node, and
shortest paths by a frontier from both ends.

Nodes are numbered in order of their names, and the search runs on the numbers:
rows are short, the smallest neighbour is a hash aggregate over whole numbers
(one over strings sorts its rows), and names are joined back to the result.
A round joins the frontier with the edge table, keyed by node, and anti-joins
the nodes reached with those seen before; each level is a written table, so a
round reads only its frontier, the edges and what has been seen.  The edges
of hub nodes are split into slots by their other end, and a hub in a frontier
meets every slot, so no task holds the edges of one node.  Edges are dealt into
as many partitions as their number asks for.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.operators.windows import row_number_global
from framewise.session import drop_materialized, materialize

#: Edges of a node beyond which it is a hub; its edges go into slots of about that many.
HUB_EDGES = 100_000
#: Edges of a partition.
TASK_EDGES = 500_000


class Network(NamedTuple):
    """``links``: (src, slot, dst), each edge once, of node numbers; ``slots``:
    (src, slots) of the hubs; ``nodes``: (id, name), numbered in order of name."""

    links: DataFrame
    slots: DataFrame
    nodes: DataFrame

    @property
    def edges(self) -> DataFrame:
        """(src, slot, dst): the edges by name."""
        return _named(self, _named(self, self.links, "src"), "dst")


def network(edges: DataFrame, src: str = "src", dst: str = "dst", directed: bool = False,
            hub_edges: int = HUB_EDGES) -> Network:
    """The graph of distinct edges; both ways unless ``directed``.  Edges
    without one of their ends and loops are left out."""
    given = materialize(edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).where("src <> dst"), "given")
    tasks = -(-given.count() // TASK_EDGES) or 1
    names = given.select(F.col("src").alias("name")).unionByName(given.select(F.col("dst").alias("name"))).distinct()
    nodes = materialize(row_number_global(names, ["name"], name="id").select("id", "name"), "nodes")
    one = given
    for end in ("src", "dst"):
        number = nodes.select(F.col("name").alias(end), F.col("id").alias(f"{end}_id"))
        one = one.repartition(tasks, end).join(number, end)
    one = one.select(F.col("src_id").alias("src"), F.col("dst_id").alias("dst"))
    if not directed:
        one = one.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    one = materialize(one.repartition(tasks, "src", "dst").distinct(), "edges")
    both = one if directed else one.unionByName(one.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    slots = materialize(both.groupBy("src").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hub_edges).select(
        "src", F.ceil(F.col("n") / hub_edges).cast("int").alias("slots")), "hubs")
    slot = F.when(F.col("slots").isNull(), 0).otherwise(F.pmod(F.hash("dst"), F.col("slots")))
    out = both.join(slots, "src", "left").select("src", slot.cast("int").alias("slot"), "dst")
    out = materialize(out.repartition(tasks if directed else 2 * tasks, "src", "slot").sortWithinPartitions(
        "src", "slot"), "edges")
    drop_materialized(given)
    drop_materialized(one)
    return Network(out, slots, nodes)


def _step(net: Network, frontier: DataFrame) -> DataFrame:
    """(node, from): every edge that leaves the frontier (node)."""
    at = frontier.select(F.col("node").alias("src")).join(net.slots, "src", "left").select(
        "src", F.explode(F.sequence(F.lit(0), F.coalesce("slots", F.lit(1)) - 1)).alias("slot"))
    return at.join(net.links, ["src", "slot"]).select(F.col("dst").alias("node"), F.col("src").alias("from"))


def _start(net: Network, name) -> DataFrame:
    """One row with the node of that name, if any edge touches it."""
    return materialize(net.nodes.where(F.col("name") == F.lit(name)).select(F.col("id").alias("node")), "level")


def _named(net: Network, rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with the names of the nodes in a column in place of their numbers; null stays null."""
    names = net.nodes.select(F.col("id").alias("_id"), "name")
    return rows.join(names, F.col(column) == F.col("_id"), "left").withColumn(column, F.col("name")).drop("_id", "name")


def _next(net: Network, frontier: DataFrame, seen: list[DataFrame], full: bool) -> DataFrame:
    """The new nodes one step on with their smallest neighbour before.  In a
    graph with both ways (not ``full``) a neighbour can only be in the last
    two levels; else all levels are looked through."""
    reached = _step(net, frontier).groupBy("node").agg(F.min("from").alias("parent"))
    for level in seen if full else seen[-2:]:
        reached = reached.join(level.select("node"), "node", "left_anti")
    return materialize(reached, "level")


def hops_from(net: Network, start, directed: bool = False) -> DataFrame:
    """(node, hops, parent) of every node that can be reached from ``start``,
    which has 0 hops and no parent; the parent is the smallest neighbour one
    hop closer.  Empty if no edge touches ``start``."""
    levels = [_start(net, start)]
    while True:
        new = _next(net, levels[-1], levels, directed)
        if new.isEmpty():
            break
        levels.append(new)
    out = levels[0].select("node", F.lit(0).alias("hops"), F.lit(None).cast("long").alias("parent"))
    for i, level in enumerate(levels[1:], 1):
        out = out.unionByName(level.select("node", F.lit(i).alias("hops"), "parent"))
    return materialize(_named(net, _named(net, out, "node"), "parent"), "hops")


def path_between(net: Network, start, goal) -> DataFrame:
    """(step, node): a shortest path of an undirected graph from ``start``
    (step 0) to ``goal``, of all shortest ones the first in order of its nodes;
    no rows if there is none.

    Frontiers grow from both ends, always the smaller one, until a level of
    one side holds nodes of the other's last level; then the nodes on shortest
    paths are told apart level by level, and the smallest next node is taken."""
    none = net.nodes.select(F.lit(0).alias("step"), F.col("name").alias("node")).where("false")
    sides = [[_start(net, start)], [_start(net, goal)]]
    if sides[0][0].isEmpty() or sides[1][0].isEmpty():
        return none
    sizes = [1, 1]
    meet = sides[0][0].join(sides[1][0], "node", "left_semi").select("node")
    while meet.isEmpty():
        grow = 0 if sizes[0] <= sizes[1] else 1
        levels = sides[grow]
        new = _next(net, levels[-1], levels, False)
        sizes[grow] = new.count()
        if not sizes[grow]:
            return none
        levels.append(new)
        meet = materialize(new.join(sides[1 - grow][-1], "node", "left_semi").select("node"), "meet")
    # nodes on shortest paths, by step: from where the frontiers met back to both ends
    on = {len(sides[0]) - 1: meet}
    for side, direction in ((0, -1), (1, 1)):
        at = len(sides[0]) - 1
        for level in reversed(sides[side][:-1]):
            back = _step(net, on[at]).select("node").distinct()
            at += direction
            on[at] = materialize(level.select("node").join(back, "node", "left_semi"), "on-path")
    node = sides[0][0].first().node
    path = [(0, node)]
    for step in range(1, len(on)):
        near = _step(net, net.links.sparkSession.createDataFrame([(node,)], "node long"))
        node = near.select("node").join(on[step], "node", "left_semi").agg(F.min("node")).first()[0]
        path.append((step, node))
    return _named(net, net.links.sparkSession.createDataFrame(path, "step int, node long"), "node")


def discounted_from(net: Network, start, discount: float = 0.99) -> DataFrame:
    """(node, value): discount^hops of every node of the graph, 0 where it
    cannot be reached."""
    hops = hops_from(net, start).select("node", "hops")
    return net.nodes.select(F.col("name").alias("node")).join(hops, "node", "left").select(
        "node", F.coalesce(F.pow(F.lit(discount), F.col("hops")), F.lit(0.0)).alias("value"))


__all__ = ["Network", "network", "hops_from", "path_between", "discounted_from"]
