"""Grid graphs: neighbour edges, hop counts, shortest paths, steepest ascent,
discounted reach.

Hop counts are found tile by tile.  The grid is cut into square tiles whose
side grows with the square root of its extent; a round solves the tiles that
received shorter distances at their borders, each in one pandas group of
bounded size, and passes the distances of their border cells on to the
neighbouring tiles.  The number of rounds follows the number of tiles that a
shortest path crosses, not its length.  Messages are written tables in the
shared folder, which cuts lineage and survives the loss of an executor.

Paths are read from parent pointers by pointer doubling: log2(length) joins
instead of one job per step.
"""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.session import materialize

# Neighbour offsets (label, row offset, column offset).
DIRECTIONS = (("N", -1, 0), ("S", 1, 0), ("W", 0, -1), ("E", 0, 1))
DISCOUNT = 0.99


def open_cells(cells: DataFrame) -> DataFrame:
    return cells.where(~F.col("wall")).select("r", "c")


def grid_edges(cells: DataFrame) -> DataFrame:
    """(r, c, dir, r2, c2) for open cells next to each other, both directions."""
    o = open_cells(cells)
    offs = F.array(*[F.struct(F.lit(d).alias("dir"), F.lit(dr).alias("dr"), F.lit(dc).alias("dc"))
                     for d, dr, dc in DIRECTIONS])
    cand = o.select("r", "c", F.inline(offs)).select(
        "r", "c", "dir", (F.col("r") + F.col("dr")).alias("r2"),
        (F.col("c") + F.col("dc")).alias("c2"))
    dst = o.select(F.col("r").alias("r2"), F.col("c").alias("c2"))
    return cand.join(dst, ["r2", "c2"]).select("r", "c", "dir", "r2", "c2")


SMALLEST_TILE = 32


def _solve(tile: pd.DataFrame) -> dict[tuple[int, int], int]:
    """Hops of the cells of one tile, from the distances it was given."""
    given = tile[tile.hops.notna()]
    opened = set(zip(tile.r[tile.hops.isna()], tile.c[tile.hops.isna()], strict=True))
    queue = [(int(h), int(r), int(c)) for r, c, h in zip(given.r, given.c, given.hops, strict=True)]
    heapq.heapify(queue)
    done: dict[tuple[int, int], int] = {}
    while queue:
        h, r, c = heapq.heappop(queue)
        if (r, c) in done or (r, c) not in opened:
            continue
        done[r, c] = h
        for _, dr, dc in DIRECTIONS:
            heapq.heappush(queue, (h + 1, r + dr, c + dc))
    return done


def bfs(edges: DataFrame, cells: DataFrame, start: tuple[int, int],
        side: int | None = None) -> tuple[DataFrame, int]:
    """(r, c, hops, pr, pc) of every open cell reachable from ``start``, with
    the parent that is the smallest (row, col) among the neighbours one hop
    closer; and the number of rounds it took.  Empty if ``start`` is a wall."""
    spark = cells.sparkSession
    extent = cells.agg(F.max("r"), F.max("c")).first()  # one row
    if side is None:
        side = max(SMALLEST_TILE, math.isqrt(max(extent[0] or 0, extent[1] or 0)) + 1)
    tile = [F.floor(F.col("r") / side).alias("tr"), F.floor(F.col("c") / side).alias("tc")]
    opened = materialize(open_cells(cells).select(
        *tile, "r", "c", F.lit(None).cast("long").alias("hops")), "cells")

    def border(tile_: pd.DataFrame) -> pd.DataFrame:
        at = (tile_.r.iloc[0] // side, tile_.c.iloc[0] // side)
        out = [(r + dr, c + dc, h + 1) for (r, c), h in _solve(tile_).items()
               for _, dr, dc in DIRECTIONS if ((r + dr) // side, (c + dc) // side) != at]
        return pd.DataFrame(out, columns=["r", "c", "hops"]).astype("int64")

    def inside(tile_: pd.DataFrame) -> pd.DataFrame:
        out = [(r, c, h) for (r, c), h in _solve(tile_).items()]
        return pd.DataFrame(out, columns=["r", "c", "hops"]).astype("int64")

    best = new = spark.createDataFrame([(*start, 0)], "r long, c long, hops long")
    rounds = 0
    while True:
        rounds += 1
        told = best.select(*tile, "r", "c", "hops")
        active = new.select(*tile).distinct()
        rows = opened.unionByName(told).join(active, ["tr", "tc"], "left_semi")
        sent = rows.groupBy("tr", "tc").applyInPandas(border, "r long, c long, hops long")
        sent = sent.groupBy("r", "c").agg(F.min("hops").alias("hops"))
        known = best.withColumnRenamed("hops", "known")
        new = materialize(sent.join(known, ["r", "c"], "left").where(
            F.col("known").isNull() | (F.col("hops") < F.col("known"))).drop("known"), "sent")
        if new.isEmpty():
            break
        best = materialize(best.unionByName(new).groupBy("r", "c").agg(
            F.min("hops").alias("hops")), "best")
    told = best.select(*tile, "r", "c", "hops")
    hops = materialize(opened.unionByName(told).groupBy("tr", "tc").applyInPandas(
        inside, "r long, c long, hops long"), "hops")
    to = hops.select(F.col("r").alias("r2"), F.col("c").alias("c2"), F.col("hops").alias("h2"))
    parents = (edges.join(hops, ["r", "c"]).join(to, ["r2", "c2"]).where("h2 = hops - 1")
               .groupBy("r", "c").agg(F.min(F.struct("r2", "c2")).alias("p")))
    out = hops.join(parents, ["r", "c"], "left").select(
        "r", "c", F.col("hops").cast("int").alias("hops"),
        F.col("p.r2").alias("pr"), F.col("p.c2").alias("pc"))
    return materialize(out, "bfs"), rounds


def farthest(hops: DataFrame) -> tuple[int, int] | None:
    """The reached cell with the most hops (then the largest row, column)."""
    top = hops.agg(F.max(F.struct("hops", "r", "c"))).first()[0]  # one row
    return None if top is None else (top.r, top.c)


def ancestor_chain(parents: DataFrame, goal: tuple[int, int] | None) -> DataFrame:
    """Cells on the parent-pointer chain from ``goal`` back to the root; none
    without a goal (nothing is reached from a start that is a wall or missing).

    ``parents`` is (r, c, pr, pc) with NULL parent at the root.  Pointer
    doubling: the jump table P_k maps a cell to its ancestor 2^k steps up;
    each round extends the chain with P_k of every chain cell, so a chain of
    length L needs ceil(log2 L) rounds.
    """
    if goal is None:
        return parents.select("r", "c").where("false")
    jump = parents.select("r", "c", F.col("pr").alias("ar"), F.col("pc").alias("ac")).where(
        F.col("ar").isNotNull())
    chain = parents.where((F.col("r") == goal[0]) & (F.col("c") == goal[1])).select("r", "c")
    while True:
        ext = chain.join(jump, ["r", "c"]).select(F.col("ar").alias("r"), F.col("ac").alias("c"))
        grown = materialize(chain.unionByName(ext).distinct(), "chain")
        if grown.count() == chain.count():
            return grown
        chain = grown
        j2 = jump.alias("a").join(jump.alias("b"), (F.col("a.ar") == F.col("b.r")) &
                                  (F.col("a.ac") == F.col("b.c")))
        jump = j2.select(F.col("a.r").alias("r"), F.col("a.c").alias("c"),
                         F.col("b.ar").alias("ar"), F.col("b.ac").alias("ac"))
        jump = materialize(jump, "jump")


def ascent_path(edges: DataFrame, hops: DataFrame, goal: tuple[int, int] | None) -> DataFrame:
    """(step, r, c): from ``goal`` (step 0) by steepest ascent to the start."""
    up = ascent_parents(edges, hops)
    chain = ancestor_chain(up, goal).join(hops.select("r", "c", "hops"), ["r", "c"])
    most = chain.agg(F.max("hops")).scalar()
    return chain.select((most - F.col("hops")).cast("int").alias("step"), "r", "c")


def shortest_path(hops: DataFrame, goal: tuple[int, int] | None) -> DataFrame:
    """(step, r, c) from start (step 0) to goal; empty when the goal is unreachable."""
    chain = ancestor_chain(hops, goal)
    return chain.join(hops.select("r", "c", "hops"), ["r", "c"]).select(
        F.col("hops").alias("step"), "r", "c")


def discounted_reach(cells: DataFrame, hops: DataFrame, goal: tuple[int, int] | None) -> DataFrame:
    """(r, c, value) for every cell: DISCOUNT^hops for reachable cells no further
    than the goal (all reachable cells if it is unreachable or none), else 0."""
    limit = F.lit(2 ** 31 - 1)
    if goal is not None:
        gh = hops.where((F.col("r") == goal[0]) & (F.col("c") == goal[1])).agg(F.max("hops"))
        limit = F.coalesce(gh.scalar(), limit)
    v = F.when(F.col("hops") <= limit, F.pow(F.lit(DISCOUNT), F.col("hops"))).otherwise(0.0)
    return (cells.select("r", "c").join(hops.select("r", "c", "hops"), ["r", "c"], "left")
                 .select("r", "c", F.coalesce(v, F.lit(0.0)).alias("value")))


def ascent_parents(edges: DataFrame, hops: DataFrame) -> DataFrame:
    """Steepest-ascent step of every reached cell toward the start: the
    neighbour one hop closer, first in the order W, E, N, S."""
    rank = F.when(F.col("dir") == "W", 0).when(F.col("dir") == "E", 1).when(
        F.col("dir") == "N", 2).otherwise(3)
    h = hops.select("r", "c", "hops")
    nb = hops.select(F.col("r").alias("r2"), F.col("c").alias("c2"), F.col("hops").alias("h2"))
    cand = (edges.join(h, ["r", "c"]).join(nb, ["r2", "c2"])
                 .where(F.col("h2") == F.col("hops") - 1))
    best = cand.groupBy("r", "c").agg(F.min(F.struct(rank.alias("k"), "r2", "c2")).alias("b"))
    return (h.join(best, ["r", "c"], "left")
             .select("r", "c", "hops", F.col("b.r2").alias("pr"), F.col("b.c2").alias("pc")))
