"""Connected components by randomised contraction, and work on the members of
a group in blocks."""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (src, dst); nodes of one
    component share a root, which is one of them.

    Each round, every node joins the neighbour (or itself) with the least hash
    of the round, and the edges are contracted to the chosen nodes.  The random
    order shrinks chains by a constant factor, so the rounds grow with the
    logarithm of the longest one.  Edges are kept distinct and both tables are
    written every round; joins read written tables, so Spark can split a hub."""
    kind = edges.schema["src"].dataType
    e = written(edges.where(F.col("src") != F.col("dst")).select(
        F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct(), "edges")
    maps: list[DataFrame] = []
    step = 0
    while not e.isEmpty():
        step += 1
        both = e.union(e.select(F.col("dst"), F.col("src"))).toDF("node", "other")

        def rank(c: str):
            return F.struct(F.xxhash64(F.col(c), F.lit(step)).alias("h"), F.col(c).alias("at"))

        to = both.groupBy("node").agg(F.min(rank("other")).alias("o")) \
            .select("node", F.least(F.col("o"), rank("node")).getField("at").alias("to"))
        m = written(to, "map")
        maps.append(m)
        a, b = m.toDF("src", "a"), m.toDF("dst", "b")
        e = written(e.join(a, "src").join(b, "dst").where(F.col("a") != F.col("b"))
                    .select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct(), "edges")
    if not maps:
        return edges.sparkSession.createDataFrame([], f"node {kind.simpleString()}, root {kind.simpleString()}")
    # From the last map, which is the smallest, back to the first.
    out = maps[-1].toDF("node", "root")
    for i, m in enumerate(reversed(maps[:-1])):
        later = out.toDF("at", "next")
        out = m.toDF("node", "at").join(later, "at", "left").select("node", F.coalesce("next", "at").alias("root"))
        if i % 3 == 2:
            out = written(out, "map")
    return written(out, "components")


def forest_of(linked: np.ndarray) -> list[tuple[int, int]]:
    """Spanning edges of the graph of a boolean adjacency matrix, as shallow
    trees in which no member has more than nine of them."""
    n = len(linked)
    group = np.full(n, -1)
    for i in range(n):
        if group[i] >= 0:
            continue
        group[i] = i
        todo = [i]
        while todo:
            new = np.flatnonzero(linked[todo.pop()] & (group < 0))
            group[new] = i
            todo += new.tolist()
    out = []
    for g in np.unique(group):
        own = np.flatnonzero(group == g)
        out += [(int(own[(k - 1) // 8]), int(own[k])) for k in range(1, len(own))]
    return out


def cells(members: DataFrame, sizes: DataFrame, key: str, item: str, block: int) -> DataFrame:
    """``members`` with columns ``cell_i``, ``cell_j``, ``own`` such that every
    two members of a group meet in exactly one cell (``key``, i, j), i <= j,
    and a cell holds about two blocks at most.

    A group of n members (``sizes``: key, n) is dealt into ceil(n / block)
    blocks by the hash of the item; each member goes to the cells of its block.
    Groups up to one block have the one cell (0, 0)."""
    g = F.greatest(F.lit(1), F.ceil(F.col("n") / block)).cast("int")
    dealt = members.join(sizes.select(key, F.col("n")).hint("merge"), key).withColumn("g", g) \
        .withColumn("own", F.when(F.col("g") == 1, 0).otherwise(F.pmod(F.xxhash64(item, F.lit(17)), F.col("g")).cast("int")))
    return dealt.withColumn("_k", F.explode(F.when(F.col("g") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("g") - 1)))) \
        .withColumn("cell_i", F.least("own", "_k")).withColumn("cell_j", F.greatest("own", "_k")).drop("_k", "g", "n")
