"""Hierarchies and reachability by repeated joins over edge tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from sparkweave.sources.files import stored


def _step(df: DataFrame) -> DataFrame:
    """Write one level to the shared folder, so that no level is computed twice."""
    return stored(df, "level")


def hierarchy(nodes: DataFrame, node: str, parent: str, label: str) -> DataFrame:
    """``node``, ``level`` (roots are 1) and ``path`` of labels joined by `` > ``, one join per level.

    Goes on to the deepest level. A path cannot be longer than there are nodes; one that is shows a cycle and raises.
    """
    frontier = _step(
        nodes.filter(F.col(parent).isNull()).select(node, F.lit(1).alias("level"), F.col(label).cast("string").alias("path"))
    )
    levels = [frontier]
    children = nodes.filter(F.col(parent).isNotNull()).select(
        F.col(node).alias("_child"), F.col(parent).alias("_parent"), F.col(label).cast("string").alias("_label")
    )
    n_nodes = nodes.count()
    while True:
        if len(levels) > n_nodes:
            raise ValueError("the hierarchy has a cycle")
        frontier = _step(
            children.join(frontier, F.col("_parent") == F.col(node)).select(
                F.col("_child").alias(node),
                (F.col("level") + 1).alias("level"),
                F.concat("path", F.lit(" > "), "_label").alias("path"),
            )
        )
        if frontier.isEmpty():
            break
        levels.append(frontier)
    return reduce(DataFrame.unionByName, levels)


def reach(edges: DataFrame, start: DataFrame, max_depth: int) -> DataFrame:
    """Nodes reachable from ``start(node)`` over ``edges(src, dst)`` with the least depth, up to ``max_depth``."""
    frontier = _step(start.select("node").distinct().withColumn("depth", F.lit(0)))
    seen = frontier
    for depth in range(1, max_depth + 1):
        found = (
            edges.join(frontier, F.col("src") == F.col("node"))
            .select(F.col("dst").alias("node"))
            .distinct()
            .join(seen, "node", "left_anti")
            .withColumn("depth", F.lit(depth))
        )
        frontier = _step(found)
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen


def walks(edges: DataFrame, start: DataFrame, max_depth: int) -> DataFrame:
    """All simple paths of up to ``max_depth`` edges: ``node``, ``depth``, ``path``; a node is never revisited."""
    frontier = _step(start.select("node", F.lit(0).alias("depth"), F.array("node").alias("path")))
    levels = [frontier]
    for _ in range(max_depth):
        frontier = _step(
            edges.join(frontier, F.col("src") == F.col("node"))
            .filter(~F.array_contains("path", F.col("dst")))
            .select(
                F.col("dst").alias("node"),
                (F.col("depth") + 1).alias("depth"),
                F.concat("path", F.array("dst")).alias("path"),
            )
        )
        if frontier.isEmpty():
            break
        levels.append(frontier)
    return reduce(DataFrame.unionByName, levels)


def cyclic_core(edges: DataFrame) -> DataFrame:
    """``node, component``: what is left of ``edges(src, dst)`` when nodes without edges in or out are peeled off, turn by turn.

    Every cycle is in the core, and the core holds nothing but cycles and ways between them; its connected components are
    named by their least node. No paths are kept, so rows never exceed edges. Turns grow with the longest way into or out
    of a cycle. A node with an edge to itself is a cycle; nulls are dropped, repeated edges count once.
    """
    now = _step(edges.select("src", "dst").filter("src IS NOT NULL AND dst IS NOT NULL").distinct())
    size = now.count()
    while size:
        heads, tails = now.select(F.col("dst").alias("src")).distinct(), now.select(F.col("src").alias("dst")).distinct()
        now = _step(now.join(heads, "src", "left_semi").join(tails, "dst", "left_semi").select("src", "dst"))
        before, size = size, now.count()
        if size == before:
            break
    named = connected_components(now.select(F.col("src").alias("a"), F.col("dst").alias("b")))
    nodes = now.select(F.col("src").alias("node")).unionByName(now.select(F.col("dst").alias("node"))).distinct()
    return nodes.join(named, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def _lowest(edges: DataFrame) -> DataFrame:
    """Per node ``a`` the least of itself and its neighbours; summed up before the shuffle."""
    return edges.groupBy("a").agg(F.min("b").alias("_b")).select("a", F.least("a", "_b").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    led = both.join(_lowest(both), "a").filter("b > a")
    return led.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")  # repeated edges go in the small star


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = _lowest(down)
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node) for every node of ``edges(a, b)``.

    Each round is a grouped minimum, a join that adaptive execution splits at a hub, and a write to the shared
    folder, so lineage stays short and a lost executor costs one round. Rounds grow with the logarithm of the
    longest path. Nulls and loops are dropped; repeated edges count once; no edges give no rows.
    """
    now = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        now = stored(_small_star(_large_star(now)), "stars")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    members = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
