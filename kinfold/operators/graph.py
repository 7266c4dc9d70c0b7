"""Connected components, and the clusters of least mass of a minimum spanning forest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b): component is the least node that can be reached.

    Each round hooks every node to the least of its neighbours' labels and then jumps to the label of its label, so the rounds
    grow with the logarithm of the longest path in practice; each round is written out, which cuts the lineage.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("node"), "label"), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("__l")), "b").groupBy("a").agg(F.min("__l").alias("__l"))
        hooked = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("__old"), F.least("label", "__l").alias("label"))
        jump = hooked.select(F.col("node").alias("__n"), F.col("label").alias("__next"))
        new = hooked.join(jump, hooked["label"] == jump["__n"], "left").select("node", "__old", F.least("label", F.coalesce("__next", "label")).alias("label"))
        new = written(new, "labels")
        changed = not new.where("label <> __old").isEmpty()
        labels = new.select("node", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")


def condensed(edges: DataFrame, masses: DataFrame, least_mass: float) -> DataFrame:
    """(node, cluster) of every node of `masses` (node, mass): the leaves of the minimum spanning forest of `edges` (a, b, w), condensed by
    `least_mass`; `cluster` is the least node in it, or null.

    Grow the forest edge by edge, the least weight first and ties by (a, b). Where two trees of less than the mass meet and
    have it together, a cluster starts; a lighter tree that meets a cluster joins it; a cluster that meets another one is closed, and
    what joins later belongs to neither. Nodes that never get to the mass have no cluster. Null masses count as 0; edges with null
    ends or weights, loops and edges to nodes that `masses` lacks are ignored, and of parallel edges the least counts.

    Done in Boruvka rounds: the next edge of a light tree is the least that leaves it, whatever happens elsewhere, so all light trees pick at once.
    Two that pick each other become one; those whose picks lead to a heavy tree join it. Heavy trees never pick, so no round looks for the
    least edge of a large one, and edges within a tree or between heavy ones leave the rounds. Each round is written out.
    """
    pairs = edges.where("a <> b AND w IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("w").cast("double").alias("w"))
    pairs = written(pairs.groupBy("a", "b").agg(F.min("w").alias("w")), "forest-edges")
    edge = F.struct("w", "a", "b")
    alone = F.struct(F.lit(float("-inf")).alias("w"), F.col("node").alias("a"), F.col("node").alias("b"))
    state = masses.select("node", F.col("node").alias("tree"), F.coalesce(F.col("mass").cast("double"), F.lit(0.0)).alias("mass"))
    state = written(state.withColumn("level", F.when(F.col("mass") >= least_mass, alone)), "forest")  # the edge that brought a node the mass

    def at(side: str) -> DataFrame:
        return state.select(F.col("node").alias(side), F.col("tree").alias(f"tree_{side}"), F.col("level").alias(f"level_{side}"))

    active = pairs
    while True:
        met = active.select("a", "b", "w").join(at("a"), "a").join(at("b"), "b").where("tree_a <> tree_b AND (level_a IS NULL OR level_b IS NULL)")
        active = written(met.select("a", "b", "w", "tree_a", "tree_b", F.col("level_a").isNull().alias("light_a"), F.col("level_b").isNull().alias("light_b")), "forest-edges")
        ends = active.where("light_a").select(F.col("tree_a").alias("tree"), F.col("tree_b").alias("other"), edge.alias("edge"))
        ends = ends.union(active.where("light_b").select("tree_b", "tree_a", edge))
        picks = ends.groupBy("tree").agg(F.min("edge").alias("edge"), F.min_by("other", "edge").alias("other"))
        back = picks.select(F.col("tree").alias("__t"), F.col("other").alias("__o"))
        picks = picks.join(back, (picks["tree"] == back["__o"]) & (picks["other"] == back["__t"]), "left")
        picks = written(picks.select("tree", "other", "edge", F.col("__t").isNotNull().alias("mutual")), "forest-picks")
        if picks.isEmpty():
            break
        # picks lead either to a heavy tree, which all of them join, or to two that pick each other, for which the others wait
        groups = components(picks.select(F.col("tree").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "tree").join(picks, "tree", "left")
        paired = groups.groupBy("component").agg(F.coalesce(F.max("mutual"), F.lit(False)).alias("paired"))
        moves = groups.join(paired, "component").where("mutual OR NOT paired")
        moves = moves.select("tree", F.when(F.col("paired"), F.least("tree", "other")).otherwise(F.col("component")).alias("__into"), "edge", "paired")
        moved = state.join(moves, "tree", "left").withColumn("level", F.coalesce("level", F.when(~F.col("paired"), F.col("edge"))))
        moved = moved.select("node", F.coalesce("__into", "tree").alias("tree"), "mass", "level", "edge", "paired")
        full = moved.where("paired").groupBy("tree").agg(F.sum("mass").alias("__total")).where(F.col("__total") >= least_mass)
        grown = moved.join(full, "tree", "left").withColumn("level", F.coalesce("level", F.when(F.col("__total").isNotNull(), F.col("edge"))))
        state = written(grown.select("node", "tree", "mass", "level"), "forest")
    between = pairs.join(at("a"), "a").join(at("b"), "b").where("tree_a <> tree_b AND level_a IS NOT NULL AND level_b IS NOT NULL")
    closed = between.select(F.explode(F.array("tree_a", "tree_b")).alias("tree"), edge.alias("edge")).groupBy("tree").agg(F.min("edge").alias("closed"))
    ours = state.join(closed, "tree", "left")
    inside = F.col("level").isNotNull() & (F.col("closed").isNull() | (F.col("level") < F.col("closed")))
    ours = written(ours.select("node", F.when(inside, F.col("tree")).alias("tree")), "forest")
    names = ours.where("tree IS NOT NULL").groupBy("tree").agg(F.min("node").alias("cluster"))  # the tree may be named for a node that came too late
    return ours.join(names, "tree", "left").select("node", "cluster")
