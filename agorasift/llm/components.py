"""Connected components by minimum-edge contraction, in DataFrames.

Borůvka-style rounds: every component picks its smallest edge to another component, the picked
edges hook components together, hooks are shortened by pointer jumping and the edges are
contracted. The picked edges form a spanning forest, which is kept. All keys are hashed, all
aggregates combine on the map side, and each round is cut by a reliable checkpoint, so neither a
hub node nor a long chain meets in one task or in the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorasift.functions.joins import join_hot
from agorasift.session import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> tuple[DataFrame, DataFrame]:
    """(``node, root``) for every node that has an edge, and the forest (``a, b``).

    The root is the smallest node of the component. Null ends, self-edges and repeated edges are
    ignored; an empty input gives two empty tables. Nodes are strings or numbers.
    """
    base = (
        edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .distinct()
    )
    work = cut(base.select(F.col("a").alias("u"), F.col("b").alias("v"), "a", "b"))
    nodes = work.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    label = nodes.withColumn("root", F.col("node"))
    n_nodes = 0  # at most two ends an edge
    forest = work.select("a", "b").where(F.lit(False))
    while (n := work.count()) > 0:
        ends = work.select("u", "v", "a", "b").unionByName(work.select(F.col("v").alias("u"), F.col("u").alias("v"), "a", "b"))
        # the smallest edge that leaves each component; one total order of edges, so picks form no ring but 2-rings
        picks = ends.groupBy("u").agg(F.min(F.struct("a", "b", "v")).alias("e")).select("u", F.col("e.v").alias("v"), F.col("e.a").alias("a"), F.col("e.b").alias("b"))
        picks = cut(picks)
        forest = forest.unionByName(picks.select("a", "b").distinct())
        back = picks.select(F.col("u").alias("v"), F.col("v").alias("_u2"))
        hook = (
            picks.join(back, "v", "left")
            .select("u", F.when((F.col("_u2") == F.col("u")) & (F.col("u") < F.col("v")), F.col("u")).otherwise(F.col("v")).alias("p"))
        )
        while True:  # pointer jumping: the depth halves each time
            up = hook.select(F.col("u").alias("p"), F.col("p").alias("_pp"))
            jumped = cut(join_hot(hook, up, "p", F.col("u"), rows=2 * n).select("u", F.col("_pp").alias("p"), (F.col("_pp") != F.col("p")).alias("_moved")))
            hook = jumped.select("u", "p")
            if jumped.where("_moved").isEmpty():
                break
        new = hook.select(F.col("u").alias("root"), F.col("p").alias("_new"))
        n_nodes = n_nodes or 2 * n
        label = cut(join_hot(label, new, "root", F.col("node"), "left", n_nodes).select("node", F.coalesce("_new", "root").alias("root")))
        left, right = hook.select("u", F.col("p").alias("_pu")), hook.select(F.col("u").alias("v"), F.col("p").alias("_pv"))
        work = cut(
            join_hot(join_hot(work, left, "u", F.struct("a", "b"), rows=n), right, "v", F.struct("a", "b"), rows=n)
            .where(F.col("_pu") != F.col("_pv"))
            .groupBy(F.least("_pu", "_pv").alias("u"), F.greatest("_pu", "_pv").alias("v"))
            .agg(F.min(F.struct("a", "b")).alias("e"))
            .select("u", "v", F.col("e.a").alias("a"), F.col("e.b").alias("b"))
        )
    least = label.groupBy("root").agg(F.min("node").alias("_least"))
    return join_hot(label, least, "root", F.col("node"), rows=n_nodes).select("node", F.col("_least").alias("root")), forest
