"""Graph operators: connected components by label propagation and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.runtime import HOT_KEYS, HOT_ROWS, cut, drop, hot_keys, joined, release


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Rows ``(node, component)`` for every node of an undirected edge list; ``component`` is the smallest node reachable.

    Each round first shortcuts every label through its own label (pointer jumping) and then takes the smallest label
    among a node and its neighbours, so rounds grow with the logarithm of the diameter in practice. Labels meet
    edges and labels by joins that take hot keys (hubs, labels of large components) out of the shuffle, and the smallest
    labels are combined before they are shuffled, so no task gets a hub's edges or a component's nodes. Labels and
    shuffle files of earlier rounds are deleted. Self loops give singleton components, null ends are ignored, repeated edges change
    nothing, an empty edge list gives an empty result.
    """
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    both = cut(e.union(e.select("b", "a")).distinct())
    hubs = hot_keys(both, "b")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    held = cut(labels.select("node", F.least("node", "m").alias("c")))
    hot = hot_keys(held, "c")
    for _ in range(max_rounds):
        labels = held.select("node", "c")
        own = labels.select(F.col("node").alias("c"), F.col("c").alias("cc"))
        hopped = joined(labels, own, "c", "left", hot).select("node", F.col("c").alias("was"), F.least("c", "cc").alias("c"))
        near = joined(both, hopped.select(F.col("node").alias("b"), "c"), "b", "inner", hubs).groupBy(F.col("a").alias("node")).agg(F.min("c").alias("near"))
        nxt = cut(hopped.join(near, "node").select("node", "was", F.least("c", "near").alias("c")))
        n, changed, top = nxt.agg(F.count("*"), F.count_if(F.col("c") != F.col("was")), F.expr(f"approx_top_k(c, {HOT_KEYS}, {8 * HOT_KEYS})")).first()
        drop(held)
        held = nxt
        del labels, own, hopped, near, nxt
        release(edges.sparkSession)  # else the shuffle files of all rounds stay until the driver happens to collect its garbage
        hot = [x["item"] for x in top or [] if x["count"] > max(HOT_ROWS, n / HOT_KEYS)]
        if not changed:
            drop(both)
            return held.select("node", F.col("c").alias("component"))
    raise RuntimeError("components did not settle; raise max_rounds")
