"""Connected components by contraction, as joins and aggregations over an edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.lineage import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`node` and `root` for every node of the undirected `edges` (long ids, any order, repeats allowed).

    Each round every node takes the lowest of itself and its neighbours, in an order by hash,
    and the edges are rewritten to those; images of a connected graph stay connected, so a
    component is done when no edge is left of it. `root` is that node, the same for all of a
    component. Neighbours are never gathered: a round is a minimum by node and two joins.
    An empty edge table gives an empty result; loops (a = b) keep their node.
    """
    order = lambda c: F.xxhash64(F.col(c))  # noqa: E731  a fixed order without long monotone chains
    ends = cut(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")))
    nodes = cut(ends.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node")))
    live = cut(ends.where("a <> b").distinct())
    while not live.isEmpty():
        both = live.union(live.select("b", "a"))
        lowest = both.groupBy("a").agg(F.min(F.struct(order("b").alias("h"), F.col("b").alias("to"))).alias("low"))
        own = F.struct(order("a").alias("h"), F.col("a").alias("to"))
        to = cut(lowest.select("a", F.least(own, F.col("low")).getField("to").alias("to")))
        step = to.select(F.col("a").alias("root"), F.col("to").alias("new"))
        nodes = cut(nodes.join(step, "root", "left").select("node", F.coalesce("new", "root").alias("root")))
        left = live.join(to.select("a", F.col("to").alias("x")), "a").select("x", "b")
        right = left.join(to.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
        live = cut(right.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    return nodes
