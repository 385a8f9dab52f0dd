"""Connected components of a link table, in rounds of joins on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsynth.session import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root) with the smallest node reachable over ``links`` (a, b); nodes without a link are not listed.

    Alternates two steps until nothing changes: every neighbour above a node is tied to the node's smallest neighbour,
    then every neighbour below it is. The table never has more rows than there are links, and each round about halves
    the longest path. Rounds are written to the shared folder, so lost executors cost one round at most.
    """
    def apart(df: DataFrame) -> DataFrame:
        return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    now = materialise(apart(links), "links")
    while True:
        # Large step: neighbours above a node point to the smallest of its neighbours and itself.
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written, so that a node with very many neighbours is joined by a join Spark can split.
        least = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = apart(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        # Small step: in (a, b) with b below a, all b of one a and a itself point to the smallest b.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        after = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        after = materialise(apart(after), "links")
        # Done when every node has one link, and to a node without one: a star for each component.
        many = after.groupBy("a").count().where("count > 1").select("a")
        chained = after.select(F.col("b").alias("a")).join(after.select("a"), "a", "left_semi")
        if many.union(chained).isEmpty():
            return after.select(F.col("a").alias("node"), F.col("b").alias("root")).union(after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        now = after
