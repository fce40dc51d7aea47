"""Connected components without the driver: only counts leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of the undirected links (a, b) of longs; comp is one node of the component, the same for all of it.

    Each round hangs every node on the smallest of its neighbours and itself, shortens these chains twice, and contracts
    the links to the nodes hung on; a round at least halves what is left of a component whose ids are hashes.
    """
    links = materialise(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links")
    found, known = None, 0
    while n := links.count():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("up")), "up", 2 * n)
        for _ in range(2):
            over = up.select(F.col("node").alias("up"), F.col("up").alias("over"))
            up = up.join(over, "up").select("node", F.col("over").alias("up"))
        up = materialise(up, "up", 2 * n)
        known = known or up.count()
        if found is None:
            found = up.withColumnRenamed("up", "comp")
        else:
            found = materialise(found.join(up.withColumnRenamed("node", "comp"), "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")), "found", known)
            # a node that a later round meets first is one that links were contracted to, hence known already
        a, b = (up.select(F.col("node").alias(k), F.col("up").alias(f"u{k}")) for k in "ab")
        links = materialise(links.join(a, "a").join(b, "b").select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).where("a < b").distinct(), "links", n)
    return found if found is not None else links.select(F.col("a").alias("node"), F.col("b").alias("comp"))
