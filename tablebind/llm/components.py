"""Connected components of links between numbers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebind.plans.checkpoints import checkpointed


def _state(links: DataFrame):
    return links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every number in ``links`` (a, b); the root is the smallest reachable.

    Alternates two steps until nothing changes: every node's larger neighbours, then its smaller
    ones, are linked to the smallest number seen there. Each step is a grouped minimum and a join,
    so a node with many links is no group in one task. Rounds grow with the logarithm of the
    longest path; each is checkpointed to the shared folder.
    """
    links = checkpointed(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    state = _state(links)
    while state[0]:
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Links now point from larger to smaller numbers, and each has its smallest known.
        large = large.union(least.where("m < a").select("a", F.col("m").alias("b"))).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = checkpointed(small.union(least.select("a", F.col("m").alias("b"))).distinct())
        new = _state(links)
        if new == state:
            break
        state = new
    roots = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
