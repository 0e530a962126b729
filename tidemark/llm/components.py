"""Connected components of a distributed set of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import stored


def _rewired(links: DataFrame, larger: bool) -> DataFrame:
    """Link neighbours of each node to the least of them; one half of a round.

    ``links`` are ``(a, b)`` with ``b < a``. The least neighbour is an aggregate that is
    combined before it is shuffled, and meets the links in a join whose skewed partitions
    Spark splits, so a node with a third of all links is no group of one task. It is dealt
    anew before the join, as Spark splits only what comes straight from a shuffle.
    """
    if larger:
        both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).repartition("m")
        new = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("m")).repartition("m")
        joined = links.join(least, "a")
        new = joined.select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("l"))
        new = new.select(F.col("l.b").alias("a"), F.col("l.m").alias("b"))
    return new.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links``, component its least reachable node.

    ``links`` has two columns of node ids; order, repeats and self links do not matter, null
    links nothing. Rounds of neighbour rewiring (large star, small star) shrink every
    component to a star in a logarithmic number of rounds; each is written to the shared
    folder. Only a count and a checksum of the links come to the driver.
    """
    a, b = links.columns
    current = stored(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct(),
        "links",
    )
    print_of = None
    while True:
        seen = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if seen == print_of or seen[0] == 0:
            break
        print_of = seen
        current = stored(_rewired(_rewired(current, larger=True), larger=False), "links")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
