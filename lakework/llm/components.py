"""Connected components of a link table, by alternating star contraction."""

from pyspark.sql import functions as F

from lakework.llm.common import cut


def _smallest(pairs):
    """Per node, the smallest of itself and its neighbours, joined to each of its pairs."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("n"), F.least("u", "m").alias("m"))
    return pairs.join(least, pairs.u == least.n).drop("n")


def components(links, a="a", b="b"):
    """``node, component`` for every node of ``links``; the component is its smallest node.

    Nodes are numbers. Repeated links, links of a node to itself and null ends are
    harmless (a null end is left out); an empty table gives no rows. Each round turns
    every neighbourhood into a star around its smallest node, first towards larger,
    then towards smaller neighbours, so that the rounds grow with the logarithm of the
    nodes. A node with very many links is summed up before its shuffle and joined back,
    never gathered.
    """
    edges = cut(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    state = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest(both).where(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        # Each large-star pair points down already; small stars hang them on the smallest.
        large = cut(large.where(F.col("u") != F.col("v")).distinct(), "large-star")
        stars = _smallest(large)
        small = stars.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            stars.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct()
        edges = cut(small, "small-star")
        found = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
