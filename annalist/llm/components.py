"""Connected components of a table of links, by alternating stars.

Each round links every larger neighbour of a node to the smallest one it sees (large star) and then
every smaller neighbour (small star), until each node hangs on the smallest node of its component.
The number of rounds grows with the logarithm of the longest path. A node's smallest neighbour is
found by an aggregate, most of it in the map tasks, and joined back; in that join the links of a node
meet in one task unless Spark splits it as skewed. Links stay in tables; the driver sees a count and a
checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.sources.scratch import materialize

#: Links in a file of the tables between rounds.
FILE = 200_000


def _star(directed: DataFrame) -> DataFrame:
    """(v, smallest) for each (u, v): smallest is the least of u and its v."""
    least = directed.groupBy("u").agg(F.min("v").alias("low"))
    return directed.join(least.select("u", F.least("u", "low").alias("m")), "u")


def _canonical(links: DataFrame) -> DataFrame:
    """Columns u > v, distinct."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): component is its smallest node."""
    edges = materialize(_canonical(links), "links")
    before = None
    while True:
        n, check = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (n, check) == before or n == 0:
            break
        before = (n, check)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        small = _star(_canonical(large))
        # v goes to the smallest neighbour of u, and so does u.
        down = small.select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*")
        # Links never grow in number, so the count so far tells how many files are enough.
        edges = materialize(_canonical(down).coalesce(1 + n // FILE), "links")
    hung = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return hung.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
