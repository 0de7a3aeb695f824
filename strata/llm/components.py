"""Connected components of a link table, by alternating large and small stars.

Each round hangs every node's larger neighbours on its smallest neighbour (large star),
then its smaller ones (small star). The number of links never grows and paths shorten by
a constant factor, so rounds grow with the logarithm of the longest chain. Links stay in
tables of the shared folder; the driver sees one count and one checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` of any comparable type -> ``(node, root)`` for every linked node,
    ``root`` the smallest node of its component (roots themselves are not listed).

    Loops, repeated and reversed links are fine; an empty table gives an empty one. Null
    ends are dropped: a link to nothing joins nothing.
    """
    e = (links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    e = keep(e, "links")
    before = _state(e)
    while before[0]:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = keep(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "links")
        after = _state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
