"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.common import stored


def _stars(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with ``m``, the least of u and all v beside it."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) without nulls to (id, root): root is the least id of the component.

    Rounds go on until the edges stay the same; each is written to the shared folder. Edges point to a smaller id, so
    the rounds number about the logarithm of the longest chain.
    """
    now = stored(edges.where("u <> v").distinct(), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        starred = _stars(down)
        small = starred.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(starred.select("u", F.col("m").alias("v")))
        now = stored(small.where("u <> v").distinct(), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    )
