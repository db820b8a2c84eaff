"""Connected components of a link table, by contraction.

Links, labels and components stay distributed; every round is written to the
shared folder, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.session import stage


def components(links: DataFrame, jumps: int = 3) -> DataFrame:
    """``(id, component)`` for every id in ``links(a, b)``; the component is its smallest id.

    Each round points every id at its smallest neighbour, shortens the paths
    ``jumps`` times and contracts the links; about two rounds suffice for
    star-shaped groups, and long chains shrink eightfold each round.
    """
    links = stage(links.select("a", "b").filter("a <> b").distinct(), "links")
    result = None
    while True:
        both = links.union(links.select("b", "a"))
        parent = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low")).select("id", F.least("id", "low").alias("component"))
        parent = stage(parent, "parents")
        for _ in range(jumps):
            above = parent.select(F.col("id").alias("component"), F.col("component").alias("higher"))
            parent = parent.join(above, "component").select("id", F.col("higher").alias("component"))
        parent = stage(parent, "parents")
        if result is None:
            result = parent
        else:
            above = parent.select(F.col("id").alias("component"), F.col("component").alias("higher"))
            result = result.join(above, "component", "left").select("id", F.coalesce("higher", "component").alias("component"))
            result = stage(result, "components")
        left = links.join(parent.select(F.col("id").alias("a"), F.col("component").alias("p")), "a")
        left = left.join(parent.select(F.col("id").alias("b"), F.col("component").alias("q")), "b")
        links = stage(left.filter("p <> q").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct(), "links")
        if links.isEmpty():
            return result
