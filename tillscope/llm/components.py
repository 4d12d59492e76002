"""Connected components of a link table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import saved


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable over ``links``, for every id that a link names.

    Each round every id takes the smallest label among its neighbours, then
    the label of its label, so a chain of n links settles in about log(n)
    rounds.  Labels are written between rounds; nothing is collected.
    """
    both = saved(links.select(F.col(a).alias("id"), F.col(b).alias("other")).unionByName(
        links.select(F.col(b).alias("id"), F.col(a).alias("other"))).distinct(), "links")
    labels = saved(both.groupBy("id").agg(F.least(F.col("id"), F.min("other")).alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("other"), "component"), "other").groupBy("id").agg(
            F.min("component").alias("_near"))
        stepped = saved(labels.join(near, "id").select("id", F.col("component").alias("_was"),
                                                        F.least("component", "_near").alias("component")), "labels")
        jump = stepped.select(F.col("id").alias("component"), F.col("component").alias("_jump"))
        new = saved(stepped.join(jump, "component", "left").select(
            "id", "_was", F.least("component", F.coalesce("_jump", "component")).alias("component")), "labels")
        labels = new.select("id", "component")
        if new.where(F.col("component") != F.col("_was")).isEmpty():
            return labels
