"""Connected components of a link table, as joins; nothing reaches the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteomart.llm.tables import cut


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b), the component named by its least id.

    Each round takes the least name among an id's neighbours and then that
    name's own name (pointer jumping), until no name changes.
    """
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    names = cut(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("name")).withColumnRenamed("a", "id"))
    for _ in range(most_rounds):
        near = (both.join(names.withColumnRenamed("id", "b"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("name").alias("near")))
        nearer = names.join(near, "id").select("id", F.col("name").alias("old"), F.least("name", "near").alias("name"))
        jump = names.select(F.col("id").alias("name"), F.col("name").alias("further"))
        after = cut(nearer.join(jump, "name", "left")
                    .select("id", "old", F.least("name", F.coalesce("further", "name")).alias("name")))
        changed = after.where("name < old").limit(1).count()
        names = after.select("id", "name")
        if not changed:
            return names.select("id", F.col("name").alias("component"))
    raise RuntimeError("the components did not settle")
