"""Connected components of a graph whose links are a table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countcast.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a``, ``b``, both long): the smallest node it is connected with.

    In each round every node takes the smallest component among its neighbours' and its own, and then that component's component, so
    labels travel twice as far each time. A node with very many links is summed on the map side. No links give no rows.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
                    .select("node", F.least("node", "near").alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        taken = stored(labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component")), "labels")
        after = taken.select(F.col("node").alias("component"), F.col("component").alias("further"))
        new = stored(taken.join(after, "component").select("node", "old", F.col("further").alias("component")), "labels")
        labels = new.select("node", "component")
        if not new.filter(F.col("old") != F.col("component")).limit(1).count():
            return labels
