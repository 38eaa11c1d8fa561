"""Connected components of a link table, by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomstar.session import few_files


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links (a, b)``: the label is the smallest node of the
    component. Each round every node hooks to its smallest neighbour, chains of hooks are
    followed one step, and the links are contracted to the labels; rounds grow with the
    logarithm of a component's width. Nothing but a count reaches the driver. ``links`` is read
    twice and should be a checkpoint."""
    rows = 2 * links.count()  # no table below has more

    def saved(df: DataFrame) -> DataFrame:
        return few_files(df, rows).checkpoint()

    links = saved(links.select("a", "b").where("a <> b").distinct())
    labels = saved(links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
                   .withColumn("label", F.col("node")))
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        hook = saved(both.groupBy(F.col("a").alias("from")).agg(F.least(F.col("a"), F.min("b")).alias("to")))
        jump = saved(hook.alias("x").join(hook.alias("y"), F.col("x.to") == F.col("y.from"))
                     .select("x.from", "y.to"))
        labels = saved(labels.join(jump, labels.label == jump["from"], "left")
                       .select("node", F.coalesce("to", "label").alias("label")))
        to = {side: jump.select(F.col("from").alias(side), F.col("to").alias(f"{side}2")) for side in "ab"}
        links = saved(links.join(to["a"], "a").join(to["b"], "b").select(F.col("a2").alias("a"), F.col("b2").alias("b"))
                      .where("a <> b").distinct())
    return labels
