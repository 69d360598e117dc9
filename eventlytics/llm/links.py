"""Connected components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlytics.operators.scale import shared_checkpoint


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) of every end of a link: the smallest id reachable.

    Each round takes the smallest label among neighbours and then the label's own
    label, so paths halve; it ends when nothing changes. Sides that are joined on
    a possibly hot id are plain tables, which lets Spark split the other side.
    """
    one = links.filter(F.col(a) != F.col(b)).select(F.col(a).alias("id"), F.col(b).alias("to"))
    both = shared_checkpoint(one.union(one.select("to", "id")).distinct())
    labels = shared_checkpoint(both.groupBy("id").agg(F.least(F.min("to"), F.col("id")).alias("label")))
    while True:
        of_to = labels.select(F.col("id").alias("to"), F.col("label").alias("near"))
        near = both.join(of_to, "to").groupBy("id").agg(F.min("near").alias("near"))
        step = shared_checkpoint(
            labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        )
        onward = step.select(F.col("id").alias("label"), F.col("label").alias("next"))
        jumped = shared_checkpoint(step.join(onward, "label").select("id", "old", F.col("next").alias("label")))
        labels = jumped.select("id", "label")
        if jumped.filter("label <> old").isEmpty():
            return labels.withColumnRenamed("label", "component_id")
