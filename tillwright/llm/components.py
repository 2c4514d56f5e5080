"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.session import released, stored


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``component``): the least node reachable, for the nodes of ``links`` (``a``, ``b``, both long).

    Each round takes the least label among a node and its neighbours and then that label's own
    label, so chains shorten by more than half; the labels are written out in
    the shared folder and removed when the next ones are, and rounds end when none has changed.  Per node only minima are kept,
    so a node with very many links is pre-aggregated like any other.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .where("a <> b").distinct(), "links")
    first = stored(both.groupBy("a").agg(F.min("b").alias("least"))
                   .select(F.col("a").alias("node"), F.least("a", "least").alias("component")), "labels")
    labels, held = first, None
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a")
                .agg(F.min("component").alias("near")))
        nearer = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", "component", F.least("component", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("component").alias("jump"))
        following = stored(nearer.join(jump, "new", "left").select(
            "node", F.coalesce(F.least("new", "jump"), "new").alias("component"),
            (F.col("component") != F.coalesce(F.least("new", "jump"), "new")).alias("changed")), "labels")
        if held is not None:
            released(held)
        held, labels = following, following.select("node", "component")
        if not following.where("changed").head(1):
            released(both, first)
            return labels
