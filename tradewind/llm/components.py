"""Connected components of a table of links, as rounds of joins and written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.storage import stored


def components(links: DataFrame) -> DataFrame:
    """(id, label): for every id in ``links`` (a, b) the smallest id it is joined to. Each round takes the smallest label
    of the neighbours and then that label's own label, so long chains shorten by more than half. Nothing is gathered;
    aggregation combines a hub's many neighbours before they are shuffled."""
    links = links.where("a <> b").select("a", "b").distinct()
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy(both["a"].alias("n")).agg(F.min("label").alias("near"))
        closer = labels.join(near, F.col("id") == F.col("n"), "left").select(
            "id", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label"))
        closer = stored(closer, "labels")
        root = closer.select(F.col("id").alias("r"), F.col("label").alias("root"))
        labels = stored(closer.join(root, F.col("label") == F.col("r"), "left").select(
            "id", "old", F.coalesce("root", "label").alias("label")), "labels")
        if not labels.where("old <> label").limit(1).count():
            return labels.select("id", "label")
        labels = labels.select("id", "label")
