"""Connected components of an edge table, by rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def components(edges: DataFrame, name: str) -> DataFrame:
    """(id, label) for every id of ``edges`` (a, b): the smallest id it can reach.

    Each round every id takes the smallest label among itself and its
    neighbours, then the label of that label, which halves long chains. A round
    is written to the shared folder, so lineage stays short and a lost executor
    costs one round. Rounds end when no label changes.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), f"{name}-edges")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("label")), f"{name}-labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        step = labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("new"))
        far = step.select(F.col("id").alias("new"), F.col("new").alias("far"))
        step = stored(step.join(far, "new", "left").select("id", "old", F.least("new", F.coalesce("far", "new")).alias("label")), f"{name}-labels")
        changed = step.where("label <> old").limit(1).count()
        labels = step.select("id", "label")
        if not changed:
            return labels
