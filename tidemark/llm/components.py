"""Connected components of a link table, by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .session import remove, written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of (a, b): component is the smallest node it can reach.

    Every round takes the least label among neighbours and then the label of
    that label, so long chains shrink by jumps.  Labels are written to the
    shared folder in each round; only the number of changed labels comes to
    the driver.  Self-links and repeated links do no harm; no links, no rows.
    """
    both = links.selectExpr("a", "b").union(links.selectExpr("b as a", "a as b")).where("a <> b").distinct()
    both = written(both, "links")
    label = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(label, both.b == label.node).groupBy("a").agg(F.min("label").alias("near"))
        step = label.join(near, label.node == near.a).select("node", "label", F.least("label", "near").alias("goal"))
        goal = label.select(F.col("node").alias("goal"), F.col("label").alias("beyond"))
        step = step.join(goal, "goal").select("node", F.least("goal", "beyond").alias("label"), (F.least("goal", "beyond") < F.col("label")).alias("moved"))
        step = written(step, "labels")
        moved = step.where("moved").limit(1).count()
        remove(label)
        label = step.select("node", "label")
        if not moved:
            return label.withColumnRenamed("label", "component")
