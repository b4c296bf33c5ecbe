"""Connected components by least label and pointer jumping; every step is joins and combined aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm import common


def components(links: DataFrame) -> DataFrame:
    """links (a, b) to (id, component: least id reachable) of every id in a link."""
    edges = common.as_table(links.select("a", "b").union(links.select("b", "a")).distinct(), "cc-edges")
    label = common.as_table(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "cc-0")
    while True:
        near = edges.join(label, F.col("b") == F.col("id")).groupBy("a").agg(F.min("component").alias("least"))
        new = label.join(near, F.col("id") == F.col("a")).select("id", "component", F.least("component", "least").alias("to"))
        to = label.select(F.col("id").alias("__id"), F.col("component").alias("__far"))
        new = common.as_table(new.join(to, F.col("to") == F.col("__id"), "left").select("id", F.col("component").alias("was"), F.least("to", "__far").alias("component")), "cc")
        if not new.where("was <> component").limit(1).count():
            return new.select("id", "component")
        label = new.select("id", "component")
