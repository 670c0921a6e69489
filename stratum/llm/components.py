"""Connected components of a link table, by contraction.

Each round hooks every node to its smallest linked node, shortens the hooks to
their roots by pointer doubling, and renames the links by root; rounds go on
until no link is left between different roots. Every table is written to the
shared folder, only emptiness is asked for on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import stored


def _ordered(links: DataFrame) -> DataFrame:
    return (links.filter(F.col("u") != F.col("v"))
            .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (u, v); component: the smallest node reachable.

    Links from a node to itself and links with a null end are ignored; no links give an empty table.
    """
    links = stored(_ordered(links.filter("u is not null and v is not null")), "links")
    labels = links.select(F.col("u").alias("node")).union(links.select("v")).distinct().withColumn("component", F.col("node"))
    while not links.isEmpty():
        hooks = stored(links.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("root")), "hooks")
        while True:
            above = hooks.select(F.col("node").alias("root"), F.col("root").alias("__up"))
            if hooks.join(above, "root", "left_semi").isEmpty():
                break
            hooks = stored(hooks.join(above, "root", "left").select("node", F.coalesce("__up", "root").alias("root")), "hooks")
        labels = stored(labels.join(hooks.withColumnRenamed("node", "component"), "component", "left")
                        .select("node", F.coalesce("root", "component").alias("component")), "labels")
        for end in ("u", "v"):
            links = links.join(hooks.select(F.col("node").alias(end), "root"), end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
        links = stored(_ordered(links), "links")
    return labels
