"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import written

#: A node with more than this share of all rows is a hub; so there are at most 1 / HUB_SHARE hubs.
HUB_SHARE = 1 / 4096


def _with_least(rows: DataFrame, total: int, itself: bool) -> DataFrame:
    """(u, v, m): ``rows`` (u, v) with the smallest v of their u, or of u and its v's.

    Smallest values and counts are aggregated before the shuffle. Hubs, of which there are at most
    4,096 however large the table is, go to the rows; only rows of other nodes, of which none holds more
    than one row in 4,096, are dealt by node to meet theirs.
    """
    least = rows.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    least = least.select("u", (F.least("u", "m") if itself else F.col("m")).alias("m"), "n")
    hub = F.col("n") > total * HUB_SHARE
    hubs = F.broadcast(least.where(hub).select("u", "m"))
    others = rows.join(hubs, "u", "left_anti").join(least.where(~hub).select("u", "m"), "u")
    return rows.join(hubs, "u").select("u", "v", "m").union(others.select("u", "v", "m"))


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, component) of every node of ``links`` (u, v); component is its smallest node.

    Each round ties every node's neighbours to the smallest of them (the rows of a hub stay where
    they are, spread over all tasks), writes the new links to the shared folder and stops when
    no link has changed; the number of rounds is logarithmic in the longest path. Self-links and
    repeated links are allowed; links with a null end are left out; no links give no rows.
    """
    edges = written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), f"{name}-links")
    total, seen = edges.count(), None
    while True:
        both = edges.select("u", "v").union(edges.select("v", "u"))
        large = written(_with_least(both, 2 * total, True).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .distinct(), f"{name}-stars")
        tied = _with_least(large, large.count(), False)
        edges = written(tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .union(tied.select("u", "m")).distinct(), f"{name}-links")
        total, sums = edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (total, sums) == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct())
        seen = (total, sums)
