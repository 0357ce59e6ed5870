"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanelux.session import settle


def _stars(links: DataFrame) -> DataFrame:
    """One round: link each node's larger neighbours to its smallest one, then all to the smallest of the smaller ones.

    Both steps keep who is connected with whom. Smallest neighbours are found with partial minima,
    and the neighbours are joined to them, so a node with very many links is never one group in memory.
    """
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.where("u <> v").distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def roots(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """For each node of ``links`` (u, v) but the smallest of its component: u and that smallest node v.

    Null nodes take part in no link; loops and repeated links change nothing; no links give no rows.
    Each round is stored in the shared folder, so lineage stays short. Raises if ``most_rounds``
    rounds are not enough (each round about halves the longest way).
    """
    now = links.select("u", "v").where("u is not null and v is not null and u <> v")
    now = settle(now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    digest = (F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    before = tuple(now.agg(*digest).first())
    if not before[0]:
        return now
    for _ in range(most_rounds):
        now = settle(_stars(now), "links")
        after = tuple(now.agg(*digest).first())
        if after == before:
            return now
        before = after
    raise RuntimeError("components did not settle")
