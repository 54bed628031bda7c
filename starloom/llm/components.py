"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import written


LINKS_PER_FILE = 100_000


def _least(links: DataFrame) -> DataFrame:
    """(u, v, m) with the least of u and its neighbours; aggregated before it is joined back."""
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    m = F.least("u", "least").alias("m")
    return links.join(least, "u").select("u", "v", m)


def _stars(links: DataFrame, files: int) -> DataFrame:
    """One round: every node is linked to the least node that it can see."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = written(large.distinct(), "large_star", files)
    small = _least(large)
    hooked = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = small.select("u", F.col("m").alias("v"))
    return written(kept.union(hooked).where("u <> v").distinct(), "small_star", files)


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node in links (a, b): the least id that it is joined to.

    Each round's links are a written table; rounds grow with the logarithm of a component's
    width. A node with many links is summed before the join, which adaptive execution splits.
    """
    links = written(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    before = None
    # A round has no more links than it begins with.
    files = max(4, -(-links.count() // LINKS_PER_FILE))
    while True:
        after = _stars(links, files)
        # Done when a round leaves the links as they were, by their number and hashes.
        now = after.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        links = after
        if now == before:
            break
        before = now
    found = links.groupBy("u").agg(F.min("v").alias("component"))
    return found.select(F.col("u").alias("id"), "component").union(
        found.select(F.col("component").alias("id"), "component").distinct()
    )
