"""Connected components of a table of links, without bringing any of it to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """id, root for every id in ``links`` (a, b: long); root is an id of the component.

    Each round hooks every id to its smallest neighbour or itself, follows that twice more, and
    contracts the links. Ids should be hashes: under a random order the number of rounds is
    about the logarithm of the longest path. Each round is written, so a lost executor costs
    one round at most.
    """
    edges = written(both_ways(links), "links")
    labels = None
    while edges.take(1):
        parents = edges.groupBy("a").agg(F.min("b").alias("p")).select(
            F.col("a").alias("id"), F.least("a", "p").alias("root"))
        parents = written(followed(followed(parents, parents), parents), "parents")
        root_a, root_b = (parents.select(F.col("id").alias(c), F.col("root").alias(f"r{c}"))
                          for c in "ab")
        edges = written(edges.join(root_a, "a").join(root_b, "b").where("ra <> rb").select(
            F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "links")
        labels = parents if labels is None else written(followed(labels, parents), "labels")
    return labels if labels is not None else edges.select(
        F.col("a").alias("id"), F.col("b").alias("root"))


def both_ways(links: DataFrame) -> DataFrame:
    links = links.where("a <> b")
    return links.select("a", "b").union(links.select("b", "a")).distinct()


def followed(labels: DataFrame, parents: DataFrame) -> DataFrame:
    """labels with each root replaced by its own parent, if it has one."""
    up = parents.select(F.col("id").alias("root"), F.col("root").alias("up"))
    return labels.join(up, "root", "left").select("id", F.coalesce("up", "root").alias("root"))
