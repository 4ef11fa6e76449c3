"""Connected components of a link table by contraction; no group is ever gathered in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestrata.llm.store import kept


def components(links: DataFrame) -> DataFrame:
    """(node, label) for each node of `links` (a, b): nodes have one label just when links connect them.

    Each round hangs every node below the neighbour that a hash of the round puts first, shortens these paths, and
    replaces the ends of each link by what they hang below; the links that are left join what is still apart. As the
    order is another one each time, a share of the nodes goes in every round whatever their values and links: a chain of
    any kind takes rounds as the logarithm of its length. A node with very many links costs one
    partly aggregated row a task, and every step is written to the shared folder, so a lost executor repeats one step.
    A link of a node to itself is no link; without links there are no rows.
    """
    links = between(links.select("a", "b"))
    labels, turn = None, 0
    while not links.isEmpty():
        ends = links.union(links.select("b", "a")).toDF("node", "other")
        turn += 1
        own, other = (F.struct(F.xxhash64(F.lit(turn), c).alias("h"), F.col(c).alias("n")) for c in ("node", "other"))
        parents = kept(ends.groupBy("node").agg(F.min(other).alias("first")).select("node", F.least(own, "first")["n"].alias("parent")), "cc-parents")
        parents = kept(shorter(parents), "cc-parents")
        labels = parents.toDF("node", "label") if labels is None else kept(moved(labels, "label", parents), "cc-labels")
        links = between(moved(moved(links, "a", parents), "b", parents))
    if labels is None:
        labels = links.toDF("node", "label")
    return labels


def between(links: DataFrame) -> DataFrame:
    one_way = links.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return kept(one_way.distinct(), "cc-links")


def shorter(parents: DataFrame) -> DataFrame:
    up = parents.toDF("parent", "above")
    return parents.join(up, "parent").select("node", F.col("above").alias("parent"))


def moved(rows: DataFrame, name: str, parents: DataFrame) -> DataFrame:
    """`rows` with the values of one column replaced by their parents, where they have one."""
    named = parents.toDF(name, "above")
    return rows.join(named, name, "left").withColumn(name, F.coalesce("above", name)).select(*rows.columns)
