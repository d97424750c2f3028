"""Connected components by contraction: joins and grouped minima only, whatever the shape of a component.

Defined results: a node without links keeps its own name. Repeated links and links of a node with itself change nothing;
links with a null end are left out by the comparison of their ends. Of equal rows in ``labels`` each is kept. Without links
the labels stay as they are, and an empty table of labels stays empty. Columns other than the named ones are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granero.llm.scratch import Scratch


def relabel(scratch: Scratch, labels: DataFrame, parents: DataFrame) -> DataFrame:
    """(node, comp) with each comp replaced by its parent, where it has one."""
    known = scratch.hinted(parents)
    return labels.join(known, labels["comp"] == known["child"], "left").select("node", F.coalesce("parent", "comp").alias("comp"))


def merge(scratch: Scratch, labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, comp) after links (a, b) between comps joined them; a new table, ``labels`` is dropped.

    In each step every comp that has a smaller neighbour takes the smallest one's name, twice over, and links
    are renamed accordingly. A link between two comps stays until both have one name, so nothing is lost when a
    chain is only partly followed. Hub comps aggregate per task before the shuffle.
    """
    links = scratch.save(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), narrow=True)
    while not links.isEmpty():
        hooks = links.groupBy(F.col("b").alias("child")).agg(F.min("a").alias("parent"))
        up = hooks.select(F.col("child").alias("parent"), F.col("parent").alias("grand"))
        parents = scratch.save(hooks.join(up, "parent", "left").select("child", F.coalesce("grand", "parent").alias("parent")), narrow=True)
        renamed_a = links.join(parents, links.a == parents.child, "left").select(F.coalesce("parent", "a").alias("a"), "b")
        renamed = renamed_a.join(parents, renamed_a.b == parents.child, "left").select("a", F.coalesce("parent", "b").alias("b"))
        newer = scratch.save(
            renamed.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), narrow=True
        )
        moved = scratch.save(relabel(scratch, labels, parents), narrow=True)
        for old in (links, labels, parents):
            scratch.drop(old)
        links, labels = newer, moved
    scratch.drop(links)
    return labels
