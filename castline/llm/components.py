"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castline.llm.common import discard, staged


def components(edges: DataFrame) -> DataFrame:
    """``node, comp``: the smallest node reachable from every node of ``edges`` (``a``, ``b``).

    Rounds of the smallest label among neighbours, then of the label's label, so
    that a chain halves in a round; every round is written to the shared folder.
    Labels spread by joins with fresh shuffles on both sides, which adaptive
    execution splits where a node has very many edges.  Nothing is collected.
    """
    both = staged(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "cc-edges")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("comp")), "cc-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        spread = staged(labels.join(near, "node", "left").select(
            "node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp")), "cc-spread")
        jump = spread.select(F.col("node").alias("comp"), F.col("comp").alias("to"))
        new = staged(spread.join(jump, "comp").select("node", "was", F.least("comp", "to").alias("comp")), "cc-labels")
        discard(labels, spread)
        if new.where("comp <> was").isEmpty():
            discard(both)
            return new.select("node", "comp")
        labels = new
