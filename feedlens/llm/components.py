"""Connected components by min-label propagation with pointer jumping.

Every round is a join and a partial aggregate over (node, label) rows, written to
the shared folder; nothing but one count per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from feedlens.llm.storage import stored, stored_rows


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge.

    Self edges and repeated edges change nothing; rows with a null end are ignored.
    No edges give no rows.  Raises if ``max_rounds`` do not suffice (the number of
    rounds is about the logarithm of the longest path).
    """
    ends = F.array(F.struct(F.col(a).alias("u"), F.col(b).alias("v")), F.struct(F.col(b).alias("u"), F.col(a).alias("v")))
    both = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.inline(ends)).distinct()
    both, n = stored_rows(both, "edges")
    labels = stored(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("u")).alias("component")), "labels", n)
    for _ in range(max_rounds):
        lab_v = labels.select(F.col("node").alias("v"), F.col("component").alias("cv"))
        heard = both.join(lab_v, "v").groupBy(F.col("u").alias("node")).agg(F.min("cv").alias("heard"))
        nearer = labels.join(heard, "node").select("node", "component", F.least("component", "heard").alias("near"))
        # pointer jump: the label of the label (a label is itself a node with an edge)
        root = labels.select(F.col("node").alias("near"), F.col("component").alias("far"))
        moved = Observation()
        after = nearer.join(root, "near", "left").select("node", F.least("near", "far").alias("component"), F.col("component").alias("was"))
        labels = stored(after.observe(moved, F.count_if(F.col("component") != F.col("was")).alias("n")).select("node", "component"), "labels", n)
        if not moved.get["n"]:
            return labels
    raise RuntimeError(f"components: labels still change after {max_rounds} rounds")
