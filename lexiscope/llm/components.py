"""Connected components of an edge table by hooking and pointer jumping, all in joins.

Each round every node takes the least label among its neighbours, hands it on to its
present root, and then jumps to its label's label, so the rounds grow with the logarithm of
a component's size.  Labels are written to the shared folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiscope.llm.common import find_by, written


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``): the least node of its component.

    Nodes with very many neighbours, and labels that very many nodes share, are broadcast (:func:`find_by`), so neither
    a hub nor a large component is one task.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    # degree: the rows of ``both`` that ask for the node's label.
    label = written(both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("degree")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("root"), "degree"), "labels")
    while True:
        seen = find_by(both, label.withColumnRenamed("node", "b"), "b", "degree").groupBy("a").agg(
            F.min("root").alias("m"))
        near = label.join(seen, label["node"] == seen["a"]).select("node", "root", "degree", F.least("m", "root").alias("m"))
        hooked = written(near.select("node", "m", "degree").union(near.select("root", "m", F.lit(0).cast("long"))).groupBy(
            "node").agg(F.min("m").alias("m"), F.max("degree").alias("degree")), "hooked")
        shared = hooked.groupBy("m").agg(F.count(F.lit(1)).alias("n"))
        up = written(hooked.select(F.col("node").alias("m"), F.col("m").alias("mm")).join(shared, "m"), "parents")
        new = written(find_by(hooked, up, "m", "n").select("node", F.least("m", "mm").alias("root"), "degree"), "labels")
        changed = new.join(label.select("node", F.col("root").alias("was")), "node").where("root <> was").limit(1).count()
        label = new
        if not changed:
            return label.select("node", "root")
