"""Connected components of a graph given as edges, by minimum labels and pointer jumping."""

from pyspark.sql import functions as F

from rastro.session import scratch_path


def _stored(frame, label):
    """``frame`` written to the shared folder and read again, so later steps do not recompute it."""
    folder = scratch_path(frame.sparkSession, label)
    frame.write.parquet(folder)
    return frame.sparkSession.read.parquet(folder)


def connected_components(edges):
    """Table (node, label) for the nodes of ``edges`` (a, b): label is the component's least node.

    Every round takes the least label among a node and its neighbours and then the label of that
    label, so paths shrink geometrically. Each round is stored, and a lost executor costs one round.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = _stored(both.distinct(), "edges")
    labels = _stored(
        both.groupBy("a").agg(F.min("b").alias("least")).select(
            F.col("a").alias("node"), F.least("a", "least").alias("label")
        ),
        "labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        moved = labels.join(near, "node").select(
            "node", "label", F.least("label", "near").alias("next")
        )
        jumps = labels.select(F.col("node").alias("next"), F.col("label").alias("jump"))
        new = _stored(
            moved.join(jumps, "next").select(
                "node", F.least("next", "jump").alias("label"), (F.least("next", "jump") < F.col("label")).alias("changed")
            ),
            "labels",
        )
        if not new.where("changed").limit(1).count():
            return new.select("node", "label")
        labels = new.select("node", "label")
