"""Connected components of links between ids, by repeated joins on narrow rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbvec.session import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """id and component (smallest id reachable) of every id that occurs in ``links``.

    Every round each id takes the smallest label among itself and its neighbours, then the label of its label
    (halving the depth), so the rounds follow the logarithm of a chain's length. Labels are written to the shared
    folder after a round. A hub's row is joined by its neighbours' rows, whose side of the join can be split, and
    minima are taken inside the tasks before rows are shuffled.
    """
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    edges = materialize(pairs.union(pairs.select("v", "u")).distinct(), "links")
    # After the first step every id knows its smallest neighbour.
    labels = materialize(edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("label"))
                         .withColumnRenamed("u", "id"), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("id", "v"), "v").groupBy("u").agg(F.min("label").alias("near"))
        taken = labels.join(near.withColumnRenamed("u", "id"), "id").select(
            "id", "label", F.least("label", "near").alias("hop"))
        # A label is an id itself; what that id has taken by now is at least as small.
        jump = labels.select(F.col("id").alias("hop"), F.col("label").alias("further"))
        rows = taken.join(jump, "hop", "left").select(
            "id", "label", F.least("hop", F.coalesce("further", "hop")).alias("new"))
        written = materialize(rows, "labels")
        changed = written.filter("new <> label").limit(1).count()
        labels = written.select("id", F.col("new").alias("label"))
        if not changed:
            return labels.select("id", F.col("label").alias("component"))
