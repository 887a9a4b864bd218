"""Connected components of a table of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_shuffles, release, stored


def components(links: DataFrame) -> DataFrame:
    """(node, comp): comp is the smallest node reachable over ``links`` (a, b).

    Every round takes the smallest label among a node's neighbours and then the
    label of that label, so paths shorten fast; rounds end when nothing changes.
    A round's table is deleted once the next one is written, and tables are in as
    many files as their rows need, so the rounds take no more disk than one does.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "cc-links")
    n = both.count()                                     # from file footers; there are no more nodes than rows
    few, both = both, stored(both, "cc-links", n)
    release(few)
    label = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                   .select("node", F.least("node", "m").alias("comp")), "cc-labels", n)
    while True:
        near = both.join(label, F.col("b") == F.col("node"), "inner").groupBy("a").agg(F.min("comp").alias("m"))
        step = label.join(near, F.col("node") == F.col("a"), "inner") \
                    .select("node", F.col("comp").alias("old"), F.least("comp", "m").alias("comp"))
        jump = label.select(F.col("node").alias("j_node"), F.col("comp").alias("j_comp"))
        new = step.join(jump, F.col("comp") == F.col("j_node"), "left") \
                  .select("node", "old", F.least("comp", F.coalesce("j_comp", "comp")).alias("comp"))
        new = stored(new, "cc-labels", n)
        release(label)
        label = new.select("node", "comp")
        label._scratch = new._scratch
        if new.filter("comp <> old").isEmpty():
            release(both)
            del near, step, jump, new
            drop_shuffles(links.sparkSession)
            return label
