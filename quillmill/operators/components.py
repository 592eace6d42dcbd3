"""Connected components of a table of links, by least labels and short cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.session import written


def component_labels(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, label)``: for every node of ``links`` the least node that a chain of links leads to.

    In each round a label hands on the least label seen across a link, to the node and to the node that its old label
    names, and then every label is replaced by the label of the node that it names. Rounds grow with the logarithm of the longest
    chain. Only least values are aggregated, so a node with very many links sends on one row a task; each round is written.
    """
    ways = [F.struct(F.col(x).alias("node"), F.col(y).alias("other")) for x, y in ((a, b), (b, a))]
    # both ways of a link in one go: a union would work the links out twice
    both = links.filter(F.col(a) != F.col(b)).select(F.explode(F.array(*ways)).alias("_way")).select("_way.*")
    both = written(both.distinct(), "links")
    labels = written(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("seen"))
        met = labels.join(seen, "node").select("node", "label", F.least("label", "seen").alias("new"))
        # the node that a label names learns of the better one as well: whole stars move at once
        offers = met.select("node", "new").unionByName(met.select(F.col("label").alias("node"), "new"))
        better = offers.groupBy("node").agg(F.min("new").alias("label"))
        named = better.select(F.col("node").alias("label"), F.col("label").alias("further"))
        cut = better.join(named, "label", "left").select("node", F.least("label", F.coalesce("further", "label")).alias("label"))
        cut = written(cut, "labels")
        if cut.join(labels.withColumnRenamed("label", "old"), "node").filter("label <> old").isEmpty():
            return cut
        labels = cut
