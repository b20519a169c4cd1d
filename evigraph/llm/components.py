"""Connected components by smallest label, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(links: DataFrame) -> DataFrame:
    """(node, root): for each node of ``links`` (a, b) the smallest node it can reach.

    Every round takes the smallest label of a node's neighbours and the label of its label: a node asks
    both at once, and answers are combined before the shuffle, so a node with many links costs little.
    A round is one join and one sum, so that the driver has few exchanges to keep track of; the number of
    rounds grows with the logarithm of a chain's length. Each round is written to the shared folder, which
    survives lost executors. Repeated links and links of a node to itself do no harm; links with a null
    are left out. Few links are kept in few partitions, whatever the session's number of them.
    """
    links = links.where("a is not null and b is not null and a <> b")
    both = common.stored(links.select(F.inline(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v"))))).distinct())
    n = both.count()
    few = lambda df: common.packed(df, n)
    both = few(both)
    labels = common.stored(few(both.groupBy("u").agg(F.min("v").alias("v"))).select(F.col("u").alias("node"), F.least("u", "v").alias("root"), F.lit(True).alias("moved")))
    while not labels.where("moved").isEmpty():
        asked = both.unionByName(labels.select(F.col("node").alias("u"), F.inline(F.array(F.struct(F.col("node").alias("v")), F.struct(F.col("root").alias("v"))))))
        answers = asked.join(labels, asked["v"] == labels["node"]).groupBy("u").agg(F.min("root").alias("least"), F.min(F.when(F.col("u") == F.col("v"), F.col("root"))).alias("old"))
        labels = common.stored(few(answers).select(F.col("u").alias("node"), F.col("least").alias("root"), (F.col("least") < F.col("old")).alias("moved")))
    return labels.select("node", "root")
