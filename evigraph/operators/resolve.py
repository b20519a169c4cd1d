"""Applying duplicate reviews: accept, follow chains to their root, break cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evigraph.functions.store import cut


def judge(reviews: DataFrame, nodes: DataFrame) -> DataFrame:
    """Duplicate reviews with ``verdict``: accepted, or why not.

    ``reviews`` is (review_ord, node_id, duplicate_of); of several accepted ones of a node the first
    counts, the others are ``repeated``. A node is no duplicate of itself or of another type.
    """
    own, other = (nodes.select(F.col("node_id").alias(f"{x}_id"), F.col("node_type").alias(f"{x}_type"), F.col("occ_ord").alias(f"{x}_ord")) for x in ("own", "other"))
    seen = reviews.join(own, F.col("node_id") == F.col("own_id"), "left").join(other, F.col("duplicate_of") == F.col("other_id"), "left")
    verdict = F.when(F.col("own_id").isNull(), "unknown node").when(F.col("other_id").isNull(), "unknown duplicate").when(F.col("own_id") == F.col("other_id"), "self").when(F.col("own_type") != F.col("other_type"), "type mismatch").otherwise("accepted")
    judged = seen.withColumn("verdict", verdict)
    first = F.row_number().over(W.partitionBy("node_id", "verdict").orderBy("review_ord"))
    return judged.withColumn("verdict", F.when((F.col("verdict") == "accepted") & (first > 1), "repeated").otherwise(F.col("verdict"))).select("review_ord", "node_id", "duplicate_of", "verdict", "own_ord", "other_ord")


def roots(judged: DataFrame) -> DataFrame:
    """(old_node_id, node_id): the end of each accepted chain; of a cycle, its member of the smallest ordinal.

    Pointers are doubled, so the rounds are the binary digits of the longest chain; each is a
    checkpoint. A node has one pointer at most, so what still points on after as many steps as there
    are rows leads round a cycle; the smallest ordinal met on the way is that cycle's.
    """
    edge = judged.where("verdict = 'accepted'").select(F.col("node_id").alias("old_node_id"), F.struct(F.col("other_ord").alias("o"), F.col("duplicate_of").alias("id")).alias("up"))
    step = cut(edge.select("old_node_id", "up", F.col("up").alias("least"), F.lit(False).alias("done")))
    n, length = step.count(), 1
    while length < 2 * n and step.where("not done").limit(1).count():
        on = step.select(F.col("old_node_id").alias("via"), F.col("up").alias("up2"), F.col("least").alias("least2"))
        step = cut(step.join(on, F.col("up.id") == F.col("via"), "left").select("old_node_id", F.coalesce("up2", "up").alias("up"), F.when(F.col("via").isNull(), F.col("least")).otherwise(F.least("least", "least2")).alias("least"), F.col("via").isNull().alias("done")))
        length *= 2
    # on a cycle every further round walks it whole, so ``least`` holds at least the cycle's members
    ends = step.where("done").select("old_node_id", F.col("up.id").alias("node_id"))
    cycling = step.where("not done").select("old_node_id", F.col("up.id").alias("at"))
    members = cycling.select(F.col("at").alias("member")).distinct()
    loop = step.join(members, F.col("old_node_id") == F.col("member")).select(F.col("member"), F.col("least.id").alias("node_id"))
    turned = cycling.join(loop, F.col("at") == F.col("member")).select("old_node_id", "node_id")
    return ends.unionByName(turned).where("old_node_id <> node_id")
