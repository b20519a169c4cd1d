"""Numbers in an order, without one task for a large group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evigraph.functions.store import stored

#: A group of about as many rows is dealt over several tasks; it is looked for among one row in ``ONE_IN``.
MANY, ONE_IN = 1_000_000, 1000


def _same(group: list[str], other: str) -> Column:
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"{other}{g}"))
    return same


def by_size(rows: DataFrame, group: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """Stored ``rows`` of groups that one task may hold, and those of large ones, if there are any.

    What is large is estimated; either way of numbering is right for any group.
    """
    if rows.count() < MANY:
        return rows, None
    seen = rows.select(*(F.col(g).alias(f"_{g}") for g in group)).sample(1 / ONE_IN, seed=1)
    large = stored(seen.groupBy(*seen.columns).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= MANY // ONE_IN).drop("_n"))  # few
    if large.isEmpty():
        return rows, None
    named = F.broadcast(large)
    return rows.join(named, _same(group, "_"), "left_anti"), rows.join(named, _same(group, "_"), "left_semi")


def by_ranges(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """As :func:`numbered`, for few groups: rows are sorted by ranges of group and order, which hold a group's rows next to each other."""
    dealt = stored(rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order).withColumn("_piece", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()))
    pieces = dealt.groupBy(*group, "_piece").agg(F.min("_row").alias("_from"), F.count(F.lit(1)).alias("_in_all"))
    before = F.coalesce(F.sum("_in_all").over(W.partitionBy(*group).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = pieces.select(*(F.col(g).alias(f"_{g}") for g in group), F.col("_piece").alias("_of"), (before - F.col("_from")).alias("_shift"))
    placed = dealt.join(starts, _same(group, "_") & (F.col("_piece") == F.col("_of")))
    return placed.withColumn(name, (F.col("_row") + F.col("_shift")).cast("long")).drop("_piece", "_row", "_of", "_shift", *(f"_{g}" for g in group))


def in_window(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """As :func:`numbered`, a group in one task."""
    return rows.withColumn(name, (F.row_number().over(W.partitionBy(*group).orderBy(*order)) - 1).cast("long"))


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``: the place from 0 of each row in its group, in the order of ``order``.

    Rows of large groups, as of all rows where ``group`` is empty, are dealt by ranges of the order, and the counts of the
    ranges before are added; groups of which a task may hold many are numbered as they are.
    """
    if not group:
        return by_ranges(rows, group, order, name)
    few, many = by_size(stored(rows), group)
    small = in_window(few, group, order, name)
    return small if many is None else small.unionByName(by_ranges(many, group, order, name))
