"""Places in corpus order, as structs that are compared field by field.

No number has to hold several places, so none can overflow, and an item of a later stage is behind
all items of earlier ones however large their ids are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

#: Passes over chunks, and stages of a run in the order in which they add to the graph; repair rounds follow the last.
PASSES = ("primary", "recall", "coverage")
STAGES = ("extraction", "coverage", "relationships", "verification")


def chunk(document: Column, piece: Column) -> Column:
    """The place of a piece of a document."""
    return F.struct(document.cast("long").alias("document"), piece.cast("int").alias("piece"))


def item(stage: int, chunk: Column, pass_: Column, place: Column, passes: tuple[str, ...] = PASSES) -> Column:
    """The place of an item: stage, chunk, pass (by its place in ``passes``) and place in its reply."""
    rank = F.coalesce(*(F.when(pass_ == p, i) for i, p in enumerate(passes)), F.lit(len(passes)))
    return F.struct(F.lit(stage).cast("int").alias("stage"), chunk.alias("chunk"), rank.cast("int").alias("pass"), place.cast("long").alias("place"))


def later(kind: DataType, stage: int, place: Column) -> Column:
    """The place of an item that comes from no single chunk, of the type that :func:`item` gives elsewhere in the table."""
    if not isinstance(kind, StructType) or kind.names != ["stage", "chunk", "pass", "place"]:
        raise TypeError(f"no place of an item: {kind.simpleString()}")
    return F.struct(F.lit(stage).cast("int").alias("stage"), F.lit(None).cast(kind["chunk"].dataType).alias("chunk"), F.lit(0).cast("int").alias("pass"), place.cast("long").alias("place"))


def repair(round_: int) -> int:
    """The stage of a repair round, from 1."""
    return len(STAGES) - 1 + round_
