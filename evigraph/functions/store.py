"""Cutting lineage in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that are shuffled at a time where work is done in slices, and the most slices, each of which reads the input again.
SLICE_ROWS, MOST_SLICES = 8_000_000, 8
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Where the setting is unset, a local session gets a new folder of its own; on a cluster that is an
    error, as executors would write where nobody else reads.
    """
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not given:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        given = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(given)
    return given


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and cut from its lineage, so that it is computed once and survives lost executors."""
    shared(df.sparkSession)
    return df.checkpoint()


@contextmanager
def cleaned(spark: SparkSession):
    """Shuffle files of the queries inside go as these end, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEAN)
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN, before)


def _write(df: DataFrame, path: str) -> None:
    with cleaned(df.sparkSession):
        df.write.mode("append").option("compression", "zstd").parquet(path)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: smaller than a checkpoint, and read by column."""
    path = f"{shared(df.sparkSession)}/table-{uuid.uuid4().hex}"
    _write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_in_slices(rows: DataFrame, by: list[str], of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``of(rows)``, stored, where ``of`` can be applied to any rows that have all those of their values of ``by``.

    It is applied to one slice of the values after another, so that only one slice's shuffles are on disk at a time.
    """
    slices = min(MOST_SLICES, 1 + rows.count() // SLICE_ROWS)
    path, out = f"{shared(rows.sparkSession)}/table-{uuid.uuid4().hex}", None
    for i in range(slices):
        out = of(rows.where(F.pmod(F.xxhash64(*by), F.lit(slices)) == i) if slices > 1 else rows)
        _write(out, path)
    return rows.sparkSession.read.schema(out.schema).parquet(path)
