"""What the corpus operators share: reading tables, cutting lineage, holding rows out."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch for Python workers at most; a batch is held several times over in a
#: worker and in the JVM's buffers, so Spark's 64 MB are too many. A text of more bytes is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 256, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; ``sf_dir`` may be in any store that Spark reads.

    The session's Arrow batches are lowered to ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes, as plans take
    these settings when they run.
    """
    for name_of, most in ("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES):
        setting = f"spark.sql.execution.arrow.{name_of}"
        given = spark.conf.get(setting).rstrip("b")
        if given.isdigit() and int(given) > most:  # a number with another unit is somebody's own choice
            spark.conf.set(setting, str(most))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a new folder of its own; on a cluster that is an error,
    as executors would write where nobody else reads.
    """
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not given:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        given = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(given)
    return given


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and cut from its lineage. For small and middling tables."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def packed(df: DataFrame, rows: int, of_task: int = 25_000) -> DataFrame:
    """``df`` in no more partitions than about ``rows`` rows, narrow ones, are worth: all rows, and fewer tasks for the driver to keep track of."""
    return df.coalesce(1 + rows // of_task)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, for wide rows: smaller than a checkpoint, and read by column."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, divisor: int, held: int, most: int) -> DataFrame:
    """(doc_id, text, y) of at most ``most`` labelled documents outside the held-out fold, one row an id.

    The sample is the ``most`` ids with the smallest hash, so it does not depend on how the tables
    are laid out. It is bounded, so its ids may be broadcast. Labels that are null or neither 0 nor 1
    are left out, as are rows without an id or text; of several labels of an id the largest counts,
    of several texts the smallest.
    """
    ids = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (remainder(F.col("doc_id"), divisor) != held))
        .groupBy("doc_id").agg(F.max(label).alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    found = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(ids), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").cast("int").alias("y"))
