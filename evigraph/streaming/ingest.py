"""Chunk files as they arrive, merged into the node occurrences so far. An extension of our own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evigraph.operators import evidence as E
from evigraph.operators import merge as M
from evigraph.sources import chunks as C


def stream(spark: SparkSession, folder: str, files_each: int = 100) -> DataFrame:
    """A stream of the chunks of new ``*_chunks.json`` files; their ordinal is in their file only."""
    files = spark.readStream.schema(C.FILE_SCHEMA).option("multiLine", True).option("pathGlobFilter", "*_chunks.json").option("maxFilesPerTrigger", files_each).json(folder)
    return files.select(F.col("_metadata.file_path").alias("chunk_file"), F.posexplode("chunks").alias("pos", "c")).select("chunk_file", F.col("pos").cast("long").alias("chunk_ord"), "c.*")


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str, extract: Callable[[DataFrame], DataFrame]):
    """A query that writes ``extract`` of each batch of new chunks to ``out``, one folder a batch.

    A batch that runs again after a failure overwrites its own folder, so no row is there twice.
    """

    def one(batch: DataFrame, number: int) -> None:
        extract(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream(spark, folder).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge(spark: SparkSession, folder: str, out: str, checkpoint: str, extract: Callable[[DataFrame], DataFrame], strategy: str = "canonical"):
    """A query that merges the node occurrences of each batch of new chunks into the nodes so far.

    ``extract`` gives occurrences (occ_ord, node_id, node_type, canonical_key, source_instance_id, props, evidence) of
    chunks. Nodes that are there come before those of a later batch, whatever the ordinals, so order goes on over
    files as they arrive. Batch n reads version n - 1 of the tables and writes version n, so one that runs again after a failure
    gives the same; see :func:`merged` for the last one.
    """
    key = M.STRATEGIES[strategy]

    def version(kind: str, number: int) -> str:
        return f"{out}/{kind}/version={number}"

    def one(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        fresh = extract(batch)
        if number:
            known, items = (session.read.parquet(version(kind, number - 1)) for kind in ("nodes", "evidence"))
            found = M.merged_with(known, items, fresh, key())
        else:
            found = M.merged_nodes(fresh, strategy)
        found.table.write.mode("overwrite").parquet(version("nodes", number))
        found.evidence().write.mode("overwrite").parquet(version("evidence", number))

    return stream(spark, folder).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merged(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, evidence) of the last version that is whole: evidence (node_id, place, fields) is written after nodes."""
    last = spark.read.parquet(f"{out}/evidence").agg(F.max("version")).first()[0]
    nodes, items = (spark.read.parquet(f"{out}/{kind}/version={last}") for kind in ("nodes", "evidence"))
    return nodes, items.select("node_id", "place", *E.FIELDS)
