"""Chunks of documents: from chunk files, or cut from a table of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evigraph.functions import ordinals

FILE_SCHEMA = """chunks array<struct<document_id: string, chunk_id: string, source_file: string, chunk_index: int,
    start_page: int, end_page: int, character_count: int, text: string>>"""
COLUMNS = ("chunk_ord", "document_id", "chunk_id", "source_file", "start_page", "end_page", "text")


PATTERN = "*_chunks.json"


def read(spark: SparkSession, folder: str, relative: bool = False) -> DataFrame:
    """The chunks of all ``*_chunks.json`` files of a folder, in the order of file names, then of the arrays.

    A folder that is not there or has no such file is an error; a file without a ``chunks`` array has none. ``chunk_file`` is
    a file's whole URI, or, ``relative``, the folder's name and the file's. Files are counted, not rows collected: only a row
    for each file goes through a single window.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", PATTERN).load(folder).select("path")  # names only, contents are not read
    if not listed.limit(1).count():
        raise FileNotFoundError(f"no {PATTERN} files in {folder}")
    name = F.regexp_extract("_metadata.file_path", "[^/]*/[^/]*$", 0) if relative else F.col("_metadata.file_path")
    files = spark.read.schema(FILE_SCHEMA).json(folder, multiLine=True, pathGlobFilter=PATTERN).select(name.alias("chunk_file"), "chunks")
    sizes = files.groupBy("chunk_file").agg(F.sum(F.size(F.coalesce("chunks", F.array()))).alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("chunk_file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(F.col("chunk_file").alias("file"), before.alias("before"))
    rows = files.select("chunk_file", F.posexplode("chunks").alias("pos", "c")).join(starts, F.expr("chunk_file = file"))
    return rows.select((F.col("before") + F.col("pos")).cast("long").alias("chunk_ord"), "c.*", "chunk_file")


def cut(documents: DataFrame, size: int = 2000) -> DataFrame:
    """Texts of (doc_id, text, source) cut into pieces of ``size`` characters; a null or empty text has none.

    Their order is document and piece, as a struct.
    """
    pieces = F.expr(f"sequence(0, cast(ceil(length(text) / {size}) as int) - 1)")
    rows = documents.where("length(text) > 0").select("doc_id", "source", "text", F.explode(pieces).alias("piece"))
    return rows.select(
        ordinals.chunk(F.col("doc_id"), F.col("piece")).alias("chunk_ord"), F.concat(F.lit("doc_"), F.col("doc_id")).alias("document_id"), F.concat(F.lit("c"), F.col("piece")).alias("chunk_id"),
        F.col("source").alias("source_file"), (F.col("piece") + 1).cast("int").alias("start_page"), (F.col("piece") + 1).cast("int").alias("end_page"), F.expr(f"substring(text, piece * {size} + 1, {size})").alias("text"),
    )


def report(chunks: DataFrame, preview: int = 120) -> DataFrame:
    """What a listing of chunks shows: place, pages, length and the start of the text."""
    from evigraph.functions import text

    return chunks.select("chunk_ord", "document_id", "chunk_id", text.page_label(F.col("start_page"), F.col("end_page")).alias("pages"), F.length("text").cast("long").alias("n_chars"), F.substring(text.collapsed(F.col("text")), 1, preview).alias("preview"))


def by_document(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("document_id").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum(F.length("text")).cast("long").alias("n_chars"))
