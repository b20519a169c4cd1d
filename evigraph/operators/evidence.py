"""Evidence: quotes must stand in a chunk; evidence is united in order without repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evigraph.functions import ranks, text
from evigraph.functions.store import stored
from evigraph.operators.contains import containing

SCHEMA = "array<struct<document_id: string, source_file: string, page: string, chunk_id: string, quote: string>>"
FIELDS = ("document_id", "source_file", "page", "chunk_id", "quote")
SHORTEST = 8
#: Items of one group that may stand in one array, at a sink.
MOST_LISTED = 100_000


def in_own_chunk(quotes: DataFrame, chunks: DataFrame) -> DataFrame:
    """The rows of ``quotes`` (document_id, chunk_id, quote, ...) whose quote stands in the chunk they name.

    Quotes are compared lower-cased with collapsed white space and need ``SHORTEST`` characters.
    Chunks are named by document and chunk id.
    """
    own = chunks.select("document_id", "chunk_id", text.folded(F.col("text")).alias("_body"))
    wanted = quotes.withColumn("_quote", text.folded(F.col("quote"))).where(F.length("_quote") >= SHORTEST)
    return wanted.join(own, ["document_id", "chunk_id"]).where(F.contains("_body", F.col("_quote"))).drop("_body", "_quote")


def in_any_chunk(quotes: DataFrame, chunks: DataFrame) -> DataFrame:
    """The rows of ``quotes`` (quote, ...) whose quote stands in some chunk.

    Where quotes name a document and chunk, that chunk is looked at first; only quotes that do not stand
    there are looked for in all chunks, through their rarest words. Quotes are taken once each; no pair
    is lost and no nested loop is needed.
    """
    wanted = quotes.withColumn("_quote", text.folded(F.col("quote"))).where(F.length("_quote") >= SHORTEST)
    kinds = wanted.select(F.col("_quote").alias("phrase")).distinct()
    own = None
    if {"document_id", "chunk_id"} <= set(quotes.columns):
        own = in_own_chunk(quotes.select("document_id", "chunk_id", "quote"), chunks).select(text.folded(F.col("quote")).alias("phrase")).distinct()
        kinds = kinds.join(own, "phrase", "left_anti")
    bodies = chunks.select(text.folded(F.col("text")).alias("body")).where(F.length("body") >= SHORTEST).withColumn("text_id", F.xxhash64("body")).dropDuplicates(["text_id", "body"])
    found = containing(kinds, bodies, one=True).select("phrase").distinct()
    found = found if own is None else found.unionByName(own)
    return wanted.join(found.select(F.col("phrase").alias("_quote")), "_quote", "left_semi").drop("_quote")


def cleaned(evidence: Column, document_id: Column, source_file: Column, chunk_id: Column, page: Column) -> Column:
    """Items with a quote, each once, missing fields taken from the chunk."""
    filled = F.transform(evidence, lambda e: F.struct(
        F.coalesce(e["document_id"], document_id).alias("document_id"), F.coalesce(e["source_file"], source_file).alias("source_file"),
        F.coalesce(e["page"], page.cast("string")).alias("page"), F.coalesce(e["chunk_id"], chunk_id).alias("chunk_id"), e["quote"].alias("quote")))
    return F.array_distinct(F.filter(F.coalesce(filled, F.array().cast(SCHEMA)), lambda e: text.collapsed(e["quote"]) != ""))


def grounded(evidence: Column, body: Column) -> Column:
    """The items whose quote stands in the one chunk text given."""
    whole = text.folded(body)
    return F.filter(evidence, lambda e: (F.length(text.folded(e["quote"])) >= SHORTEST) & F.contains(whole, text.folded(e["quote"])))


def items(rows: DataFrame, by: str, order: str, evidence: str = "evidence") -> DataFrame:
    """(by, at, fields): the evidence of ``rows``, an item a row; ``at`` is the row's order and the place in its array."""
    listed = rows.select(by, F.col(order).alias("_order"), F.posexplode(F.coalesce(F.col(evidence), F.array().cast(SCHEMA))).alias("_place", "_item"))
    return listed.select(by, F.struct("_order", F.col("_place").cast("long").alias("_place")).alias("at"), "_item.*")


def numbered(items: DataFrame, group: str, order: str, kept: bool = False) -> DataFrame:
    """(group, place, document_id, source_file, page, chunk_id, quote): the different items of each group, in the order they first appear.

    ``items`` has one row an item; nulls equal nulls. Items are shuffled once, by their group; those of a large group
    are numbered within pieces of the order, so a group of very many is no single task and no single array.
    They are read twice, and stored for that unless they are ``kept`` in a table already.
    """
    keys = list(dict.fromkeys([group, *FIELDS]))
    placed = items.select(F.col(order).alias("_at"), *keys)
    few, many = ranks.by_size(placed if kept else stored(placed), [group])
    once = lambda rows: rows.groupBy(*keys).agg(F.min("_at").alias("_first"))
    out = ranks.in_window(once(few.repartition(group)), [group], ["_first", *FIELDS], "place").select(group, "place", *FIELDS)
    return out if many is None else out.unionByName(ranks.by_ranges(once(many), [group], ["_first", *FIELDS], "place").select(group, "place", *FIELDS))


def listed(numbered_items: DataFrame, by: str, most: int = MOST_LISTED) -> DataFrame:
    """(by, evidence): the items of each group as one array in order, for a sink; a group of more than ``most`` is an error.

    An item whose place is beyond the bound ends the job before it is collected.
    """
    item = F.when(F.col("place") < most, F.struct("place", F.struct(*FIELDS).alias("item"))).otherwise(F.raise_error(F.lit(f"over {most} evidence items in one array")).cast("struct<place: long, item: " + SCHEMA[6:-1] + ">"))
    return numbered_items.groupBy(by).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["item"]).cast(SCHEMA).alias("evidence"))
