"""A graph as one JSON object in a text file, as loaders expect it.

The object is a table of lines with their places; lines are sorted in ranges, and one task writes the ranges
one after the other, so it holds a range at a time and nothing goes through the driver but what is as
small as the ontology.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evigraph.functions import props as P
from evigraph.functions import ranks
from evigraph.operators import evidence as E
from evigraph.operators import validate as V
from evigraph.plans.assemble import serialized
from evigraph.plans.graph import Graph
from evigraph.sources.ontology import Ontology

VERSION = "evigraph-1"
#: Fields of nodes and relationships, in order.
NODE = ("id", "label", "node_id", "node_type", "properties", "evidence")
RELATIONSHIP = ("id", "relationship_id", "relationship_type", "source_id", "target_id", "source_node_id", "target_node_id", "properties", "evidence")


def _object(fields: tuple[str, ...]) -> Column:
    """A JSON object of columns; properties and evidence are JSON already."""
    shown = [F.concat(F.lit(f'"{f}": '), F.col(f) if f in ("properties", "evidence") else P.quoted(F.col(f))) for f in fields]
    return F.concat(F.lit("{"), F.concat_ws(", ", *shown), F.lit("}"))


def _lines(rows: DataFrame, section: int, line: Column, order: list[str]) -> DataFrame:
    """(section, at, line): list items, with a comma before all but the first."""
    placed = ranks.numbered(rows.select(*order, line.alias("line")), [], order, "at")
    return placed.select(F.lit(section).alias("section"), "at", F.concat(F.when(F.col("at") > 0, ", ").otherwise(""), F.col("line")).alias("line"))


def lines(graph: Graph, ontology: Ontology, ends: bool = False, most: int = E.MOST_LISTED) -> DataFrame:
    """(section, at, line): the object's lines. Nodes and relationships are in corpus order, findings by kind and subject."""
    spark = graph.nodes.sparkSession
    nodes, relations = serialized(graph, ends, most)
    placed = lambda rows, own, key, order: rows.join(own.select(F.col(key).alias("_key"), F.col(order).alias("_order")), F.col(key) == F.col("_key"))
    fields = RELATIONSHIP[:-2] + (("source", "target") if ends else ()) + RELATIONSHIP[-2:]
    found = V.coverage(graph.nodes, ontology.types_df(spark)).collect()  # as many as the ontology has
    kinds = V.relationship_coverage(graph.relationships, ontology.signatures_df(spark)).collect()
    counted = graph.audit["validation_summary"].first().asDict()
    chunks = graph.audit["chunk_counters"].first().asDict() if "chunk_counters" in graph.audit else {}
    names = lambda rows, has: [r[0] for r in sorted(rows) if bool(r.n) == has]
    dump = lambda value: json.dumps(value, ensure_ascii=False)
    head = {"node_types": list(dict.fromkeys(ontology.types)), "relationship_types": sorted({r for _, r, _ in ontology.signatures}), "relationship_signatures": [{"source": s, "relationship": r, "target": t} for s, r, t in ontology.signatures]}
    covered = {"node_types_found": names(found, True), "node_types_not_found": names(found, False), "relationship_types_found": names(kinds, True), "relationship_types_not_found": names(kinds, False)}
    summary = {"chunks_total": chunks.get("chunks"), "chunks_successful": chunks.get("chunks_ok"), "chunks_failed": chunks.get("chunks_failed"), "nodes": counted["node_count"], "relationships": counted["relationship_count"]}
    fixed = {
        0: f'{{"schema_version": {dump(VERSION)}, "ontology": {dump(head)}, "nodes": [', 2: '], "relationships": [',
        4: f'], "ontology_coverage": {dump(covered)}, "validation": {{"counts": {dump(counted)}, "errors": [', 6: f']}}, "extraction_summary": {dump(summary)}}}',
    }
    out = spark.createDataFrame([(k, 0, v) for k, v in fixed.items()], "section int, at long, line string")
    errors = graph.audit["validation_errors"]
    return (
        out.unionByName(_lines(placed(nodes, graph.nodes, "node_id", "occ_ord"), 1, _object(NODE), ["_order", "node_id"]))
        .unionByName(_lines(placed(relations, graph.relationships, "relationship_id", "rel_ord"), 3, _object(fields), ["_order", "relationship_id"]))
        .unionByName(_lines(errors, 5, F.concat(F.lit('{"kind": '), P.quoted(F.col("kind")), F.lit(', "subject": '), P.quoted(F.col("subject")), F.lit("}")), ["kind", "subject"]))
    )


def write_object(graph: Graph, ontology: Ontology, folder: str, ends: bool = False) -> None:
    """The graph as one JSON object: a single text file in ``folder``, in any store that Spark writes to; what is there is replaced."""
    lines(graph, ontology, ends).orderBy("section", "at").coalesce(1).select("line").write.mode("overwrite").text(folder)
