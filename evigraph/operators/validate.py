"""What an ontology allows, and what is wrong with a graph.

Ontologies are mostly small files; whether their tables are broadcast is left to Spark, which knows their size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evigraph.functions.store import stored


def known_types(nodes: DataFrame, types: DataFrame) -> DataFrame:
    """The nodes whose type is in the ontology."""
    return nodes.join(types.select("node_type").distinct(), "node_type", "left_semi")


def _lists(properties: DataFrame) -> DataFrame:
    return properties.groupBy(F.col("node_type").alias("_type")).agg(F.collect_set("property").alias("_allowed"))


def allowed_properties(nodes: DataFrame, properties: DataFrame) -> DataFrame:
    """Nodes with only the properties that their type may have."""
    joined = nodes.join(_lists(properties), F.col("node_type") == F.col("_type"), "left")
    kept = F.expr("filter(props, p -> array_contains(coalesce(_allowed, cast(array() as array<string>)), p.key))")
    return joined.withColumn("props", kept).drop("_type", "_allowed")


def removed_properties(nodes: DataFrame, properties: DataFrame) -> DataFrame:
    """(node_id, node_type, property): what :func:`allowed_properties` takes away."""
    long = nodes.select("node_id", "node_type", F.explode("props").alias("p")).select("node_id", "node_type", F.col("p.key").alias("property"))
    return long.join(properties, ["node_type", "property"], "left_anti").select("node_id", "node_type", "property")


def ends(relationships: DataFrame, nodes: DataFrame) -> DataFrame:
    """Relationships with ``source_type`` and ``target_type``, null where there is no such node; of a repeated id the last node counts. Relationships that have them are taken as they are."""
    if "source_type" in relationships.columns:
        return relationships
    one = nodes.groupBy("node_id").agg(F.max_by("node_type", "occ_ord").alias("node_type"))
    s, t = (one.select(F.col("node_id").alias(f"_{x}"), F.col("node_type").alias(f"{y}_type")) for x, y in (("s", "source"), ("t", "target")))
    return relationships.join(s, F.col("source_node_id") == F.col("_s"), "left").join(t, F.col("target_node_id") == F.col("_t"), "left").drop("_s", "_t")


def orphans(relationships: DataFrame, nodes: DataFrame) -> DataFrame:
    """Relationships without one of their ends, and which: source, target or both."""
    found = ends(relationships, nodes).where("source_type is null or target_type is null")
    return found.withColumn("reason", F.when(F.col("source_type").isNotNull(), "target").when(F.col("target_type").isNotNull(), "source").otherwise("both"))


def violations(relationships: DataFrame, nodes: DataFrame, signatures: DataFrame) -> DataFrame:
    """Relationships with both ends whose types do not allow them."""
    found = ends(relationships, nodes).where("source_type is not null and target_type is not null")
    return found.join(signatures.distinct(), ["source_type", "relationship_type", "target_type"], "left_anti")


def valid(relationships: DataFrame, nodes: DataFrame, signatures: DataFrame) -> DataFrame:
    """Relationships with both ends and an allowed signature."""
    return ends(relationships, nodes).join(signatures.distinct(), ["source_type", "relationship_type", "target_type"], "left_semi").select(*relationships.columns)


def final_filter(relationships: DataFrame, nodes: DataFrame, signatures: DataFrame) -> DataFrame:
    """All relationships with ``verdict``, in one pass: kept, or why not.

    ``source missing``, ``target missing``, ``both missing`` where an end is no node, ``signature not allowed``, or ``repeated`` where
    an earlier one that is sound has the same ends and type.
    """
    allowed = signatures.distinct().withColumn("_ok", F.lit(True))
    seen = ends(relationships, nodes).join(allowed, ["source_type", "relationship_type", "target_type"], "left")
    no_source, no_target = F.col("source_type").isNull(), F.col("target_type").isNull()
    lost = F.when(no_source & no_target, "both missing").when(no_source, "source missing").when(no_target, "target missing").when(F.col("_ok").isNull(), "signature not allowed")
    judged = seen.withColumn("_lost", lost).drop("_ok")
    triple = ["source_node_id", "relationship_type", "target_node_id"]
    first = judged.where("_lost is null").groupBy(*triple).agg(F.min("rel_ord").alias("_first"))  # these have no null
    again = F.row_number().over(W.partitionBy(*triple, "rel_ord").orderBy("relationship_id")) > 1  # rows of one ordinal are few
    verdict = F.coalesce(F.col("_lost"), F.when((F.col("rel_ord") == F.col("_first")) & ~again, "kept").otherwise("repeated"))
    return judged.join(first, triple, "left").withColumn("verdict", verdict).select(*relationships.columns, *(c for c in ("source_type", "target_type") if c not in relationships.columns), "verdict")


def degrees(relationships: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node_id, node_type, degree): ends of relationships at each node, valid or not; a loop counts twice."""
    touched = relationships.select(F.explode(F.array("source_node_id", "target_node_id")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    return nodes.select("node_id", "node_type").join(touched, F.col("node_id") == F.col("id"), "left").select("node_id", "node_type", F.coalesce("degree", F.lit(0)).cast("long").alias("degree"))


def coverage(nodes: DataFrame, types: DataFrame) -> DataFrame:
    """(node_type, n, found): nodes of each type of the ontology, 0 too."""
    counts = nodes.groupBy(F.col("node_type").alias("t")).agg(F.count(F.lit(1)).alias("n"))
    return types.select("node_type").distinct().join(counts, F.col("node_type") == F.col("t"), "left").select("node_type", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.col("n").isNotNull().alias("found"))


def relationship_coverage(relationships: DataFrame, signatures: DataFrame) -> DataFrame:
    """(relationship_type, n): relationships of each type of the ontology, 0 too."""
    counts = relationships.groupBy(F.col("relationship_type").alias("t")).agg(F.count(F.lit(1)).alias("n"))
    return signatures.select("relationship_type").distinct().join(counts, F.col("relationship_type") == F.col("t"), "left").select("relationship_type", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def _bare(rows: DataFrame) -> Column:
    """Whether a row has no evidence: by its flag, where evidence is a table, or by its array."""
    return ~F.col("has_evidence") if "has_evidence" in rows.columns else F.coalesce(F.size("evidence"), F.lit(0)) <= 0


def thin_nodes(nodes: DataFrame) -> DataFrame:
    """(node_id, node_type, occ_ord, keys, bare): what validation looks at."""
    return nodes.select("node_id", "node_type", "occ_ord", F.col("keys") if "keys" in nodes.columns else F.transform("props", lambda p: p["key"]).alias("keys"), _bare(nodes).alias("bare"))


def thin_relationships(relationships: DataFrame) -> DataFrame:
    """(relationship_id, relationship_type, source_node_id, target_node_id, bare)."""
    return relationships.select("relationship_id", "relationship_type", "source_node_id", "target_node_id", _bare(relationships).alias("bare"))


def _thin(nodes: DataFrame, relationships: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and relationships with only what validation looks at, computed once; those that are thin are taken as they are."""
    n = nodes if "keys" in nodes.columns else stored(thin_nodes(nodes))
    r = relationships if "bare" in relationships.columns else thin_relationships(relationships)
    return n, r if "source_type" in r.columns else stored(ends(r, n))


def findings(nodes: DataFrame, relationships: DataFrame, types: DataFrame, properties: DataFrame, signatures: DataFrame) -> DataFrame:
    """(kind, subject): a row for each error. Relationships without an end or an allowed signature are not looked at further."""
    return _findings(*_thin(nodes, relationships), types, properties, signatures)


errors = findings


def _findings(n: DataFrame, r: DataFrame, types: DataFrame, properties: DataFrame, signatures: DataFrame) -> DataFrame:
    row = lambda test, kind, subject: F.when(test, F.struct(F.lit(kind).alias("kind"), subject.alias("subject")))
    rows = lambda df, *found: df.select(F.inline(F.filter(F.array(*found), lambda x: x.isNotNull())))
    own = types.select(F.col("node_type").alias("_known")).distinct()
    bad = F.array_sort(F.array_distinct(F.expr("filter(keys, k -> not array_contains(coalesce(_allowed, cast(array() as array<string>)), k))")))
    seen = n.join(own, F.col("node_type") == F.col("_known"), "left").join(_lists(properties), F.col("node_type") == F.col("_type"), "left").withColumn("bad", bad)
    # the same key of one id counts once, as do keys of a repeated node
    by_node = rows(seen, row(F.col("_known").isNull(), "unknown type", F.col("node_id")), row(F.col("bare"), "node without evidence", F.col("node_id")))
    keys = seen.where(F.size("bad") > 0).groupBy("node_id", "node_type").agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("bad")))), ",").alias("keys"))
    keys = keys.select(F.lit("unsupported properties").alias("kind"), F.concat_ws(":", "node_id", "keys").alias("subject"))
    again = lambda df, by, kind, subject: df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit(kind).alias("kind"), subject.alias("subject"), F.explode(F.expr("sequence(2, n)"))).select("kind", "subject")
    judged = r.join(signatures.distinct().withColumn("_ok", F.lit(True)), ["source_type", "relationship_type", "target_type"], "left")
    lost, ok = F.col("source_type").isNull() | F.col("target_type").isNull(), F.col("_ok").isNotNull()
    by_relationship = rows(judged, row(lost, "orphan relationship", F.col("relationship_id")), row(~lost & ~ok, "invalid relationship", F.concat_ws("|", "source_type", "relationship_type", "target_type")), row(ok & F.col("bare"), "relationship without evidence", F.col("relationship_id")))
    triple = ["source_node_id", "relationship_type", "target_node_id"]
    return (
        by_node.unionByName(keys).unionByName(by_relationship)
        .unionByName(again(n, ["node_id"], "duplicate node", F.col("node_id"))).unionByName(again(judged.where(ok), triple, "duplicate relationship", F.concat_ws("|", *triple)))
    )


#: Errors that an earlier form of the validator only warns of.
WARNINGS = ("unsupported properties", "node without evidence", "relationship without evidence")


def graded(found: DataFrame, missing: DataFrame) -> DataFrame:
    """(level, kind, subject): findings as errors or warnings; missing types (node_type) are warnings and never make a graph invalid."""
    level = F.when(F.col("kind").isin(*WARNINGS), "warning").otherwise("error")
    return found.select(level.alias("level"), "kind", "subject").unionByName(missing.select(F.lit("warning").alias("level"), F.lit("missing type").alias("kind"), F.col("node_type").alias("subject")))


def without_orphans(found: DataFrame) -> DataFrame:
    """Findings of a validator that lists relationships without an end, but counts no error for them."""
    return found.where("kind <> 'orphan relationship'")


def summary(nodes: DataFrame, relationships: DataFrame, types: DataFrame, properties: DataFrame, signatures: DataFrame) -> DataFrame:
    """One row: counts of nodes, relationships, disconnected nodes, missing types and errors, and whether all is valid."""
    n, r = _thin(nodes, relationships)
    names = ["node_count", "relationship_count", "disconnected_count", "missing_type_count", "error_count"]
    counts = [n, r, degrees(r, n).where("degree = 0"), coverage(n, types).where("not found"), _findings(n, r, types, properties, signatures)]
    out = None
    for name, df in zip(names, counts):
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = part if out is None else out.unionByName(part)
    return out.agg(*(F.max(F.when(F.col("name") == x, F.col("n"))).alias(x) for x in names)).withColumn("valid", F.col("error_count") == 0)
