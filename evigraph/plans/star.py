"""A graph over the star schema, with defects planted by fixed rules, as input for every graph operator.

Occurrences of regions, nations, customers, suppliers, parts and orders; relationships between them.
Customers of every tenth key are mentioned again under an alias; some properties, types, endpoints
and signatures are wrong. ``*_SQL`` has the same rows for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evigraph.functions import props as P
from evigraph.sources.ontology import Ontology

ONTOLOGY = Ontology(
    types=["Region", "Nation", "Customer", "Supplier", "Part", "Order", "Warehouse"],
    properties={"Region": {"name"}, "Nation": {"name"}, "Customer": {"name", "segment", "balance"}, "Supplier": {"name"}, "Part": {"name", "brand"}, "Order": {"status", "priority"}, "Warehouse": {"name"}},
    signatures=[("Nation", "IN_REGION", "Region"), ("Customer", "LOCATED_IN", "Nation"), ("Supplier", "LOCATED_IN", "Nation"), ("Customer", "PLACED", "Order"), ("Order", "CONTAINS", "Part"), ("Supplier", "SUPPLIES", "Part"), ("Warehouse", "STORES", "Part")],
)
_T = 1_000_000_000_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(kind: str, key: Column) -> Column:
    return F.concat(F.lit(f"{kind}_"), key)


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node occurrences (occ_ord, node_id, node_type, canonical_key, source_instance_id, props, evidence)."""
    t = lambda name: _table(spark, sf_dir, name)
    q = lambda c: P.quoted(F.col(c))

    def of(df: DataFrame, rank: int, kind: str, key: str, canonical: Column, props: Column, prefix: str | None = None) -> DataFrame:
        node_id = _id(prefix or kind.lower(), F.col(key))
        evidence = F.array(F.struct(F.lit("star").alias("document_id"), F.lit("tables").alias("source_file"), F.lit(None).cast("string").alias("page"), node_id.alias("chunk_id"), canonical.alias("quote")))
        return df.select((F.lit(rank) * _T + F.col(key)).cast("long").alias("occ_ord"), node_id.alias("node_id"), F.lit(kind).alias("node_type"), canonical.alias("canonical_key"), node_id.alias("source_instance_id"), props.alias("props"), F.when(canonical.isNotNull(), evidence).otherwise(F.array().cast(evidence_type)).alias("evidence"))

    evidence_type = "array<struct<document_id: string, source_file: string, page: string, chunk_id: string, quote: string>>"
    balance = F.when(F.col("c_custkey") % 30 == 0, F.lit('""')).otherwise(F.round(F.col("c_acctbal") * 100).cast("long").cast("string"))
    parts = [
        of(t("region"), 1, "Region", "r_regionkey", F.col("r_name"), P.of(name=q("r_name"))),
        of(t("nation"), 2, "Nation", "n_nationkey", F.col("n_name"), P.of(name=q("n_name"))),
        of(t("customer"), 3, "Customer", "c_custkey", F.col("c_name"), P.of(name=q("c_name"), segment=q("c_mktsegment"), balance=balance)),
        of(t("supplier"), 4, "Supplier", "s_suppkey", F.col("s_name"), P.of(name=q("s_name"))),
        of(t("part"), 5, "Part", "p_partkey", F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey")), P.of(name=q("p_name"), brand=q("p_brand"), debug=F.when(F.col("p_partkey") % 11 == 0, F.lit("true")))),
        of(t("orders"), 6, "Order", "o_orderkey", F.lit(None).cast("string"), P.of(status=q("o_orderstatus"), priority=q("o_orderpriority"))),
        of(t("nation").where("n_nationkey % 7 = 0"), 7, "Planet", "n_nationkey", F.col("n_name"), P.of(name=q("n_name"))),
        of(t("customer").where("c_custkey % 10 = 0").withColumn("c_alias", F.upper("c_name")), 8, "Customer", "c_custkey", F.col("c_alias"), P.of(segment=F.lit('""'), name=P.quoted(F.concat("c_alias", F.lit(" Inc."))), balance=F.round(F.col("c_acctbal") * 100).cast("long").cast("string")), "alias"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relationship occurrences (rel_ord, relationship_id, relationship_type, source_node_id, target_node_id, props, evidence)."""
    t = lambda name: _table(spark, sf_dir, name)
    line = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.round("l_quantity").cast("long").alias("qty"))
    order = (F.col("l_orderkey") * 100_000_000 + F.col("l_partkey") * 100 + F.col("l_linenumber"))
    supply = (F.col("l_suppkey") * 100_000_000 + F.col("l_partkey"))

    def of(df: DataFrame, rank: int, ordinal: Column, kind: str, source: Column, target: Column, props: Column | None = None) -> DataFrame:
        return df.select((F.lit(rank) * 10 * _T + ordinal).cast("long").alias("rel_ord"), F.lit(kind).alias("relationship_type"), source.alias("source_node_id"), target.alias("target_node_id"), (P.of() if props is None else props).cast(P.SCHEMA).alias("props"))

    c, alias = _id("customer", F.col("c_custkey")), _id("alias", F.col("c_custkey"))
    nation = _id("nation", F.col("c_nationkey"))
    bad = F.col("c_custkey") % 53 == 0
    parts = [
        of(t("nation"), 1, F.col("n_nationkey"), "IN_REGION", _id("nation", F.col("n_nationkey")), _id("region", F.col("n_regionkey"))),
        of(t("customer"), 2, F.col("c_custkey"), "LOCATED_IN", F.when(bad, nation).otherwise(c), F.when(bad, c).otherwise(nation)),
        of(t("customer").where("c_custkey % 10 = 0"), 3, F.col("c_custkey"), "LOCATED_IN", alias, nation),
        of(t("supplier").where("s_suppkey % 13 <> 0"), 4, F.col("s_suppkey"), "LOCATED_IN", _id("supplier", F.col("s_suppkey")), _id("nation", F.col("s_nationkey"))),
        of(t("orders"), 5, F.col("o_orderkey"), "PLACED", _id("customer", F.col("o_custkey")), _id("order", F.when(F.col("o_orderkey") % 97 == 0, F.col("o_orderkey") + 1_000_000_000).otherwise(F.col("o_orderkey")))),
        of(line, 6, order, "CONTAINS", _id("order", F.col("l_orderkey")), _id("part", F.col("l_partkey")), P.of(quantity=F.col("qty").cast("string"))),
        of(line.where("l_suppkey % 13 <> 0"), 7, supply, "SUPPLIES", _id("supplier", F.col("l_suppkey")), _id("part", F.col("l_partkey"))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    empty = "array<struct<document_id: string, source_file: string, page: string, chunk_id: string, quote: string>>"
    quote = F.array(F.struct(F.lit("star").alias("document_id"), F.lit("tables").alias("source_file"), F.lit(None).cast("string").alias("page"), F.col("source_node_id").alias("chunk_id"), F.col("target_node_id").alias("quote"))).cast(empty)
    return out.select("rel_ord", F.concat(F.lit("r_"), F.col("rel_ord")).alias("relationship_id"), "relationship_type", "source_node_id", "target_node_id", "props", quote.alias("evidence"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate reviews of customers (review_ord, node_id, duplicate_of): selves, other types, and chains."""
    k = F.col("c_custkey")
    of = F.when(k % 41 == 0, _id("customer", k)).when(k % 43 == 0, _id("nation", k % 25)).when((k % 20).isin(1, 2), _id("customer", k - 1))
    return _table(spark, sf_dir, "customer").select(k.alias("review_ord"), _id("customer", k).alias("node_id"), of.alias("duplicate_of")).where("duplicate_of is not null")


#: (occ_ord, node_id, node_type, canonical_key) and, in long form, (occ_ord, pos, key, value_json).
NODES_SQL = """
occ AS (
 SELECT 1000000000000 + r_regionkey AS occ_ord, 'region_' || r_regionkey AS node_id, 'Region' AS node_type, r_name AS canonical_key FROM region
 UNION ALL SELECT 2000000000000 + n_nationkey, 'nation_' || n_nationkey, 'Nation', n_name FROM nation
 UNION ALL SELECT 3000000000000 + c_custkey, 'customer_' || c_custkey, 'Customer', c_name FROM customer
 UNION ALL SELECT 4000000000000 + s_suppkey, 'supplier_' || s_suppkey, 'Supplier', s_name FROM supplier
 UNION ALL SELECT 5000000000000 + p_partkey, 'part_' || p_partkey, 'Part', p_name || ' #' || p_partkey FROM part
 UNION ALL SELECT 6000000000000 + o_orderkey, 'order_' || o_orderkey, 'Order', NULL FROM orders
 UNION ALL SELECT 7000000000000 + n_nationkey, 'planet_' || n_nationkey, 'Planet', n_name FROM nation WHERE n_nationkey % 7 = 0
 UNION ALL SELECT 8000000000000 + c_custkey, 'alias_' || c_custkey, 'Customer', upper(c_name) FROM customer WHERE c_custkey % 10 = 0),
prop AS (
 SELECT 1000000000000 + r_regionkey AS occ_ord, 0 AS pos, 'name' AS key, '"' || r_name || '"' AS value_json FROM region
 UNION ALL SELECT 2000000000000 + n_nationkey, 0, 'name', '"' || n_name || '"' FROM nation
 UNION ALL SELECT 3000000000000 + c_custkey, 0, 'name', '"' || c_name || '"' FROM customer
 UNION ALL SELECT 3000000000000 + c_custkey, 1, 'segment', '"' || c_mktsegment || '"' FROM customer
 UNION ALL SELECT 3000000000000 + c_custkey, 2, 'balance', CASE WHEN c_custkey % 30 = 0 THEN '""' ELSE round(c_acctbal * 100)::BIGINT::VARCHAR END FROM customer
 UNION ALL SELECT 4000000000000 + s_suppkey, 0, 'name', '"' || s_name || '"' FROM supplier
 UNION ALL SELECT 5000000000000 + p_partkey, 0, 'name', '"' || p_name || '"' FROM part
 UNION ALL SELECT 5000000000000 + p_partkey, 1, 'brand', '"' || p_brand || '"' FROM part
 UNION ALL SELECT 5000000000000 + p_partkey, 2, 'debug', 'true' FROM part WHERE p_partkey % 11 = 0
 UNION ALL SELECT 6000000000000 + o_orderkey, 0, 'status', '"' || o_orderstatus || '"' FROM orders
 UNION ALL SELECT 6000000000000 + o_orderkey, 1, 'priority', '"' || o_orderpriority || '"' FROM orders
 UNION ALL SELECT 7000000000000 + n_nationkey, 0, 'name', '"' || n_name || '"' FROM nation WHERE n_nationkey % 7 = 0
 UNION ALL SELECT 8000000000000 + c_custkey, 0, 'segment', '""' FROM customer WHERE c_custkey % 10 = 0
 UNION ALL SELECT 8000000000000 + c_custkey, 1, 'name', '"' || upper(c_name) || ' Inc."' FROM customer WHERE c_custkey % 10 = 0
 UNION ALL SELECT 8000000000000 + c_custkey, 2, 'balance', round(c_acctbal * 100)::BIGINT::VARCHAR FROM customer WHERE c_custkey % 10 = 0)"""

RELATIONSHIPS_SQL = """
rel AS (
 SELECT 10000000000000 + n_nationkey AS rel_ord, 'IN_REGION' AS relationship_type, 'nation_' || n_nationkey AS source_node_id, 'region_' || n_regionkey AS target_node_id, NULL::BIGINT AS quantity FROM nation
 UNION ALL SELECT 20000000000000 + c_custkey, 'LOCATED_IN', CASE WHEN c_custkey % 53 = 0 THEN 'nation_' || c_nationkey ELSE 'customer_' || c_custkey END, CASE WHEN c_custkey % 53 = 0 THEN 'customer_' || c_custkey ELSE 'nation_' || c_nationkey END, NULL FROM customer
 UNION ALL SELECT 30000000000000 + c_custkey, 'LOCATED_IN', 'alias_' || c_custkey, 'nation_' || c_nationkey, NULL FROM customer WHERE c_custkey % 10 = 0
 UNION ALL SELECT 40000000000000 + s_suppkey, 'LOCATED_IN', 'supplier_' || s_suppkey, 'nation_' || s_nationkey, NULL FROM supplier WHERE s_suppkey % 13 <> 0
 UNION ALL SELECT 50000000000000 + o_orderkey, 'PLACED', 'customer_' || o_custkey, 'order_' || CASE WHEN o_orderkey % 97 = 0 THEN o_orderkey + 1000000000 ELSE o_orderkey END, NULL FROM orders
 UNION ALL SELECT 60000000000000 + l_orderkey * 100000000 + l_partkey * 100 + l_linenumber, 'CONTAINS', 'order_' || l_orderkey, 'part_' || l_partkey, round(l_quantity)::BIGINT FROM lineitem
 UNION ALL SELECT 70000000000000 + l_suppkey * 100000000 + l_partkey, 'SUPPLIES', 'supplier_' || l_suppkey, 'part_' || l_partkey, NULL FROM lineitem WHERE l_suppkey % 13 <> 0)"""

REVIEWS_SQL = """
rev AS (SELECT * FROM (SELECT c_custkey AS review_ord, 'customer_' || c_custkey AS node_id, CASE WHEN c_custkey % 41 = 0 THEN 'customer_' || c_custkey WHEN c_custkey % 43 = 0 THEN 'nation_' || c_custkey % 25 WHEN c_custkey % 20 IN (1, 2) THEN 'customer_' || (c_custkey - 1) END AS duplicate_of FROM customer) WHERE duplicate_of IS NOT NULL)"""

_rows = lambda rows: ", ".join("(" + ", ".join(f"'{x}'" for x in r) + ")" for r in rows)
ONTOLOGY_SQL = f"""
typ AS (SELECT * FROM (VALUES {_rows((t,) for t in ONTOLOGY.types)}) v(node_type)),
alw AS (SELECT * FROM (VALUES {_rows((t, p) for t in ONTOLOGY.types for p in sorted(ONTOLOGY.properties[t]))}) v(node_type, property)),
sig AS (SELECT * FROM (VALUES {_rows(ONTOLOGY.signatures)}) v(source_type, relationship_type, target_type))"""

#: Merged by canonical key: (old_node_id, node_id) as ``als``, and the surviving occurrences as ``node``.
MERGED_SQL = r"""
keyed AS (SELECT *, CASE WHEN canonical_key IS NULL THEN node_type || '|source_instance|' || node_id ELSE node_type || '|canonical_key|' || trim(regexp_replace(lower(canonical_key), '[^a-z0-9]+', ' ', 'g')) END AS merge_key FROM occ),
node AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY merge_key ORDER BY occ_ord) = 1),
als AS (SELECT k.node_id AS old_node_id, n.node_id FROM keyed k JOIN node n USING (merge_key))"""

#: Relationships moved to merged nodes, one for each triple.
REMAPPED_SQL = """
mov AS (SELECT r.*, coalesce(s.node_id, source_node_id) AS s, coalesce(t.node_id, target_node_id) AS t FROM rel r LEFT JOIN als s ON source_node_id = s.old_node_id LEFT JOIN als t ON target_node_id = t.old_node_id),
tri AS (SELECT min(rel_ord) AS rel_ord, s AS source_node_id, relationship_type, t AS target_node_id, arg_min(quantity, rel_ord) AS quantity FROM mov GROUP BY s, relationship_type, t),
typed AS (SELECT t.*, a.node_type AS source_type, b.node_type AS target_type FROM tri t LEFT JOIN node a ON source_node_id = a.node_id LEFT JOIN node b ON target_node_id = b.node_id),
good AS (SELECT typed.* FROM typed JOIN sig USING (source_type, relationship_type, target_type))"""
