"""Graph queries over the star schema and documents, each with DuckDB SQL for the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evigraph.functions import ordinals
from evigraph.functions import props as P
from evigraph.functions import text
from evigraph.functions.store import shared, stored, stored_in_slices
from evigraph.operators import evidence as E
from evigraph.operators import merge as M
from evigraph.operators import replies as R
from evigraph.operators import normalize as N
from evigraph.operators import resolve, retrieve
from evigraph.operators import validate as V
from evigraph.plans import passes
from evigraph.plans import repair as rounds_of
from evigraph.plans import star
from evigraph.plans.graph import Graph
from evigraph.sources import chunks as C

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return keep


def _docs(spark, sf_dir) -> DataFrame:
    """The documents; a table of fewer files than there are cores, which may be single row groups, is dealt out over them."""
    docs, cores = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.sparkContext.defaultParallelism
    return docs.repartition(cores) if len(docs.inputFiles()) < cores else docs


def _chunks(spark, sf_dir) -> DataFrame:
    return C.cut(_docs(spark, sf_dir))


def _shown(rows: DataFrame, name: str = "chunk_ord") -> DataFrame:
    """``rows`` with the place of a chunk as the number that the SQL has for it."""
    return rows.withColumn(name, F.col(name)["document"] * 1_000_000 + F.col(name)["piece"])


def _item(place: str) -> Column:
    """The place of a reply's item as the number that the SQL has for it."""
    at = F.col(place)
    return (at["chunk"]["document"] * 1_000_000 + at["chunk"]["piece"]) * 100_000 + at["place"]


def _onto(spark):
    o = star.ONTOLOGY
    return o.types_df(spark), o.properties_df(spark), o.signatures_df(spark)


CHUNKS_SQL = """
chk AS (SELECT doc_id * 1000000 + piece AS chunk_ord, 'doc_' || doc_id AS document_id, 'c' || piece AS chunk_id, source AS source_file, piece + 1 AS page, substring(text, piece * 2000 + 1, 2000) AS text
        FROM (SELECT *, unnest(range(0, ceil(length(text) / 2000.0)::BIGINT)) AS piece FROM documents))"""
SPACE = r"[\s\x0b\x1c-\x1f\x85\xa0  -     　]+"
_fold = lambda c: f"lower(trim(regexp_replace(coalesce({c}, ''), '{SPACE}', ' ', 'g')))"
_identity = lambda c: f"trim(regexp_replace({_fold(c)}, '[^a-z0-9]+', ' ', 'g'))"
_suffix = lambda c: f"trim(regexp_replace(regexp_replace({_identity(c)}, '\\b(?:{'|'.join(text.COMPANY_WORDS)})\\b', ' ', 'g'), ' +', ' ', 'g'))"


# --- chunks and text -------------------------------------------------------------------------------


@query("chunk_scan_report", f"WITH {CHUNKS_SQL} SELECT chunk_ord, document_id, chunk_id, page::VARCHAR AS pages, length(text)::BIGINT AS n_chars, substring(trim(regexp_replace(text, '{SPACE}', ' ', 'g')), 1, 120) AS preview FROM chk")
def chunk_scan_report(spark, sf_dir):
    return _shown(C.report(_chunks(spark, sf_dir)))


@query("chunk_by_document", f"WITH {CHUNKS_SQL} SELECT document_id, count(*)::BIGINT AS n_chunks, sum(length(text))::BIGINT AS n_chars FROM chk GROUP BY document_id")
def chunk_by_document(spark, sf_dir):
    return C.by_document(_chunks(spark, sf_dir))


@query("text_normalize", f"SELECT doc_id, md5({_fold('text')}) AS folded FROM documents")
def text_normalize(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(text.folded(F.col("text"))).alias("folded"))


@query("identity_text", f"SELECT doc_id, md5({_identity('text')}) AS identity FROM documents")
def identity_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(text.identity(F.col("text"))).alias("identity"))


@query("identity_suffix", f"WITH {star.NODES_SQL} SELECT node_id, {_suffix('canonical_key')} AS plain, {_suffix(chr(39) + 'The ' + chr(39) + ' || canonical_key || ' + chr(39) + ' Co., Ltd.' + chr(39))} AS company FROM occ")
def identity_suffix(spark, sf_dir):
    return star.nodes(spark, sf_dir).select("node_id", text.company_identity(F.col("canonical_key")).alias("plain"), text.company_identity(F.concat(F.lit("The "), F.col("canonical_key"), F.lit(" Co., Ltd."))).alias("company"))


@query("node_id_mint", f"WITH {star.NODES_SQL} SELECT node_id, 'node_' || substring(sha1(node_type || '|star|' || node_id || '|' || coalesce(canonical_key, 'None')), 1, 20) AS minted FROM occ")
def node_id_mint(spark, sf_dir):
    return star.nodes(spark, sf_dir).select("node_id", text.minted("node_", F.col("node_type"), F.lit("star"), F.col("node_id"), F.col("canonical_key")).alias("minted"))


@query("relationship_id_mint", f"WITH {star.RELATIONSHIPS_SQL} SELECT DISTINCT rel_ord, 'rel_' || substring(sha1(source_node_id || '|' || relationship_type || '|' || target_node_id), 1, 20) AS minted FROM rel")
def relationship_id_mint(spark, sf_dir):
    r = star.relationships(spark, sf_dir)
    return r.select("rel_ord", text.minted("rel_", F.col("source_node_id"), F.col("relationship_type"), F.col("target_node_id")).alias("minted")).distinct()


@query("display_name", f"""WITH {star.NODES_SQL}, v AS (SELECT occ_ord, json_extract_string(value_json, '$') AS v, row_number() OVER (PARTITION BY occ_ord ORDER BY CASE WHEN key = 'name' THEN 0 ELSE 1 END, pos) AS n FROM prop WHERE value_json NOT IN ('""', 'null') AND value_json LIKE '"%')
SELECT node_id, occ_ord, coalesce(v, node_id) AS display_name FROM occ LEFT JOIN (SELECT * FROM v WHERE n = 1) USING (occ_ord)""")
def display_name(spark, sf_dir):
    return star.nodes(spark, sf_dir).select("node_id", "occ_ord", P.display_name(F.col("props"), F.col("node_id")).alias("display_name"))


# --- ontology filters ------------------------------------------------------------------------------


@query("node_type_allowlist", f"WITH {star.NODES_SQL}, {star.ONTOLOGY_SQL} SELECT occ_ord, node_id, node_type FROM occ WHERE node_type IN (SELECT node_type FROM typ)")
def node_type_allowlist(spark, sf_dir):
    return V.known_types(star.nodes(spark, sf_dir), _onto(spark)[0]).select("occ_ord", "node_id", "node_type")


@query("property_enforce", f"WITH {star.NODES_SQL}, {star.ONTOLOGY_SQL} SELECT occ_ord, node_id, p.key AS property, p.value_json AS value_json FROM occ JOIN prop p USING (occ_ord) JOIN alw ON alw.node_type = occ.node_type AND alw.property = p.key")
def property_enforce(spark, sf_dir):
    kept = V.allowed_properties(star.nodes(spark, sf_dir), _onto(spark)[1])
    return kept.select("occ_ord", "node_id", F.explode("props").alias("p")).select("occ_ord", "node_id", F.col("p.key").alias("property"), "p.value_json")


@query("property_removed_audit", f"WITH {star.NODES_SQL}, {star.ONTOLOGY_SQL} SELECT node_id, occ.node_type, p.key AS property FROM occ JOIN prop p USING (occ_ord) LEFT JOIN alw ON alw.node_type = occ.node_type AND alw.property = p.key WHERE alw.property IS NULL")
def property_removed_audit(spark, sf_dir):
    return V.removed_properties(star.nodes(spark, sf_dir), _onto(spark)[1])


# --- evidence --------------------------------------------------------------------------------------

QUOTES_SQL = f"quo AS (SELECT chunk_ord, document_id, chunk_id, substring(text, 5, 20) || CASE WHEN chunk_ord // 1000000 % 2 = 1 THEN '#' ELSE '' END AS quote FROM chk)"


def _quotes(chunks: DataFrame) -> DataFrame:
    odd = F.col("chunk_ord.document") % 2 == 1
    return chunks.select("chunk_ord", "document_id", "chunk_id", F.concat(F.substring("text", 5, 20), F.when(odd, "#").otherwise("")).alias("quote"))


@query("quote_grounding_local", f"WITH {CHUNKS_SQL}, {QUOTES_SQL} SELECT chunk_ord, quote FROM quo JOIN chk USING (chunk_ord) WHERE length({_fold('quote')}) >= 8 AND contains({_fold('text')}, {_fold('quote')})")
def quote_grounding_local(spark, sf_dir):
    chunks = _chunks(spark, sf_dir)
    return _shown(E.in_own_chunk(_quotes(chunks), chunks).select("chunk_ord", "quote"))


@query("quote_grounding_global", f"WITH {CHUNKS_SQL}, {QUOTES_SQL}, fq AS (SELECT DISTINCT {_fold('quote')} AS q FROM quo), fb AS (SELECT DISTINCT {_fold('text')} AS b FROM chk), hit AS (SELECT DISTINCT q FROM fq JOIN fb ON contains(b, q) WHERE length(q) >= 8) SELECT chunk_ord, quote FROM quo WHERE {_fold('quote')} IN (SELECT q FROM hit)")
def quote_grounding_global(spark, sf_dir):
    chunks = _chunks(spark, sf_dir)
    return _shown(E.in_any_chunk(_quotes(chunks), chunks).select("chunk_ord", "quote"))


@query("evidence_dedup", f"WITH {CHUNKS_SQL}, e AS (SELECT source_file, document_id, md5(text) AS quote, min(chunk_ord) AS o FROM chk GROUP BY ALL) SELECT source_file, (row_number() OVER (PARTITION BY source_file ORDER BY o) - 1)::BIGINT AS place, document_id, quote FROM e")
def evidence_dedup(spark, sf_dir):
    """Each source's different evidence items in corpus order; a quote is a chunk's whole text, by its digest."""
    none = F.lit(None).cast("string")
    items = _chunks(spark, sf_dir).select("source_file", "chunk_ord", "document_id", none.alias("page"), none.alias("chunk_id"), F.md5("text").alias("quote"))
    return E.numbered(items, "source_file", "chunk_ord").select("source_file", "place", "document_id", "quote")


# --- merging ---------------------------------------------------------------------------------------


@query("node_merge_key", f"WITH {star.NODES_SQL}, {star.MERGED_SQL} SELECT occ_ord, merge_key FROM keyed")
def node_merge_key(spark, sf_dir):
    return star.nodes(spark, sf_dir).select("occ_ord", M.canonical_key().alias("merge_key"))


@query("node_merge_first_nonempty", f"""WITH {star.NODES_SQL}, {star.MERGED_SQL},
l AS (SELECT k.merge_key, p.* FROM keyed k JOIN prop p USING (occ_ord)),
b AS (SELECT merge_key, key, min(occ_ord * 100 + pos) AS o, coalesce(arg_min(value_json, occ_ord) FILTER (WHERE value_json NOT IN ('""', 'null', '[]', '{{}}')), arg_max(value_json, occ_ord)) AS value_json FROM l GROUP BY ALL)
SELECT node_id, (row_number() OVER (PARTITION BY merge_key ORDER BY o) - 1)::BIGINT AS pos, key, value_json FROM b JOIN node USING (merge_key)""")
def node_merge_first_nonempty(spark, sf_dir):
    nodes = M.merged_nodes(star.nodes(spark, sf_dir)).table
    return nodes.select("node_id", F.explode("props").alias("p")).select("node_id", F.col("p.pos").cast("long").alias("pos"), "p.key", "p.value_json")


@query("alias_map", f"WITH {star.NODES_SQL}, {star.MERGED_SQL} SELECT old_node_id, node_id FROM als")
def alias_map(spark, sf_dir):
    return M.merged_nodes(star.nodes(spark, sf_dir)).aliases


_STRONG_SQL = f"""strong AS (SELECT occ.*, node_type || CASE WHEN p.value_json IS NULL THEN '|opaque|' || node_id ELSE '|name|' || {_suffix("json_extract_string(p.value_json, '$')")} END AS merge_key FROM occ LEFT JOIN prop p ON p.occ_ord = occ.occ_ord AND p.key = 'name' AND p.value_json <> '""')"""


@query("node_merge_strong_or_name", f"WITH {star.NODES_SQL}, {_STRONG_SQL} SELECT arg_min(node_id, occ_ord) AS node_id, node_type, count(*)::BIGINT AS n_occurrences FROM strong GROUP BY merge_key, node_type")
def node_merge_strong_or_name(spark, sf_dir):
    merged = M.merged_nodes(star.nodes(spark, sf_dir), "strong_or_name")
    nodes, aliases = merged.table, merged.aliases
    return aliases.groupBy("node_id").agg(F.count(F.lit(1)).alias("n_occurrences")).join(nodes.select("node_id", "node_type"), "node_id").select("node_id", "node_type", "n_occurrences")


def _metrics(spark, sf_dir) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    year = F.year("o_orderdate").cast("string")
    p = P.of(metric_name=P.quoted(F.concat(F.lit("Orders, "), F.col("o_orderpriority"))), period=P.quoted(year), status=P.quoted(F.col("o_orderstatus")), value=(F.col("o_orderkey") % 7).cast("string"))
    empty = F.array().cast("array<struct<document_id: string, source_file: string, page: string, chunk_id: string, quote: string>>")
    return orders.select(F.col("o_orderkey").alias("occ_ord"), F.concat(F.lit("m_"), F.col("o_orderkey")).alias("node_id"), F.lit(M.METRIC_TYPE).alias("node_type"), F.lit(None).cast("string").alias("canonical_key"), F.lit(None).cast("string").alias("source_instance_id"), p.alias("props"), empty.alias("evidence"))


@query("metric_identity_merge", "SELECT 'm_' || min(o_orderkey) AS node_id, count(*)::BIGINT AS n FROM orders GROUP BY o_orderpriority, year(o_orderdate), o_orderstatus, o_orderkey % 7")
def metric_identity_merge(spark, sf_dir):
    return M.merged_nodes(_metrics(spark, sf_dir), "name_or_metric").aliases.groupBy("node_id").agg(F.count(F.lit(1)).alias("n"))


@query("relationship_remap_dedup", f"WITH {star.NODES_SQL}, {star.RELATIONSHIPS_SQL}, {star.ONTOLOGY_SQL}, {star.MERGED_SQL}, {star.REMAPPED_SQL} SELECT rel_ord, source_node_id, relationship_type, target_node_id, 'rel_' || substring(sha1(source_node_id || '|' || relationship_type || '|' || target_node_id), 1, 20) AS relationship_id FROM tri")
def relationship_remap_dedup(spark, sf_dir):
    aliases = M.merged_nodes(star.nodes(spark, sf_dir)).aliases
    return M.merged_relationships(M.redirected(star.relationships(spark, sf_dir), aliases)).table.select("rel_ord", "source_node_id", "relationship_type", "target_node_id", "relationship_id")


_REVIEWED = f"""{star.REVIEWS_SQL},
jud AS (SELECT r.*, CASE WHEN a.node_id IS NULL THEN 'unknown node' WHEN b.node_id IS NULL THEN 'unknown duplicate' WHEN a.node_id = b.node_id THEN 'self' WHEN a.node_type <> b.node_type THEN 'type mismatch' ELSE 'accepted' END AS verdict
        FROM rev r LEFT JOIN occ a ON r.node_id = a.node_id LEFT JOIN occ b ON r.duplicate_of = b.node_id)"""


@query("duplicate_review_apply", f"WITH {star.NODES_SQL}, {_REVIEWED} SELECT review_ord, node_id, duplicate_of, verdict FROM jud")
def duplicate_review_apply(spark, sf_dir):
    return resolve.judge(star.reviews(spark, sf_dir), star.nodes(spark, sf_dir)).select("review_ord", "node_id", "duplicate_of", "verdict")


@query("alias_chain_resolve", f"WITH RECURSIVE {star.NODES_SQL}, {_REVIEWED}, acc AS (SELECT node_id, duplicate_of FROM jud WHERE verdict = 'accepted'), walk AS (SELECT node_id AS old_node_id, duplicate_of AS node_id, 1 AS d FROM acc UNION ALL SELECT w.old_node_id, a.duplicate_of, d + 1 FROM walk w JOIN acc a ON w.node_id = a.node_id) SELECT old_node_id, arg_max(node_id, d) AS node_id FROM walk GROUP BY old_node_id")
def alias_chain_resolve(spark, sf_dir):
    return resolve.roots(resolve.judge(star.reviews(spark, sf_dir), star.nodes(spark, sf_dir)))


_REPAIRED = """
ids AS (SELECT c_custkey AS k, 'customer_' || c_custkey AS node_id, 3000000000000 + c_custkey AS o FROM customer),
fix AS (SELECT k, 'fix_' || k AS old_id, CASE WHEN k % 2 = 1 THEN 'somebody else ' || k ELSE c_name END AS name, 13000000000000 + k AS o FROM ids JOIN customer ON c_custkey = k WHERE k % 5 = 0),
named AS (SELECT lower(trim(c_name)) AS name, max('customer_' || c_custkey) AS node_id, count(*) AS n FROM customer GROUP BY 1),
tgt AS (SELECT f.*, coalesce(n.node_id, f.old_id) AS node_id FROM fix f LEFT JOIN named n ON n.name = lower(trim(f.name))),
allv AS (SELECT node_id, o, 0 AS pos, 'name' AS key, '"' || c_name || '"' AS v FROM ids JOIN customer ON c_custkey = k
         UNION ALL SELECT node_id, o, 1, 'segment', '"' || c_mktsegment || '"' FROM ids JOIN customer ON c_custkey = k
         UNION ALL SELECT node_id, o, 2, 'balance', CASE WHEN k % 30 = 0 THEN '""' ELSE round(c_acctbal * 100)::BIGINT::VARCHAR END FROM ids JOIN customer ON c_custkey = k
         UNION ALL SELECT node_id, o, 0, 'name', '"' || name || '"' FROM tgt
         UNION ALL SELECT node_id, o, 1, 'balance', '7' FROM tgt
         UNION ALL SELECT node_id, o, 2, 'extra', k::VARCHAR FROM tgt)
SELECT node_id, key, coalesce(arg_min(v, o) FILTER (WHERE v <> '""'), arg_max(v, o)) AS value_json FROM allv GROUP BY node_id, key"""


@query("repair_merge", f"WITH {_REPAIRED.strip()}")
def repair_merge(spark, sf_dir):
    """Customers after a repair: nodes of the same name take in its values, the others are added."""
    nodes = star.nodes(spark, sf_dir).where("node_type = 'Customer' and occ_ord < 8000000000000")
    key = F.expr("cast(substring(node_id, 10) as long)")
    name = F.when(key % 2 == 1, P.quoted(F.concat(F.lit("somebody else "), key))).otherwise(P.value(F.col("props"), "name"))
    repair = nodes.where(key % 5 == 0).withColumn("props", P.of(name=name, balance=F.lit("7"), extra=key.cast("string")).cast(P.SCHEMA)).withColumn("node_id", F.concat(F.lit("fix_"), key)).withColumn("occ_ord", F.col("occ_ord") + 10**13)
    merged, _ = M.repaired_nodes(nodes, repair)
    return merged.table.select("node_id", F.explode("props").alias("p")).select("node_id", "p.key", "p.value_json")


@query("repair_relationships", f"""WITH fixed AS (SELECT 'fix_' || c_custkey AS old_id, 'customer_' || c_custkey AS node_id FROM customer WHERE c_custkey % 5 = 0),
old AS (SELECT 'r_' || o_orderkey AS relationship_id, 'PLACED' AS relationship_type, 'customer_' || o_custkey AS source_node_id, 'order_' || o_orderkey AS target_node_id FROM orders WHERE o_orderkey % 3 = 0),
new AS (SELECT 'r_' || o_orderkey AS relationship_id, 'PLACED', coalesce(f.node_id, 'fix_' || o_custkey) AS source_node_id, 'order_' || o_orderkey FROM orders LEFT JOIN fixed f ON f.old_id = 'fix_' || o_custkey)
SELECT * FROM old UNION ALL SELECT * FROM new WHERE source_node_id IN (SELECT 'customer_' || c_custkey FROM customer) AND relationship_id NOT IN (SELECT relationship_id FROM old)""")
def repair_relationships(spark, sf_dir):
    """Relationships after a repair: ends redirected, those without a node left out, ids that are there already kept as they are."""
    nodes = star.nodes(spark, sf_dir).where("node_type in ('Customer', 'Order') and occ_ord < 8000000000000")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    none = (P.of().cast(P.SCHEMA).alias("props"), F.array().cast(E.SCHEMA).alias("evidence"))
    row = lambda df, source: df.select(F.col("o_orderkey").alias("rel_ord"), F.concat(F.lit("r_"), F.col("o_orderkey")).alias("relationship_id"), F.lit("PLACED").alias("relationship_type"), F.concat(F.lit(source), F.col("o_custkey")).alias("source_node_id"), F.concat(F.lit("order_"), F.col("o_orderkey")).alias("target_node_id"), *none)
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_custkey % 5 = 0")
    redirects = customers.select(F.concat(F.lit("fix_"), F.col("c_custkey")).alias("old_node_id"), F.concat(F.lit("customer_"), F.col("c_custkey")).alias("node_id"))
    out = M.merge_repaired_relationships(row(orders.where("o_orderkey % 3 = 0"), "customer_"), row(orders, "fix_"), nodes, redirects)
    return out.select("relationship_id", "relationship_type", "source_node_id", "target_node_id")


def _counted(merged: M.Merged) -> DataFrame:
    """Merged rows with the number of their different evidence items."""
    n = merged.numbered().groupBy("merge_key").agg(F.count(F.lit(1)).alias("n"))
    return merged.rows.join(n, "merge_key", "left").withColumn("n_evidence", F.coalesce("n", F.lit(0)).cast("long"))


@query("merged_node_evidence", f"WITH {star.NODES_SQL}, {star.MERGED_SQL} SELECT n.node_id, (row_number() OVER (PARTITION BY k.merge_key ORDER BY k.occ_ord) - 1)::BIGINT AS place, k.node_id AS chunk_id, k.canonical_key AS quote FROM keyed k JOIN node n USING (merge_key) WHERE k.canonical_key IS NOT NULL")
def merged_node_evidence(spark, sf_dir):
    """The evidence that merged nodes take in, a row an item, in order."""
    return M.merged_nodes(star.nodes(spark, sf_dir)).evidence().select("node_id", "place", "chunk_id", "quote")


@query("merged_relationship_evidence", f"WITH {star.NODES_SQL}, {star.RELATIONSHIPS_SQL}, {star.MERGED_SQL}, mov AS (SELECT r.*, coalesce(s.node_id, source_node_id) AS s, coalesce(t.node_id, target_node_id) AS t FROM rel r LEFT JOIN als s ON source_node_id = s.old_node_id LEFT JOIN als t ON target_node_id = t.old_node_id), i AS (SELECT s, relationship_type, t, source_node_id AS chunk_id, target_node_id AS quote, min(rel_ord) AS o FROM mov GROUP BY ALL) SELECT 'rel_' || substring(sha1(s || '|' || relationship_type || '|' || t), 1, 20) AS relationship_id, (row_number() OVER (PARTITION BY s, relationship_type, t ORDER BY o) - 1)::BIGINT AS place, chunk_id, quote FROM i")
def merged_relationship_evidence(spark, sf_dir):
    """The evidence that relationships take in as their ends are merged, a row an item, in order."""
    aliases = M.merged_nodes(star.nodes(spark, sf_dir)).aliases
    return M.relationship_evidence(star.relationships(spark, sf_dir), aliases).select("relationship_id", "place", "chunk_id", "quote")


@query("relationship_merge_by_id", "SELECT 'l_' || l_orderkey AS relationship_id, min(((l_orderkey * 100000 + l_partkey) * 10000 + l_suppkey) * 10 + l_linenumber) AS rel_ord, 'part_' || arg_min(l_partkey, ((l_orderkey * 100000 + l_partkey) * 10000 + l_suppkey) * 10 + l_linenumber) AS target_node_id, arg_min(round(l_quantity)::BIGINT, ((l_orderkey * 100000 + l_partkey) * 10000 + l_suppkey) * 10 + l_linenumber)::VARCHAR AS quantity, count(DISTINCT l_suppkey)::BIGINT AS n_evidence FROM lineitem GROUP BY l_orderkey")
def relationship_merge_by_id(spark, sf_dir):
    """Line items of an order as occurrences of one relationship id: first ends and values, all evidence once."""
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    quote = F.array(F.struct(F.lit("star").alias("document_id"), F.lit("tables").alias("source_file"), F.lit(None).cast("string").alias("page"), F.lit(None).cast("string").alias("chunk_id"), F.col("l_suppkey").cast("string").alias("quote"))).cast(E.SCHEMA)
    rows = line.select((((F.col("l_orderkey") * 100_000 + F.col("l_partkey")) * 10_000 + F.col("l_suppkey")) * 10 + F.col("l_linenumber")).alias("rel_ord"), F.concat(F.lit("l_"), F.col("l_orderkey")).alias("relationship_id"), F.lit("CONTAINS").alias("relationship_type"), F.concat(F.lit("order_"), F.col("l_orderkey")).alias("source_node_id"), F.concat(F.lit("part_"), F.col("l_partkey")).alias("target_node_id"), P.of(quantity=F.round("l_quantity").cast("long").cast("string")).alias("props"), quote.alias("evidence"))
    return _counted(M.merged_relationships_by_id(rows)).select("relationship_id", "rel_ord", "target_node_id", P.value(F.col("props"), "quantity").alias("quantity"), "n_evidence")


@query("node_merge_by_id", "SELECT 'c_' || o_custkey AS node_id, min(o_orderkey) AS occ_ord, count(DISTINCT o_orderpriority)::BIGINT AS n_evidence, '\"' || arg_min(o_orderstatus, o_orderkey) || '\"' AS status FROM orders GROUP BY o_custkey")
def node_merge_by_id(spark, sf_dir):
    """Orders as occurrences of their customer by id alone."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    none = F.lit(None).cast("string")
    quote = F.array(F.struct(F.lit("star").alias("document_id"), F.lit("tables").alias("source_file"), none.alias("page"), none.alias("chunk_id"), F.col("o_orderpriority").alias("quote"))).cast(E.SCHEMA)
    rows = orders.select(F.col("o_orderkey").alias("occ_ord"), F.concat(F.lit("c_"), F.col("o_custkey")).alias("node_id"), F.lit("Customer").alias("node_type"), none.alias("canonical_key"), none.alias("source_instance_id"), P.of(status=P.quoted(F.col("o_orderstatus"))).alias("props"), quote.alias("evidence"))
    return _counted(M.merged_nodes(rows, "id")).select("node_id", "occ_ord", "n_evidence", P.value(F.col("props"), "status").alias("status"))


@query("property_list_union", "SELECT 'c_' || o_custkey AS node_id, to_json(list(s ORDER BY o)) AS statuses FROM (SELECT o_custkey, o_orderpriority AS s, min(o_orderkey) AS o FROM orders GROUP BY ALL) GROUP BY o_custkey")
def property_list_union(spark, sf_dir):
    """A list property of each customer's orders, united in order without repeats."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = orders.select(F.concat(F.lit("c_"), F.col("o_custkey")).alias("merge_key"), F.col("o_orderkey").alias("occ_ord"), P.of(statuses=F.to_json(F.array("o_orderpriority"))).alias("props"))
    return M.merged_properties(rows, "merge_key", "occ_ord", union_lists=True).select(F.col("merge_key").alias("node_id"), P.value(F.col("props"), "statuses").alias("statuses"))


# --- validation ------------------------------------------------------------------------------------

_GRAPH = f"WITH {star.NODES_SQL}, {star.RELATIONSHIPS_SQL}, {star.ONTOLOGY_SQL}, {star.MERGED_SQL}, {star.REMAPPED_SQL}"


def _merged(spark, sf_dir, keys: bool = False) -> tuple[DataFrame, DataFrame]:
    """Merged nodes, with their properties' ``keys`` where these are looked at, and remapped relationships with the types of their ends, each computed once."""
    merged = M.merged_nodes(star.nodes(spark, sf_dir))
    nodes = stored(V.thin_nodes(merged.with_keys()) if keys else merged.heads.select("node_id", "node_type", "occ_ord"))
    aliases = stored(M.typed_aliases(merged.aliases, nodes))
    return nodes, M.typed_triples(star.relationships(spark, sf_dir), aliases).withColumn("bare", ~F.col("has_evidence")).drop("has_evidence")


@query("orphan_relationships", f"{_GRAPH} SELECT rel_ord, source_node_id, relationship_type, target_node_id, CASE WHEN source_type IS NOT NULL THEN 'target' WHEN target_type IS NOT NULL THEN 'source' ELSE 'both' END AS reason FROM typed WHERE source_type IS NULL OR target_type IS NULL")
def orphan_relationships(spark, sf_dir):
    nodes, rels = _merged(spark, sf_dir)
    return V.orphans(rels, nodes).select("rel_ord", "source_node_id", "relationship_type", "target_node_id", "reason")


@query("signature_violations", f"{_GRAPH} SELECT rel_ord, source_type, relationship_type, target_type FROM typed WHERE source_type IS NOT NULL AND target_type IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sig WHERE sig.source_type = typed.source_type AND sig.relationship_type = typed.relationship_type AND sig.target_type = typed.target_type)")
def signature_violations(spark, sf_dir):
    nodes, rels = _merged(spark, sf_dir)
    return V.violations(rels, nodes, _onto(spark)[2]).select("rel_ord", "source_type", "relationship_type", "target_type")


@query("type_coverage", f"{_GRAPH} SELECT typ.node_type, count(node.node_id)::BIGINT AS n, count(node.node_id) > 0 AS found FROM typ LEFT JOIN node ON typ.node_type = node.node_type GROUP BY typ.node_type")
def type_coverage(spark, sf_dir):
    return V.coverage(M.merged_nodes(star.nodes(spark, sf_dir)).heads, _onto(spark)[0])


@query("missing_types", f"{_GRAPH} SELECT node_type FROM typ WHERE node_type NOT IN (SELECT node_type FROM node)")
def missing_types(spark, sf_dir):
    return V.coverage(M.merged_nodes(star.nodes(spark, sf_dir)).heads, _onto(spark)[0]).where("not found").select("node_type")


@query("relationship_type_counts", f"{_GRAPH} SELECT s.relationship_type, count(tri.relationship_type)::BIGINT AS n FROM (SELECT DISTINCT relationship_type FROM sig) s LEFT JOIN tri USING (relationship_type) GROUP BY s.relationship_type")
def relationship_type_counts(spark, sf_dir):
    return V.relationship_coverage(_merged(spark, sf_dir)[1], _onto(spark)[2])


_DEGREE = f"{_GRAPH}, touched AS (SELECT source_node_id AS id FROM tri UNION ALL SELECT target_node_id FROM tri), deg AS (SELECT node.node_id, node.node_type, count(touched.id)::BIGINT AS degree FROM node LEFT JOIN touched ON node.node_id = touched.id GROUP BY node.node_id, node.node_type)"


@query("node_degree", f"{_DEGREE} SELECT * FROM deg")
def node_degree(spark, sf_dir):
    nodes, rels = _merged(spark, sf_dir)
    return V.degrees(rels, nodes)


@query("disconnected_nodes", f"{_DEGREE} SELECT node_id, node_type FROM deg WHERE degree = 0")
def disconnected_nodes(spark, sf_dir):
    nodes, rels = _merged(spark, sf_dir)
    return V.degrees(rels, nodes).where("degree = 0").select("node_id", "node_type")


_ERRORS = f"""{_GRAPH}, err AS (
SELECT 'unknown type' AS kind, node_id AS subject FROM node WHERE node_type NOT IN (SELECT node_type FROM typ)
UNION ALL SELECT 'unsupported properties', node_id || ':' || string_agg(DISTINCT key, ',' ORDER BY key) FROM (SELECT n.node_id, n.node_type, p.key FROM node n JOIN keyed k USING (merge_key) JOIN prop p ON k.occ_ord = p.occ_ord) x WHERE NOT EXISTS (SELECT 1 FROM alw WHERE alw.node_type = x.node_type AND alw.property = x.key) GROUP BY node_id
UNION ALL SELECT 'node without evidence', node_id FROM node WHERE canonical_key IS NULL
UNION ALL SELECT 'orphan relationship', 'rel_' || substring(sha1(source_node_id || '|' || relationship_type || '|' || target_node_id), 1, 20) FROM typed WHERE source_type IS NULL OR target_type IS NULL
UNION ALL SELECT 'invalid relationship', source_type || '|' || relationship_type || '|' || target_type FROM typed t WHERE source_type IS NOT NULL AND target_type IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sig WHERE sig.source_type = t.source_type AND sig.relationship_type = t.relationship_type AND sig.target_type = t.target_type))"""


@query("validation_errors", f"{_ERRORS} SELECT kind, subject, count(*)::BIGINT AS n FROM err GROUP BY ALL")
def validation_errors(spark, sf_dir):
    nodes, rels = _merged(spark, sf_dir, keys=True)
    return V.errors(nodes, rels, *_onto(spark)).groupBy("kind", "subject").agg(F.count(F.lit(1)).alias("n"))


@query("validation_report", f"{_ERRORS} SELECT kind, subject FROM err ORDER BY kind, subject LIMIT 30")
def validation_report(spark, sf_dir):
    """The first thirty errors, as a report shows them."""
    from evigraph.plans import assemble

    nodes, rels = _merged(spark, sf_dir, keys=True)
    return assemble.examples("validation_errors", V.errors(nodes, rels, *_onto(spark)))


@query("validation_summary", f"{_ERRORS}, touched AS (SELECT source_node_id AS id FROM tri UNION SELECT target_node_id FROM tri) SELECT (SELECT count(*) FROM node)::BIGINT AS node_count, (SELECT count(*) FROM tri)::BIGINT AS relationship_count, (SELECT count(*) FROM node WHERE node_id NOT IN (SELECT id FROM touched))::BIGINT AS disconnected_count, (SELECT count(*) FROM typ WHERE node_type NOT IN (SELECT node_type FROM node))::BIGINT AS missing_type_count, (SELECT count(*) FROM err)::BIGINT AS error_count, (SELECT count(*) FROM err) = 0 AS valid")
def validation_summary(spark, sf_dir):
    nodes, rels = _merged(spark, sf_dir, keys=True)
    return V.summary(nodes, rels, *_onto(spark))


@query("raw_duplicate_relationships", f"WITH {star.RELATIONSHIPS_SQL} SELECT source_node_id, relationship_type, target_node_id, (count(*) - 1)::BIGINT AS n FROM rel GROUP BY 1, 2, 3 HAVING count(*) > 1")
def raw_duplicate_relationships(spark, sf_dir):
    return star.relationships(spark, sf_dir).groupBy("source_node_id", "relationship_type", "target_node_id").agg((F.count(F.lit(1)) - 1).alias("n")).where("n > 0")


# --- retrieval and requests ------------------------------------------------------------------------
# Search terms: the title line of every document, in groups of its source, up to 150 characters as terms are.

_TERMS = f"""node_q AS (SELECT doc_id, source, trim(regexp_replace(split_part(text, chr(10), 1), '{SPACE}', ' ', 'g')) AS whole FROM documents),
trm AS (SELECT source AS grp, lower(substring(whole, 1, 150)) AS term, count(*)::BIGINT AS n FROM node_q WHERE length(whole) >= 4 GROUP BY ALL)"""


def _term_nodes(spark, sf_dir) -> DataFrame:
    """A node for each document: its title line, and evidence in its first chunk."""
    title = F.substring_index("text", "\n", 1)
    d = _docs(spark, sf_dir)
    quote = F.array(F.struct(F.concat(F.lit("doc_"), F.col("doc_id")).alias("document_id"), F.col("source").alias("source_file"), F.lit(None).cast("string").alias("page"), F.lit("c0").alias("chunk_id"), title.alias("quote")))
    return d.select(F.col("source").alias("grp"), F.col("doc_id").alias("occ_ord"), P.of(title=P.quoted(title)).alias("props"), quote.alias("evidence"))


_SCORED = f"{CHUNKS_SQL}, {_TERMS}, fol AS (SELECT chunk_ord, {_fold('text')} AS body FROM chk), sco AS (SELECT grp, chunk_ord, sum(n)::BIGINT AS score, min(length(body))::BIGINT AS size FROM fol JOIN trm ON contains(body, term) GROUP BY grp, chunk_ord)"
_DIRECT = "dir AS (SELECT DISTINCT source AS grp, doc_id * 1000000 AS chunk_ord FROM documents WHERE length(text) > 0)"
_RANKED = "al AS (SELECT grp, chunk_ord, 0 AS tier, 0 AS score, 0 AS size FROM dir UNION ALL SELECT grp, chunk_ord, 1, score, size FROM sco WHERE (grp, chunk_ord) NOT IN (SELECT (grp, chunk_ord) FROM dir)), r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY tier, score DESC, size, chunk_ord)::INTEGER AS rank FROM al) SELECT grp, chunk_ord, rank FROM r"


@query("retrieve_topk_nodes", f"WITH {_SCORED}, {_DIRECT}, {_RANKED} WHERE rank <= 10")
def retrieve_topk_nodes(spark, sf_dir):
    chunks, nodes = _chunks(spark, sf_dir), _term_nodes(spark, sf_dir)
    return _shown(retrieve.top(retrieve.direct(nodes, chunks, "grp"), retrieve.scored(retrieve.node_terms(nodes, "grp"), chunks, "grp"), "grp", 10))


@query("retrieve_topk_best", f"WITH {_SCORED}, b AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY score DESC, size, chunk_ord) AS best FROM sco), {_DIRECT.replace('length(text) > 0', 'length(text) > 0 AND doc_id < 0')}, {_RANKED.replace('FROM sco', 'FROM b').replace('WHERE (grp', 'WHERE best <= 10 AND (grp')} WHERE rank <= 10")
def retrieve_topk_best(spark, sf_dir):
    """The ten best scored chunks of each group, with no chunk quoted by any node in front."""
    chunks, nodes = _chunks(spark, sf_dir), _term_nodes(spark, sf_dir)
    scored = retrieve.scored(retrieve.node_terms(nodes, "grp"), chunks, "grp")
    none = nodes.withColumn("evidence", F.filter("evidence", lambda e: F.lit(False)))
    return _shown(retrieve.top_of_best(retrieve.direct(none, chunks, "grp"), scored, "grp", 10))


@query("retrieve_topk_endpoints", f"WITH {_SCORED.replace('SELECT source AS grp, lower', 'SELECT grp, lower').replace('FROM node_q WHERE', 'FROM node_q JOIN pair USING (source) WHERE').replace('node_q AS', 'pair AS (SELECT grp, source FROM (SELECT a.source || chr(124) || b.source AS grp, a.source AS x, b.source AS y FROM (SELECT DISTINCT source FROM documents) a JOIN (SELECT DISTINCT source FROM documents) b ON b.source = (SELECT min(source) FROM documents)) p JOIN (SELECT DISTINCT source FROM documents) s ON s.source IN (x, y)), node_q AS')}, dir AS (SELECT DISTINCT grp, doc_id * 1000000 AS chunk_ord FROM documents JOIN pair USING (source) WHERE length(text) > 0), {_RANKED} WHERE rank <= 12")
def retrieve_topk_endpoints(spark, sf_dir):
    """Chunks for relationships between the nodes of each source and those of the first: both ends' nodes give terms and quoted chunks."""
    chunks, nodes = _chunks(spark, sf_dir), _term_nodes(spark, sf_dir)
    sources = nodes.select(F.col("grp").alias("x")).distinct()
    pairs = sources.withColumn("y", sources.agg(F.min("x")).scalar())
    ends = pairs.select(F.concat_ws("|", "x", "y").alias("pair"), F.explode(F.array_distinct(F.array("x", "y"))).alias("end"))
    members = nodes.join(ends, F.col("grp") == F.col("end")).select(F.col("pair").alias("grp"), "occ_ord", "props", "evidence")
    return _shown(retrieve.top(retrieve.direct(members, chunks, "grp"), retrieve.scored(retrieve.node_terms(members, "grp"), chunks, "grp"), "grp", 12))


@query("retrieve_topk_scored", f"WITH {_SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY score DESC, size, chunk_ord)::INTEGER AS rank FROM sco) SELECT grp, chunk_ord, score, rank FROM r WHERE rank <= 12")
def retrieve_topk_scored(spark, sf_dir):
    chunks, nodes = _chunks(spark, sf_dir), _term_nodes(spark, sf_dir)
    scored = retrieve.scored(retrieve.node_terms(nodes, "grp"), chunks, "grp")
    ranked = retrieve.top(scored.where("false"), scored, "grp", 12)
    return _shown(ranked.join(scored, ["grp", "chunk_ord"]).select("grp", "chunk_ord", "score", "rank"))


SCHEMA_TERMS = (("Verb", "are"), ("Verb", "was"), ("Noun", "thing"), ("Noun", "que"), ("None", "xylophone"))


@query("schema_term_topk", f"""WITH {CHUNKS_SQL}, t AS (SELECT * FROM (VALUES {', '.join(f"('{a}', '{b}')" for a, b in SCHEMA_TERMS)}) v(grp, term)),
s AS (SELECT grp, chunk_ord, sum(least(len(regexp_extract_all(translate(lower(text), 'áéíóúàèìòùâêîôûäëïöüñçß', 'zzzzzzzzzzzzzzzzzzzzzzzzz'), '\\b' || term || '\\b')), 10))::BIGINT AS score FROM chk, t GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY score DESC, chunk_ord)::INTEGER AS rank, max(score) OVER (PARTITION BY grp) AS best FROM s)
SELECT grp, chunk_ord, score, rank FROM r WHERE CASE WHEN best > 0 THEN score > 0 AND rank <= 8 ELSE rank <= 2 END""")
def schema_term_topk(spark, sf_dir):
    # accents become a letter, as word boundaries beside them differ between engines
    chunks = _chunks(spark, sf_dir).withColumn("text", F.translate(F.lower("text"), "áéíóúàèìòùâêîôûäëïöüñçß", "z" * 23))
    return _shown(retrieve.by_words(spark.createDataFrame(SCHEMA_TERMS, "grp string, term string"), chunks, "grp"))


@query("keyword_topk", f"""WITH {CHUNKS_SQL}, t AS (SELECT * FROM (VALUES {', '.join(f"('{a}', '{b}')" for a, b in SCHEMA_TERMS)}) v(grp, term)),
s AS (SELECT grp, chunk_ord, sum((length(lower(text)) - length(replace(lower(text), term, ''))) // length(term))::BIGINT AS score FROM chk, t GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY score DESC, chunk_ord)::INTEGER AS rank FROM s WHERE score > 0) SELECT grp, chunk_ord, score, rank FROM r WHERE rank <= 8""")
def keyword_topk(spark, sf_dir):
    return _shown(retrieve.by_substrings(spark.createDataFrame(SCHEMA_TERMS, "grp string, term string"), _chunks(spark, sf_dir), "grp"))


_BLOCK = "chr(10) || '--- ' || document_id || ' / ' || chunk_id || ' / pages ' || page || '-' || page || ' ---' || chr(10) || text || chr(10)"


@query("context_budget", f"WITH {CHUNKS_SQL}, r AS (SELECT document_id, chunk_ord, row_number() OVER (PARTITION BY document_id ORDER BY length(text), chunk_ord)::INTEGER AS rank, length({_BLOCK}) AS size FROM chk), b AS (SELECT *, sum(size) OVER (PARTITION BY document_id ORDER BY rank)::BIGINT AS used FROM r) SELECT document_id, chunk_ord, rank, used FROM b WHERE used <= 5000")
def context_budget(spark, sf_dir):
    from pyspark.sql import Window as W

    chunks = _chunks(spark, sf_dir)
    ranked = chunks.select("document_id", "chunk_ord", F.row_number().over(W.partitionBy("document_id").orderBy(F.length("text"), "chunk_ord")).alias("rank"))
    return _shown(retrieve.within_budget(ranked, chunks, "document_id", 5000).select("document_id", "chunk_ord", "rank", "used"))


_BATCHED = f"WITH {star.NODES_SQL}, {star.ONTOLOGY_SQL}, {star.MERGED_SQL}, bat AS (SELECT node_id, node_type, (row_number() OVER (PARTITION BY node_type ORDER BY occ_ord) - 1) // 16 AS batch FROM node)"


@query("node_batches", f"{_BATCHED} SELECT node_id, node_type, batch::BIGINT AS batch FROM bat")
def node_batches(spark, sf_dir):
    return retrieve.batches(M.merged_nodes(star.nodes(spark, sf_dir)).heads).select("node_id", "node_type", "batch")


@query("signature_batches", f"{_BATCHED}, k AS (SELECT DISTINCT node_type, batch FROM bat), p AS (SELECT DISTINCT source_type, target_type FROM sig), j AS (SELECT p.*, s.batch AS sb, t.batch AS tb FROM p LEFT JOIN k s ON s.node_type = source_type LEFT JOIN k t ON t.node_type = target_type) SELECT DISTINCT source_type, target_type, CASE WHEN sb IS NOT NULL AND tb IS NOT NULL THEN sb END::BIGINT AS source_batch, CASE WHEN sb IS NOT NULL AND tb IS NOT NULL THEN tb END::BIGINT AS target_batch, CASE WHEN sb IS NOT NULL AND tb IS NOT NULL THEN 'reviewed' ELSE 'not_applicable' END AS status FROM j")
def signature_batches(spark, sf_dir):
    batched = retrieve.batches(M.merged_nodes(star.nodes(spark, sf_dir)).heads.select("node_type", "occ_ord"))
    return retrieve.signature_batches(batched, _onto(spark)[2])


@query("coverage_requests", f"WITH {CHUNKS_SQL}, {star.NODES_SQL}, {star.ONTOLOGY_SQL}, {star.MERGED_SQL}, o AS (SELECT chunk_ord, (row_number() OVER (ORDER BY chunk_ord) - 1) // 6 AS batch FROM chk) SELECT node_type, batch::BIGINT AS batch, count(*)::BIGINT AS n_chunks FROM typ, o WHERE node_type NOT IN (SELECT node_type FROM node) GROUP BY ALL")
def coverage_requests(spark, sf_dir):
    chunks = _chunks(spark, sf_dir).select("chunk_ord", F.lit("chunk").alias("node_type"))
    six = retrieve.batches(chunks, 6, "chunk_ord").groupBy("batch").agg(F.count(F.lit(1)).alias("n_chunks"))
    missing = V.coverage(M.merged_nodes(star.nodes(spark, sf_dir)).table, _onto(spark)[0]).where("not found").select("node_type")
    asked = missing.agg(F.array_sort(F.collect_set("node_type"))).scalar()  # at most the ontology's types
    return six.select(F.explode(asked).alias("node_type"), "batch", "n_chunks")


@query("reply_parse", None)
def reply_parse(spark, sf_dir):
    raw = F.concat(F.lit("Sure:\n```json\n"), F.to_json(F.struct(F.array(F.struct(F.col("doc_id").cast("string").alias("node_id"), F.lit("Document").alias("node_type"), F.struct(F.col("source"), F.col("n_chars")).alias("properties"))).alias("nodes"))), F.lit("\n```"))
    replies = _docs(spark, sf_dir).select("doc_id", R.json_object(raw).alias("reply"))
    item = replies.select("doc_id", F.explode(R.items(F.col("reply"), "nodes")).alias("item"))
    return item.select("doc_id", F.get_json_object("item", "$.node_id").alias("node_id"), F.explode(R.properties(F.col("item"))).alias("p")).select("doc_id", "node_id", "p.pos", "p.key", "p.value_json")


SQL["reply_parse"] = """SELECT doc_id, doc_id::VARCHAR AS node_id, pos::INTEGER AS pos, key, CASE key WHEN 'source' THEN '"' || source || '"' ELSE n_chars::VARCHAR END AS value_json FROM documents, (VALUES (0, 'source'), (1, 'n_chars')) v(pos, key)"""


# --- normalizing replies: each chunk gets a reply made by a rule -----------------------------------


def _replies(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(replies, chunks): two nodes, one of an unknown type, and a relationship, quoting the chunk or not by the parity of the document; one reply in seven is broken."""
    chunks = _chunks(spark, sf_dir)
    k = F.col("chunk_ord.document")
    quote = F.when(k % 2 == 0, F.col("text")).otherwise(F.lit("words that stand nowhere in it"))
    node = lambda i, kind: F.struct(F.concat(F.lit(i), k.cast("string")).alias("node_id"), F.lit(kind).alias("node_type"), F.struct(F.col("source_file").alias("name"), F.lit("").alias("brand"), F.lit(1).alias("odd")).alias("properties"), F.array(F.struct(quote.alias("quote"))).alias("evidence"))
    link = F.struct(F.concat(F.lit("q"), k.cast("string")).alias("relationship_id"), F.lit("SUPPLIES").alias("relationship_type"), F.concat(F.lit("s"), k.cast("string")).alias("source_node_id"), F.concat(F.lit("p"), k.cast("string")).alias("target_node_id"), F.struct().alias("properties"), F.array(F.struct(quote.alias("quote"))).alias("evidence"))
    body = F.to_json(F.struct(F.array(node("s", "Supplier"), node("p", "Part"), node("x", "Planet")).alias("nodes"), F.array(link).alias("relationships"), F.array(F.concat(F.lit("seen "), F.col("source_file"))).alias("warnings")))
    raw = F.when(k % 7 == 0, F.concat(F.lit("no {"), F.substring(body, 1, 20))).when(k % 7 == 1, F.concat(F.lit("Sure:\n```json\n"), body, F.lit("\n```"))).otherwise(body)
    return chunks.select(F.lit("primary").alias("pass"), "chunk_ord", raw.alias("raw"), F.when(k % 7 == 0, "error").otherwise("ok").alias("status")), chunks


_SAID = f"""WITH {CHUNKS_SQL}, c0 AS (SELECT *, chunk_ord // 1000000 AS k FROM chk), good AS (SELECT * FROM c0 WHERE k % 7 <> 0),
gr AS (SELECT * FROM good WHERE k % 2 = 0 AND length({_fold('text')}) >= 8)"""


@query("normalize_nodes", f"{_SAID}, n AS (SELECT *, unnest(['Supplier', 'Part']) AS node_type FROM gr) SELECT chunk_ord * 100000 + CASE node_type WHEN 'Part' THEN 1 ELSE 0 END AS occ_ord, node_type, 'node_' || substring(sha1(node_type || '|' || document_id || '|' || chunk_id || '|primary|' || CASE node_type WHEN 'Part' THEN '1|p' ELSE '0|s' END || k), 1, 20) AS node_id, 'name' AS keys, 1::BIGINT AS n_evidence FROM n")
def normalize_nodes(spark, sf_dir):
    types, properties, _ = _onto(spark)
    out = N.nodes(*_replies(spark, sf_dir), types, properties)
    return out.select(_item("occ_ord").alias("occ_ord"), "node_type", "node_id", F.array_join("props.key", ",").alias("keys"), F.size("evidence").cast("long").alias("n_evidence"))


@query("normalize_nodes_kept", f"{_SAID}, n AS (SELECT *, unnest(['Supplier', 'Part']) AS node_type FROM gr) SELECT node_type, CASE node_type WHEN 'Part' THEN 'p' ELSE 's' END || k AS node_id, CASE node_type WHEN 'Part' THEN 'name,brand' ELSE 'name' END AS keys, page::VARCHAR AS page FROM n")
def normalize_nodes_kept(spark, sf_dir):
    types, properties, _ = _onto(spark)
    out = N.nodes(*_replies(spark, sf_dir), types, properties, "kept")
    return out.select("node_type", "node_id", F.array_join("props.key", ",").alias("keys"), F.get("evidence", F.lit(0))["page"].alias("page"))


@query("normalize_nodes_permissive", f"{_SAID}, n AS (SELECT *, unnest(['Supplier', 'Part', 'Planet']) AS node_type FROM good) SELECT node_type, CASE node_type WHEN 'Part' THEN 'p' WHEN 'Planet' THEN 'x' ELSE 's' END || k AS node_id, 'name,brand,odd' AS keys, trim(CASE WHEN k % 2 = 0 THEN regexp_replace(text, '{SPACE}', '', 'g') ELSE 'w' END) <> '' AS quoted FROM n")
def normalize_nodes_permissive(spark, sf_dir):
    types, properties, _ = _onto(spark)
    out = N.nodes(*_replies(spark, sf_dir), types, properties, "permissive")
    return out.select("node_type", "node_id", F.array_join("props.key", ",").alias("keys"), F.get("evidence", F.lit(0))["quote"].isNotNull().alias("quoted"))


@query("normalize_relationships", f"{_SAID}, i AS (SELECT *, 'node_' || substring(sha1('Supplier|' || document_id || '|' || chunk_id || '|primary|0|s' || k), 1, 20) AS s, 'node_' || substring(sha1('Part|' || document_id || '|' || chunk_id || '|primary|1|p' || k), 1, 20) AS t FROM gr) SELECT chunk_ord * 100000 AS rel_ord, s AS source_node_id, 'SUPPLIES' AS relationship_type, t AS target_node_id, 'rel_' || substring(sha1(s || '|SUPPLIES|' || t), 1, 20) AS relationship_id FROM i")
def normalize_relationships(spark, sf_dir):
    types, properties, signatures = _onto(spark)
    replies, chunks = _replies(spark, sf_dir)
    out = N.relationships(replies, N.nodes(replies, chunks, types, properties), chunks, signatures)
    return out.select(_item("rel_ord").alias("rel_ord"), "source_node_id", "relationship_type", "target_node_id", "relationship_id")


@query("normalize_relationships_kept", f"{_SAID} SELECT 'q' || k AS relationship_id, 's' || k AS source_node_id, 'SUPPLIES' AS relationship_type, 'p' || k AS target_node_id FROM gr")
def normalize_relationships_kept(spark, sf_dir):
    types, properties, signatures = _onto(spark)
    replies, chunks = _replies(spark, sf_dir)
    return N.relationships(replies, N.nodes(replies, chunks, types, properties, "kept"), chunks, signatures, "kept").select("relationship_id", "source_node_id", "relationship_type", "target_node_id")


@query("normalize_relationships_permissive", f"{_SAID} SELECT 'q' || k AS relationship_id, 's' || k AS source_node_id, 'SUPPLIES' AS relationship_type, 'p' || k AS target_node_id FROM good")
def normalize_relationships_permissive(spark, sf_dir):
    replies, chunks = _replies(spark, sf_dir)
    none = replies.limit(0)
    return N.relationships(replies, none, chunks, _onto(spark)[2], "permissive").select("relationship_id", "source_node_id", "relationship_type", "target_node_id")


@query("reply_warnings", f"{_SAID} SELECT DISTINCT 'seen ' || source_file AS warning FROM good")
def reply_warnings(spark, sf_dir):
    return N.warnings(_replies(spark, sf_dir)[0])


@query("source_document_set", f"{_SAID} SELECT DISTINCT document_id FROM good")
def source_document_set(spark, sf_dir):
    replies, chunks = _replies(spark, sf_dir)
    return N.source_documents(replies.where("status = 'ok'"), chunks)


@query("chunk_counters", f"{_SAID} SELECT count(*)::BIGINT AS chunks, count(*) FILTER (WHERE k % 7 <> 0)::BIGINT AS chunks_ok, count(*) FILTER (WHERE k % 7 = 0)::BIGINT AS chunks_failed FROM c0")
def chunk_counters(spark, sf_dir):
    replies, chunks = _replies(spark, sf_dir)
    return N.counters(chunks, replies)


@query("validation_graded", f"{_ERRORS} SELECT CASE WHEN kind IN ('unsupported properties', 'node without evidence', 'relationship without evidence') THEN 'warning' ELSE 'error' END AS level, kind, count(*)::BIGINT AS n FROM err GROUP BY ALL UNION ALL SELECT 'warning', 'missing type', count(*)::BIGINT FROM typ WHERE node_type NOT IN (SELECT node_type FROM node)")
def validation_graded(spark, sf_dir):
    """Findings as errors and warnings, as an earlier validator grades them, by kind."""
    types, properties, signatures = _onto(spark)
    nodes, rels = _merged(spark, sf_dir, keys=True)
    missing = V.coverage(nodes, types).where("not found")
    return V.graded(V.findings(nodes, rels, types, properties, signatures), missing).groupBy("level", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("validation_without_orphans", f"{_ERRORS} SELECT kind, count(*)::BIGINT AS n FROM err WHERE kind <> 'orphan relationship' GROUP BY ALL")
def validation_without_orphans(spark, sf_dir):
    nodes, rels = _merged(spark, sf_dir, keys=True)
    return V.without_orphans(V.findings(nodes, rels, *_onto(spark))).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("final_clean", f"{_GRAPH} SELECT source_node_id, relationship_type, target_node_id, min(rel_ord) AS rel_ord, 'rel_' || substring(sha1(source_node_id || '|' || relationship_type || '|' || target_node_id), 1, 20) AS relationship_id FROM rel WHERE source_node_id IN (SELECT node_id FROM node) AND target_node_id IN (SELECT node_id FROM node) GROUP BY 1, 2, 3")
def final_clean(spark, sf_dir):
    """Raw relationships without those that lack an end, the first of each triple, under a minted id."""
    nodes = M.merged_nodes(star.nodes(spark, sf_dir)).table
    ids = nodes.select("node_id").distinct()
    rels = star.relationships(spark, sf_dir)
    whole = rels.join(ids.withColumnRenamed("node_id", "source_node_id"), "source_node_id", "left_semi").join(ids.withColumnRenamed("node_id", "target_node_id"), "target_node_id", "left_semi")
    return M.first_of_triples(whole).select("source_node_id", "relationship_type", "target_node_id", "rel_ord", text.minted("rel_", F.col("source_node_id"), F.col("relationship_type"), F.col("target_node_id")).alias("relationship_id"))


@query("final_filter_reasons", f"""WITH {star.NODES_SQL}, {star.RELATIONSHIPS_SQL}, {star.ONTOLOGY_SQL}, j AS (SELECT r.*, CASE WHEN a.node_id IS NULL AND b.node_id IS NULL THEN 'both missing' WHEN a.node_id IS NULL THEN 'source missing' WHEN b.node_id IS NULL THEN 'target missing' WHEN sig.source_type IS NULL THEN 'signature not allowed' END AS lost
FROM rel r LEFT JOIN occ a ON source_node_id = a.node_id LEFT JOIN occ b ON target_node_id = b.node_id LEFT JOIN sig ON sig.source_type = a.node_type AND sig.relationship_type = r.relationship_type AND sig.target_type = b.node_type)
SELECT rel_ord, coalesce(lost, CASE WHEN row_number() OVER (PARTITION BY lost, source_node_id, relationship_type, target_node_id ORDER BY rel_ord) = 1 THEN 'kept' ELSE 'repeated' END) AS verdict FROM j""")
def final_filter_reasons(spark, sf_dir):
    """Every relationship with whether it stays in the final graph, or why not, in one pass."""
    rels, nodes, signatures = star.relationships(spark, sf_dir).select("rel_ord", "relationship_id", *M.ENDS), star.nodes(spark, sf_dir), _onto(spark)[2]
    typed = stored_in_slices(rels, ["source_node_id"], lambda rows: V.ends(rows, nodes))
    return stored_in_slices(typed, list(M.ENDS), lambda rows: V.final_filter(rows, nodes, signatures).select("rel_ord", "verdict"))


# --- reviews and recovered relationships, over rule-made replies -----------------------------------

_WALK = "acc AS (SELECT node_id, duplicate_of FROM jud WHERE verdict = 'accepted'), walk AS (SELECT node_id AS old_node_id, duplicate_of AS node_id, 1 AS d FROM acc UNION ALL SELECT w.old_node_id, a.duplicate_of, d + 1 FROM walk w JOIN acc a ON w.node_id = a.node_id), als AS (SELECT old_node_id, arg_max(node_id, d) AS node_id FROM walk GROUP BY old_node_id)"


def _reviewed(spark, sf_dir) -> tuple[M.Merged, DataFrame]:
    """(merged, aliases): the star's nodes with reviewed duplicates merged into their roots."""
    occurrences = star.nodes(spark, sf_dir)
    items = E.numbered(E.items(occurrences, "node_id", "occ_ord"), "node_id", "at")
    merged, aliases, _ = passes.apply_reviews(M.without_arrays(occurrences), star.reviews(spark, sf_dir), items)
    return merged, aliases


@query("reviewed_node_evidence", f"WITH RECURSIVE {star.NODES_SQL}, {_REVIEWED}, {_WALK} SELECT coalesce(als.node_id, occ.node_id) AS node_id, (row_number() OVER (PARTITION BY coalesce(als.node_id, occ.node_id) ORDER BY als.node_id IS NOT NULL, occ_ord) - 1)::BIGINT AS place, canonical_key AS quote FROM occ LEFT JOIN als ON occ.node_id = old_node_id WHERE canonical_key IS NOT NULL")
def reviewed_node_evidence(spark, sf_dir):
    """Evidence of nodes after reviews: the root's first, then that of its duplicates."""
    return _reviewed(spark, sf_dir)[0].evidence().select("node_id", "place", "quote")


@query("reviewed_relationships", f"WITH RECURSIVE {star.NODES_SQL}, {star.RELATIONSHIPS_SQL}, {_REVIEWED}, {_WALK}, mov AS (SELECT r.*, coalesce(s.node_id, source_node_id) AS s, coalesce(t.node_id, target_node_id) AS t FROM rel r LEFT JOIN als s ON source_node_id = s.old_node_id LEFT JOIN als t ON target_node_id = t.old_node_id) SELECT 'rel_' || substring(sha1(s || '|' || relationship_type || '|' || t), 1, 20) AS relationship_id, min(rel_ord) AS rel_ord, s AS source_node_id, relationship_type, t AS target_node_id FROM mov GROUP BY s, relationship_type, t")
def reviewed_relationships(spark, sf_dir):
    """Relationships after reviews, one for each source, type and target."""
    moved = M.redirected(star.relationships(spark, sf_dir), _reviewed(spark, sf_dir)[1])
    return M.merged_relationships(moved).table.select("relationship_id", "rel_ord", "source_node_id", "relationship_type", "target_node_id")


def _order_replies(spark, sf_dir) -> DataFrame:
    """A reply for every tenth order (node_type, batch, raw): who placed it, a signature that is not allowed, an end that is not there, and where its customer is said to be; the quote is from a document, or, of odd ones, from nowhere."""
    docs = _docs(spark, sf_dir)
    n = docs.agg(F.max("doc_id")).first()[0] + 1
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderkey % 10 = 0").select("o_orderkey", "o_custkey", (F.col("o_orderkey") / 10).cast("long").alias("k"))
    quotes = docs.select("doc_id", F.concat(F.substring("text", 5, 20), F.when(F.col("doc_id") % 2 == 1, "#").otherwise("")).alias("quote"))
    both = orders.join(quotes, F.col("k") % n == F.col("doc_id"), "left")
    order, customer, nation = F.concat(F.lit("order_"), "o_orderkey"), F.concat(F.lit("customer_"), "o_custkey"), F.concat(F.lit("nation_"), F.col("k") % 25)
    link = lambda kind, s, t: F.struct(F.lit(kind).alias("relationship_type"), s.alias("source_node_id"), t.alias("target_node_id"), F.array(F.struct("quote")).alias("evidence"))
    links = F.array(link("PLACED", customer, order), link("SUPPLIES", customer, order), link("PLACED", F.lit("customer_nobody"), order), link("LOCATED_IN", customer, nation))
    return both.select(F.lit("Order").alias("node_type"), F.col("o_orderkey").alias("batch"), F.to_json(F.struct(links.alias("relationships"))).alias("raw"))


@query("relationship_candidates", f"""WITH {CHUNKS_SQL}, {star.NODES_SQL}, {star.RELATIONSHIPS_SQL}, {star.ONTOLOGY_SQL}, quo AS (SELECT doc_id, substring(text, 5, 20) || CASE WHEN doc_id % 2 = 1 THEN '#' ELSE '' END AS quote FROM documents),
fq AS (SELECT DISTINCT {_fold('quote')} AS q FROM quo), fb AS (SELECT DISTINCT {_fold('text')} AS b FROM chk), hit AS (SELECT DISTINCT q FROM fq JOIN fb ON contains(b, q) WHERE length(q) >= 8),
ask AS (SELECT o_orderkey, o_custkey, o_orderkey // 10 AS k, {_fold('quote')} IN (SELECT q FROM hit) AS found FROM orders LEFT JOIN quo ON doc_id = (o_orderkey // 10) % (SELECT max(doc_id) + 1 FROM documents) WHERE o_orderkey % 10 = 0),
raw AS (SELECT o_orderkey * 10 AS o, 'PLACED' AS relationship_type, 'customer_' || o_custkey AS s, 'order_' || o_orderkey AS t, found FROM ask
 UNION ALL SELECT o_orderkey * 10 + 1, 'SUPPLIES', 'customer_' || o_custkey, 'order_' || o_orderkey, found FROM ask UNION ALL SELECT o_orderkey * 10 + 2, 'PLACED', 'customer_nobody', 'order_' || o_orderkey, found FROM ask
 UNION ALL SELECT o_orderkey * 10 + 3, 'LOCATED_IN', 'customer_' || o_custkey, 'nation_' || k % 25, found FROM ask),
v AS (SELECT raw.*, CASE WHEN a.node_id IS NULL OR b.node_id IS NULL THEN 'unknown endpoint' WHEN sig.source_type IS NULL THEN 'signature not allowed' WHEN found IS NOT TRUE THEN 'evidence not found' WHEN EXISTS (SELECT 1 FROM rel WHERE rel.source_node_id = s AND rel.relationship_type = raw.relationship_type AND rel.target_node_id = t) THEN 'already present' ELSE 'accepted' END AS verdict
 FROM raw LEFT JOIN occ a ON s = a.node_id LEFT JOIN occ b ON t = b.node_id LEFT JOIN sig ON sig.source_type = a.node_type AND sig.relationship_type = raw.relationship_type AND sig.target_type = b.node_type)
SELECT (row_number() OVER (ORDER BY o) - 1)::BIGINT AS place, s AS source_node_id, relationship_type, t AS target_node_id, CASE WHEN verdict = 'accepted' AND row_number() OVER (PARTITION BY s, relationship_type, t, verdict ORDER BY o) > 1 THEN 'already present' ELSE verdict END AS verdict FROM v""")
def relationship_candidates(spark, sf_dir):
    """Relationships of replies, each with the first reason why it is not taken up: ends, signature, quote, or that it is there."""
    at = lambda c: ordinals.item(0, ordinals.chunk(F.lit(0), F.lit(0)), F.lit("primary"), F.col(c)).alias(c)
    known = star.relationships(spark, sf_dir).withColumn("rel_ord", at("rel_ord"))
    judged = passes.candidates(_order_replies(spark, sf_dir), "relationships", star.nodes(spark, sf_dir), known, _chunks(spark, sf_dir), star.ONTOLOGY, ["node_type", "batch"], "relationships")
    return judged.select(F.col("rel_ord.place").alias("place"), "source_node_id", "relationship_type", "target_node_id", "verdict")


# --- repair rounds: a graph without suppliers and warehouses is asked for them ----------------------


def _without_suppliers(spark, sf_dir) -> tuple[Graph, DataFrame]:
    """(graph, chunks): the star's nodes and relationships but those of suppliers, each once, with places in corpus order."""
    at = lambda c: ordinals.item(0, ordinals.chunk(F.lit(0), F.lit(0)), F.lit("primary"), F.col(c)).alias(c)
    nodes = star.nodes(spark, sf_dir).where("node_type <> 'Supplier' and occ_ord < 7000000000000").withColumn("occ_ord", at("occ_ord"))
    rels = star.relationships(spark, sf_dir).where("relationship_type <> 'SUPPLIES'").withColumn("rel_ord", at("rel_ord"))
    items = [stored(E.numbered(E.items(df, key, order), key, "at")) for df, key, order in ((nodes, "node_id", "occ_ord"), (rels, "relationship_id", "rel_ord"))]
    return Graph(stored(M.without_arrays(nodes)), stored(M.without_arrays(rels)), *items), _chunks(spark, sf_dir)


def _supplier_replies() -> R.RuleExtractor:
    """What a model says when asked: suppliers in the first round, one of them twice, a customer under a new id; a warehouse in the second. Quotes are from the first chunk shown."""
    block = r"(?s)--- (\S+) / (\S+) / pages \S+ ---\n(.{20})"
    part = lambda i: F.regexp_extract("prompt", block, i)
    quote = F.array(F.struct(part(1).alias("document_id"), part(2).alias("chunk_id"), part(3).alias("quote")))
    node = lambda i, kind, name: F.struct(F.lit(i).alias("node_id"), F.lit(kind).alias("node_type"), F.struct(F.lit(name).alias("name")).alias("properties"), quote.alias("evidence"))
    link = lambda i, kind, s, t: F.struct(F.lit(i).alias("relationship_id"), F.lit(kind).alias("relationship_type"), F.lit(s).alias("source_node_id"), F.lit(t).alias("target_node_id"), quote.alias("evidence"))
    said = lambda nodes, links: F.to_json(F.struct(F.array(*nodes).alias("nodes"), F.array(*links).alias("relationships")))
    suppliers = said([node("fix_s", "Supplier", "Repair Supply"), node("fix_t", "Supplier", "repair supply "), node("fix_c", "Customer", "customer#000000001")], [link(*x) for x in REPAIR_LINKS[:5]])
    warehouse = said([node("fix_w", "Warehouse", "House")], [link(*x) for x in REPAIR_LINKS[5:]])
    return R.RuleExtractor(F.when((F.col("node_type") == "Supplier") & (F.col("round") == 1), suppliers).when((F.col("node_type") == "Warehouse") & (F.col("round") == 2), warehouse).otherwise(F.lit('{"nodes": []}')))


REPAIR_LINKS = (
    ("f1", "SUPPLIES", "fix_s", "part_1"), ("f2", "SUPPLIES", "fix_t", "part_0"), ("f3", "SUPPLIES", "fix_s", "part_ghost"), ("f4", "PLACED", "fix_c", "order_3"), ("r_10000000000000", "IN_REGION", "nation_0", "region_1"),
    ("f5", "STORES", "fix_w", "part_1"), ("f6", "PLACED", "fix_c", "order_4"),
)
SUPPLIER_TEXT = "1. Supplier\nProperties:\n- name\n2. Warehouse\nProperties:\n- name\n"


def _repaired(spark, sf_dir, mode: str) -> rounds_of.Repaired:
    graph, chunks = _without_suppliers(spark, sf_dir)
    work = f"{shared(spark)}/repair-{uuid.uuid4().hex}"
    return rounds_of.run(spark, graph, chunks, star.ONTOLOGY, SUPPLIER_TEXT, _supplier_replies(), work, rounds_of.RepairOptions(mode))


_NO_SUPPLIERS = f"{star.NODES_SQL}, {star.RELATIONSHIPS_SQL}, {star.ONTOLOGY_SQL}, old AS (SELECT occ_ord, node_id, node_type, canonical_key FROM occ WHERE node_type <> 'Supplier' AND occ_ord < 7000000000000)"
_SOUND = "JOIN {0} a ON e.source_node_id = a.node_id JOIN {0} b ON e.target_node_id = b.node_id JOIN sig ON sig.source_type = a.node_type AND sig.relationship_type = e.relationship_type AND sig.target_type = b.node_type"


@query("repair_loop", f"""WITH {_NO_SUPPLIERS}, al AS (SELECT node_id, node_type FROM old UNION ALL VALUES ('fix_s', 'Supplier'), ('fix_w', 'Warehouse')),
edge AS (SELECT rel_ord, 'r_' || rel_ord AS relationship_id, relationship_type, source_node_id, target_node_id FROM rel WHERE relationship_type <> 'SUPPLIES' UNION ALL SELECT * FROM (VALUES (90000000000000, 'f1', 'SUPPLIES', 'fix_s', 'part_1'), (90000000000001, 'f2', 'SUPPLIES', 'fix_s', 'part_0'), (90000000000002, 'f4', 'PLACED', 'customer_1', 'order_3'), (90000000000003, 'f5', 'STORES', 'fix_w', 'part_1'), (90000000000004, 'f6', 'PLACED', 'customer_1', 'order_4')) v)
SELECT arg_min(relationship_id, rel_ord) AS relationship_id, e.relationship_type, source_node_id, target_node_id FROM edge e {_SOUND.format('al')} GROUP BY ALL""")
def repair_loop(spark, sf_dir):
    """The final relationships after two rounds, by stable ids: two names of one supplier and a customer's new id are redirected, also for the round after."""
    done = _repaired(spark, sf_dir, "stable").graph
    return V.final_filter(done.relationships, done.nodes, _onto(spark)[2]).where("verdict = 'kept'").select("relationship_id", "relationship_type", "source_node_id", "target_node_id")


_RAW_NAME = f"trim(regexp_replace(regexp_replace(lower(trim(p_name)), '\\b(?:{'|'.join(text.COMPANY_WORDS_RAW)})\\b', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"


@query("repair_loop_resolved", f"""WITH {_NO_SUPPLIERS}, one AS (SELECT {_RAW_NAME} AS name, min(p_partkey) AS k FROM part GROUP BY 1), als AS (SELECT 'part_' || p_partkey AS o, 'part_' || k AS n FROM part JOIN one ON one.name = {_RAW_NAME}),
al AS (SELECT node_id, node_type FROM old WHERE node_type <> 'Part' UNION ALL SELECT 'part_' || k, 'Part' FROM one UNION ALL VALUES ('fix_s', 'Supplier'), ('fix_w', 'Warehouse')),
edge AS (SELECT rel_ord, 'r_' || rel_ord AS relationship_id, relationship_type, source_node_id, target_node_id FROM rel WHERE relationship_type <> 'SUPPLIES' UNION ALL SELECT * FROM (VALUES (90000000000000, 'rel_' || substring(sha1('fix_s|SUPPLIES|part_1'), 1, 20), 'SUPPLIES', 'fix_s', 'part_1'), (90000000000001, 'rel_' || substring(sha1('fix_t|SUPPLIES|part_0'), 1, 20), 'SUPPLIES', 'fix_s', 'part_0'), (90000000000002, 'rel_' || substring(sha1('nation_0|IN_REGION|region_1'), 1, 20), 'IN_REGION', 'nation_0', 'region_1'), (90000000000003, 'rel_' || substring(sha1('fix_w|STORES|part_1'), 1, 20), 'STORES', 'fix_w', 'part_1')) v),
mov AS (SELECT rel_ord, relationship_id, relationship_type, coalesce(s.n, source_node_id) AS source_node_id, coalesce(t.n, target_node_id) AS target_node_id FROM edge LEFT JOIN als s ON source_node_id = s.o LEFT JOIN als t ON target_node_id = t.o)
SELECT arg_min(relationship_id, rel_ord) AS relationship_id, e.relationship_type, source_node_id, target_node_id FROM mov e {_SOUND.format('al')} GROUP BY ALL""")
def repair_loop_resolved(spark, sf_dir):
    """The same, all nodes merged by name after each round: parts of one name become one, and relationships follow."""
    done = _repaired(spark, sf_dir, "resolved").graph
    return V.final_filter(done.relationships, done.nodes, _onto(spark)[2]).where("verdict = 'kept'").select("relationship_id", "relationship_type", "source_node_id", "target_node_id")


# --- end to end ------------------------------------------------------------------------------------


@query("graph_end_to_end", f"""{_GRAPH}, fin AS (SELECT * FROM node WHERE node_type IN (SELECT node_type FROM typ)),
touched AS (SELECT source_node_id AS id FROM good UNION ALL SELECT target_node_id FROM good),
deg AS (SELECT fin.node_id, fin.node_type, count(touched.id) AS degree FROM fin LEFT JOIN touched ON fin.node_id = touched.id GROUP BY ALL)
SELECT 'node' AS part, typ.node_type AS kind, count(deg.node_id)::BIGINT AS n, coalesce(sum(CASE WHEN degree = 0 THEN 1 ELSE 0 END) FILTER (WHERE deg.node_id IS NOT NULL), 0)::BIGINT AS disconnected FROM typ LEFT JOIN deg ON typ.node_type = deg.node_type GROUP BY typ.node_type
UNION ALL SELECT 'relationship', s.relationship_type, count(good.relationship_type)::BIGINT, 0 FROM (SELECT DISTINCT relationship_type FROM sig) s LEFT JOIN good USING (relationship_type) GROUP BY s.relationship_type""")
def graph_end_to_end(spark, sf_dir):
    """How many nodes and relationships of each type survive merging, remapping and validation, and how many nodes have no relationship."""
    types, _, signatures = _onto(spark)
    nodes, rels = _merged(spark, sf_dir)
    nodes = V.known_types(nodes, types)
    rels = V.valid(rels, nodes, signatures)
    degrees = V.degrees(rels, nodes).groupBy(F.col("node_type").alias("t")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("degree") == 0, 1).otherwise(0)).alias("disconnected"))
    by_type = types.select("node_type").distinct().join(degrees, F.col("node_type") == F.col("t"), "left").select(F.lit("node").alias("part"), F.col("node_type").alias("kind"), F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("disconnected", F.lit(0)).cast("long").alias("disconnected"))
    by_relation = V.relationship_coverage(rels, signatures).select(F.lit("relationship").alias("part"), F.col("relationship_type").alias("kind"), "n", F.lit(0).cast("long").alias("disconnected"))
    return by_type.unionByName(by_relation)
