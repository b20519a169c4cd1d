"""Merging occurrences to nodes, and relationships after their endpoints.

The first occurrence gives a node its scalar fields; of each property the first non-empty value
wins, or the last one if all are empty, and keys stand in the order they first appeared. These are
aggregates with explicit ordinals, so results do not depend on how rows are dealt out. Evidence
stays a table with a row an item: repeats go before the shuffle, and the items of a node or relationship are numbered in
pieces of their order, so one with millions of them is neither an array nor a single task. Arrays
of evidence are made at sinks only (:func:`merge_nodes` and the like), under the bound of :func:`evidence.listed`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evigraph.functions import props as P
from evigraph.functions import text
from evigraph.functions.store import stored, stored_in_slices
from evigraph.operators import evidence as E

METRIC_TYPE = "FinancialMetric"
#: Fields that make an identity when a repair is merged.
REPAIR_FIELDS = ("name", "fund_name", "legal_name", "deal_name", "criterion_id", "finding_id", "metric_name")


def canonical_key() -> Column:
    """Type and canonical key; without one, the occurrence itself.

    A key without ASCII letters or digits falls back to its lower-cased NFKC form, so different
    foreign keys stay different.
    """
    known = text.collapsed(F.col("canonical_key"))
    plain = text.identity(known)
    return F.when(known == "", F.concat_ws("|", "node_type", F.lit("source_instance"), F.coalesce("source_instance_id", "node_id"))).otherwise(F.concat_ws("|", "node_type", F.lit("canonical_key"), F.when(plain != "", plain).otherwise(F.lower(text.nfkc(known)))))


def strong_or_name() -> Column:
    """Type and the first strong identity, else the first name-like one, else the id."""
    first = lambda test: F.try_element_at(F.filter("props", lambda p: test(p["key"]) & ~P.is_empty(p["value_json"])), F.lit(1))["value_json"]
    strong, name = first(P.is_strong), first(P.is_name)
    return F.when(strong.isNotNull(), F.concat_ws("|", "node_type", F.lit("strong"), text.company_identity(P.text_of(strong)))).when(name.isNotNull(), F.concat_ws("|", "node_type", F.lit("name"), text.company_identity(P.text_of(name)))).otherwise(F.concat_ws("|", "node_type", F.lit("opaque"), "node_id"))


def name_or_metric() -> Column:
    """Type and normalized name; a metric by name, period, basis, status, currency, unit and value. Names that normalize to nothing fall back to the id."""
    v = lambda *keys: text.compatible_identity(P.text_of(P.value(F.col("props"), *keys)))
    raw = lambda key: P.text_of(P.value(F.col("props"), key))
    metric = F.concat_ws("|", "node_type", v("metric_name", "name"), v("period", "fiscal_year", "quarter"), v("basis"), v("status"), v("currency"), v("unit"), F.coalesce(raw("value"), raw("normalized_value"), F.lit("None")))
    name = text.compatible_identity(node_name())
    return F.when(F.col("node_type") == METRIC_TYPE, metric).otherwise(F.concat_ws("|", "node_type", F.when(name != "", name).otherwise(F.concat(F.lit("id:"), "node_id"))))


def node_name() -> Column:
    """The name by type-specific fields, else the id."""
    one = lambda *keys: P.text_of(P.value(F.col("props"), *keys))
    by_type = F.when(F.col("node_type") == METRIC_TYPE, one("metric_name", "name")).when(F.col("node_type") == "Deal", one("deal_name", "name")).when(F.col("node_type") == "AuditFinding", one("finding_id", "name", "description")).otherwise(one("name", "legal_name"))
    return F.coalesce(by_type, "node_id")


def by_id() -> Column:
    """The id alone, whatever the type: only for replies of models that number entities themselves."""
    return F.col("node_id")


def repair_identity() -> Column:
    """Type and all repair fields present, joined; null without any."""
    values = F.filter(F.array(*(F.lower(F.trim(P.text_of(P.value(F.col("props"), k)))) for k in REPAIR_FIELDS)), lambda x: x.isNotNull())
    return F.when(F.size(values) > 0, F.concat_ws("|", F.col("node_type"), F.array_join(values, "|")))


STRATEGIES = {"canonical": canonical_key, "strong_or_name": strong_or_name, "name_or_metric": name_or_metric, "id": by_id}


def merged_properties(rows: DataFrame, key: str, order: str, union_lists: bool = False) -> DataFrame:
    """(key, props) of rows with ``props``: in long form, the first non-empty value of each property wins.

    With ``union_lists`` a property whose winner is a list takes in the items of later values.
    """
    long = rows.select(key, F.col(order).alias("o"), F.explode("props").alias("p")).select(key, "o", "p.*")
    empty = P.is_empty(F.col("value_json"))
    place = F.struct("o", "pos")
    best = long.groupBy(key, "key").agg(
        F.min(place).alias("first"), F.min_by("value_json", F.when(~empty, place)).alias("won"), F.max_by(F.coalesce("value_json", F.lit("null")), place).alias("last"),
        *([F.array_sort(F.collect_list(F.when(~empty, F.struct("o", "pos", "value_json")))).alias("all")] if union_lists else []),
    )
    value = F.coalesce("won", "last")
    if union_lists:
        items = F.array_distinct(F.flatten(F.transform("all", lambda r: F.when(r["value_json"].startswith("["), F.from_json(r["value_json"], "array<string>")).otherwise(F.array(P.text_of(r["value_json"]))))))
        value = F.when(F.startswith(F.col("won"), F.lit("[")), F.to_json(items)).otherwise(value)
    ordered = F.array_sort(F.collect_list(F.struct(F.col("first"), F.col("key"), value.alias("value_json"))))
    numbered = F.transform(ordered, lambda x, i: F.struct(i.cast("int").alias("pos"), x["key"].alias("key"), x["value_json"].alias("value_json")))
    return best.groupBy(key).agg(numbered.alias("props"))


@dataclass(frozen=True)
class Merged:
    """Merged rows with ``merge_key`` and ``has_evidence``, what became of ids, and the evidence they take in, as yet unordered.

    ``heads`` are the rows without properties: who only asks for ids, types and ends need not have properties merged.
    """

    rows: DataFrame
    heads: DataFrame
    aliases: DataFrame
    id_col: str
    items: DataFrame  # (merge_key, at, fields)
    keyed: DataFrame  # the rows before, with ``merge_key`` and ``_order``

    @property
    def table(self) -> DataFrame:
        """The rows without their key."""
        return self.rows.drop("merge_key")

    def with_keys(self) -> DataFrame:
        """The heads with ``keys``, the names of all properties, whose values need not be merged for that."""
        keys = F.array_distinct(F.flatten(F.collect_set(F.transform("props", lambda p: p["key"])))).alias("keys")
        return self.heads.join(self.keyed.groupBy("merge_key").agg(keys), "merge_key").drop("merge_key")

    def numbered(self) -> DataFrame:
        """(merge_key, place, fields): each row's different evidence items in order."""
        return E.numbered(self.items, "merge_key", "at")

    def evidence(self) -> DataFrame:
        """(id, place, fields): as :func:`numbered`, under the merged id."""
        ids = self.heads.select("merge_key", self.id_col)
        return self.numbered().join(ids, "merge_key").select(self.id_col, "place", *E.FIELDS)

    def with_arrays(self) -> DataFrame:
        """The rows with their evidence as arrays; see :func:`evidence.listed` for the bound."""
        joined = self.rows.join(E.listed(self.numbered(), "merge_key"), "merge_key", "left")
        return joined.withColumn("evidence", F.coalesce("evidence", F.array().cast(E.SCHEMA))).drop("merge_key", "has_evidence")


def _merged(keyed: DataFrame, id_col: str, head: list[str], items: DataFrame | None = None, union_lists: bool = False, carried: DataFrame | None = None, by_key: dict[str, Column] | None = None) -> Merged:
    """Rows with ``merge_key`` and ``_order`` merged by key.

    A row's ``head`` is that of its first occurrence; or, as ``by_key``, follows from ``merge_key`` and ``_first``, the first
    ordinal, so that groups are hashed and not sorted.

    Evidence, in the order of its rows and then its own, is in their arrays, or in ``items`` (id, place, fields), or in
    ``carried`` (merge_key, at, fields).
    """
    has = F.size("evidence") > 0 if "evidence" in keyed.columns else F.col("has_evidence")
    any_has = F.coalesce(F.bool_or(has), F.lit(False)).alias("has_evidence")
    if by_key is None:
        heads = keyed.groupBy("merge_key").agg(F.min_by(F.struct(*head), "_order").alias("head"), any_has).select("merge_key", "head.*", "has_evidence")
    else:
        heads = keyed.groupBy("merge_key").agg(F.min("_order").alias("_first"), any_has).select("merge_key", *(by_key[c].alias(c) for c in head), "has_evidence")
    props = merged_properties(keyed, "merge_key", "_order", union_lists)
    rows = heads.join(props, "merge_key", "left").select("merge_key", *head, F.coalesce("props", F.array().cast(P.SCHEMA)).alias("props"), "has_evidence")
    first = keyed.select("merge_key", F.col(id_col).alias("_old"), "_order").groupBy("merge_key", "_old").agg(F.min("_order").alias("_order"))
    named = first.withColumn(id_col, by_key[id_col]) if by_key else first.join(heads.select("merge_key", id_col), "merge_key")
    aliases = named.groupBy("_old").agg(F.min_by(id_col, "_order").alias(id_col)).withColumnRenamed("_old", f"old_{id_col}")
    if carried is None and items is None:
        carried = E.items(keyed, "merge_key", "_order")
    elif carried is None:
        owner = first.groupBy("_old").agg(F.min_by(F.struct("merge_key", "_order"), "_order").alias("o")).select("_old", "o.*")
        carried = items.withColumnRenamed(id_col, "_old").join(owner, "_old").select("merge_key", F.struct("_order", F.col("place").alias("_place")).alias("at"), *E.FIELDS)
    return Merged(rows, heads, aliases, id_col, carried, keyed)


def merged_nodes(occurrences: DataFrame, strategy: str = "canonical", union_lists: bool = False, order: Column | None = None, items: DataFrame | None = None) -> Merged:
    """Occurrences merged to nodes, evidence as rows.

    ``occurrences`` is (occ_ord, node_id, node_type, canonical_key, source_instance_id, props, evidence).
    ``order``, the ordinal by default, says which of a group comes first; the node keeps that one's ordinal.
    Nodes that were merged before have ``has_evidence`` and their evidence in ``items`` (node_id, place, fields).
    """
    keyed = occurrences.withColumn("merge_key", STRATEGIES[strategy]()).withColumn("_order", F.col("occ_ord") if order is None else order)
    head = [c for c in occurrences.columns if c not in ("props", "evidence", "has_evidence")]
    return _merged(keyed, "node_id", head, items, union_lists)


def merged_by_key(keyed: DataFrame, items: DataFrame) -> Merged:
    """Nodes that carry their ``merge_key`` and ``_order`` merged by it; their evidence is in ``items``. The first of a key gives the id."""
    head = [c for c in keyed.columns if c not in ("props", "evidence", "has_evidence", "merge_key", "_order")]
    return _merged(keyed, "node_id", head, items)


def without_arrays(rows: DataFrame) -> DataFrame:
    """Rows with ``has_evidence`` instead of their array."""
    return rows.withColumn("has_evidence", F.coalesce(F.size("evidence") > 0, F.lit(False))).drop("evidence")


def merged_with(known: DataFrame, items: DataFrame, fresh: DataFrame, key: Column, id_col: str = "node_id", order: str = "occ_ord", union_lists: bool = False) -> Merged:
    """``known`` rows, whose evidence is in ``items`` (id, place, fields), and ``fresh`` ones with arrays of it, merged by ``key``.

    Known rows come first, whatever the ordinals.
    """
    placed = lambda rows, late: rows.withColumn("merge_key", key).withColumn("_order", F.struct(F.lit(late).alias("late"), order))
    old, new = placed(known, False), placed(fresh, True)
    both = old.unionByName(without_arrays(new).select(*old.columns))
    owner = old.select(F.col(id_col).alias("_of"), "merge_key", "_order")
    at = F.struct("_order", F.col("place").alias("_place")).alias("at")
    carried = items.join(owner, F.col(id_col) == F.col("_of")).select("merge_key", at, *E.FIELDS).unionByName(E.items(new, "merge_key", "_order"))
    return _merged(both, id_col, [c for c in known.columns if c not in ("props", "has_evidence")], union_lists=union_lists, carried=carried)


def merge_nodes(occurrences: DataFrame, strategy: str = "canonical", union_lists: bool = False) -> tuple[DataFrame, DataFrame]:
    """(nodes, aliases): merged nodes with arrays of evidence, and (old_node_id, node_id) of all occurrences.

    For nodes of little evidence; see :func:`merged_nodes`. Merging what is merged already changes nothing.
    """
    found = merged_nodes(occurrences, strategy, union_lists)
    return found.with_arrays(), found.aliases


def redirected(relationships: DataFrame, aliases: DataFrame, drop_unknown: bool = False) -> DataFrame:
    """Relationships with endpoints replaced by their aliases (old_node_id, node_id).

    Endpoints without an alias stay as they are, or, with ``drop_unknown``, drop the relationship.
    """
    how = "inner" if drop_unknown else "left"
    aliases = aliases if drop_unknown else aliases.where("old_node_id <> node_id")  # an id that stays needs no alias
    s, t = (aliases.select(F.col("old_node_id").alias(f"{x}_old"), F.col("node_id").alias(f"{x}_new")) for x in "st")
    moved = relationships.join(s, F.col("source_node_id") == F.col("s_old"), how).join(t, F.col("target_node_id") == F.col("t_old"), how)
    return moved.withColumn("source_node_id", F.coalesce("s_new", "source_node_id")).withColumn("target_node_id", F.coalesce("t_new", "target_node_id")).drop("s_old", "s_new", "t_old", "t_new")


ENDS = ("source_node_id", "relationship_type", "target_node_id")


def relationship_evidence(relationships: DataFrame, aliases: DataFrame) -> DataFrame:
    """(relationship_id, place, fields): the evidence of :func:`merged_relationships` of :func:`redirected` ones, whose rows are shuffled slice by slice."""
    changed = stored(aliases.where("old_node_id <> node_id"))
    items = stored_in_slices(relationships, ["source_node_id"], lambda rows: merged_relationships(redirected(rows, changed)).items)
    return E.numbered(items, "merge_key", "at", kept=True).select(text.minted("rel_", *(F.col("merge_key")[c] for c in ENDS)).alias("relationship_id"), "place", *E.FIELDS)


def typed_aliases(aliases: DataFrame, nodes: DataFrame) -> DataFrame:
    """Aliases (old_node_id, node_id) with the ``node_type`` of the merged node."""
    return aliases.join(nodes.groupBy("node_id").agg(F.max_by("node_type", "occ_ord").alias("node_type")), "node_id")


def typed_triples(relationships: DataFrame, aliases: DataFrame) -> DataFrame:
    """(rel_ord, relationship_id, relationship_type, ends, source_type, target_type, has_evidence): as :func:`merged_relationships` gives the heads of :func:`redirected` ones, with the types of both ends.

    ``aliases`` is that of :func:`typed_aliases` for every node; an end without an alias is no node and has no type. So types cost
    no joins besides those that redirect, and rows are shuffled slice by slice.
    """
    s, t = (aliases.select(F.col("old_node_id").alias("_old"), F.col("node_id").alias("_new"), F.col("node_type").alias(f"{x}_type")) for x in ("source", "target"))
    has = F.size("evidence") > 0 if "evidence" in relationships.columns else F.col("has_evidence")

    def end(rows: DataFrame, ids: DataFrame, name: str) -> DataFrame:
        return rows.join(ids, F.col(name) == F.col("_old"), "left").withColumn(name, F.coalesce("_new", name)).drop("_old", "_new")

    def first(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*ENDS, "source_type", "target_type").agg(F.min("rel_ord").alias("rel_ord"), F.coalesce(F.bool_or("has_evidence"), F.lit(False)).alias("has_evidence"))

    thin = relationships.select("rel_ord", *ENDS, has.alias("has_evidence"))
    moved = stored_in_slices(thin, ["source_node_id"], lambda rows: end(end(rows, s, "source_node_id"), t, "target_node_id"))
    once = stored_in_slices(moved, list(ENDS), first)
    return once.select("rel_ord", text.minted("rel_", *(F.col(c) for c in ENDS)).alias("relationship_id"), *ENDS, "source_type", "target_type", "has_evidence")


def merged_relationships(relationships: DataFrame, items: DataFrame | None = None, minted: bool = True, union_lists: bool = False) -> Merged:
    """One relationship for each (source, type, target), evidence as rows; its id minted from these, or else the first one's."""
    keyed = relationships.withColumn("merge_key", F.struct(*ENDS)).withColumn("_order", F.col("rel_ord"))
    head = ["rel_ord", "relationship_id", *ENDS]
    ends = {c: F.col("merge_key")[c] for c in ENDS}
    made = {"rel_ord": F.col("_first"), "relationship_id": text.minted("rel_", *ends.values()), **ends}
    return _merged(keyed, "relationship_id", head, items, union_lists, by_key=made if minted else None)


def remap(relationships: DataFrame, aliases: DataFrame, drop_unknown: bool = False) -> DataFrame:
    """Relationships with endpoints replaced by their aliases, then one for each (source, type, target), with arrays of evidence."""
    return merge_relationships(redirected(relationships, aliases, drop_unknown))


def merge_relationships(relationships: DataFrame) -> DataFrame:
    """One relationship for each (source, type, target), with an id minted from these and an array of evidence."""
    return merged_relationships(relationships).with_arrays()


def merged_relationships_by_id(relationships: DataFrame) -> Merged:
    """One relationship for each id: the first occurrence's ends and type, the first non-empty value of each property, all evidence as rows."""
    keyed = relationships.withColumn("merge_key", F.col("relationship_id")).withColumn("_order", F.col("rel_ord"))
    return _merged(keyed, "relationship_id", ["rel_ord", "relationship_id", "relationship_type", "source_node_id", "target_node_id"])


def merge_relationships_by_id(relationships: DataFrame) -> DataFrame:
    """As :func:`merged_relationships_by_id`, with arrays of evidence."""
    return merged_relationships_by_id(relationships).with_arrays()


def merge_repaired_relationships(relationships: DataFrame, repair: DataFrame, nodes: DataFrame, redirects: DataFrame) -> DataFrame:
    """``relationships`` and those of ``repair`` that are new: ends redirected, both of them nodes, an id that is not there yet.

    Of repair relationships with one id the first counts. ``redirects`` is (old_node_id, node_id).
    """
    return relationships.unionByName(fresh_relationships(relationships, repair, nodes, redirects).select(*relationships.columns))


def fresh_relationships(relationships: DataFrame, repair: DataFrame, nodes: DataFrame, redirects: DataFrame) -> DataFrame:
    """The relationships of ``repair`` that :func:`merge_repaired_relationships` adds."""
    known = nodes.select(F.col("node_id").alias("_n")).distinct()
    moved = redirected(repair, redirects)
    whole = moved.join(known, F.col("source_node_id") == F.col("_n"), "left_semi").join(known, F.col("target_node_id") == F.col("_n"), "left_semi").where("relationship_id <> ''")
    fields = [c for c in repair.columns if c != "relationship_id"]
    first = whole.groupBy("relationship_id").agg(F.min_by(F.struct(*fields), "rel_ord").alias("r")).select("relationship_id", "r.*")
    return first.join(relationships.select("relationship_id").distinct(), "relationship_id", "left_anti")


def first_of_triples(relationships: DataFrame) -> DataFrame:
    """The first relationship of each (source, type, target), nothing merged."""
    order = W.partitionBy("source_node_id", "relationship_type", "target_node_id").orderBy("rel_ord")
    return relationships.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def repair_targets(nodes: DataFrame, repair: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(moved, redirects): ``repair`` under the ids they merge into, and (old_node_id, node_id) of those that are others.

    That is the node of the same id, else of the same repair identity, else their own, or that of the first repair
    node of the same identity. Only ids and identities of ``repair``, which are few, are looked for among the nodes.
    """
    own = repair.withColumn("identity", repair_identity())
    known = nodes.join(own.select("node_id").distinct(), "node_id", "left_semi").select(F.col("node_id").alias("known_id")).distinct()
    named = nodes.withColumn("identity", repair_identity()).join(own.select("identity").distinct(), "identity", "left_semi").groupBy("identity").agg(F.max_by("node_id", "occ_ord").alias("same_id"))
    seen = own.join(known, F.col("node_id") == F.col("known_id"), "left")
    fresh = seen.where("known_id is null and identity is not null").groupBy("identity").agg(F.min_by("node_id", "occ_ord").alias("first_id"))
    found = seen.join(named, "identity", "left").join(fresh, "identity", "left")
    moved = found.withColumn("old_id", F.col("node_id")).withColumn("node_id", F.coalesce("known_id", "same_id", "first_id", "node_id"))
    redirects = moved.where("old_id <> node_id").groupBy(F.col("old_id").alias("old_node_id")).agg(F.min_by("node_id", "occ_ord").alias("node_id"))
    return moved.select(*repair.columns), redirects


def repaired_nodes(nodes: DataFrame, repair: DataFrame) -> tuple[Merged, DataFrame]:
    """(merged, redirects): repair nodes merged into those of :func:`repair_targets`, or added.

    Both have arrays of evidence. What ``nodes`` have comes first, whatever the ordinals. ``redirects`` is (old_node_id, node_id).
    """
    moved, redirects = repair_targets(nodes, repair)
    items = E.numbered(E.items(nodes, "node_id", "occ_ord"), "node_id", "at")
    return merged_with(without_arrays(nodes), items, moved.select(*nodes.columns), F.col("node_id")), redirects


def merge_repair(nodes: DataFrame, repair: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, redirects): as :func:`repaired_nodes`, for nodes and repair nodes with arrays of evidence. Both have the columns of occurrences."""
    merged, redirects = repaired_nodes(nodes, repair)
    return merged.with_arrays(), redirects


def composed(redirects: DataFrame, later: DataFrame) -> DataFrame:
    """(old_node_id, node_id): redirects followed by later ones. An id that both redirect goes where the first one leads, and on from there."""
    on = later.select(F.col("old_node_id").alias("_via"), F.col("node_id").alias("_to"))
    first = redirects.join(on, F.col("node_id") == F.col("_via"), "left").select("old_node_id", F.coalesce("_to", "node_id").alias("node_id"))
    rest = later.join(redirects.select(F.col("old_node_id").alias("_via")).distinct(), F.col("old_node_id") == F.col("_via"), "left_anti")
    return first.unionByName(rest).where("old_node_id <> node_id")
