"""What work in slices and in windows gives, against the same work in one piece; and what it leaves on disk."""

import os
import random

import pytest
from pyspark.sql import functions as F
from test_operators import nodes, occ, rels

from evigraph.functions import ranks, store
from evigraph.operators import evidence as E
from evigraph.operators import merge as M
from evigraph.operators import retrieve
from evigraph.operators import validate as V

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture
def slices(monkeypatch):
    monkeypatch.setattr(store, "SLICE_ROWS", 3)


def graph(spark, seed=1, n=9, m=60):
    """Nodes of which some share a key, and relationships between them and ids that are no nodes."""
    r = random.Random(seed)
    found = nodes(spark, *(occ(i, f"n{i}", r.choice(("Company", "City")), key=f"k{r.randrange(5)}") for i in range(n)))
    links = rels(spark, *((f"n{r.randrange(n + 2)}", r.choice(("BASED_IN", "EATS")), f"n{r.randrange(n + 2)}") for _ in range(m)))
    none, text = F.lit(None).cast("string"), lambda c: F.col(c).alias("quote")
    quote = F.struct(F.lit("d").alias("document_id"), F.lit("s").alias("source_file"), none.alias("page"), F.col("source_node_id").alias("chunk_id"), text("target_node_id"))
    return found, links.withColumn("evidence", F.array(quote).cast(E.SCHEMA))


def test_stored_tables_leave_no_shuffle_files(spark):
    def shuffles():
        return {f for d, _, names in os.walk(spark.conf.get("spark.local.dir")) for f in names if f.startswith("shuffle_")}

    before = shuffles()
    store.stored(spark.range(50_000).groupBy((F.col("id") % 999).alias("k")).count())
    assert shuffles() <= before


def test_relationship_evidence_by_slices(spark, slices):
    n, r = graph(spark)
    aliases = M.merged_nodes(n).aliases
    whole = M.merged_relationships(M.redirected(r, aliases)).evidence()
    assert rows(M.relationship_evidence(r, aliases)) == rows(whole) and whole.count() > 0


@pytest.mark.parametrize("many", [1_000_000, 40])
def test_places_in_large_and_small_groups(spark, monkeypatch, many):
    monkeypatch.setattr(ranks, "MANY", many)
    monkeypatch.setattr(ranks, "ONE_IN", 1)
    given = [(g, i * 7919 % 1009) for g, n in (("a", 300), ("b", 3), (None, 100), ("c", 1)) for i in range(n)]
    got = ranks.numbered(spark.createDataFrame(given, "g string, v long"), ["g"], ["v"], "at").collect()
    want = {(g, v): at for g in "abc" + "\0" for at, v in enumerate(sorted(v for h, v in given if (h or "\0") == g))}
    assert {(x.g or "\0", x.v): x.at for x in got} == want and len(got) == len(given)
    assert [x.at for x in ranks.numbered(spark.range(50), [], ["id"], "at").orderBy("id").collect()] == list(range(50))


def test_pairs_of_batches_are_made_where_they_are_written(spark, monkeypatch):
    monkeypatch.setattr(retrieve, "PAIRS_EACH", 10)
    batched = spark.createDataFrame([("A", i) for i in range(20)] + [("B", i) for i in range(5)] + [("A", 0)], "node_type string, batch long")
    sig = spark.createDataFrame([("A", "R", "B"), ("A", "S", "B"), ("A", "R", "C"), ("B", "R", "B"), ("C", "R", "C")], "source_type string, relationship_type string, target_type string")
    out = retrieve.signature_batches(batched, sig)
    want = [("A", "B", a, b, "reviewed") for a in range(20) for b in range(5)] + [("B", "B", a, b, "reviewed") for a in range(5) for b in range(5)] + [("A", "C", None, None, "not_applicable"), ("C", "C", None, None, "not_applicable")]
    assert rows(out) == sorted(repr(x) for x in spark.createDataFrame(want, out.schema).collect())
    assert out.where("status = 'reviewed'").rdd.getNumPartitions() >= 125 // 10


def test_typed_triples_are_merged_relationships_with_types(spark, slices):
    n, r = graph(spark)
    merged = M.merged_nodes(n)
    heads = M.merged_relationships(M.redirected(r, merged.aliases)).heads
    want = V.ends(heads, merged.heads).drop("merge_key")
    got = M.typed_triples(r, M.typed_aliases(merged.aliases, merged.heads))
    assert rows(got.select(*want.columns)) == rows(want) and got.where("source_type is null").count() and got.where("source_type is not null").count()
    assert V.ends(got, None) is got  # types cost no further joins
    one = {x.node_id: sorted(x["keys"]) for x in merged.with_keys().collect()}
    assert one == {x.node_id: sorted(p.key for p in x.props) for x in merged.table.collect()}


def test_final_filter_by_slices(spark, slices):
    from evigraph.plans import queries, star

    got = queries.QUERIES["final_filter_reasons"](spark, SF)
    whole = V.final_filter(star.relationships(spark, SF), star.nodes(spark, SF), star.ONTOLOGY.signatures_df(spark)).select("rel_ord", "verdict")
    assert rows(got) == rows(whole)
    assert len({f for f in got.inputFiles()}) >= store.MOST_SLICES


def test_an_ontology_is_small_for_spark(spark, capsys):
    from evigraph.plans import star

    n, r = graph(spark)
    V.violations(M.typed_triples(r, M.typed_aliases(M.merged_nodes(n).aliases, n)), n, star.ONTOLOGY.signatures_df(spark)).explain()
    assert "BroadcastHashJoin" in capsys.readouterr().out


def test_evidence_of_a_group_that_is_a_field(spark):
    items = spark.createDataFrame([("s", i, "d", q) for i, q in enumerate("abca")], "source_file string, at long, document_id string, quote string").selectExpr("*", "cast(null as string) page", "cast(null as string) chunk_id")
    assert [(x.place, x.quote) for x in E.numbered(items, "source_file", "at").select("place", "quote").orderBy("place").collect()] == [(0, "a"), (1, "b"), (2, "c")]


@pytest.mark.parametrize("sieve", [1 << 19, 2])
def test_phrases_in_one_text_or_in_all(spark, monkeypatch, sieve):
    from evigraph.operators import contains

    monkeypatch.setattr(contains, "SIEVE", sieve)
    r = random.Random(4)
    texts = [" ".join(r.choice(("the", "thesis", "aa", "a", "other", "bother", "x1", "longerword")) for _ in range(r.randrange(1, 12))) for _ in range(40)]
    cut = [(t, a, r.randrange(4, 25)) for t in texts for a in (r.randrange(len(t)), 0)]
    phrases = sorted({t[a : a + n] for t, a, n in cut if len(t[a : a + n].strip()) >= 4} | {"the other bothers", "aa zz aa", "zzzz", "esis a the"})
    want = {(p, i) for p in phrases for i, t in enumerate(texts) if p in t}
    rows = spark.createDataFrame([(p,) for p in phrases], "phrase string"), spark.createDataFrame(list(enumerate(texts)), "text_id long, body string")
    assert {(x.phrase, x.text_id) for x in contains.containing(*rows).collect()} == want
    some = [(x.phrase, x.text_id) for x in contains.containing(*rows, one=True).collect()]
    assert set(some) <= want and {p for p, _ in some} == {p for p, _ in want} and len(some) < len(want)
