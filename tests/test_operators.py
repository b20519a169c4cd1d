"""Small cases with results known by hand, and properties that must hold."""

import json

import pytest
from pyspark.sql import functions as F

from evigraph.functions import props as P
from evigraph.functions import text
from evigraph.operators import evidence as E
from evigraph.operators import merge as M
from evigraph.operators import replies as R
from evigraph.operators import resolve, retrieve
from evigraph.operators import validate as V
from evigraph.sources import chunks as C
from evigraph.sources import ontology as O

OCC = f"occ_ord long, node_id string, node_type string, canonical_key string, source_instance_id string, props {P.SCHEMA}, evidence {E.SCHEMA}"
REL = f"rel_ord long, relationship_id string, relationship_type string, source_node_id string, target_node_id string, props {P.SCHEMA}, evidence {E.SCHEMA}"


def occ(o, node_id, kind="Company", key=None, props=None, evidence=()):
    return (o, node_id, kind, key, node_id, [(i, k, v if isinstance(v, str) and v[:1] in '"[{0123456789tfn' else json.dumps(v)) for i, (k, v) in enumerate((props or {}).items())], [tuple(e) for e in evidence])


def nodes(spark, *rows):
    return spark.createDataFrame(list(rows), OCC)


def rels(spark, *rows):
    return spark.createDataFrame([(i, f"r{i}", t, s, d, [], []) for i, (s, t, d) in enumerate(rows)], REL)


def test_text_functions(spark):
    rows = spark.createDataFrame([("  A b\x1c\n C ", "Acme Holdings Co., Ltd."), (None, None), ("", "ＡＣＭＥ Inc"), ("É-1", "Company")], "a string, b string")
    got = rows.select(text.collapsed(F.col("a")), text.identity(F.col("a")), text.company_identity(F.col("b")), text.compatible_identity(F.col("b"))).collect()
    assert [tuple(r) for r in got] == [("A b C", "a b c", "acme holdings", "acme holdings co"), ("", "", "", ""), ("", "", "", "acme"), ("É-1", "1", "", "")]
    import hashlib

    one = spark.range(1).select(text.minted("rel_", F.lit("a"), F.lit(None).cast("string"), F.lit("ü")), text.camel_words(F.lit("InvestmentFund")), text.occurrences(F.lit("aaaa"), F.lit("aa")), text.word_hits(F.lit("arr arrow arr."), F.lit("arr")), text.page_label(F.lit(1), F.lit(3)), text.page_label(F.lit(2), F.lit(2)), text.page_label(F.lit(None).cast("int"), F.lit(None).cast("int"))).first()
    assert tuple(one) == ("rel_" + hashlib.sha1("a|None|ü".encode()).hexdigest()[:20], "Investment Fund", 2, 2, "1-3", "2", "unknown")


NODES = "1. Customer\nProperties:\n- name\n- segment\nnote\n- ignored\n2. Order\nProperties:\n- id\n1. Customer\nProperties:\n- other\n"
RELATIONS = "Customer -> Order\n- PLACED\n- lower\nCustomer -> Planet\n- SEES\nOrder -> Customer\nGENERAL RELATIONSHIP PROPERTY CONVENTION\n- DESCRIPTION\n"


def test_ontology_dialects():
    assert O.parse_nodes(NODES) == (["Customer", "Order", "Customer"], {"Customer": {"other"}, "Order": {"id"}})
    loose = O.parse_nodes("# Customer\nProperties:\n* name (text)\n\n- segment\n2) Order\nProperties:\n- id\nCustomer\nProperties:\n- late\n", "loose")
    assert loose == (["Customer", "Order"], {"Customer": {"name", "segment"}, "Order": {"id", "late"}})
    assert O.parse_nodes(NODES, "contract")[1]["Customer"] == {"name", "segment", "other"}
    assert O.parse_relationships(RELATIONS, ["Customer", "Order"]) == ([("Customer", "PLACED", "Order")], [("Customer", "Order"), ("Order", "Customer")])
    assert ("Customer", "SEES", "Planet") in O.parse_relationships(RELATIONS, ["Customer"], "contract")[0]
    for f in (lambda: O.parse_nodes("x"), lambda: O.parse_relationships("x", [])):
        with pytest.raises(ValueError):
            f()
    assert O.base_types("FINAL GRAPH SCHEMA — BASE NODES\n1. A\n- **B**\n# Next\n- C\nFinal Graph Schema - other\n- D") == ["A", "B", "C"]
    assert O.base_types("Final graph schema - base nodes\n- A\n- A\nALLOWED RELATIONSHIPS\n- B") == ["A"]
    assert O.allowed_types("1. A\nProperties:\n- name\n- two words\n* **B**") == {"A", "name", "B"} and O.allowed_relationships("A -> B\n- R_1\n* S\n- lower") == {"R_1", "S"}
    with pytest.raises(ValueError):
        O.base_types("FINAL GRAPH SCHEMA - BASE NODES\nnothing")
    assert O.schema_terms("Alpha", "1. Alpha\nfirst words\n2. Beta\nother\n3. Alpha\nlater") == ["alpha", "first", "words"]
    none = O.parse_nodes("Properties:\n- stray\n1. A\n- early\nProperties:\n- a\n- two words\n- b\nend\n- c\n2. B\n")
    assert none == (["A", "B"], {"A": {"a", "b"}, "B": set()})
    assert O.parse_nodes("A\nProperties:\n- x\nB\nProperties:\n- y\nA\n- z", "loose") == (["A", "B"], {"A": {"x"}, "B": {"y", "z"}})
    assert O.parse_relationships("- LOST\nA -> B\n- R\nA -> Z\n- S\nB -> A\nA -> B\n- Q\n", ["A", "B"]) == ([("A", "Q", "B"), ("A", "R", "B")], [("A", "B"), ("B", "A")])
    assert O.schema_terms("RiskFactor", "1. RiskFactor\nProperties:\nexposure_level is a required string\n2. Other\nno") == ["exposure level", "factor", "risk"]
    onto = O.parse("1. A\nProperties:\n- z\n- b\n2. B\n", "A -> B\n- R\nB -> A\n")
    assert onto.render() == "NODE TYPES\nA: b, z\nB: \n\nRELATIONSHIP SIGNATURES\nA -> B: R\nB -> A: "


def test_chunk_files(spark, tmp_path):
    (tmp_path / "b_chunks.json").write_text(json.dumps({"chunks": [{"document_id": "d2", "chunk_id": "c", "text": "x"}], "other": 1}))
    (tmp_path / "a_chunks.json").write_text(json.dumps({"chunks": [{"document_id": "d1", "chunk_id": "c1", "text": "y", "start_page": 1}, {"document_id": "d1", "chunk_id": "c2", "text": "z"}]}))
    (tmp_path / "c_chunks.json").write_text("{}")
    (tmp_path / "ignored.json").write_text('{"chunks": [{"text": "no"}]}')
    got = C.read(spark, str(tmp_path)).orderBy("chunk_ord").collect()
    assert [(r.chunk_ord, r.document_id, r.chunk_id) for r in got] == [(0, "d1", "c1"), (1, "d1", "c2"), (2, "d2", "c")]
    assert C.cut(spark.createDataFrame([(1, "abcde", "s"), (2, "", "s"), (3, None, "s")], "doc_id long, text string, source string"), 2).select("text").collect() == [("ab",), ("cd",), ("e",)]


def test_grounding(spark):
    chunks = spark.createDataFrame([(0, "d", "c1", "Annual  Revenue\nof Acme"), (1, "e", "c1", "nothing here at all")], "chunk_ord long, document_id string, chunk_id string, text string")
    quotes = spark.createDataFrame([("d", "c1", "ANNUAL revenue"), ("d", "c1", "revenue"), ("d", "c1", "revenue "), ("e", "c1", "annual revenue"), ("d", "c1", "of acme and"), ("d", "c1", None), ("zz", "c1", "here  at all")], "document_id string, chunk_id string, quote string")
    assert [r.quote for r in E.in_own_chunk(quotes, chunks).collect()] == ["ANNUAL revenue"]
    assert sorted(r.quote for r in E.in_any_chunk(quotes, chunks).collect()) == ["ANNUAL revenue", "annual revenue", "here  at all"]
    assert E.in_any_chunk(quotes.limit(0), chunks).count() == 0
    named = sorted(r.quote for r in E.in_any_chunk(quotes, chunks).collect())
    assert sorted(r.quote for r in E.in_any_chunk(quotes.select("quote"), chunks).collect()) == named


def test_phrases_are_found_wherever_they_stand(spark):
    import random

    from evigraph.operators.contains import containing

    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 12)))
    texts = [" ".join(word() for _ in range(rng.randrange(1, 12))) for _ in range(150)] + ["", "abcd"]
    phrases = {t[a : a + n] for t in texts if t for a, n in ((rng.randrange(len(t)), rng.randrange(2, 30)) for _ in range(6))}
    phrases = {p.strip() for p in phrases} | {"zzzz", "ab cd", "a b c", "abcdabcd"} | {t[:12] for t in texts}
    got = {(r.phrase, r.text_id) for r in containing(spark.createDataFrame([(p,) for p in [*phrases, None, *phrases]], "phrase string"), spark.createDataFrame(list(enumerate(texts)), "text_id long, body string")).collect()}
    assert got == {(p, i) for p in phrases if len(p) >= 4 for i, t in enumerate(texts) if p in t} and len(got) > 300
    assert containing(spark.createDataFrame([], "phrase string"), spark.createDataFrame([(1, "x")], "text_id long, body string")).count() == 0


def test_places_in_an_order_without_one_task(spark):
    from evigraph.functions import ranks

    rows = [(g, i * 7 % 1000, i) for g in ("a", None, "b") for i in range({"a": 900, None: 50, "b": 1}[g])]
    got = ranks.numbered(spark.createDataFrame(rows, "g string, o long, _at long"), ["g"], ["o", "_at"], "place").collect()
    want = {(g, o, i): n for g in ("a", None, "b") for n, (_, o, i) in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2])))}
    assert {(r.g, r.o, r._at): r.place for r in got} == want


def test_merge_keeps_the_first_non_empty_value_in_order(spark):
    e = ("d", "s", None, "c", "quote")
    got, aliases = M.merge_nodes(nodes(spark, occ(2, "n2", key="ACME", props={"b": '"x"', "a": '"2"', "z": "0", "gone": '""'}, evidence=[e, ("d", "s", "1", "c", "quote")]), occ(1, "n1", key="acme!", props={"a": '"1"', "b": "[]", "z": "null"}, evidence=[e, e])))
    row = got.first()
    assert row.node_id == "n1" and [(p.pos, p.key, p.value_json) for p in row.props] == [(0, "a", '"1"'), (1, "b", '"x"'), (2, "z", "0"), (3, "gone", '""')]
    assert [x.page for x in row.evidence] == [None, "1"]
    assert {(a.old_node_id, a.node_id) for a in aliases.collect()} == {("n1", "n1"), ("n2", "n1")}
    again, _ = M.merge_nodes(got.select(*[c.split(" ")[0] for c in ("occ_ord", "node_id", "node_type", "canonical_key", "source_instance_id", "props", "evidence")]))
    assert again.first().asDict(True) == row.asDict(True)


def test_merge_keys(spark):
    n = nodes(spark, occ(1, "a"), occ(2, "b"), occ(3, "c", key="日本"), occ(4, "d", key="東京"), occ(5, "e", key="Ｔokyo"), occ(6, "f", "Person", key="日本"), occ(7, "g", key=" - "))
    assert M.merge_nodes(n)[0].count() == 7
    strong = nodes(spark, occ(1, "a", props={"company_id": '"X 1"', "name": '"A"'}), occ(2, "b", props={"name": '"B"', "registry_code": '"x-1 Ltd"'}), occ(3, "c", props={"name": '"Acme Inc"'}), occ(4, "d", props={"title": '"ACME"'}), occ(5, "e", props={"name": '""'}))
    assert {tuple(r) for r in M.merge_nodes(strong, "strong_or_name")[1].collect()} == {("a", "a"), ("b", "a"), ("c", "c"), ("d", "c"), ("e", "e")}
    v1 = nodes(spark, occ(1, "a", props={"name": '"Acme, Inc."'}), occ(2, "b", props={"legal_name": '"ACME"'}), occ(3, "c", props={"name": '"株式会社"'}), occ(4, "d", props={"name": '"会社"'}), occ(5, "m", M.METRIC_TYPE, props={"metric_name": '"ARR"', "period": '"2020"', "value": "1"}), occ(6, "o", M.METRIC_TYPE, props={"name": '"arr"', "fiscal_year": '"2020"', "value": "1"}), occ(7, "p", M.METRIC_TYPE, props={"name": '"arr"', "fiscal_year": '"2021"', "value": "1"}))
    assert {tuple(r) for r in M.merge_nodes(v1, "name_or_metric")[1].collect()} == {("a", "a"), ("b", "a"), ("c", "c"), ("d", "d"), ("m", "m"), ("o", "m"), ("p", "p")}
    lists = nodes(spark, occ(1, "a", key="k", props={"tags": '["x","y"]'}), occ(2, "b", key="k", props={"tags": '["y","z"]'}))
    assert M.merge_nodes(lists, union_lists=True)[0].first().props[0].value_json == '["x","y","z"]'


def test_remap_keeps_edges_with_one_merged_end(spark):
    aliases = spark.createDataFrame([("b", "a")], "old_node_id string, node_id string")
    r = rels(spark, ("b", "T", "c"), ("a", "T", "c"), ("x", "T", "y"))
    assert {(x.source_node_id, x.target_node_id) for x in M.remap(r, aliases).collect()} == {("a", "c"), ("x", "y")}
    assert M.remap(r, aliases, drop_unknown=True).count() == 0
    assert M.first_of_triples(rels(spark, ("a", "T", "b"), ("a", "T", "b"))).count() == 1


def test_repair_redirects(spark):
    kept = nodes(spark, occ(1, "a", props={"name": '"Acme"'}), occ(2, "b", props={}))
    fix = nodes(spark, occ(10, "z", props={"name": '"ACME "', "extra": "1"}), occ(11, "b", props={"name": '"Other"'}), occ(12, "y", "Person", props={"name": '"Acme"'}))
    merged, redirects = M.merge_repair(kept, fix)
    assert [tuple(r) for r in redirects.collect()] == [("z", "a")]
    assert {r.node_id: {p.key for p in r.props} for r in merged.collect()} == {"a": {"name", "extra"}, "b": {"name"}, "y": {"name"}}


def test_repaired_relationships_and_merge_by_id(spark):
    n = nodes(spark, occ(1, "a"), occ(2, "b"))
    old = rels(spark, ("a", "T", "b"))
    fix = spark.createDataFrame([(10, "r0", "T", "z", "b", [], []), (11, "n1", "T", "z", "b", [], []), (12, "n1", "U", "b", "a", [], []), (13, "n2", "T", "ghost", "b", [], []), (14, "", "T", "a", "b", [], [])], REL)
    out = M.merge_repaired_relationships(old, fix, n, spark.createDataFrame([("z", "a")], "old_node_id string, node_id string"))
    assert sorted((r.relationship_id, r.relationship_type, r.source_node_id) for r in out.collect()) == [("n1", "T", "a"), ("r0", "T", "a")]
    same = spark.createDataFrame([(2, "x", "U", "c", "d", [(0, "k", '"2"'), (1, "m", "1")], []), (1, "x", "T", "a", "b", [(0, "k", '""')], [])], REL)
    one = M.merge_relationships_by_id(same).first()
    assert (one.relationship_type, one.source_node_id, [(p.key, p.value_json) for p in one.props]) == ("T", "a", [("k", '"2"'), ("m", "1")])


def test_best_scored_chunks_first_then_quoted_ones(spark):
    scored = spark.createDataFrame([("g", i, 10 - i, 5) for i in range(5)], "g string, chunk_ord long, score long, size long")
    direct = spark.createDataFrame([("g", 4), ("g", 9)], "g string, chunk_ord long")
    assert [r.chunk_ord for r in retrieve.top_of_best(direct, scored, "g", 3).orderBy("rank").collect()] == [4, 9, 0]


def test_reviews_chains_cycles_and_rejections(spark):
    n = nodes(spark, *[occ(i, x) for i, x in enumerate("abcdxyzt")], occ(50, "p", "Person"))
    r = spark.createDataFrame([(1, "a", "b"), (2, "b", "c"), (3, "c", "d"), (4, "x", "y"), (5, "y", "z"), (6, "z", "x"), (7, "t", "x"), (8, "p", "a"), (9, "d", "d"), (10, "q", "a"), (11, "a", "nope"), (12, "a", "c")], "review_ord long, node_id string, duplicate_of string")
    judged = resolve.judge(r, n)
    assert {x.review_ord: x.verdict for x in judged.collect() if x.verdict != "accepted"} == {8: "type mismatch", 9: "self", 10: "unknown node", 11: "unknown duplicate", 12: "repeated"}
    assert {tuple(x) for x in resolve.roots(judged).collect()} == {("a", "d"), ("b", "d"), ("c", "d"), ("y", "x"), ("z", "x"), ("t", "x")}
    assert resolve.roots(judged.limit(0)).count() == 0


def test_validation(spark):
    types = spark.createDataFrame([("A",), ("B",), ("C",)], "node_type string")
    allowed = spark.createDataFrame([("A", "name")], "node_type string, property string")
    sigs = spark.createDataFrame([("A", "R", "B")], "source_type string, relationship_type string, target_type string")
    e = [("d", "s", None, "c", "q")]
    n = nodes(spark, occ(1, "a", "A", props={"name": '"x"', "bad": "1"}, evidence=e), occ(2, "b", "B", evidence=e), occ(3, "b", "B", evidence=e), occ(4, "u", "Z", evidence=e), occ(5, "lone", "B"))
    r = rels(spark, ("a", "R", "b"), ("a", "R", "b"), ("b", "R", "a"), ("a", "R", "ghost"), ("a", "R", "a"))
    assert {x.node_id: x.degree for x in V.degrees(r, n).collect()} == {"a": 6, "b": 3, "u": 0, "lone": 0}
    got = sorted((x.kind, x.subject) for x in V.errors(n, r, types, allowed, sigs).collect())
    assert got == sorted([("duplicate node", "b"), ("unknown type", "u"), ("unsupported properties", "a:bad"), ("node without evidence", "lone"), ("orphan relationship", "r3"), ("invalid relationship", "B|R|A"), ("invalid relationship", "A|R|A"), ("duplicate relationship", "a|R|b"), ("relationship without evidence", "r0"), ("relationship without evidence", "r1")])
    assert {x.node_type: (x.n, x.found) for x in V.coverage(n, types).collect()} == {"A": (1, True), "B": (3, True), "C": (0, False)}
    s = V.summary(n, r, types, allowed, sigs).first()
    assert (s.node_count, s.relationship_count, s.missing_type_count, s.error_count, s.valid) == (5, 5, 1, 10, False)


def test_retrieval_ties_and_budget(spark):
    chunks = spark.createDataFrame([(0, "d", "c0", "acme acme longer text"), (1, "d", "c1", "acme text"), (2, "d", "c2", "Acme rext"), (3, "d", "c3", "other"), (4, "e", "c0", "none")], "chunk_ord long, document_id string, chunk_id string, text string").withColumn("start_page", F.lit(None).cast("int")).withColumn("end_page", F.lit(1))
    n = nodes(spark, occ(1, "a", props={"name": '"ACME"', "x": '"abc"', "n": "12345"}, evidence=[("d", "s", None, "c3", "other"), ("e", "s", None, "c9", "none")])).withColumn("g", F.lit("g"))
    top = retrieve.top(retrieve.direct(n, chunks, "g"), retrieve.scored(retrieve.node_terms(n, "g"), chunks, "g"), "g", 3)
    assert [r.chunk_ord for r in top.orderBy("rank").collect()] == [3, 1, 2]
    blocks = retrieve.within_budget(top, chunks, "g", 10_000)
    assert blocks.orderBy("rank").first().block == "\n--- d / c3 / pages None-1 ---\nother\n"
    sizes = [len(r.block) for r in blocks.orderBy("rank").collect()]
    assert retrieve.within_budget(top, chunks, "g", sum(sizes) - 1).count() == 2
    none = retrieve.context(retrieve.within_budget(top, chunks, "g", 5), top, "g").first()
    assert (none.context, none.warning) == ("", "no chunk fits")
    b = retrieve.batches(spark.range(0, 10000, 3).select(F.col("id").alias("occ_ord"), F.lit("T").alias("node_type")), 16)
    assert b.groupBy("batch").count().where("count = 16").count() == 3334 // 16 and b.agg(F.max("batch")).first()[0] == 3333 // 16


def test_replies_are_read_where_they_can_be(spark):
    cases = {'{"a": 1}': '{"a": 1}', '```json\n{"a": 1}\n```': '{"a": 1}', 'Sure! {"a": {"b": 2}} done': '{"a": {"b": 2}}', "[1, 2]": None, "": None, None: None, "{} and {}": None, "no": None}
    rows = spark.createDataFrame([(k,) for k in cases], "raw string")
    assert {r.raw: r.got for r in rows.select("raw", R.json_object(F.col("raw")).alias("got")).collect()} == cases
    item = F.lit('{"nodes": [{"properties": {"b": 1.50, "a": "x", "l": [1], "n": null, "f": false}, "evidence": [{"quote": "q"}, 7, {"page": 3}]}, 5]}')
    got = spark.range(1).select(F.explode(R.items(item, "nodes")).alias("i")).select(R.properties(F.col("i")).alias("p"), R.evidence(F.col("i")).alias("e")).collect()
    assert [(p.key, p.value_json) for p in got[0].p] == [("b", "1.5"), ("a", '"x"'), ("l", "[1]"), ("n", "null"), ("f", "false")] and got[1].p == []
    assert [e.quote for e in got[0].e if e.quote] == ["q"]


def test_every_signature_has_all_pairs_of_its_batches(spark):
    import os

    from evigraph.plans import queries, star

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test data")
    count = {r.node_type: -(-r["count"] // 16) for r in M.merge_nodes(star.nodes(spark, sf))[0].groupBy("node_type").count().collect()}
    got = {(r.source_type, r.target_type): r["count"] for r in queries.QUERIES["signature_batches"](spark, sf).groupBy("source_type", "target_type").count().collect()}
    want = {(s, t): count.get(s, 0) * count.get(t, 0) or 1 for s, _, t in star.ONTOLOGY.signatures}
    assert got == want and any("Order" in pair for pair in got)
