"""Orders, evidence, repair and retrieval as tables, against small brute-force forms."""

import json
import random
import re
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from test_operators import OCC, REL, nodes, occ, rels

from evigraph.functions import ordinals
from evigraph.operators import evidence as E
from evigraph.operators import merge as M
from evigraph.operators import normalize as N
from evigraph.operators import replies as R
from evigraph.operators import retrieve
from evigraph.operators import validate as V
from evigraph.plans import assemble as A
from evigraph.plans import repair as rounds_of
from evigraph.plans.graph import Graph
from evigraph.sources import chunks as C
from evigraph.sources import ontology as O

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import tests

ONTO = O.parse("1. Company\nProperties:\n- name\n2. City\nProperties:\n- name\n3. Law\nProperties:\n- name\n4. Fine\nProperties:\n- name\n", "Company -> City\n- BASED_IN\nLaw -> Company\n- BINDS\nLaw -> Fine\n- SETS\n")


def test_ordinals_of_very_large_ids(spark):
    big = 10**9
    docs = spark.createDataFrame([(i, "Acme text here", "s") for i in (1, big, 93 * 10**9, 2**62)], "doc_id long, text string, source string")
    chunks = C.cut(docs)
    raw = json.dumps({"nodes": [{"node_id": f"n{i}", "node_type": "Company", "canonical_key": "acme", "properties": {"name": "x"}, "evidence": [{"quote": "Acme text"}]} for i in range(3)]})
    replies = chunks.select(F.explode(F.array(F.lit("recall"), F.lit("primary"))).alias("pass"), "chunk_ord", F.lit(raw).alias("raw"))
    found = N.nodes(replies, chunks, ONTO.types_df(spark), ONTO.properties_df(spark))
    ordered = [(r.occ_ord.chunk.document, r["pass"], r.llm_node_id) for r in found.orderBy("occ_ord").collect()]
    assert ordered == [(d, p, f"n{i}") for d in (1, big, 93 * 10**9, 2**62) for p in ("primary", "recall") for i in range(3)]
    first = M.merged_nodes(found.drop("pass", "chunk_ord")).table.collect()
    assert len(first) == 1 and first[0].llm_node_id == "n0" and first[0].occ_ord.chunk.document == 1
    late = N.nodes(replies, chunks, ONTO.types_df(spark), ONTO.properties_df(spark), stage=ordinals.repair(1))
    assert late.agg(F.min("occ_ord").alias("o")).first().o > found.agg(F.max("occ_ord").alias("o")).first().o
    with pytest.raises(TypeError):
        ordinals.later(spark.range(1).schema["id"].dataType, 1, F.lit(1))


def test_a_duplicate_never_gives_its_root_its_fields(spark):
    from evigraph.plans import passes

    n = nodes(spark, occ(1, "a", key="dup", props={"x": "1"}, evidence=[("d", "s", None, "c", "dup")]), occ(2 * 10**16, "r", key="root", props={"x": "2"}, evidence=[("d", "s", None, "c", "root"), ("d", "s", None, "c", "dup")]))
    items = E.numbered(E.items(n, "node_id", "occ_ord"), "node_id", "at")
    found = spark.createDataFrame([(1, "a", "r")], "review_ord long, node_id string, duplicate_of string")
    merged, aliases, _ = passes.apply_reviews(M.without_arrays(n), found, items)
    row = merged.with_arrays().first()
    assert (row.node_id, row.canonical_key, row.occ_ord, row.props[0].value_json) == ("r", "root", 2 * 10**16, "2")
    assert [e.quote for e in row.evidence] == ["root", "dup"] and [tuple(r) for r in aliases.collect()] == [("a", "r")]


def test_a_node_of_a_million_items(spark):
    n = 1_000_000
    quote = F.concat(F.lit("q"), (F.col("id") % (n - 5)).cast("string"))
    item = F.struct(F.lit("d").alias("document_id"), F.lit(None).cast("string").alias("source_file"), F.lit(None).cast("string").alias("page"), F.lit("c").alias("chunk_id"), quote.alias("quote"))
    many = spark.range(n).select(F.col("id").alias("occ_ord"), F.concat(F.lit("n"), "id").alias("node_id"), F.lit("Company").alias("node_type"), F.lit("hot").alias("canonical_key"), F.lit(None).cast("string").alias("source_instance_id"), F.array().cast("array<struct<pos: int, key: string, value_json: string>>").alias("props"), F.array(item).cast(E.SCHEMA).alias("evidence"))
    merged = M.merged_nodes(many)
    got = merged.evidence()
    row = got.agg(F.count("*").alias("n"), F.min("place").alias("least"), F.max("place").alias("most"), F.count_distinct("place").alias("places"), F.sum(F.when(F.col("quote") == F.concat(F.lit("q"), F.col("place").cast("string")), 1).otherwise(0)).alias("right"), F.min("node_id").alias("id")).first()
    assert tuple(row) == (n - 5, 0, n - 6, n - 5, n - 5, "n0")
    assert merged.table.first().has_evidence and merged.aliases.count() == n
    with pytest.raises(Exception, match="over 10 evidence items"):
        E.listed(got, "node_id", 10).collect()


def test_redirects_are_composed(spark):
    pairs = lambda *p: spark.createDataFrame(list(p), "old_node_id string, node_id string")
    got = M.composed(pairs(("z", "y"), ("w", "v")), pairs(("y", "x"), ("u", "t"), ("w", "lost")))
    assert {tuple(r) for r in got.collect()} == {("z", "x"), ("w", "v"), ("y", "x"), ("u", "t")}


def test_final_filter_says_why(spark):
    n = nodes(spark, occ(1, "a", "Company"), occ(2, "c", "City"))
    sig = ONTO.signatures_df(spark)
    r = rels(spark, ("a", "BASED_IN", "c"), ("a", "BASED_IN", "c"), ("x", "BASED_IN", "c"), ("a", "BASED_IN", "y"), ("x", "T", "y"), ("c", "BASED_IN", "a"), ("a", "EATS", "c"), ("a", "EATS", "c"))
    got = [x.verdict for x in V.final_filter(r, n, sig).orderBy("rel_ord").collect()]
    assert got == ["kept", "repeated", "source missing", "target missing", "both missing"] + ["signature not allowed"] * 3


CHUNK = "chunk_ord struct<document: long, piece: int>, document_id string, chunk_id string, source_file string, start_page int, end_page int, text string"
TEXTS = ["Acme Widgets of Springfield grew. Rule Seven binds it.", "The rule sets a fine of nine."]


def graph_of(spark):
    place = lambda o: ordinals.item(0, ordinals.chunk(F.lit(0), F.lit(0)), F.lit("primary"), F.col(o)).alias(o)
    n = nodes(spark, occ(1, "co", "Company", props={"name": "Acme Widgets"}, evidence=[("d", "f", "1", "c0", "Acme Widgets")]), occ(2, "ci", "City", props={"name": "Springfield"})).withColumn("occ_ord", place("occ_ord"))
    r = rels(spark, ("co", "BASED_IN", "ci")).withColumn("rel_ord", place("rel_ord"))
    parts = [E.numbered(E.items(x, k, o), k, "at") for x, k, o in ((n, "node_id", "occ_ord"), (r, "relationship_id", "rel_ord"))]
    return Graph(M.without_arrays(n), M.without_arrays(r), *parts)


def said(prompt):
    """Round 1 knows the law, calls the company by another id, and repeats itself; round 2 knows the fine."""
    q = lambda chunk, text: [{"document_id": "d", "chunk_id": chunk, "quote": text}]
    link = lambda i, kind, s, t, quote=q("c0", "rule seven binds"): {"relationship_id": i, "relationship_type": kind, "source_node_id": s, "target_node_id": t, "evidence": quote}
    node = lambda i, kind, name, quote: {"node_id": i, "node_type": kind, "properties": {"name": name, "odd": 1}, "evidence": quote}
    if "TYPE Law" in prompt:
        assert "co | Company" in prompt  # it quotes the chunk shown
        return {"nodes": [node("law", "Law", "Rule Seven", q("c0", "Rule Seven binds")), node("law2", "Law", "rule seven", q("c0", "rule seven")), node("acme", "Company", "ACME widgets", q("c0", "acme widgets")), node("liar", "Law", "Lie", q("c0", "not in there"))],
                "relationships": [link("l1", "BINDS", "law2", "acme"), link("l2", "BINDS", "law", "ghost"), link("l3", "EATS", "law", "co"), link("r0", "BINDS", "law", "co"), link("l4", "BINDS", "law", "co", q("c0", "no such words"))]}
    if "TYPE Fine" in prompt and "law | Law" in prompt:
        return {"nodes": [node("fine", "Fine", "Nine", q("c1", "a fine of nine"))], "relationships": [link("s1", "SETS", "law2", "fine", q("c1", "sets a fine")), link("", "BINDS", "law", "co", q("c0", "binds it."))]}
    return {"nodes": [], "relationships": []}


@pytest.mark.parametrize("mode", ["stable", "resolved"])
def test_repair_rounds_take_in_nodes_and_relationships(spark, tmp_path, mode):
    chunks = spark.createDataFrame([((1, i), "d", f"c{i}", "f", i, i, t) for i, t in enumerate(TEXTS)], CHUNK)
    text = "3. Law\nrule seven\nProperties:\n- name\n4. Fine\nrule fine\nProperties:\n- name\n"
    extractor = R.CallingExtractor(lambda system, prompt, most: json.dumps(said(prompt)), 1)
    done = rounds_of.run(spark, graph_of(spark), chunks, ONTO, text, extractor, str(tmp_path), rounds_of.RepairOptions(mode))
    names, links = done.graph.with_arrays()
    got = {r.node_id: (r.node_type, [p.key for p in r.props], len(r.evidence)) for r in names.collect()}
    edges = {r.relationship_id: (r.source_node_id, r.relationship_type, r.target_node_id, len(r.evidence)) for r in links.collect()}
    assert done.history == [(1, 2, 1), (2, 1, 0)]
    log = {(r.round, r.node_type): (r.status, r.n_nodes) for r in done.log.collect()}
    assert log == {(1, "Law"): ("evidence found", 2), (1, "Fine"): ("no supported evidence", 0), (2, "Fine"): ("evidence found", 1)}
    moved = {tuple(r) for r in done.redirects.collect()}
    law = ("Law", ["name"], 2)
    if mode == "stable":
        assert got == {"co": ("Company", ["name"], 2), "ci": ("City", ["name"], 0), "law": law, "fine": ("Fine", ["name"], 1)}
        assert moved == {("acme", "co"), ("law2", "law")}
        assert edges == {"r0": ("co", "BASED_IN", "ci", 0), "l1": ("law", "BINDS", "co", 1), "s1": ("law", "SETS", "fine", 1)}
    else:  # the company named by the way is not of the type asked for
        assert got == {"co": ("Company", ["name"], 1), "ci": ("City", ["name"], 0), "law": law, "fine": ("Fine", ["name"], 1)}
        assert moved == {("law2", "law")}
        assert set(edges.values()) == {("co", "BASED_IN", "ci", 0), ("law", "BINDS", "co", 2), ("law", "SETS", "fine", 1)}
    out = A.finish(done.graph, ONTO, A._written(spark, str(tmp_path / "end")))
    assert out.audit["validation_summary"].first().missing_type_count == 0 and out.relationships.count() == 3
    again = rounds_of.run(spark, graph_of(spark), chunks, ONTO, text, R.RecordedExtractor(spark.createDataFrame([], "request_key string, raw string")), str(tmp_path), rounds_of.RepairOptions(mode))
    assert again.history == done.history  # all replies were there


def test_chunks_of_pairs_equal_those_of_both_together(spark):
    rng = random.Random(4)
    chunk = [f"{' '.join(rng.choice(['alpha one', 'beta two', 'gamma three', 'delta four', 'none']) for _ in range(rng.randrange(1, 6)))} {i}" for i in range(40)]
    chunks = spark.createDataFrame([(i, "d", f"c{i}", t) for i, t in enumerate(chunk)], "chunk_ord long, document_id string, chunk_id string, text string")
    members = [("A|0", "alpha one", 3), ("A|1", "beta two", 9), ("A|1", "gamma three", 2), ("B|0", "delta four", 3), ("B|0", "beta two", 11), ("B|1", "nowhere", 99)]
    n = spark.createDataFrame([(u, i, [(0, "name", json.dumps(t))], [("d", None, None, f"c{q}", "q")]) for i, (u, t, q) in enumerate(members)], "unit string, occ_ord long, props array<struct<pos: int, key: string, value_json: string>>, evidence " + E.SCHEMA)
    pairs = spark.createDataFrame([(f"{s}|{t}", s, t) for s in ("A|0", "A|1", "B|1") for t in ("B|0", "B|1", "A|1")], "grp string, source_unit string, target_unit string")
    for most in (1, 3, 12):
        got = retrieve.pair_top(pairs, retrieve.direct(n, chunks, "unit"), retrieve.scored(retrieve.node_terms(n, "unit"), chunks, "unit"), most)
        both = pairs.select("grp", F.explode(F.array_distinct(F.array("source_unit", "target_unit"))).alias("unit")).join(n, "unit").drop("unit")
        want = retrieve.top(retrieve.direct(both, chunks, "grp"), retrieve.scored(retrieve.node_terms(both, "grp"), chunks, "grp"), "grp", most)
        assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()} and want.count()


WORDS = ["risk", "risks", "risk factor", "Factor", "a_b", "c++", "++", "é", "être", "naïve", "x.y", "y", "aa", "a", "the end of", "日本", "", "\\E", "5"]


def test_terms_are_counted_as_words_and_as_strings(spark):
    rng = random.Random(7)
    bits = [*WORDS, "riskfactor", "aaaa", " ", ", ", ".", "(", "_", "RISK", "zz", "ÊTRE"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(0, 60))) for _ in range(60)] + ["risk " * 40, None, ""]
    chunks = spark.createDataFrame(list(enumerate(texts)), "chunk_ord long, text string")
    terms = spark.createDataFrame([("g", w.lower()) for w in WORDS], "g string, term string")
    low = {i: (t or "").lower() for i, t in enumerate(texts)}
    words = {(w.lower(), i): min(10, len(re.findall(rf"\b{re.escape(w.lower())}\b", t))) for w in WORDS if w for i, t in low.items()}
    assert {(r.term, r.chunk_ord): r.n for r in retrieve.word_counts(terms, chunks).collect()} == {k: n for k, n in words.items() if n}
    strings = {(w.lower(), i): t.count(w.lower()) for w in WORDS if w for i, t in low.items()}
    assert {(r.term, r.chunk_ord): r.n for r in retrieve.substring_counts(terms, chunks).collect()} == {k: n for k, n in strings.items() if n}
    assert retrieve.by_words(terms.limit(0), chunks, "g").count() == 0 and retrieve.by_substrings(terms.limit(0), chunks, "g").count() == 0


def test_a_hundred_thousand_terms(spark, monkeypatch):
    terms = spark.range(100_000).select(F.concat(F.lit("g"), F.col("id") % 7).alias("g"), F.concat(F.lit("term"), F.col("id")).alias("term"))
    chunks = spark.createDataFrame([(0, "term5 term5 term99999 term100000"), (1, "xterm12 term12"), (2, "nothing")], "chunk_ord long, text string")
    assert {(r.g, r.chunk_ord, r.score) for r in retrieve.by_words(terms, chunks, "g").where("score > 0").collect()} == {("g5", 0, 3 if 99999 % 7 == 5 else 2), (f"g{12 % 7}", 1, 1)} | ({(f"g{99999 % 7}", 0, 1)} if 99999 % 7 != 5 else set())
    monkeypatch.setattr(retrieve, "BLOCK_CHARS", 300_000)  # several blocks
    got = {(r.term, r.chunk_ord): r.n for r in retrieve.substring_counts(terms, chunks).collect()}
    want = {(f"term{i}", c): t.count(f"term{i}") for c, t in enumerate(["term5 term5 term99999 term100000", "xterm12 term12", "nothing"]) for i in (0, 1, 5, 9, 10, 12, 99, 100, 999, 1000, 9999, 10000, 99999, 2, 3)}
    assert got == {k: n for k, n in want.items() if n}


def test_phrases_of_common_words_are_dealt_over_parts(spark, monkeypatch):
    from evigraph.operators import contains

    monkeypatch.setattr(contains, "DEALT", 10)
    texts = spark.range(300).select(F.col("id").alias("text_id"), F.concat(F.lit("so and the of it "), F.col("id")).alias("body"))
    phrases = spark.createDataFrame([("and the of",), ("and the of it",), ("so and the of it 7",), ("it 29",), ("the",)], "phrase string")
    got = {}
    for r in contains.containing(phrases, texts).collect():
        got.setdefault(r.phrase, set()).add(r.text_id)
    body = {i: f"so and the of it {i}" for i in range(300)}
    assert got == {p: {i for i, t in body.items() if p in t} for p in ("and the of", "and the of it", "so and the of it 7", "it 29")}


def test_one_json_object(spark, tmp_path):
    from evigraph.plans import export

    g = A.finish(graph_of(spark), ONTO, A._written(spark, str(tmp_path / "w")))
    summary = V.summary(g.nodes, g.relationships, ONTO.types_df(spark), ONTO.properties_df(spark), ONTO.signatures_df(spark)).first()
    assert g.audit["validation_summary"].first().asDict() == summary.asDict()  # counted while tables were written
    export.write_object(g, ONTO, str(tmp_path / "o"), ends=True)
    files = list((tmp_path / "o").glob("part-*"))
    whole = json.loads(files[0].read_text(encoding="utf-8"))
    assert len(files) == 1 and list(whole) == ["schema_version", "ontology", "nodes", "relationships", "ontology_coverage", "validation", "extraction_summary"]
    assert whole["nodes"][0] == {"id": "co", "label": "Company", "node_id": "co", "node_type": "Company", "properties": {"name": "Acme Widgets"}, "evidence": [{"document_id": "d", "source_file": "f", "page": "1", "chunk_id": "c0", "quote": "Acme Widgets"}]}
    assert [n["id"] for n in whole["nodes"]] == ["co", "ci"]
    assert whole["relationships"] == [{"id": "r0", "relationship_id": "r0", "relationship_type": "BASED_IN", "source_id": "co", "target_id": "ci", "source_node_id": "co", "target_node_id": "ci", "source": "co", "target": "ci", "properties": {}, "evidence": []}]
    assert whole["ontology_coverage"] == {"node_types_found": ["City", "Company"], "node_types_not_found": ["Fine", "Law"], "relationship_types_found": ["BASED_IN"], "relationship_types_not_found": ["BINDS", "SETS"]}
    assert whole["validation"]["errors"] == [{"kind": "node without evidence", "subject": "ci"}, {"kind": "relationship without evidence", "subject": "r0"}]
    assert whole["extraction_summary"]["nodes"] == 2 and whole["ontology"]["relationship_signatures"][0] == {"source": "Company", "relationship": "BASED_IN", "target": "City"}


def test_folders_without_chunk_files_are_errors(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "other.json").write_text("{}")
    with pytest.raises(FileNotFoundError):
        C.read(spark, str(tmp_path / "in"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        C.read(spark, str(tmp_path / "nowhere"))
    (tmp_path / "in" / "a_chunks.json").write_text(json.dumps({"chunks": [{"text": "x"}]}))
    assert C.read(spark, str(tmp_path / "in"), relative=True).first().chunk_file == "in/a_chunks.json"


def test_a_stream_of_occurrences_merges_to_the_nodes_of_one_run(spark, tmp_path):
    from evigraph.streaming import ingest

    rng = random.Random(3)
    folder = tmp_path / "in"
    folder.mkdir()
    file = lambda n: json.dumps({"chunks": [{"document_id": f"d{n}", "chunk_id": f"c{i}", "text": f"{rng.choice(['Acme', 'acme!', 'Beta'])} {rng.randrange(3)}"} for i in range(4)]})

    def extract(chunks):
        name = F.substring_index("text", " ", 1)
        props = F.array(F.struct(F.lit(0).alias("pos"), F.substring_index("text", " ", -1).alias("key"), F.concat(F.lit('"'), "text", F.lit('"')).alias("value_json")))
        item = F.struct("document_id", F.lit(None).cast("string").alias("source_file"), F.lit(None).cast("string").alias("page"), "chunk_id", F.col("text").alias("quote"))
        node_id = F.concat_ws("_", "document_id", "chunk_id")
        return chunks.select("chunk_ord", node_id.alias("node_id"), F.lit("Company").alias("node_type"), name.alias("canonical_key"), node_id.alias("source_instance_id"), props.cast("array<struct<pos: int, key: string, value_json: string>>").alias("props"), F.array(item).cast(E.SCHEMA).alias("evidence")).withColumnRenamed("chunk_ord", "occ_ord")

    for n in range(3):
        (folder / f"{n}_chunks.json").write_text(file(n))
        ingest.merge(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "ck"), extract).awaitTermination()
    got, items = ingest.merged(spark, str(tmp_path / "out"))
    want = M.merged_nodes(extract(C.read(spark, str(folder))))
    rows = lambda df: sorted((r.node_id, r.canonical_key, [(p.key, p.value_json) for p in r.props], r.has_evidence) for r in df.collect())
    assert rows(got) == rows(want.table) and got.count() == 2
    assert {tuple(r) for r in items.collect()} == {tuple(r) for r in want.evidence().collect()}


def test_of_several_replies_the_same_one_counts(spark, tmp_path):
    asked = spark.createDataFrame([("a", "p", "s", "one", 1)], "request_id string, pass string, system string, prompt string, max_tokens int")
    key = R.keyed(asked).first().request_key
    rows = [("a", "p", key, raw, status, n, None) for raw, status, n in (("z", "ok", 2), ("y", "ok", 1), ("x", "ok", 1), ("b", "error", 0))]
    spark.createDataFrame(rows, R.REPLY_SCHEMA).write.parquet(str(tmp_path / "r"))
    recorded = R.RecordedExtractor(spark.createDataFrame([(key, "q"), (key, "c")], "request_key string, raw string"))
    assert R.answered(asked, recorded, str(tmp_path / "r")).first().raw == "x"
    assert R.answered(asked, recorded, str(tmp_path / "new")).first().raw == "c"


def test_source_is_given_as_source_text_where_asked(spark, tmp_path):
    onto = O.parse("1. Company\nProperties:\n- source_text\n2. City\nProperties:\n- name\n", "Company -> City\n- BASED_IN\n")
    n = nodes(spark, occ(1, "a", "Company", props={"source": "s", "x": "1"}), occ(2, "b", "Company", props={"source": "s", "source_text": '"t"'}), occ(3, "c", "City", props={"name": '"n"'}))
    r = rels(spark, ("a", "BASED_IN", "c"), ("a", "EATS", "c"), ("a", "BASED_IN", "ghost"))
    parts = [E.numbered(E.items(x, k, o), k, "at") for x, k, o in ((n, "node_id", "occ_ord"), (r, "relationship_id", "rel_ord"))]
    g = A.finish(Graph(M.without_arrays(n), M.without_arrays(r), *parts), onto, A._written(spark, str(tmp_path)), A.Options(source_text=True, strict=True))
    assert {x.node_id: [(p.key, p.value_json) for p in x.props] for x in g.nodes.collect()} == {"a": [("source_text", '"s"')], "b": [("source_text", '"t"')], "c": [("name", '"n"')]}
    assert {(x.relationship_id, x.reason) for x in A.examples("relationship_filter", g.audit["relationship_filter"]).collect()} == {("r1", "signature not allowed"), ("r2", "target missing")}
