"""The whole run, with replies made by a small function, and again with replies recorded."""

import json
import re
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from evigraph.operators.replies import CallingExtractor, RecordedExtractor, answered
from evigraph.plans import assemble as A
from evigraph.sources import ontology as O
from evigraph.streaming import ingest

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import tests

ONTO = O.parse("1. Company\nProperties:\n- name\n2. City\nProperties:\n- name\n3. Law\nProperties:\n- name\n", "Company -> City\n- BASED_IN\n- BORN_IN\n")
CHUNK = "chunk_ord long, document_id string, chunk_id string, source_file string, start_page int, end_page int, text string"
ROWS = [(0, "d1", "c0", "f", 1, 1, "Acme Widgets is based in Springfield."), (1, "d1", "c1", "f", 2, 2, "ACME WIDGETS grew again; Rule Seven applies."), (2, "d2", "c0", "g", 1, 1, "broken")]


def model(system, prompt, max_tokens):
    """Finds capitalised pairs; knows one law; fails on one chunk."""
    if system.startswith("Extract") and "broken" in prompt:
        raise RuntimeError("service down")
    source = prompt.split("---\n")[-1] if "SOURCE" not in prompt else prompt
    out = {"nodes": [], "relationships": [], "node_reviews": [], "relationship_candidates": []}
    if system.startswith("Extract"):
        for m in re.finditer(r"Acme Widgets|ACME WIDGETS|Springfield", source):
            kind = "City" if m[0] == "Springfield" else "Company"
            out["nodes"].append({"node_id": m[0], "node_type": kind, "canonical_key": m[0], "properties": {"name": m[0], "odd": 1}, "evidence": [{"quote": m[0]}]})
        out["nodes"].append({"node_id": "lie", "node_type": "Company", "properties": {"name": "Lie"}, "evidence": [{"quote": "not in the text"}]})
        out["relationships"] = [{"relationship_type": t, "source_node_id": "Acme Widgets", "target_node_id": " Springfield ", "evidence": [{"quote": "is based in"}]} for t in ("BASED_IN", "EATS")]
        return "```json\n" + json.dumps(out) + "\n```"
    if system.startswith("Look for") and "TYPE Law" in prompt:
        out["nodes"] = [{"node_id": "law", "node_type": "Law", "canonical_key": "rule seven", "properties": {"name": "Rule Seven"}, "evidence": [{"quote": "Rule Seven applies"}]}]
    if system.startswith("List relationships"):
        ids = dict(re.findall(r"^(node_\w+) \| (Company|City)", prompt, re.M))
        s, t = ([i for i, k in ids.items() if k == kind] for kind in ("Company", "City"))
        ok = {"relationship_type": "BORN_IN", "source_node_id": s[0], "target_node_id": t[0], "evidence": [{"quote": "grew again; rule"}]}
        out["relationships"] = [ok, ok, {**ok, "relationship_type": "BASED_IN"}, {**ok, "source_node_id": "ghost"}, {**ok, "target_node_id": s[0]}, {**ok, "relationship_type": "BORN_IN", "source_node_id": s[0], "evidence": [{"quote": "invented words"}]}]
    return json.dumps(out)


def test_assemble_and_run_again_without_calls(spark, tmp_path):
    chunks = spark.createDataFrame(ROWS, CHUNK)
    g = A.assemble(spark, chunks, ONTO, CallingExtractor(model, attempts=2, base_seconds=0.01, parallel=2), str(tmp_path / "w"))
    assert sorted((r.node_type, [p.value_json for p in r.props]) for r in g.nodes.collect()) == [("City", ['"Springfield"']), ("Company", ['"Acme Widgets"']), ("Law", ['"Rule Seven"'])]
    assert sorted(r.relationship_type for r in g.relationships.collect()) == ["BASED_IN", "BORN_IN"]
    verdicts = sorted(r.verdict for r in g.audit["relationship_recovery"].collect())
    assert verdicts == sorted(["accepted", "already present", "already present", "unknown endpoint", "signature not allowed", "evidence not found"])
    lost = g.audit["extraction_failures"].collect()
    assert [r.request_id for r in lost] == ["primary:2"] and "service down" in lost[0].error
    assert g.audit["validation_summary"].first().valid and A.exit_code(g) == 1
    n, r = A.serialized(g)
    assert json.loads(n.where("node_type = 'City'").first().properties) == {"name": "Springfield"} and r.columns[:5] == ["id", "relationship_id", "relationship_type", "source_id", "target_id"]
    A.write(g, str(tmp_path / "out"), as_json=True)
    assert spark.read.parquet(str(tmp_path / "out/nodes")).count() == 3

    recorded = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "w/replies")).where("status = 'ok'").select("request_key", "raw")
    again = A.assemble(spark, chunks, ONTO, RecordedExtractor(recorded), str(tmp_path / "w2"))
    assert sorted(x.node_id for x in again.nodes.collect()) == sorted(x.node_id for x in g.nodes.collect())


def test_options_and_repair(spark, tmp_path):
    chunks = spark.createDataFrame(ROWS[:2], CHUNK)
    off = A.Options(recall=False, resolution=False, coverage=False, verification=False, node_batch=None)
    g = A.assemble(spark, chunks, ONTO, CallingExtractor(model, 1), str(tmp_path / "w"), off)
    assert {r.node_type for r in g.nodes.collect()} == {"Company", "City"} and A.exit_code(g) == 0

    def fixing(system, prompt, max_tokens):
        return json.dumps({"nodes": [{"node_id": "x", "node_type": "Law", "properties": {"name": "Rule Seven"}, "evidence": [{"document_id": "d1", "chunk_id": "c1", "quote": "rule seven applies"}]}]})

    fixed, history = A.repair(spark, g, chunks, ONTO, "3. Law\nProperties:\n- name\nrule applies\n", CallingExtractor(fixing, 1), str(tmp_path / "w"))
    assert [tuple(r) for r in history.collect()] == [(1, 1, 0)]
    assert {r.node_type for r in fixed.nodes.collect()} == {"Company", "City", "Law"}


def test_a_second_run_asks_only_what_failed(spark, tmp_path):
    asked = spark.createDataFrame([("a", "p", "s", "one", 1), ("b", "p", "s", "two", 1), ("c", "p", "s", "one", 1)], "request_id string, pass string, system string, prompt string, max_tokens int")
    path = str(tmp_path / "r")

    def once(system, prompt, max_tokens):
        if prompt == "two":
            raise ValueError("no")
        return "{}"

    first = answered(asked, CallingExtractor(once, 1), path)
    assert {r.request_id: r.status for r in first.collect()} == {"a": "ok", "b": "error", "c": "ok"}

    def rest(system, prompt, max_tokens):
        assert prompt == "two"
        return '{"n": 2}'

    second = answered(asked, CallingExtractor(rest, 1), path)
    assert {r.request_id: r.raw for r in second.collect()} == {"a": "{}", "b": '{"n": 2}', "c": "{}"}
    assert second.where("attempts > 1").count() == 0


def test_stream_of_chunk_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a_chunks.json").write_text(json.dumps({"chunks": [{"document_id": "d", "chunk_id": "c", "text": "x"}]}))
    run = lambda: ingest.ingest(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "ck"), lambda df: df.select("document_id", F.length("text").alias("n"))).awaitTermination()
    run()
    (folder / "b_chunks.json").write_text(json.dumps({"chunks": [{"document_id": "e", "chunk_id": "c", "text": "yy"}]}))
    run()
    assert sorted((r.document_id, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("d", 1), ("e", 2)]
