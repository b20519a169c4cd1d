import hashlib

from pyspark.sql import functions as F

from evigraph.llm import chat


def test_tree_branches_are_ranked_and_formatted(spark):
    rows = [(1, 1, None, "user", "root", 0.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b", 5.0), (1, 4, 3, "user", "c", None), (1, 5, 3, "user", "d", 4.0), (2, 1, 9, None, None, 1.0), (3, 1, 2, "user", "x", 1.0), (3, 2, 1, "user", "y", 1.0), (3, 3, 2, "user", "leaf below a cycle", 1.0)]
    m = spark.createDataFrame(rows, "tree long, id long, parent long, role string, text string, score double")
    listed = {(r.tree, r.leaf): [] for r in chat.paths(m).collect()}
    for r in chat.paths(m).collect():
        listed[r.tree, r.leaf].append((r.up, r.id))
    assert {k: [i for _, i in sorted(v)] for k, v in listed.items()} == {(1, 2): [2, 1], (1, 4): [4, 3, 1], (1, 5): [5, 3, 1], (2, 1): [1]}
    got = {(r.tree, r.branch): r for r in chat.conversations(m.withColumn("branch", F.lit(9)), 2).collect()}
    assert set(got) == {(1, 1), (1, 2), (2, 1)}
    assert got[1, 1].leaf == 5 and got[1, 2].leaf == 4  # means 3 and 5/3
    assert got[1, 1].formatted == "<|turn|>user<|text|>root<|end|><|turn|>assistant<|text|>b<|end|><|turn|>user<|text|>d<|end|>"
    span = got[1, 1].loss[0]
    assert got[1, 1].formatted[span.start : span.start + span.size] == "b"
    assert got[2, 1].formatted == "<|turn|><|text|><|end|>" and got[2, 1].loss == []
    assert chat.conversations(m.limit(0)).count() == 0


def test_round_trip_of_texts_with_marks(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>x<|end|>", "\\", "<", "<\\|", "|>", "\\<|", "<<||", "a\nb\n", "", None, "<|end|>\\", "é\U0001f600<|", "\\\\|"]
    rows = [(7, i, r, t) for i, (r, t) in enumerate(zip(["user", "assistant", "<|text|>", None, "x\ny"] * 3, nasty))]
    out = chat.conversations(chat.linear(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    turns = out.select(chat.parsed(F.col("formatted")).alias("t")).first().t
    assert [(t.role, t.text) for t in turns] == [(r or "", t or "") for _, _, r, t in rows]
    d = chat.digests(out).first()
    said = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in rows)
    learned = "".join(t or "" for _, _, r, t in rows if r == "assistant")
    assert (d.n_turns, d.turns_sha256, d.loss_chars, d.loss_sha256) == (len(rows), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert d.formatted_chars == len(out.first().formatted)


def test_long_conversations_ties_and_nulls(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(300)] + [(None, None, "user", "n"), (2, 5, "b", "x"), (2, 5, "a", "y"), (2, 5, "a", "y")]
    d = {r.conv_id: r for r in chat.digests(chat.conversations(chat.linear(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))).collect()}
    assert {k: r.n_turns for k, r in d.items()} == {1: 300, None: 1, 2: 3}
    assert d[2].turns_sha256 == hashlib.sha256(b"a\ny\na\ny\nb\nx\n").hexdigest()
