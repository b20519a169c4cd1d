"""Reply trees to formatted conversations, with built-in functions only.

Messages point to the message they reply to. Pointers are doubled by self-joins: after k rounds
every message knows its ancestor 2^k steps up. With these, in as many self-joins again, every leaf
lists its path, twice as many messages each time, so the number of joins is that of the binary digits
of the longest path. Branches, the
paths from root to leaf, are ranked by their score within their tree, and each chosen one is
formatted as one conversation.

A turn is written ``<|turn|>`` role ``<|text|>`` text ``<|end|>``. Inside roles and texts ``\\`` becomes
``\\\\`` and ``<|`` becomes ``<\\|``, so no text holds a mark, and each escape is undone by dropping its
backslash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, id, up): for each leaf of each tree all messages of its path; ``up`` counts from the leaf, 0.

    ``messages`` has (tree, id, parent), an id once in a tree. A parent that is null or not a
    message of the same tree makes a root; messages on or below a cycle have no root and are left
    out. Each round is a checkpoint.
    """
    known = messages.select("tree", "id", "parent")
    there = known.select(F.col("tree").alias("t"), F.col("id").alias("i"))
    nodes = common.cut(known.join(there, F.expr("tree <=> t and parent = i"), "left").select("tree", "id", F.col("i").alias("parent")))
    parents = nodes.where("parent is not null").select(F.col("tree").alias("t"), F.col("parent").alias("p")).distinct()
    leaves = nodes.join(parents, F.expr("tree <=> t and id = p"), "left_anti")
    jumps = nodes.where("parent is not null").select("tree", F.col("id").alias("lower"), F.col("parent").alias("upper"))
    listed = leaves.select("tree", F.col("id").alias("leaf"), "id", F.lit(0).cast("long").alias("up"))
    n, hops = nodes.count(), [jumps]  # hops[k] leads 2^k steps up
    while 1 << (len(hops) - 1) < n and jumps.limit(1).count():
        far = jumps.select(F.col("tree").alias("t"), F.col("lower").alias("over"), F.col("upper").alias("top"))
        jumps = common.cut(jumps.join(far, F.expr("tree <=> t and upper = over")).select("tree", "lower", F.col("top").alias("upper")))
        hops.append(jumps)
    # pointers that have not run out after as many steps as there are messages go round a cycle
    looped = jumps.select(F.col("tree").alias("t"), F.col("lower").alias("l"))
    listed = listed.join(looped, F.expr("tree <=> t and leaf = l"), "left_anti")
    for k, hop in enumerate(hops):
        above = hop.select(F.col("tree").alias("t"), "lower", "upper")
        higher = listed.join(above, F.expr("tree <=> t and id = lower")).select("tree", "leaf", F.col("upper").alias("id"), (F.col("up") + (1 << k)).alias("up"))
        listed = common.cut(listed.unionByName(higher))
    return listed


def conversations(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, branch, score, formatted, loss): the best ``branches`` paths of each tree as conversations.

    ``messages`` has (tree, id, parent, role, text, score); other columns are not used. A branch's
    score is the mean of its messages' scores, null counting as 0; ties go to the longer branch,
    then to the smaller leaf. Null roles and texts are empty. ``loss`` lists, in order, first code
    point and length of each assistant text in ``formatted`` (as escaped). No messages, no rows.
    """
    listed = common.cut(paths(messages))
    scores = messages.select(F.col("tree").alias("t"), F.col("id").alias("i"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    ranked = (
        listed.join(scores, F.expr("tree <=> t and id = i")).groupBy("tree", "leaf").agg(F.avg("score").alias("score"), F.max("up").alias("depth"))
        .withColumn("branch", F.row_number().over(W.partitionBy("tree").orderBy(F.desc("score"), F.desc("depth"), "leaf"))).where(F.col("branch") <= branches)
    )
    chosen = listed.join(ranked.select(F.col("tree").alias("t"), F.col("leaf").alias("l"), "branch", "score", "depth"), F.expr("tree <=> t and leaf = l")).select("tree", "leaf", "branch", "score", "id", (F.col("depth") - F.col("up")).alias("at"))
    role, text = escape(F.coalesce("role", F.lit(""))), escape(F.coalesce("text", F.lit("")))
    turns = messages.select(F.col("tree").alias("t"), F.col("id").alias("i"), F.concat(F.lit(TURN), role, F.lit(TEXT)).alias("head"), text.alias("body"), F.coalesce(F.col("role") == "assistant", F.lit(False)).alias("learn"))
    full = chosen.join(turns, F.expr("tree <=> t and id = i")).withColumn("size", F.length("head") + F.length("body") + len(END))
    before = F.coalesce(F.sum("size").over(W.partitionBy("tree", "leaf").orderBy("at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = full.select("tree", "leaf", "branch", "score", "at", F.concat("head", "body", F.lit(END)).alias("part"), F.when(F.col("learn"), F.struct((before + F.length("head")).cast("long").alias("start"), F.length("body").cast("long").alias("size"))).alias("span"))
    whole = placed.groupBy("tree", "leaf", "branch", "score").agg(F.array_sort(F.collect_list(F.struct("at", "part", "span"))).alias("parts"))
    return whole.select("tree", "leaf", "branch", "score", F.array_join("parts.part", "").alias("formatted"), F.expr("filter(parts.span, s -> s is not null)").alias("loss"))


def parsed(formatted: Column) -> Column:
    """The turns (role, text) that a conversation was formatted from, unescaped."""
    turns = F.filter(F.split(formatted, F.lit(r"<\|end\|>"), -1), lambda p: p.startswith(TURN))
    return F.transform(turns, lambda p: F.struct(unescape(F.substring_index(F.substring(p, len(TURN) + 1, 2**31 - 1), TEXT, 1)).alias("role"), unescape(F.substring_index(p, TEXT, -1)).alias("text")))


def linear(rows: DataFrame) -> DataFrame:
    """Messages of (conv_id, turn, role, text): each turn replies to the one before, so a conversation is a tree with one branch.

    Turns are numbered by turn (null first), then role and text, so that ties and repeated rows have a place.
    """
    order = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text"))
    numbered = rows.select(F.col("conv_id").alias("tree"), F.row_number().over(order).cast("long").alias("id"), "role", "text")
    return numbered.select("tree", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations: turns, the text under the loss mask, and size."""
    turns = parsed(F.col("formatted"))
    read = formatted.select(F.col("tree").alias("conv_id"), "formatted", "loss", turns.alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["size"].cast("int")))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


#: A conversation whose texts look like another template's marks.
CONTROL = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op2_reply_trees(spark, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and read back."""
    rows = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    messages = common.stored(linear(rows.unionByName(spark.createDataFrame(CONTROL, "conv_id long, turn long, role string, text string"))))
    return digests(conversations(messages))


ORACLE_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS id
           FROM (SELECT conv_id, turn, role, text FROM conversations
                 UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, length(replace(replace(text, '\', '\\'), '<|', '<\|')) + length(replace(replace(role, '\', '\\'), '<|', '<\|')) + 23 AS size FROM c),
g AS (SELECT conv_id, count(*)::BIGINT AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY id) AS said,
             coalesce(string_agg(text, '' ORDER BY id) FILTER (WHERE role = 'assistant'), '') AS learned, sum(size)::BIGINT AS formatted_chars FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned)::BIGINT AS loss_chars, sha256(learned) AS loss_sha256, formatted_chars FROM g
"""
