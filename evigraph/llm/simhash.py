"""SimHash near-duplicates, found through anchor points of a covering code.

Two fingerprints of 64 bits that differ in at most three bits differ in at most one bit in one of
their halves. The 31 low bits of a half are covered by the perfect [31, 26] Hamming code, whose
code words are the anchors: every point is within the covering radius, 1, of exactly one of them,
its home. The last bit of a half stands for itself. So if x and y differ in at most one bit of a
half, y lies within radius plus threshold, 2, of the home of x, or shares that home and differs in
the bit that stands for itself. Each fingerprint is therefore filed once under its home and
replicated to at most 17 anchors of each half, and only a home and a replica that meet at an anchor
are compared. No link is lost, and the number of rows does not depend on how they are distributed.

Near copies by the similarity of their shingles are found through the same anchors, of several SimHashes
of 32 bits, and verified by their texts; see :func:`representatives`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest, xxh64_intdigest

from . import common
from .components import components

SEED = 42
#: Shingles hashed at a time, so that a text of any length needs little memory.
BLOCK = 1 << 16
#: SimHashes of 32 bits by which near copies meet, longs of the whole code, and bits of it in which they may differ: texts
#: of similarity 0.8 differ in some 60 of the 768, at most 89 of those seen, unrelated ones in some 384.
PARTS, LONGS, APART = 6, 12, 192
#: Leads of a home, and pairs of one text that a task verifies.
LEADS, DEALT = 8, 4096
_ODD = np.uint64(0x9E3779B97F4A7C15)


def fingerprint(text: str | None, words: int = 3) -> int:
    """The 64-bit SimHash of a text, as a signed integer; see :func:`fingerprints`."""
    tokens = (text or "").encode().lower().split()  # of bytes: A-Z only, and the six ASCII white spaces
    if not tokens:
        return 0
    n = max(1, len(tokens) - words + 1)
    shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)))) if len(tokens) >= words else iter([b" ".join(tokens)])
    ones = np.zeros(64, np.int64)
    for start in range(0, n, BLOCK):
        h = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED, min(BLOCK, n - start))), "<u8", min(BLOCK, n - start))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(text: Column, words: int = 3) -> Column:
    """The SimHash of each whole text as a long.

    A-Z are lower-cased, words are runs of characters other than space and U+0009 to U+000D, and
    all shingles of ``words`` words count, repeats included; a text of fewer words is one shingle.
    A bit is 1 if it is set in over half of the shingles' XXH64 values (UTF-8, seed 42). A null,
    empty or blank text has fingerprint 0.
    """

    @F.pandas_udf("long")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return udf(text)


def _home(part: Column) -> tuple[Column, Column]:
    """The syndrome of the 31 low bits of a part, and these bits."""
    masks = [sum(1 << (p - 1) for p in range(1, 32) if p >> j & 1) for j in range(5)]
    syndrome = sum(((F.bit_count(part.bitwiseAND(F.lit(m).cast("long"))).cast("long") % 2) * (1 << j) for j, m in enumerate(masks)), F.lit(0).cast("long"))
    return syndrome, part.bitwiseAND(F.lit((1 << 31) - 1).cast("long"))


def _filed(points: DataFrame) -> DataFrame:
    """(node, home, anchors) for each part of ``points`` (node, parts): its home and every anchor to be met, as longs that name side, free bit and code word."""
    rows = points.select("node", F.posexplode("parts").alias("side", "part"))
    syndrome, low = _home(F.col("part"))
    rows = rows.select("node", ((F.col("side").cast("long") * 2 + F.shiftrightunsigned("part", 31)) * (1 << 31)).alias("base"), syndrome.alias("s"), low.alias("low"))
    rows = rows.withColumn("home", F.expr("base + if(s = 0, low, low ^ shiftleft(1L, cast(s - 1 as int)))"))
    pairs = F.expr("transform(filter(sequence(1L, 31L), a -> s <> 0 and a <> s and a < (a ^ s)), a -> base + (low ^ shiftleft(1L, cast(a - 1 as int)) ^ shiftleft(1L, cast((a ^ s) - 1 as int))))")
    return rows.select("node", "home", F.concat(F.array("home", F.expr("home ^ 2147483648L")), pairs).alias("anchors"))


def families(points: DataFrame, close: Callable[[Column, Column], Column], codes: DataFrame | None = None, verify: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(node, root): for each node of ``points`` (node, parts) that is linked, the smallest node it can reach.

    ``parts`` are 32-bit numbers as longs. Nodes with a part within one bit of each other's meet if their
    codes are ``close``; ``codes`` has (node, code), without it a node is its own code. ``verify`` keeps of
    such pairs (a, b), a < b, those that are links; without it all are. Every node is first held against
    the ``LEADS`` leads of its homes, so that a group of very many like nodes becomes few families by
    pairs in proportion to its nodes. Then each node meets the homes within reach that have nodes of
    other families, and only pairs of two families are looked at; those of one family would change
    nothing. No link between two families is lost.
    """

    def coded(rows: DataFrame, node: str, name: str) -> DataFrame:
        if codes is None:
            return rows.withColumn(name, F.array(node))
        return packed(rows.join(codes.select(F.col("node").alias("_of"), F.col("code").alias(name)), F.col(node) == F.col("_of"))).drop("_of")

    n = points.count() * PARTS
    packed = lambda df: common.packed(df, n)
    kept = verify or (lambda pairs: pairs)
    both = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    filed = _filed(points)  # replicas are made where they are sent from, and not kept
    homes = common.stored(packed(filed.select(F.col("home").alias("anchor"), "node")))
    place = F.row_number().over(W.partitionBy("anchor").orderBy(F.xxhash64("node", "anchor"), "node"))
    leads = packed(homes.select("anchor", F.col("node").alias("lead"), place.alias("place")).where(F.col("place") <= LEADS)).drop("place")
    stars = packed(packed(homes.join(leads.hint("shuffle_hash"), "anchor").where("lead <> node")).select(*both("lead", "node")).distinct())
    stars = coded(coded(stars, "a", "_x"), "b", "_y").where(close(F.col("_x"), F.col("_y"))).select("a", "b")
    found = common.stored(packed(kept(common.stored(stars))))
    grown = components(found)
    own = common.stored(packed(_in_families(homes, grown)))
    sizes = packed(own.groupBy("anchor", "family").agg(F.count(F.lit(1)).alias("n"))).groupBy("anchor").agg(F.max_by("family", F.struct("n", "family")).alias("most"), F.count(F.lit(1)).alias("kinds"))
    met = _in_families(filed.select("node", "anchors"), grown).select(F.explode("anchors").alias("anchor"), "node", "family")
    # homes, one row for each fingerprint and part, are hashed, so that replicas need no sort
    near = common.stored(coded(met.join(sizes.hint("shuffle_hash"), "anchor").where("kinds > 1 or family <> most"), "node", "code"))
    named = own.join(near.select("anchor").distinct(), "anchor", "left_semi").select("anchor", F.col("node").alias("other_node"), F.col("family").alias("other")).join(sizes, "anchor")
    named = coded(named, "other_node", "other_code")
    few, many = (named.where(test).select("anchor", "other_node", "other_code", "other") for test in ("other <> most", "other = most"))
    reach = (F.col("family") != F.col("other")) & close(F.col("code"), F.col("other_code"))
    cross = near.join(few, "anchor").where(reach).select(*both("node", "other_node")).unionByName(near.where("family <> most").join(many, "anchor").where(reach).select(*both("node", "other_node")))
    pairs = common.stored(packed(packed(cross).distinct()))
    if pairs.isEmpty():
        return grown
    return components(found.unionByName(common.stored(packed(kept(pairs)))))


def _in_families(rows: DataFrame, grown: DataFrame | None) -> DataFrame:
    """``rows`` with ``family``: the root of the node, itself as long as it is not linked."""
    if grown is None:
        return rows.withColumn("family", F.col("node"))
    known = grown.select(F.col("node").alias("_node"), "root")
    return rows.join(known, F.col("node") == F.col("_node"), "left").withColumn("family", F.coalesce("root", "node")).drop("_node", "root")


def within(bits: int, longs: int) -> Callable[[Column, Column], Column]:
    """Whether two codes, arrays of ``longs`` numbers, differ in ``bits`` bits or fewer."""
    return lambda a, b: sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(1, longs)), F.bit_count(a[0].bitwiseXOR(b[0]))) <= bits


def halves(fps: DataFrame) -> DataFrame:
    """Points of fingerprints ``fp``: of two that differ in three bits, a half of one is within a bit of the other's."""
    return fps.select(F.col("fp").alias("node"), F.expr("array(fp & 4294967295L, shiftrightunsigned(fp, 32))").alias("parts"))


def linked(fps: DataFrame, bits: int = 3) -> DataFrame:
    """(node, root) of the fingerprints ``fp`` that reach another by steps of ``bits`` or fewer differing bits, at most 3: more are not covered."""
    if not 0 <= bits <= 3:
        raise ValueError("the anchors cover up to 3 differing bits")
    return families(halves(fps), within(bits, 1))


def classes(docs: DataFrame, bits: int = 3, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, fp, component_id), the smallest id reachable through links.

    Rows of equal fingerprint are linked, whatever their texts. Null ids take part but are never a
    component's smallest id unless it has no other. Repeated rows repeat their results. Other columns
    of ``docs`` are not used, so their names cannot clash. An empty table gives an empty one.
    """
    signed = common.stored(docs.select(F.col(id_col).alias("doc_id"), fingerprints(F.col(text_col), words).alias("fp")))
    fps = common.stored(signed.groupBy("fp").agg(F.min("doc_id").alias("first")))
    named = _named(fps.select(F.col("fp").alias("node"), "first"), linked(fps, bits))
    return signed.join(named.select(F.col("node").alias("fp"), "component_id").hint("shuffle_hash"), "fp").select("doc_id", "fp", "component_id")


def _named(nodes: DataFrame, grown: DataFrame) -> DataFrame:
    """(node, root, component_id) of ``nodes`` (node, first): the root, and the smallest ``first`` of a family."""
    rooted = _in_families(nodes, grown).withColumnRenamed("family", "root")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(least, "root").select("node", "root", "component_id")


def tokens(text: str | None) -> list[bytes]:
    """Words as fingerprints take them: A-Z lower-cased, parted by the six ASCII white spaces."""
    return (text or "").encode().lower().split()


def signed(text: str | None) -> tuple[int, list[int], list[int]]:
    """A number for the text's sequence of words, and the SimHash of its words and pairs of words, each once: ``PARTS`` parts of 32 bits, and the whole code.

    Short shingles, as an edited word changes one word and two pairs, but five shingles of five: texts
    of similarity 0.8 differ in some 8 of 100 bits, so that some part mostly differs in one bit at most.
    """
    found = tokens(text)
    kinds = list({*found, *map(b" ".join, zip(found, found[1:]))})
    ones = np.zeros(64 * LONGS, np.int64)
    for start in range(0, len(kinds), BLOCK >> 3):
        h = np.frombuffer(b"".join(map(xxh3_128_digest, kinds[start : start + (BLOCK >> 3)])), "<u8").reshape(-1, 2)
        more = [h]
        while len(more) < LONGS // 2:  # further bits of the same hash, by multiplying and folding
            x = more[-1] * _ODD
            more.append(x ^ x >> np.uint64(32))
        ones += np.unpackbits(np.concatenate(more, 1).view(np.uint8), axis=1).sum(0, dtype=np.int32)
    bits = np.packbits(2 * ones > len(kinds))
    return node_of(found), bits[: 4 * PARTS].view(">u4").tolist(), bits.view(">i8").tolist()


def shingles(found: list[bytes], words: int = 5) -> np.ndarray:
    """The 64-bit hashes of the shingles of a text's :func:`tokens`, each once; a text of fewer words is one shingle."""
    runs = map(b" ".join, zip(*(found[i:] for i in range(words)))) if len(found) >= words else [b" ".join(found)]
    return np.unique(np.fromiter(map(xxh3_64_intdigest, runs), np.uint64)).view(np.int64)


def alike(docs: DataFrame, firsts: DataFrame, similarity: float, words: int) -> Callable[[DataFrame], DataFrame]:
    """Keeps pairs of nodes whose texts have shingles alike by ``similarity`` or more (Jaccard); ``firsts`` (node, first) has a document of each.

    Shingles are made of the texts of pairs only: rows are mapped, as Spark takes a condition on what a function
    returns below the join, where the function runs over all texts, and runs it once more above. A node that is
    in very many pairs is dealt to several tasks.
    """

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = ((node, tokens(t)) for node, t in zip(rows["_node"], rows["text"]))
            yield pd.DataFrame([(node, shingles(t, words)) for node, t in found if node_of(t) == node], columns=["node", "hashes"], dtype=object)

    def keep(pairs: DataFrame) -> DataFrame:
        asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = common.stored(firsts.join(asked, "node").select(F.col("first").alias("_first"), F.col("node").alias("_node")))
        texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("_first")).select("_node", "text")
        sets = common.stored(texts.mapInPandas(hashed, "node long, hashes array<long>")).dropDuplicates(["node"])
        often = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        fat = pairs.join(often, "a").select("a", "b", F.expr(f"pmod(xxhash64(b), n div {DEALT} + 1)").alias("deal")).join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb")), "b")
        many = sets.join(often, F.col("node") == F.col("a")).select("a", F.col("hashes").alias("ha"), F.explode(F.expr(f"sequence(0L, n div {DEALT})")).alias("deal"))
        both = F.size(F.array_intersect("ha", "hb"))
        return fat.join(many, ["a", "deal"]).where(both >= similarity * (F.size("ha") + F.size("hb") - both)).select("a", "b")

    return keep


def node_of(found: list[bytes]) -> int:
    """A number for a text's sequence of :func:`tokens`."""
    node = xxh3_64_intdigest(b" ".join(found))
    return node - (1 << 64) * (node >> 63)


def representatives(docs: DataFrame, similarity: float = 0.8, words: int = 5) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...), with their columns, that are the first of their group of near copies: one for each.

    Texts are near copies if their sets of ``words``-word shingles have a Jaccard similarity of
    ``similarity`` or more; groups are what such links connect. Candidates come from the anchors of
    ``PARTS`` SimHashes of 32 bits whose whole codes differ in ``APART`` bits, so a link is found with a
    probability (measured in the tests), and every candidate is verified, so no two texts are linked
    that are not alike. Texts of equal words
    are copies; empty and null texts are copies of each other. Of a group the smallest id stays. Of
    repeated rows one stays, as of documents without an id in a group that has no other; documents
    without an id are only compared by equal words. An empty table gives an empty one.
    """

    @F.pandas_udf("node long, parts array<long>, code array<long>")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([signed(t) for t in texts], columns=["node", "parts", "code"], dtype=object)

    rows_signed = common.stored(docs.select("doc_id", sign("text").alias("s")).select("doc_id", "s.*"))
    firsts = common.stored(rows_signed.groupBy("node").agg(F.min("doc_id").alias("first"), F.any_value("parts").alias("parts"), F.any_value("code").alias("code")))
    grown = families(firsts.select("node", "parts"), within(APART, LONGS), firsts.select("node", "code"), alike(docs, firsts.select("node", "first"), similarity, words))
    named = common.stored(_named(firsts.select("node", "first"), grown))
    rows, ids = rows_signed.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if rows == ids:
        kept = common.stored(named.select(F.col("component_id").alias("kept")).distinct())
        return docs.join(kept.hint("shuffle_hash"), docs["doc_id"] == kept["kept"], "left_semi")  # ids only are hashed; texts are not sorted
    number = F.pandas_udf(lambda texts: texts.map(lambda t: node_of(tokens(t))), "long")
    marked = docs.select(F.struct("*").alias("row"), number("text").alias("mark")).join(named, F.expr("mark = node"))
    return marked.where("row.doc_id <=> component_id").dropDuplicates(["root"]).select("row.*")


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = classes(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
