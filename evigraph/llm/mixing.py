"""Mixing sources to target weights by Poisson replication, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Sources whose rates are broadcast at most; more are joined on (source, salt).
BROADCAST_SOURCES = 50_000
SALTS = 64


def rates(docs: DataFrame, weights: DataFrame | None, total: float | None, source_col: str) -> DataFrame:
    """(source, rate, cdf): the mean number of copies of a source's documents, and the Poisson distribution up to far beyond it.

    The rate is the source's share of the weights times ``total``, over its rows. ``cdf`` ends
    where what remains of the distribution is below any number that :func:`uniform` can give.
    """
    counted = docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    weighted = counted.withColumn("weight", F.lit(1.0)) if weights is None else counted.join(weights.select(F.col("source").alias("s"), F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).alias("weight")), F.expr("source <=> s"), "left").select("source", "n", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    whole = weighted.agg(F.sum("weight").alias("all_weight"), F.sum("n").alias("all_n"))
    out = weighted.crossJoin(F.broadcast(whole))  # one row
    rate = F.when(F.col("all_weight") > 0, F.col("weight") / F.col("all_weight") * (F.lit(float(total)) if total is not None else F.col("all_n").cast("double")) / F.col("n")).otherwise(F.lit(0.0))
    out = out.select("source", rate.alias("rate"))
    steps = "sequence(1, cast(ceil(rate + 12 * sqrt(rate) + 40) as int))"
    # log pmf(k) = log pmf(k - 1) + ln(rate / k): no underflow of the factor exp(-rate)
    cdf = f"""if(rate <= 0, array(1.0D), aggregate({steps}, named_struct('c', array(exp(-rate)), 'l', -rate),
        (a, k) -> named_struct('c', array_append(a.c, element_at(a.c, -1) + exp(a.l + ln(rate / k))), 'l', a.l + ln(rate / k)), a -> a.c))"""
    return out.withColumn("cdf", F.expr(cdf))


def uniform(seed: int, key: Column) -> Column:
    """A number in [0, 1) with 52 bits from the MD5 of seed and key; the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), key)), 1, 13), 16, 10).cast("long").cast("double") / float(1 << 52)


def mix(docs: DataFrame, weights: DataFrame | None = None, total: float | None = None, seed: int = 42, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs``, each row as often as its source's Poisson distribution says, in a global random order.

    ``weights`` has (source, weight); None weighs all sources alike; a source without a weight, or
    with a null or negative one, gets none. ``total`` is the expected number of rows of the result,
    None the number of rows of ``docs``. A row's count is the smallest k with u <= CDF(k), u from
    the hash of seed and id: the same id always has the same count, so repeated rows are copied
    alike. A null id counts as the empty text; null is a source like any other. The result has the
    columns of ``docs`` and ``mix_copy`` (from 1) and ``mix_key``, the random key by which rows are
    dealt to partitions and sorted inside them; columns of ``docs`` with these names are replaced.
    No rows in, no rows out.

    The rates are broadcast if there are at most ``BROADCAST_SOURCES``; otherwise both sides are
    joined on source and a salt, so a source with a third of all rows is no single task.
    """
    kept = [c for c in docs.columns if c not in ("mix_copy", "mix_key")]
    dist = common.cut(rates(docs, weights, total, source_col))
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*kept).alias("row"), key.alias("key"), F.col(source_col).alias("from"))
    if dist.count() <= BROADCAST_SOURCES:
        joined = rows.join(F.broadcast(dist), F.expr("from <=> source"))
    else:
        salted = dist.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        joined = rows.withColumn("deal", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(salted, F.expr("from <=> source and deal = salt"))
    joined = joined.withColumn("u", uniform(seed, F.col("key")))
    copies = joined.select("row", "key", F.expr("size(filter(cdf, c -> c < u))").alias("n")).where("n > 0").select("row", "key", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("mix_copy"))
    dealt = copies.select("row.*", "mix_copy", F.md5(F.concat_ws("|", F.lit(f"{seed}|order"), "key", "mix_copy")).alias("mix_key"))
    return dealt.repartition("mix_key").sortWithinPartitions("mix_key")


def op7_poisson_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents mixed so that every source has the same expected number of rows, as many rows as before in all."""
    return mix(common.table(spark, sf_dir, "documents"))


ORACLE_SQL = """
WITH RECURSIVE n AS (SELECT source, count(*)::DOUBLE AS n FROM documents GROUP BY source),
a AS (SELECT count(*)::DOUBLE AS w, sum(n)::DOUBLE AS all_n FROM n),
r AS (SELECT source, 1.0::DOUBLE / w * all_n / n AS rate FROM n, a),
p AS (SELECT source, rate, 0 AS k, -rate AS l, exp(-rate) AS c FROM r
      UNION ALL SELECT source, rate, k + 1, l + ln(rate / (k + 1)), c + exp(l + ln(rate / (k + 1))) FROM p WHERE k + 1 <= ceil(rate + 12 * sqrt(rate) + 40)),
d AS (SELECT *, coalesce(doc_id::VARCHAR, '') AS key, ('0x' || substr(md5('42|' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496 AS u FROM documents),
c AS (SELECT source, list(c ORDER BY k) AS cdf FROM p GROUP BY source),
m AS (SELECT d.*, unnest(range(1, 1 + len(list_filter(cdf, lambda x: x < u)))) AS mix_copy FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, text, lang, source, n_chars, mix_copy::INTEGER AS mix_copy, md5('42|order|' || key || '|' || mix_copy) AS mix_key FROM m
"""
