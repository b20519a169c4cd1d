"""The corpus pipeline: documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, all but the last with the columns
of documents. Stages are meant to be written out and read again one after the other, so a lost
executor costs part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evigraph.llm import common, language, mixing, simhash, tiling, toxicity

#: A text is in no learned language if the best one codes it in more than so many times the bits that its
#: own texts take, and in no one language if the next best takes less than so many bits a byte more.
MOST_EXCESS, LEAST_MARGIN = 1.5, 0.25


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold.

    A null or empty text has the score of the examples' share of toxic ones, which is below it.
    Repeated rows stay or go together. Without labels all stay.
    """
    model = toxicity.train(docs, common.table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_column(F.col("text"), model, spark)["score"] < toxicity.THRESHOLD)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one learned language, by the limits above.

    Machine strings, shouting, other scripts and mixtures without a main language go, as do null texts
    and those without a letter. With a single learned language there is no margin to keep. Repeated
    rows stay or go together; without a learned language none stays.
    """
    found = language.predict_column(F.col("text"), language.train(docs), spark)
    known = F.coalesce(found["excess"] <= MOST_EXCESS, F.lit(False)) & F.coalesce(found["margin"] >= LEAST_MARGIN, F.lit(True))
    return docs.where(known)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies: five-word shingles alike by 0.8 or more.

    Ties, nulls and repeated rows: see :func:`simhash.representatives`.
    """
    return simhash.representatives(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item by half of its words.

    Null texts hold none; null items and items without a word are held by none. Repeated rows stay or go together.
    """
    return tiling.without_overlaps(docs, common.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many documents as before, every source alike, in a global random order.

    Null is a source; rows of one id are copied alike. Adds ``mix_copy`` and ``mix_key``.
    """
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
]

#: Learned models, fingerprints and tiles are beyond SQL; tests hold the pipeline against its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows are written to the shared folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = common.stored(docs)
    return docs
