"""Language identification by prediction by partial matching.

For each language a tree of byte contexts up to three bytes long holds how often each byte followed.
A byte is coded in the longest context that has it; each shorter context costs an escape, whose
probability is the number of different bytes seen there over that number plus the count (method C),
and bytes already excluded by longer contexts do not count in shorter ones. Bytes never seen share
what is left evenly. After training the statistics are frozen, so the code length of every byte
after every context is computed once and exactly; a text's code length is their sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Documents of each language that the trees are learned from, on average.
DOCS_EACH = 400
#: Contexts whose code lengths are worked out at a time, so that the driver needs little memory besides the model.
CONTEXTS = 1024
UNKNOWN = "und"
RESULT = "lang_pred string, score double, bits_per_byte double, excess double, margin double"


def sample(docs: DataFrame, each: int = DOCS_EACH) -> DataFrame:
    """(lang, text): about ``each`` documents per language, those whose id has the smallest hash, outside the held-out fold.

    Every language is in it; rows without language, text or id are left out.
    """
    known = docs.select("doc_id", "lang", "text").where((common.remainder(F.col("doc_id"), 4) != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    share = known.groupBy("lang").count().select(F.col("lang").alias("of"), (F.lit(float(each)) / F.col("count")).alias("share"))
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return known.join(F.broadcast(share), F.expr("lang = of")).where(chance < F.col("share")).select("lang", "text")


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): how often each four bytes stand in the texts of a language; a text begins after three zero bytes."""

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for lang, texts in rows.groupby("lang")["text"]:
                b = np.frombuffer(b"\0\0\0" + b"\0\0\0".join(t.encode() for t in texts), np.uint8).astype(np.int64)
                if len(b) > 3:
                    g, n = np.unique(((b[:-3] * 256 + b[1:-2]) * 256 + b[2:-1]) * 256 + b[3:], return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": g, "n": n})

    return docs.mapInPandas(grams, "lang string, gram long, n long").where("gram % 256 <> 0").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def build(rows: list[tuple[str, int, int]]) -> dict:
    """The frozen code lengths from (lang, gram, n); no rows give a model that knows no language."""
    langs = sorted({r[0] for r in rows})
    if not langs:
        return {"langs": []}
    lang = np.array([langs.index(r[0]) for r in rows])
    gram = np.array([r[1] for r in rows], np.int64)
    n = np.array([r[2] for r in rows], float)
    part = np.stack([gram >> 24, gram >> 16 & 255, gram >> 8 & 255, gram & 255], 1)
    seen = np.unique(part)
    width = len(seen) + 1  # the last stands for all other bytes
    symbol = np.full(256, width - 1)
    symbol[seen] = np.arange(len(seen))
    part = symbol[part]
    key = (part[:, 0] * width + part[:, 1]) * width + part[:, 2]
    # a node for each context of 3, 2, 1 and 0 bytes, in that order
    suffixes = [key, key % width**2, key % width, key * 0]
    contexts = [np.unique(s) for s in suffixes]
    starts = np.cumsum([0] + [len(c) for c in contexts])
    bits = np.zeros((starts[-1], width, len(langs)), np.float32)
    unseen = 256 - len(seen)
    for i in range(len(langs)):
        own = lang == i
        lower_counts: list[np.ndarray] = []
        for k in range(4):
            c = np.zeros((len(contexts[k]), width))
            np.add.at(c, (np.searchsorted(contexts[k], suffixes[k][own]), part[own, 3]), n[own])
            lower_counts.append(c)
        for k in range(4):
            for start in range(0, len(contexts[k]), CONTEXTS):
                some = contexts[k][start : start + CONTEXTS]
                left = np.ones((len(some), width), bool)  # symbols that no longer context has had
                cost = np.zeros((len(some), width))
                escape = np.zeros(len(some))
                for j in range(k, 4):
                    up = some % width ** (3 - j) if j < 3 else some * 0
                    c = lower_counts[j][np.searchsorted(contexts[j], up)] * left
                    total, kinds = c.sum(1), (c > 0).sum(1)
                    whole = np.maximum(total + kinds, 1)
                    with np.errstate(divide="ignore"):
                        own_cost = escape[:, None] - np.log2(c / whole[:, None])
                    cost = np.where(c > 0, own_cost, cost)
                    escape = escape + np.where(kinds > 0, -np.log2(np.maximum(kinds, 1) / whole), 0)
                    left &= c == 0
                rest = (left[:, :-1].sum(1) + unseen)[:, None]
                cost = np.where(left, escape[:, None] + np.log2(np.maximum(rest, 1)), cost)
                bits[starts[k] + start : starts[k] + start + len(some), :, i] = cost
        del lower_counts
    node = np.empty(width**3, np.int32)
    for start in range(0, width**3, width**2):
        every = np.arange(start, start + width**2)
        found = np.full(width**2, starts[3], np.int32)
        for k in (2, 1, 0):
            short = every % width ** (3 - k)
            at = np.minimum(np.searchsorted(contexts[k], short), len(contexts[k]) - 1)
            found = np.where(contexts[k][at] == short, starts[k] + at, found)
        node[start : start + width**2] = found
    model = {"langs": langs, "symbol": symbol.astype(np.int32), "width": width, "node": node * width, "bits": bits.reshape(-1, len(langs))}
    # what a byte of a language's own texts takes
    own = model["bits"][model["node"][key] + part[:, 3], lang].astype(float) * n
    model["typical"] = np.bincount(lang, own, len(langs)) / np.bincount(lang, n, len(langs))
    return model


def code_lengths(model: dict, text: str, block: int = 1 << 20) -> np.ndarray:
    """Bits that each language's tree needs for the whole text."""
    s = model["symbol"][np.frombuffer(b"\0\0\0" + text.encode(), np.uint8)]
    w, out = model["width"], np.zeros(len(model["langs"]))
    for a in range(0, len(s) - 3, block):
        t = s[a : a + block + 3]
        out += model["bits"][model["node"][(t[:-3] * w + t[1:-2]) * w + t[2:-1]] + t[3:]].sum(0, dtype=np.float64)
    return out


def predict(model: dict, text: str | None) -> tuple[str, float, float | None, float | None, float | None]:
    if not text or not model["langs"] or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, None, None, None
    bits, size = code_lengths(model, text), len(text.encode())
    best = int(bits.argmin())
    margin = float((np.partition(bits, 1)[1] - bits[best]) / size) if len(bits) > 1 else None
    return model["langs"][best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum()), float(bits[best] / size), float(bits[best] / size / model["typical"][best]), margin


def train(docs: DataFrame, each: int = DOCS_EACH) -> dict:
    """The model from ``docs`` (doc_id, text, lang); grams are counted and summed on the executors."""
    return build([tuple(r) for r in count_grams(sample(docs, each)).orderBy("lang", "gram").collect()])


def predict_column(text: Column, model: dict, spark) -> Column:
    """The language of each whole text, as a struct of :data:`RESULT`.

    ``score`` is the posterior probability of the language if all are alike beforehand;
    ``bits_per_byte`` its code length, ``excess`` how many times that is of what the language's own
    texts take, ``margin`` how many bits a byte the next language takes more (null with one language
    only). A text that is null or has no letter is ``und`` with score 0 and nulls, as is any text if no
    language was learned. Ties go to the first language by name. Repeated rows repeat their results,
    texts are coded whole in blocks, and other columns are not used.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([predict(shared.value, t) for t in texts], columns=["lang_pred", "score", "bits_per_byte", "excess", "margin"])

    return udf(text)


def op6_language_ppm(spark, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = common.table(spark, sf_dir, "documents")
    found = docs.select("doc_id", (common.remainder(F.col("doc_id"), 4) == 2).alias("held_out"), predict_column(F.col("text"), train(docs), spark).alias("r"))
    return found.select("doc_id", "held_out", "r.lang_pred", "r.score", "r.bits_per_byte")
