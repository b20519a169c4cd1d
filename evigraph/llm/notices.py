"""License notices: exact phrases, and short notices found within a bounded number of edits.

A notice that occurs with at most k edits contains one of any k + 1 pieces of it unchanged. So each
notice is split into k + 1 pieces; where a piece stands, a window as long as the notice and k
characters more on either side is handed to the ``regex`` library, whose bounded-error matching
counts the edits and gives the span. Texts are searched as lower-case words with single spaces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Phrases that count wherever their words stand consecutively, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Short notices that may be misspelled: label, words, edits allowed.
NOTICES = (
    ("apache", "licensed under the apache license version 2 0", 4),
    ("apache", "you may obtain a copy of the license at http www apache org licenses", 6),
    ("bsd", "redistribution and use in source and binary forms with or without modification", 7),
    ("cc", "licensed under a creative commons attribution", 4),
    ("gpl", "under the terms of the gnu general public license", 4),
    ("gpl", "released under the gnu general public license", 4),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", 7),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", 7),
    ("mit", "released under the mit license", 3),
    ("mpl", "subject to the terms of the mozilla public license", 4),
)
RESULT = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label: string, start: long, stop: long, edits: int>>"

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # A-Z not yet lower-cased


def pieces(notice: bytes, edits: int) -> list[tuple[int, bytes]]:
    """``edits`` + 1 pieces of about the same length, and where each begins."""
    cuts = [round(i * len(notice) / (edits + 1)) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """Finds phrases and notices in texts; see :func:`scan` for the results."""

    def __init__(self, phrases: dict[str, str], notices: tuple[tuple[str, str, int], ...]):
        self.phrases = [(p.encode(), label, re.compile(rb"(?<![^ ])(?=" + re.escape(p.encode()) + rb"(?![^ ]))")) for p, label in phrases.items()]
        self.notices = [(label, len(w), k, pieces(w.encode(), k), regex.compile(rb"(?<![^ ])(?e)(?:" + regex.escape(w.encode(), special_only=True) + rb"){e<=" + str(k).encode() + rb"}(?![^ ])")) for label, w, k in notices]

    def fuzzy(self, norm: bytes) -> list[tuple[str, int, int, int]]:
        found = {}
        for label, length, edits, parts, pattern in self.notices:
            windows = []
            for offset, piece in parts:
                at = norm.find(piece)
                while at >= 0:
                    windows.append((max(0, at - offset - edits - 1), at - offset + length + edits + 1))
                    at = norm.find(piece, at + 1)
            end = -1
            for a, b in _merged(windows):
                for m in pattern.finditer(norm, a, min(b, len(norm))):
                    found[label, m.start(), m.end()] = sum(m.fuzzy_counts)
        return [(label, a, b, e) for (label, a, b), e in sorted(found.items(), key=lambda x: (x[0][1], x[0]))]

    def scan(self, text: str | None) -> tuple:
        words = (text or "").encode().translate(_FOLD).split()
        norm = b" ".join(words)
        base = sorted((norm.count(b" ", 0, m.start()), label, m.start(), m.start() + len(p)) for p, label, pattern in self.phrases if p in norm for m in pattern.finditer(norm))
        fuzzy = self.fuzzy(norm)
        base_labels = {label for _, label, _, _ in base}
        score = 1.0 if base else max((1 - e / (b - a) for _, a, b, e in fuzzy), default=0.0)
        spans = [(label, a, b, 0) for _, label, a, b in base] + fuzzy
        return (
            len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None,
            ",".join(sorted(base_labels)), ",".join(sorted(base_labels | {x[0] for x in fuzzy})), float(score), _in_text(text, norm, spans),
        )


def _merged(windows: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Overlapping windows as one."""
    a = b = None
    for x, y in sorted(windows):
        if b is not None and x <= b:
            b = max(b, y)
        else:
            if b is not None:
                yield a, b
            a, b = x, y
    if b is not None:
        yield a, b


def _in_text(text: str | None, norm: bytes, spans: list) -> list[dict]:
    """Spans of normal form as code points of the text: from the start of their first word to the end of their last."""
    if not spans:
        return []
    at = [m.span() for m in _WORD.finditer(text or "")]
    return [{"label": label, "start": at[norm.count(b" ", 0, a)][0], "stop": at[norm.count(b" ", 0, max(a, b - 1))][1], "edits": e} for label, a, b, e in spans]


def scan(text: Column, phrases: dict[str, str] | None = None, notices: tuple | None = None) -> Column:
    """What each whole text says of licenses, as a struct of :data:`RESULT`.

    A-Z are lower-cased; words are runs of characters other than ASCII ones that are no digits or
    letters. ``n_base`` counts all places where a phrase's words stand consecutively, ``first_word``
    and ``last_word`` are their smallest and largest word numbers from 0, or null. ``labels`` adds
    those of the notices found with no more than their edits, at word boundaries. ``score`` is 1
    with a phrase, else the largest share of unedited characters, else 0. ``spans`` are code points
    of the text. Null is the empty text: no words, empty labels, score 0.
    """
    scanner = Scanner(PHRASES if phrases is None else phrases, NOTICES if notices is None else notices)
    names = [x.split(" ")[0] for x in RESULT.split(", spans")[0].split(", ")] + ["spans"]

    @F.pandas_udf(RESULT)
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([scanner.scan(t) for t in texts], columns=names, dtype=object)

    return udf(text)


def op10_license_notices(spark, sf_dir: str) -> DataFrame:
    """Words, phrases and license labels of every document."""
    docs = common.table(spark, sf_dir, "documents")
    return docs.select("doc_id", scan(F.col("text")).alias("r")).select("doc_id", "r.n_words", "r.n_base", "r.first_word", "r.last_word", "r.base_labels", "r.labels", "r.score", "r.spans")
