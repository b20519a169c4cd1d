"""Text and identity functions as column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Every Unicode white space and the four ASCII separators.
WHITE = r"(?U)[\s\x1c-\x1f]+"
# Words that do not tell companies apart, for names already reduced to letters and digits ...
COMPANY_WORDS = ("inc", "incorporated", "ltd", "limited", "llc", "corp", "corporation", "company", "co")
# ... and for names that still have their punctuation.
COMPANY_WORDS_RAW = ("company", "incorporated", "inc", "corp", "corporation", "ltd", "limited", "llc")


def collapsed(c: Column) -> Column:
    """White space collapsed to single spaces and trimmed; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), WHITE, " "))


def trimmed(c: Column) -> Column:
    """Without white space at the ends; null is empty."""
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def folded(c: Column) -> Column:
    """Collapsed and lower-cased."""
    return F.lower(collapsed(c))


def identity(c: Column) -> Column:
    """Lower-case ASCII letters and digits, everything else one space."""
    return F.trim(F.regexp_replace(folded(c), "[^a-z0-9]+", " "))


def company_identity(c: Column) -> Column:
    """:func:`identity` without company words."""
    return F.trim(F.regexp_replace(F.regexp_replace(identity(c), rf"\b(?:{'|'.join(COMPANY_WORDS)})\b", " "), " +", " "))


@F.pandas_udf(StringType())
def nfkc(values: pd.Series) -> pd.Series:
    """Unicode NFKC, for which there is no built-in."""
    return values.str.normalize("NFKC")


def compatible_identity(c: Column) -> Column:
    """NFKC, lower-case, without company words (before punctuation goes), ASCII letters and digits."""
    plain = F.trim(F.lower(nfkc(F.coalesce(c, F.lit("")))))
    return F.trim(F.regexp_replace(F.regexp_replace(plain, rf"\b(?:{'|'.join(COMPANY_WORDS_RAW)})\b", " "), "[^a-z0-9]+", " "))


def minted(prefix: str, *parts: Column, length: int = 20) -> Column:
    """``prefix`` and the first digits of the SHA-1 of the parts joined by ``|``; null reads None."""
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("None")) for p in parts)).cast("binary")), 1, length))


def page_label(start: Column, end: Column) -> Column:
    """``unknown``, one page, or a range of pages."""
    return F.when(start.isNull() & end.isNull(), "unknown").when(start.eqNullSafe(end) | end.isNull(), start.cast("string")).when(start.isNull(), end.cast("string")).otherwise(F.concat_ws("-", start.cast("string"), end.cast("string")))


def context_block(document: Column, chunk: Column, start: Column, end: Column, text: Column) -> Column:
    """A chunk as it stands in a request: a header line, then its text."""
    shown = [F.coalesce(x.cast("string"), F.lit("None")) for x in (document, chunk, start, end)]
    return F.concat(F.lit("\n--- "), shown[0], F.lit(" / "), shown[1], F.lit(" / pages "), shown[2], F.lit("-"), shown[3], F.lit(" ---\n"), F.coalesce(text, F.lit("")), F.lit("\n"))


def camel_words(c: Column) -> Column:
    """A space before every capital but the first character."""
    return F.regexp_replace(c, "(?<!^)(?=[A-Z])", " ")


def occurrences(text: Column, term: Column) -> Column:
    """How often a term stands in a text, without overlaps."""
    return F.when(F.length(term) > 0, ((F.length(text) - F.length(F.replace(text, term, F.lit("")))) / F.length(term)).cast("long")).otherwise(F.lit(0).cast("long"))


def word_hits(text: Column, term: Column, most: int = 10) -> Column:
    """How often a term stands in a text as words, of any script, at most ``most``."""
    return F.least(F.regexp_count(text, F.concat(F.lit(r"(?U)\b\Q"), F.replace(term, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E\b"))), F.lit(most)).cast("long")
