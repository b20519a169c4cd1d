"""Ordered properties: ``ARRAY<STRUCT<pos INT, key STRING, value_json STRING>>``.

The order of keys decides display names and identities, and a value keeps the JSON text it came as,
so neither maps nor VARIANT would do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEMA = "array<struct<pos: int, key: string, value_json: string>>"
EMPTY = ("null", '""', "[]", "{}")


def is_empty(value_json: Column) -> Column:
    """Missing, null, or an empty string, list or object; 0 and false are values."""
    return value_json.isNull() | value_json.isin(*EMPTY)


def text_of(value_json: Column) -> Column:
    """A JSON string's text, any other value's JSON."""
    return F.get_json_object(F.concat(F.lit("["), value_json, F.lit("]")), "$[0]")


def value(props: Column, *keys: str) -> Column:
    """The first non-empty value among keys, in the order of keys, as JSON."""

    def first(key: str) -> Column:
        return F.try_element_at(F.filter(props, lambda p: (p["key"] == key) & ~is_empty(p["value_json"])), F.lit(1))["value_json"]

    return F.coalesce(*map(first, keys))


def is_name(key: Column) -> Column:
    k = F.lower(key)
    return (k == "name") | k.endswith("_name") | k.isin("title", "label")


def is_strong(key: Column) -> Column:
    k = F.lower(key)
    return (k == "id") | k.endswith("_id") | k.endswith("code") | k.endswith("_key")


def display_name(props: Column, node_id: Column, most: int = 120) -> Column:
    """The first name-like value, else the start of the first text, else the id."""
    named = F.try_element_at(F.filter(props, lambda p: is_name(p["key"]) & ~is_empty(p["value_json"])), F.lit(1))
    texts = F.try_element_at(F.filter(props, lambda p: p["value_json"].startswith('"') & (F.trim(text_of(p["value_json"])) != "")), F.lit(1))
    return F.coalesce(text_of(named["value_json"]), F.substring(text_of(texts["value_json"]), 1, most), node_id)


def of(**values: Column) -> Column:
    """Properties from JSON texts, in the order given; null values are left out."""
    if not values:
        return F.array().cast(SCHEMA)
    rows = [F.struct(F.lit(i).cast("int").alias("pos"), F.lit(k).alias("key"), v.alias("value_json")) for i, (k, v) in enumerate(values.items())]
    return F.filter(F.array(*rows), lambda p: p["value_json"].isNotNull())


def quoted(text: Column) -> Column:
    """A text as JSON string."""
    return F.regexp_replace(F.to_json(F.struct(F.coalesce(text, F.lit("")).alias("v"))), r'^\{"v":|\}$', "")
