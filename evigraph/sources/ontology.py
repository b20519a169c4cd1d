"""Ontologies: node types with properties, and signatures of relationships, from two small text files."""

from __future__ import annotations

import bisect
import itertools
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

NAME = r"([A-Za-z][A-Za-z0-9_]*)"


def _table(spark: SparkSession, columns: dict[str, str], rows: list[tuple]) -> DataFrame:
    """``rows`` as a table whose size Spark knows, as it does not of one made from Python rows."""
    values = list(zip(*rows)) or [()] * len(columns)
    return spark.createDataFrame(pa.table({c: pa.array(v, kind) for (c, kind), v in zip(columns.items(), values)}))


@dataclass(frozen=True)
class Dialect:
    """How the files are written; see :data:`DIALECTS`."""

    heading: str
    bullet: str
    ends: str = "undashed"  # a property list ends at an 'undashed' line, an 'other' line, or 'never'
    repeated: str = "restart"  # a heading met again restarts the list, is 'ignored', or is 'continued'
    known_ends: bool = True  # a signature's types must be node types
    relation: str = r"-\s*([A-Z][A-Z0-9_]*)"
    stop: tuple[str, ...] = ("GENERAL RELATIONSHIP PROPERTY CONVENTION",)
    stop_exact: bool = False
    need_nodes: bool = True
    need_relations: bool = True


DIALECTS = {
    "numbered": Dialect(rf"\d+\.\s*{NAME}", rf"-\s*{NAME}"),
    "loose": Dialect(rf"#*\s*(?:\d+[.)]\s*)?{NAME}", rf"[-*]\s*{NAME}\s*(?:\(.*)?", ends="never", repeated="ignored", relation=r"[-*]\s*([A-Z][A-Z0-9_]*)", stop=("GENERAL RELATIONSHIP PROPERTY CONVENTION", "GENERAL RELATIONSHIP PROPERTIES"), stop_exact=True, need_relations=False),
    "contract": Dialect(rf"\d+\.\s*{NAME}", rf"-\s*{NAME}", ends="other", repeated="continued", known_ends=False, stop=(), need_nodes=False, need_relations=False),
}


@dataclass
class Ontology:
    """Node types in order, their properties, and (source type, relationship type, target type) rows."""

    types: list[str] = field(default_factory=list)
    properties: dict[str, set[str]] = field(default_factory=dict)
    signatures: list[tuple[str, str, str]] = field(default_factory=list)
    empty_pairs: list[tuple[str, str]] = field(default_factory=list)

    def types_df(self, spark: SparkSession) -> DataFrame:
        return _table(spark, {"type_ord": "int32", "node_type": "string"}, list(enumerate(self.types)))

    def properties_df(self, spark: SparkSession) -> DataFrame:
        return _table(spark, {"node_type": "string", "property": "string"}, [(t, p) for t in dict.fromkeys(self.types) for p in sorted(self.properties.get(t, ()))])

    def signatures_df(self, spark: SparkSession) -> DataFrame:
        return _table(spark, {"source_type": "string", "relationship_type": "string", "target_type": "string"}, self.signatures)

    def render(self) -> str:
        """The ontology as text for a request: types with sorted properties, then sorted signatures."""
        pairs: dict[tuple[str, str], list[str]] = {p: [] for p in self.empty_pairs}
        for s, r, t in self.signatures:
            pairs.setdefault((s, t), []).append(r)
        head = [f"{t}: {', '.join(sorted(self.properties.get(t, ())))}" for t in self.types]
        tail = [f"{s} -> {t}: {', '.join(sorted(rs))}" for (s, t), rs in sorted(pairs.items())]
        return "\n".join(["NODE TYPES", *head, "", "RELATIONSHIP SIGNATURES", *tail])


def _lines(text: str) -> list[str]:
    return [x.strip() for x in text.splitlines() if x.strip()]


def _last(places: list[int], at: int) -> int:
    """The last of rising ``places`` before ``at``; -1 without any."""
    i = bisect.bisect_left(places, at)
    return places[i - 1] if i else -1


def parse_nodes(text: str, dialect: str | Dialect = "numbered") -> tuple[list[str], dict[str, set[str]]]:
    """Node types in file order and their properties.

    A bullet is a property of the heading before it if a list of properties has begun since, and has not ended.
    """
    d = DIALECTS[dialect] if isinstance(dialect, str) else dialect
    lines = _lines(text)
    named = {i: found[1] for i, line in enumerate(lines) if (found := re.fullmatch(d.heading, line))}
    begins = [i for i, line in enumerate(lines) if re.fullmatch(r"Properties\s*:", line, re.IGNORECASE)]
    bullets = {i: found[1] for i, line in enumerate(lines) if i not in named and (found := re.fullmatch(d.bullet, line))}
    first = {name: i for i, name in reversed(named.items())}
    heads = [i for i, name in named.items() if d.repeated != "ignored" or first[name] == i]
    plain = set(range(len(lines))) - named.keys() - set(begins) - bullets.keys()
    ends = sorted(i for i in plain if d.ends == "other" or d.ends == "undashed" and not lines[i].startswith("-"))
    owned = [(_last(heads, i), prop) for i, prop in bullets.items() if _last(begins, i) > max(_last(heads, i), _last(ends, i)) and heads and heads[0] < _last(begins, i)]
    final = {named[i]: i for i in heads}  # where a heading restarts its list, the last one counts
    types = [named[i] for i in heads]
    properties = {t: {prop for i, prop in owned if named[i] == t and (d.repeated != "restart" or i == final[t])} for t in types}
    if d.need_nodes and not types:
        raise ValueError("no node types in the ontology")
    return types if d.repeated == "restart" else list(properties), properties


def parse_relationships(text: str, types: list[str], dialect: str | Dialect = "numbered") -> tuple[list[tuple[str, str, str]], list[tuple[str, str]]]:
    """Signature rows, and the pairs of types that are named (also those without a relationship).

    A relationship belongs to the pair before it, or to none if that one's types are not known.
    """
    d = DIALECTS[dialect] if isinstance(dialect, str) else dialect
    stops = lambda shout: shout in d.stop if d.stop_exact else shout.startswith(d.stop)
    lines = list(itertools.takewhile(lambda line: not stops(line.upper()), _lines(text)))
    pairs = {i: found.groups() for i, line in enumerate(lines) if (found := re.fullmatch(rf"{NAME}\s*->\s*{NAME}", line))}
    sound = {i: pair for i, pair in pairs.items() if not d.known_ends or set(pair) <= set(types)}
    named = [(_last(list(pairs), i), found[1]) for i, line in enumerate(lines) if i not in pairs and (found := re.fullmatch(d.relation, line))]
    order = list(dict.fromkeys(sound.values()))
    rows = sorted({(order.index(sound[i]), name) for i, name in named if i in sound})
    if d.need_relations and not rows:
        raise ValueError("no relationships in the ontology")
    return [(order[i][0], name, order[i][1]) for i, name in rows], order


def parse(nodes_text: str, relationships_text: str, dialect: str | Dialect = "numbered") -> Ontology:
    types, properties = parse_nodes(nodes_text, dialect)
    rows, pairs = parse_relationships(relationships_text, types, dialect)
    return Ontology(types, properties, rows, pairs)


def read(spark: SparkSession, folder: str, dialect: str | Dialect = "numbered") -> Ontology:
    """``nodes.txt`` and ``relationships.txt`` of a folder in any store that Spark reads."""
    whole = lambda name: spark.read.text(f"{folder}/{name}", wholetext=True).first()[0]
    return parse(whole("nodes.txt"), whole("relationships.txt"), dialect)


_ITEM = re.compile(rf"(?:\d+\.\s*|[-*]\s*)\**{NAME}\**")


def blocks(text: str) -> list[tuple[str | None, str]]:
    """The file as (block, line): each stripped line with the item, a bare name as numbered or dashed entry, that it stands under."""
    rows, name = [], None
    for line in _lines(text):
        found = _ITEM.fullmatch(line)
        name = found[1] if found else name
        rows.append((name, line))
    return rows


def _items(rows: list[tuple[str | None, str]]) -> list[str]:
    return list(dict.fromkeys(found[1] for _, line in rows if (found := _ITEM.fullmatch(line))))


def base_types(text: str) -> list[str]:
    """The different items between the heading of the base nodes and the next heading of the schema or of relationships."""
    rows = blocks(text)
    begin = [i for i, (_, line) in enumerate(rows) if re.search(r"FINAL\s+GRAPH\s+SCHEMA\s*[—-]\s*BASE\s+NODES", line, re.IGNORECASE)]
    if not begin:
        raise ValueError("no list of base types")
    end = [i for i, (_, line) in enumerate(rows) if i > begin[0] and re.match(r"FINAL\s+GRAPH\s+SCHEMA|ALLOWED\s+RELATIONSHIPS", line, re.IGNORECASE)]
    found = _items(rows[begin[0] + 1 : end[0] if end else None])
    if not found:
        raise ValueError("no base types under their heading")
    return found


# Items of an ontology file that are headings of lists.
LIST_HEADINGS = ("Properties", "Attributes")


def allowed_types(text: str) -> set[str]:
    """Every item of a nodes file but headings of lists, in the file's loosest reading: properties count too."""
    return set(_items(blocks(text))) - set(LIST_HEADINGS)


def allowed_relationships(text: str) -> set[str]:
    """Every entry in capitals of a relationships file."""
    return {found[1] for line in _lines(text) if (found := re.fullmatch(r"[-*]\s*([A-Z][A-Z0-9_]*)", line))}


# Words of an ontology file that say nothing of a type.
SCHEMA_WORDS = ("properties", "attributes", "description", "optional", "required", "string", "number", "boolean", "list")


def schema_terms(node_type: str, nodes_text: str) -> list[str]:
    """Search terms of a type: the words of its name, and those of the lines of its first block that are no item; three letters or more."""
    name = re.sub(r"(?<!^)(?=[A-Z])", " ", node_type).lower().split()
    rows = blocks(nodes_text)
    start = next((i for i, (block, _) in enumerate(rows) if block == node_type), len(rows))
    own = [line.lower() for _, line in itertools.takewhile(lambda row: not _ITEM.fullmatch(row[1]), rows[start + 1 :])]
    words = {w.replace("_", " ") for line in own for w in re.findall("[a-z][a-z0-9_]{2,}", line)} - {w for w in SCHEMA_WORDS}
    return sorted(t for t in words | {w for part in name for w in re.findall("[a-z0-9]+", part)} if len(t) >= 3)
