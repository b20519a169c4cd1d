"""How many tokens texts have, counted in batches by the tokenizers' own libraries; only the lengths leave the Python workers.

A text of more than ``PIECE`` characters is split where no token can reach across: between two ASCII
letters with one space (or line break) between them, where the vocabulary's rules are known to part
there. Pieces are then dealt, in order, to batches of ``BATCH_BYTES`` bytes, so that a batch is as much
work whether it has one long text or many short ones, and what a library holds for a batch is bounded. A text
without such a place, or of a vocabulary with other rules, is encoded whole, which is right but holds more.

Pieces are parted at every safe place, and the length of a short part that is met again is remembered in its
task: most words of a text were seen before, and looking up a length costs far less than encoding.
"""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Characters of a piece from which on the next safe place is taken, and bytes of a batch.
PIECE, BATCH_BYTES = 16_384, 262_144
#: Characters of a part that is remembered at most, and parts that a task remembers before it starts anew.
SHORT, REMEMBERED = 64, 1 << 18
VOCABULARY, LIMIT = "word_bpe_49k.json", 2048
#: One space, or white space, between two ASCII letters.
SPACE, WHITE = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])"), re.compile(r"(?<=[A-Za-z])[ \n](?=[A-Za-z])")
#: Any space or line break: safe where words are kept by a split of which no part takes white space.
ANY, PLAIN = re.compile(r"[ \n]"), {r"[\p{L}]+", r"\p{L}+", r"[\p{N}]", r"[\p{N}]+", r"\p{N}", r"\p{N}+", r"[^\s\p{L}\p{N}]+"}


def place(vocabulary: str) -> str:
    """A vocabulary's file: a path as it is, a bare name among the public vocabularies installed where this runs."""
    if os.path.dirname(vocabulary):
        return vocabulary
    import public_tokenizers

    return str(public_tokenizers.path(vocabulary))


def _parts_at_white(rules: dict) -> bool:
    """Whether a tokenizer's rules never let a token reach over white space between letters: byte-level words, or words kept by a split."""
    pre = rules.get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [pre])[0]
    words = first.get("type") == "ByteLevel" and first.get("use_regex") or first.get("type") == "Split" and first.get("invert") and first.get("behavior") == "Removed" and r"\s" in first["pattern"].get("Regex", "")
    steps = rules.get("normalizer") or {"type": "NFC"}
    plain = all(n["type"] in ("NFC", "NFKC", "Lowercase") or n["type"] == "Replace" and n.get("content") == " " for n in steps.get("normalizers", [steps]))
    # a string of its own rules is looked for in the text first; it must neither hold white space nor look at its neighbours
    return bool(words) and plain and not any(re.search(r"\s", t["content"]) or t["single_word"] or t["lstrip"] or t["rstrip"] for t in rules.get("added_tokens", []))


def _safe(rules: dict) -> re.Pattern | None:
    """Where texts may be split under a tokenizer's rules."""
    if not _parts_at_white(rules):
        return None
    pre = rules.get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [pre])[0]
    kinds = first["pattern"]["Regex"].split("|") if first.get("type") == "Split" else [" "]
    return ANY if all(k in PLAIN or re.fullmatch("['A-Za-z]+", k) for k in kinds) else WHITE


def counter(vocabulary: str) -> tuple[Callable[[list[str]], list[int]], re.Pattern | None, int]:
    """(lengths of a batch of texts, places where texts may be split, characters left out there) of a vocabulary file.

    ``.json`` is read by tokenizers, ``.model`` by sentencepiece, ``.tiktoken`` by tiktoken. No begin,
    end or added special tokens; special strings inside texts as the library has it; nothing is cut or padded.
    """
    path = place(vocabulary)
    if path.endswith(".json"):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            rules = f.read()
        t = Tokenizer.from_str(rules)
        t.no_truncation()
        t.no_padding()
        safe = _safe(json.loads(rules))
        return lambda texts: [len(e) for e in t.encode_batch_fast(texts, add_special_tokens=False)], safe, int(safe is ANY)
    if path.endswith(".model"):
        import sentencepiece

        s = sentencepiece.SentencePieceProcessor(model_file=path)
        across = any("▁" in s.id_to_piece(i).lstrip("▁") for i in range(s.vocab_size()))
        # a piece begins with the mark of a space, which the library also puts before a text: the space itself is left out
        marked = [len(x) for x in s.encode(["a b", "a", "b"], num_threads=1)]
        return lambda texts: [len(x) for x in s.encode(texts, num_threads=1)], SPACE if not across and marked[0] == marked[1] + marked[2] else None, 1
    if path.endswith(".tiktoken"):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [len(e.encode_ordinary(x)) for x in texts], WHITE, 0
    raise ValueError(f"no library for {vocabulary}")


def pieces(text: str, boundary: re.Pattern | None, left_out: int = 0, size: int = PIECE) -> Iterator[str]:
    """``text`` in pieces of at least ``size`` characters (but the last), split at the first safe place after that many."""
    start = 0
    while boundary and len(text) - start > size and (found := boundary.search(text, start + size)):
        yield text[start : found.start()]
        start = found.start() + left_out
    yield text[start:]


def lengths(texts: list[str], count: Callable[[list[str]], list[int]], boundary: re.Pattern | None, left_out: int = 0, size: int = PIECE, most: int = BATCH_BYTES) -> list[int]:
    """The tokens of each text: pieces are encoded in batches of ``most`` bytes and added up for each text."""
    out = [0] * len(texts)
    batch: list[str] = []
    owner: list[int] = []
    held = 0

    def flush() -> None:
        for i, n in zip(owner, count(batch)):
            out[i] += n
        batch.clear()
        owner.clear()

    for i, text in enumerate(texts):
        for piece in pieces(text, boundary, left_out, size):
            if piece:
                bytes_of = len(piece.encode())
                if held and held + bytes_of > most:
                    flush()
                    held = 0
                batch.append(piece)
                owner.append(i)
                held += bytes_of
    if batch:
        flush()
    return out


def remembering(count: Callable[[list[str]], list[int]], boundary: re.Pattern | None, left_out: int = 0, short: int = SHORT, most: int = REMEMBERED) -> Callable[[list[str]], list[int]]:
    """``count`` of texts, where a part between safe places is encoded by itself when it is met again, and only looked up from then on.

    A text's length is the sum of its parts' lengths. Parts that are new, or of more than ``short``
    characters, are encoded together, a text at a time, as the library is slow with single words.
    About ``most`` parts are held besides those of one batch.
    """
    if boundary is None:
        return count
    # a part begins with its white space unless that is left out
    parts = (lambda t: t.replace("\n", " ").split(" ")) if boundary is ANY and left_out else (boundary if left_out else re.compile(f"(?={boundary.pattern})")).split
    between = " " * left_out
    known: dict[str, int] = {}
    met: set[str] = set()

    def counted(texts: list[str]) -> list[int]:
        if len(met) > most:
            known.clear()
            met.clear()
        sums, rests, agains = [], [], []
        for text in texts:
            n, rest, again = 0, [], []
            for part in parts(text):
                length = known.get(part)
                if length is not None:
                    n += length
                elif part in met:
                    again.append(part)
                else:
                    rest.append(part)
                    if len(part) <= short:
                        met.add(part)
            sums.append(n)
            rests.append(between.join(rest))
            agains.append(again)
        if new := list({part for again in agains for part in again}):
            known.update(zip(new, count(new)))
        return [n + more + sum(map(known.__getitem__, again)) for n, more, again in zip(sums, count(rests), agains)]

    return counted


def token_column(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """How many tokens a text has, a long; null counts as the empty text, which has none."""

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count, boundary, left_out = counter(vocabulary)  # once a task
        count = remembering(count, boundary, left_out)
        for batch in batches:
            yield pa.array(lengths(batch.to_pylist(), count, boundary, left_out), pa.int64())

    return F.arrow_udf(encode, "long")(F.coalesce(text, F.lit("")))


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    Nulls are empty texts: no bytes and no tokens. Repeated rows and ids, null ids too, each have a
    row; other columns of ``docs`` are not looked at. Very long texts are counted whole, in pieces. An empty
    table has an empty result. No shuffle: each row is counted where it is read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    counted = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), token_column(F.col("text"), vocabulary).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op13_token_counts(spark, sf_dir: str) -> DataFrame:
    """The tokens of every document under the lower-casing word vocabulary, and whether they are over 2,048."""
    return count_tokens(common.table(spark, sf_dir, "documents"))
