import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from evigraph.llm import tokens

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model"]
BITS = ["the", "Annual", "it's", "we'd", "don't", "<|endoftext|>", "<|startoftext|>", "</s>", "42", "3.14", "é", "é", "İstanbul", "ΣΑΣ", "日本語", "naïve", " ", "\n", "\n\n", "\t", "  ", " ", " ", " ", " ", ".", "...", "!?", "_", "a_b", "\U0001f600", "'s", "‍", "x" * 40, "ab" * 9, "\x1c", " ", "▁"]


def whole(name):
    """Lengths by the library itself, a text at a time."""
    path = str(public_tokenizers.path(name))
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        return lambda x: len(t.encode(x, add_special_tokens=False).ids)
    if name.endswith(".model"):
        import sentencepiece

        s = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda x: len(s.encode(x))
    count, _, _ = tokens.counter(name)
    return lambda x: count([x])[0]


@pytest.mark.parametrize("name", FILES)
def test_pieces_have_as_many_tokens_as_the_whole(name):
    rng, one = random.Random(4), whole(name)
    count, boundary, left_out = tokens.counter(name)
    texts = ["", " ", "a", "a b", "aa bb\ncc dd"] + ["".join(rng.choice(BITS) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(1, 120))) for _ in range(150)]
    assert boundary is not None
    for size in (1, 7, 50, 10**6):
        assert tokens.lengths(texts, count, boundary, left_out, size, 300) == [one(x) for x in texts]
        assert sum(len(list(tokens.pieces(x, boundary, left_out, size))) for x in texts) > len(texts) or size > 50


@pytest.mark.parametrize("name", FILES)
def test_remembered_parts_have_as_many_tokens_as_the_whole(name):
    rng, one = random.Random(6), whole(name)
    count, boundary, left_out = tokens.counter(name)
    texts = ["", " ", "\n", "a", " a b ", "the man, the man\nthe man,"] + ["".join(rng.choice(BITS) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randrange(1, 120))) for _ in range(200)]
    want = [one(x) for x in texts]
    for short, most in ((64, 10**6), (3, 5), (0, 0)):
        kept = tokens.remembering(count, boundary, left_out, short, most)
        assert [n for i in range(0, len(texts), 9) for n in kept(texts[i : i + 9])] == want and kept(texts) == want


def test_words_met_again_are_not_encoded_each_time():
    seen = []

    def count(batch):
        seen.extend(batch)
        return [len(x.split()) for x in batch]

    kept = tokens.remembering(count, tokens.ANY, 1, 8, 100)
    assert tokens.lengths(["some, words. " * 3000, "words.\nsome,", "averylongword " * 5], kept, tokens.ANY, 1) == [6000, 2, 5] and kept(["some, averylongword"]) == [2]
    words = " ".join(seen).split()
    assert words.count("some,") == words.count("words.") == 2 and words.count("averylongword") == 6  # too long to be kept
    assert tokens.remembering(count, None) is count
    assert tokens.counter(tokens.VOCABULARY)[1:] == (tokens.ANY, 1) and tokens.counter("byte_bpe_50k.json")[1:] == (tokens.WHITE, 0)


def test_batches_are_balanced_by_bytes():
    seen = []

    def count(batch):
        seen.append(sum(len(x.encode()) for x in batch))
        return [len(x.split()) for x in batch]

    texts = ["word " * 4000, *["w x"] * 500, "y" * 9000, ""]
    assert tokens.lengths(texts, count, tokens.WHITE, 0, 100, 1000) == [4000, *[2] * 500, 1, 0]
    assert all(n <= 1000 for n in seen if n != 9000) and len(seen) < 60 and sorted(seen)[len(seen) // 2] > 800


def test_unknown_rules_are_not_split():
    split = {"type": "Split", "pattern": {"Regex": r"\s+"}, "behavior": "Removed", "invert": True}
    token = {"content": "<a>", "single_word": False, "lstrip": False, "rstrip": False}
    assert tokens._parts_at_white({"pre_tokenizer": split, "added_tokens": [token]})
    assert not tokens._parts_at_white({"pre_tokenizer": {"type": "Metaspace"}})
    assert not tokens._parts_at_white({"pre_tokenizer": None})
    assert not tokens._parts_at_white({"pre_tokenizer": split, "added_tokens": [{**token, "content": "a b"}]})
    assert not tokens._parts_at_white({"pre_tokenizer": split, "added_tokens": [{**token, "lstrip": True}]})
    with pytest.raises(ValueError):
        tokens.counter("/nowhere/x.unknown")


def test_rows_nulls_repeats_and_long_texts(spark):
    one = whole(tokens.VOCABULARY)
    long = "Some words\nof a long text, it's 2024 <|endoftext|> " * 20_000
    rows = [(1, "Hello World"), (1, "Hello World"), (2, None), (3, ""), (None, "null id"), (4, long), (5, "z" * 50_000), (6, "é" * 3), (7, "a " * 2048), (8, "a " * 2049)]
    docs = spark.createDataFrame([(i, t, 7, True) for i, t in rows], "doc_id long, text string, n_tokens int, over_limit boolean")
    out = tokens.count_tokens(docs)
    got = sorted(map(tuple, out.collect()), key=str)
    want = sorted(((i, len((t or "").encode()), one(t or ""), one(t or "") > 2048) for i, t in rows), key=str)
    assert got == want and out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert tokens.count_tokens(docs.limit(0)).count() == 0
    by_model = docs.where("doc_id = 1").select(tokens.token_column(F.col("text"), "piece_bpe_32k.model")).first()[0]
    assert by_model == whole("piece_bpe_32k.model")("Hello World")
    by_path = docs.where("doc_id = 1").select(tokens.token_column(F.col("text"), str(public_tokenizers.path(tokens.VOCABULARY)))).first()[0]
    assert by_path == one("Hello World")
