"""Counts against the libraries on whole texts; cuts against whole encodings."""

import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from smogline.llm import cuts, token_counts

BYTES, PIECES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))
HARD = [
    None, "", " ", "   ", "\n", "a", " a", "a ", "a  ", "a b", "a  b", "it's 's", "x'll5'll", "a\n\n b\t c", "tab\tand\x1cfile sep",
    "<|endoftext|>", "a<|endoftext|> b", " <|endoftext|><|endoftext|>x", "<|endof text|>", "日本語のテキスト。次の文", "é é",
    " x y　 z", "﻿bom", "emoji 👩‍👩‍👧 end", "▁under▁", "<s> </s> <unk> <0x0A>", "\x00a\x00 b", "é" * 50 + " " + "1" * 40,
    "x" * 6000, "ab1" * 3000, "9" * 5000 + "a'll" * 2000, "!" * 5000, " " * 5000 + "a", "a<|endoftext|>1" * 800,
]


def library(path):
    if path.endswith(".json"):
        one = Tokenizer.from_file(path)
        return lambda t: len(one.encode(t, add_special_tokens=False))
    one = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda t: len(one.encode(t))


@pytest.mark.parametrize("path", [BYTES, PIECES, WORDS])
def test_counts_equal_the_library(spark, monkeypatch, path):
    words = ["the", "of", "x1", "don't", "\n", "  ", "é", "<|endoftext|>", "日本", "...", "A_b"]
    rng = random.Random(1)
    texts = HARD + [" ".join(rng.choices(words, k=rng.randrange(60))) for _ in range(40)]
    texts += ["".join(rng.choices(words, k=40)) for _ in range(40)] + texts[:3]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "null id", "x")], "doc_id long, text string, id string")
    count = library(path)
    got = {r.id: (r.n_bytes, r.n_tokens) for r in token_counts.token_counts(docs, path).collect()}
    want = {i: (len((t or "").encode()), count(t) if t else 0) for i, t in enumerate(texts)} | {None: (7, count("null id"))}
    assert got == want


@pytest.mark.parametrize("path", [BYTES, PIECES])
def test_long_texts_come_in_parts(monkeypatch, path):
    import pyarrow as pa

    monkeypatch.setattr(cuts, "PART", 50)
    monkeypatch.setattr(cuts.parts, "__defaults__", (False, 50))
    monkeypatch.setattr(token_counts, "BLOCK_BYTES", 120)
    monkeypatch.setattr(token_counts, "BATCH_BYTES", 30)
    monkeypatch.setattr(token_counts, "LONG_RUN", 20)
    texts = [t for t in HARD if t and len(t) < 400] * 2 + ["one two  three\n four " * 40, "run" * 100 + " end", "a'll9" * 50]
    by, count = token_counts.counter(path), library(path)
    totals = [0] * len(texts)
    for numbers, parts in token_counts._blocks(pa.array(texts), by):
        for number, n in zip(numbers, token_counts.counted(parts, by)):
            totals[number] += n
    assert totals == [count(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1'sl \n\t.é́日。<|>\x1c　▁", max_size=40))
def test_cuts_are_safe(text):
    one = Tokenizer.from_file(BYTES) if not hasattr(test_cuts_are_safe, "one") else test_cuts_are_safe.one
    test_cuts_are_safe.one = one
    encode = lambda t: one.encode(t, add_special_tokens=False).ids
    assert "".join(cuts.words(text)) == text
    assert [i for p in cuts.words(text) for i in encode(p)] == encode(text)
    for word in cuts.words(text):
        assert [i for p in cuts.run_parts(word, ["<|endoftext|>"]) for i in encode(p)] == encode(word)
    assert "".join(cuts.spaced_words(" " + text)) == " " + text


def test_batches_are_balanced():
    parts = ["a" * n for n in (1, 5, 200, 3, 90, 20)] + ["é" * 40]
    batches = list(token_counts.balanced(parts, 100))
    assert [p for b in batches for p in b] == parts
    assert all(sum(len(p.encode()) for p in b) <= 100 or len(b) == 1 for b in batches)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.token_counts(empty, BYTES).collect() == []
