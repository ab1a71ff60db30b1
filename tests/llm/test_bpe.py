import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from smogline.llm.bpe import (
    Decoder, Encoder, PieceCache, StreamEncoder, byte_alphabet, decode_ids, encode_checked, encode_texts, round_trip,
    vocabulary,
)
from smogline.llm.catalog import byte_bpe

PATH = byte_bpe()
WORDS = ["the", "a", "don't", "we're", "'", " ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "ñandú", "日本", "1", "²",
         "٣", "😀", "-", "--------", "=-", "́", "<|endoftext|>", "<|endof", "123456", "Q", "ǅ"]
TEXTS = st.lists(st.sampled_from(WORDS) | st.text(max_size=3), max_size=25).map("".join)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(1, 9))
def test_same_as_the_library(library, text, step):
    v = vocabulary(PATH)
    want = library.encode(text, add_special_tokens=False).ids
    assert Encoder(v).encode(text).tolist() == want
    stream, got = StreamEncoder(v, PieceCache(1000)), b""
    for i in range(0, len(text), step):
        got += stream.feed(text[i : i + step])
    assert np.frombuffer(got + stream.feed("", True), v.dtype).tolist() == want
    assert Decoder(v).decode(np.array(want, int)) == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", [
    "a" * 5000, " " * 3000, "\n " * 2000 + "x", "é" * 3000, "ab" * 4000 + " c", "1234567890" * 800,
    "-" * 5000 + "'re", "'" * 3000 + "s", "x" * 700 + "  " * 800 + "y", "ÃÂ" * 3000, " " + "=-" * 3000,
    "　" * 1000 + " " * 1000 + "a", "  " + "9" * 3000,
    "".join(random.Random(1).choice("theandingoressi") for _ in range(20000)),
])
def test_long_pieces_are_streamed(library, text):
    v = vocabulary(PATH)
    want = library.encode(text, add_special_tokens=False).ids
    assert Encoder(v).encode(text).tolist() == want
    stream, got, most = StreamEncoder(v, PieceCache(1000)), b"", 0
    for i in range(0, len(text), 37):
        got += stream.feed(text[i : i + 37])
        rest = len(stream.run[1].rest) if stream.run else 0
        most = max(most, rest + len(stream.text) + len(stream.tail))
    assert np.frombuffer(got + stream.feed("", True), v.dtype).tolist() == want
    assert most < 4 * v.lookahead + 400


def test_every_text_goes_through_the_transducer_in_blocks(library, monkeypatch):
    from smogline.llm import bpe
    seen, feed = [], StreamEncoder.feed
    monkeypatch.setattr(StreamEncoder, "feed", lambda self, part, last=False: seen.append(len(part)) or feed(self, part, last))
    monkeypatch.setattr(bpe, "_BLOCK", 100)
    text = "the cat <|endoftext|>" * 30 + "x" * 900 + " we're\n\n here " * 40
    encoder = Encoder(vocabulary(PATH))
    assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert sum(seen) == len(text) and max(seen) == 100 and len(list(encoder.stream(text))) == len(seen) / 2


def test_cache_is_bounded_by_bytes():
    cache = PieceCache(5000)
    for i in range(2000):
        assert cache.join([f"p{i}", "a"], lambda pieces: [p.encode() for p in pieces]) == f"p{i}a".encode()
    assert len(cache.young) + len(cache.old) <= 2 * (5000 // 200 + 1)


def test_rows_go_on_in_blocks_of_bytes(spark, monkeypatch, library):
    rows = [(i, "word é " * 3000 if i % 3 else None, "x") for i in range(300)] + [(None, "null id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").coalesce(1)
    got = encode_checked(docs, PATH).selectExpr("id", "n_tokens", "size(ids) = n_tokens as whole", "restored").collect()
    n = len(library.encode("word é " * 3000, add_special_tokens=False).ids)
    assert all(r.whole and r.restored for r in got) and len(got) == 301
    assert {r.n_tokens for r in got if r.id is not None and r.id % 3} == {n}


def test_bytes_that_are_no_text(library):
    v, r = vocabulary(PATH), random.Random(2)
    for _ in range(300):
        ids = [v.single[r.randrange(256)] for _ in range(r.randint(0, 12))]
        assert Decoder(v).decode(np.array(ids, int)) == library.decode(ids, skip_special_tokens=False)
        parts = [np.array([i]) for i in ids]
        assert "".join(Decoder(v).stream(parts)) == library.decode(ids, skip_special_tokens=False)


def test_alphabet_and_other_kinds():
    assert len(byte_alphabet()) == len(set(byte_alphabet().values())) == 256
    with pytest.raises(ValueError):
        vocabulary(PATH.replace("byte_bpe_50k", "word_bpe_49k"))


def test_tables(spark, library, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(None, None), (1, ""), (1, ""), (-3, "a  b <|endoftext|>\n")], docs.schema)
    docs = docs.union(extra)
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = sorted((str(i), library.encode(t, add_special_tokens=False).ids, t) for i, t in rows)
    encoded = encode_texts(docs, PATH)
    assert sorted((str(r.id), r.ids) for r in encoded.collect()) == [w[:2] for w in want]
    assert sorted((str(r.id), r.text) for r in decode_ids(encoded, PATH).collect()) == [(w[0], w[2]) for w in want]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = sorted((str(r.id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in round_trip(docs, PATH).collect())
    assert got == sorted((i, len(x), sha(",".join(map(str, x))), sha(t)) for i, x, t in want)
    assert round_trip(docs.limit(0), PATH).count() == 0
