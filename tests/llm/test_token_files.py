import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from smogline.llm.catalog import byte_bpe, op10_token_files
from smogline.llm.elias_fano import EliasFano
from smogline.llm.token_files import (
    LibraryEncoder, Shard, _documents, read_token_files, shard_bytes, starts, write_token_files,
)


def test_new_pieces_are_merged_without_a_whole_encoding_each():
    """Pieces go to the library's merges; only a text with a special token is encoded whole."""
    encoder, plain = LibraryEncoder(byte_bpe()), Tokenizer.from_file(byte_bpe())
    whole, asked = [], encoder._asked
    encoder._asked = lambda texts: whole.extend(texts) or asked(texts)
    special = min(encoder.special)
    texts = ["It's 's we'll  go\n\n 'x 12ab _é ñandú\t", "\r\n a  ", "Ċ 漢字　x 😀", "".join(map(chr, range(1, 700))),
             "x" * 600 + " " + "y" * 700, f"a {special} b", "'s\n'll're'd'm've't'"]
    for text in texts * 2:
        assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == plain.encode(text, add_special_tokens=False).ids
    assert whole == [texts[5]] * 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**63 - 1) | st.integers(0, 50), max_size=700))
def test_elias_fano(values):
    values = np.sort(np.array(values, np.uint64))
    back, end = EliasFano.read(b"xyz" + (raw := EliasFano.of(values).to_bytes()), 3)
    assert end == 3 + len(raw) and back.between(0, len(back)).tolist() == values.tolist()
    assert [back[i] for i in range(len(back))] == values.tolist()


def test_size_and_select():
    r = np.random.default_rng(1)
    values = np.cumsum(r.integers(0, 2000, 50_000)).astype(np.uint64)
    ef = EliasFano.of(values)
    bits = 8 * len(ef.to_bytes()) / len(values)
    assert bits < 2.3 + np.log2(values[-1] / len(values))
    for i in r.integers(0, len(values), 300):
        assert ef[int(i)] == values[i]
    with pytest.raises(IndexError):
        ef[len(values)]
    sparse = EliasFano.of(np.sort(np.concatenate([r.integers(0, 50, 600), 2**40 + r.integers(0, 50, 600)])))
    for of in (ef, sparse):
        whole = [of[i] for i in range(1200)]
        for lo, hi in ((0, 1), (0, 512), (255, 257), (512, 1024), (599, 601), (1199, 1200), (7, 7)):
            assert of.between(lo, hi).tolist() == whole[lo:hi]


def test_shard():
    docs = [np.arange(n, dtype="<u2").tobytes() for n in (1, 5, 0, 3)]
    shard = Shard(shard_bytes(2, 7, [None, -5, -5, 2**62], docs, np.dtype("<u2")))
    assert (shard.part, shard.number, len(shard), shard.n_ids) == (2, 7, 4, 9)
    assert [shard.doc_id(i) for i in range(4)] == [None, -5, -5, 2**62]
    assert [shard.document(i).tolist() for i in range(4)] == [[0], [0, 1, 2, 3, 4], [], [0, 1, 2]]
    for lo in range(4):
        for hi in range(lo + 1, 5):
            assert shard.doc_ids_of(lo, hi) == [None, -5, -5, 2**62][lo:hi]
            assert list(zip(*(x.tolist() for x in shard.spans(lo, hi)))) == [shard.span(i) for i in range(lo, hi)]


def test_documents_are_read_by_select(spark, tmp_path, monkeypatch):
    """Nothing in the library unpacks a whole list of boundaries."""
    docs = spark.createDataFrame([(i, "a b " * (i % 7), "x") for i in range(3000)], "doc_id long, text string, ids string")
    write_token_files(docs.coalesce(1), str(tmp_path / "t"), byte_bpe())
    (path,) = (tmp_path / "t").glob("part-*")
    seen, between = [], EliasFano.between
    monkeypatch.setattr(EliasFano, "between", lambda self, lo, hi: seen.append(hi - lo) or between(self, lo, hi))
    (shard,) = Shard.all(path.read_bytes())
    rows = [r for b in _documents(shard) for r in b.to_pylist()]
    assert [r["id"] for r in rows] == list(range(3000)) and max(seen) <= 513
    assert [r["n_tokens"] for r in rows] == [shard.span(i)[1] - shard.span(i)[0] for i in range(3000)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["the", " a", "'re", "\n", "  ", "<|endoftext|>", "é"]), max_size=12).map("".join))
def test_words_are_encoded_as_the_whole(text):
    encoder = LibraryEncoder(byte_bpe())
    want = Tokenizer.from_file(byte_bpe()).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text), "<u2").tolist() == want


@pytest.mark.parametrize("options", [{}, {"part_bytes": 20_000, "shard_ids": 3000}])
def test_files(spark, small, tmp_path, options):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    extra = [(None, None), (None, "b"), (-4, ""), (2**62, "a\nb"), (7, "x"), (7, "x")]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    path = str(tmp_path / "t")
    write_token_files(docs, path, byte_bpe(), **options)
    library = Tokenizer.from_file(byte_bpe())
    rows = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in docs.collect()]
    got = read_token_files(spark, path).join(starts(spark, path), ["part", "number"]).collect()
    got = [(r.before + r["at"], r.id, np.frombuffer(r.ids, "<u4").tolist()) for r in got]
    got.sort(key=lambda r: r[0])
    place = 0
    for start, _, ids in got:
        assert start == place
        place += len(ids)
    order = [(r[1] is not None, r[1] or 0) for r in got]
    assert order == sorted(order)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted([g[1:] for g in got], key=key) == sorted(rows, key=key)


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()
    library, place, want = Tokenizer.from_file(byte_bpe()), 0, []
    for r in docs:
        ids = np.array(library.encode(r.text, add_special_tokens=False).ids + [2], "<u4")
        want.append((r.doc_id, place, len(ids), zlib.crc32(ids.tobytes())))
        place += len(ids)
    got = op10_token_files(spark, small).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want


def test_no_rows(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    write_token_files(df, str(tmp_path / "t"), byte_bpe())
    assert read_token_files(spark, str(tmp_path / "t")).count() == 0


def test_random_access_grows_with_nothing():
    r = random.Random(1)
    docs = [bytes(2 * r.randint(0, 9)) for _ in range(2000)]
    shard = Shard(shard_bytes(0, 0, list(range(2000)), docs, np.dtype("<u2")))
    assert [len(shard.document(i)) * 2 for i in (0, 255, 256, 1999)] == [len(docs[i]) for i in (0, 255, 256, 1999)]
