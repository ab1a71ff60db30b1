"""Alignment against a plain version on whole texts."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from smogline.llm import alignment
from smogline.llm.bpe import byte_alphabet
from smogline.llm.csr import Csr, row_products

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "  ", "a", "a b", " lead", "trail ", "trail  ", "two  spaces\n\nlines\t tab", "it's the cat's",
    "<|endoftext|> here</s> <s>", "<0x0A> <unk>", "under▁score", "naïve café résumé", "日本語 テキスト。", "emoji 👩‍👩‍👧!",
    "x" * 300, "1234567890 12 3", "\x00nul", "  nbsp　wide", "the cat sat on the mat", "the cat sat on the mat",
    "\n", "a\n", "\ta b", "é", "return x;\n    }\n",
]


def plain(texts):
    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    alphabet = byte_alphabet()

    def b_bytes(i):
        return bytes([int(two.id_to_piece(i)[3:-1], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode()

    docs, rows = [], []
    for text in texts:
        a = one.encode(" " + text, add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        sa = [bytes(alphabet[c] for c in one.id_to_token(i)) for i in a]
        sb = [b_bytes(i) for i in b]
        want = (" " + (text or "")).encode()
        if not text or b"".join(sa) != want or b"".join(sb) != want:
            a, b, sa, sb = [], [], [], []
        ea, eb = np.cumsum([len(x) for x in sa], dtype=int), np.cumsum([len(x) for x in sb], dtype=int)
        links = [(i, j) for i in range(len(a)) for j in range(len(b))
                 if max(ea[i] - len(sa[i]), eb[j] - len(sb[j])) < min(ea[i], eb[j])]
        common = sorted(set(ea.tolist()) & set(eb.tolist()))
        group = lambda ends, at: next(g for g, e in enumerate(common) if ends[at] <= e)
        groups = [([], []) for _ in common]
        for side, (ids, ends) in enumerate(((a, ea), (b, eb))):
            for at, i in enumerate(ids):
                groups[group(ends, at)][side].append(i)
        listed = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        docs.append([(a[i], b[j]) for i, j in links])
        rows.append([len(a), len(b), len(common), len(links), sum(len(x) * len(y) for x, y in groups),
                     hashlib.sha256(listed.encode()).hexdigest() if a else ""])
    count = Counter(p for d in docs for p in set(d))
    most = defaultdict(int)
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    return [(*r[:5], sum(count[p] == most[p[0]] for p in d), sum(count[p] for p in d), r[5]) for r, d in zip(rows, docs)]


@pytest.mark.parametrize("chunk", [1 << 23, 40, 1])
def test_equals_the_plain_version(spark, chunk):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, pair string")
    got = {r.id: tuple(r)[1:] for r in alignment.aligned(docs.coalesce(2), A, B, chunk_bytes=chunk).collect()}
    assert got == dict(enumerate(plain(TEXTS)))


def test_real_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("length(text) < 1500").orderBy("doc_id").limit(60)
    rows = docs.collect()
    got = {r.id: tuple(r)[1:] for r in alignment.aligned(docs, A, B, chunk_bytes=4000).collect()}
    assert got == dict(zip([r.doc_id for r in rows], plain([r.text for r in rows])))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab1's \n\t.é́日。<|>\x1c　", min_size=1, max_size=40))
def test_parts_are_safe_for_both(text):
    by = alignment.pair(A, B)
    parts = [p for x in by.parts(text) for p in x]
    assert "".join(parts) == " " + text
    a, b = by.encode(parts)
    assert [i for x in a for i in x] == by.a.encode(" " + text, add_special_tokens=False).ids
    assert [i for x in b for i in x] == by.b.encode(text)


def test_long_texts_come_in_parts(monkeypatch):
    monkeypatch.setattr(alignment.cuts.parts, "__defaults__", (False, 30))
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 20)
    texts = [t for t in TEXTS if t] + ["one two  three\n four " * 20]
    by = alignment.pair(A, B)
    for text, want in zip(texts, plain(texts)):
        first = next(alignment._chunk(0, [1], [text], by)).to_pylist()[0]
        assert (first["n_a"], first["n_b"], first["n_groups"], first["n_links"], first["n_shared"], first["groups_sha256"]) == (*want[:5], want[7])


def test_links(spark):
    docs = spark.createDataFrame([(1, "Übermut tut selten gut"), (2, "under▁score"), (3, None)], "doc_id long, text string")
    links = alignment.token_links(docs, A, B).collect()
    assert {r.id for r in links} == {1}
    assert sum(r.n_bytes for r in links) == len(" Übermut tut selten gut".encode())
    shared = alignment.token_links(docs, A, B, shared=True).count()
    (want,) = plain(["Übermut tut selten gut"])
    assert (len(links), shared) == (want[3], want[4])


def test_products_equal_dense_ones():
    rng = np.random.default_rng(3)

    def matrix(dense):
        start = np.concatenate([[0], np.cumsum((dense > 0).sum(1))])
        return Csr(start, np.nonzero(dense)[1], dense.shape[1], dense[dense > 0])

    for _ in range(20):
        left, right = rng.integers(0, 3, (7, 5)) * (rng.random((7, 5)) < 0.5), rng.integers(0, 3, (5, 6)) * (rng.random((5, 6)) < 0.5)
        out = np.zeros((7, 6), int)
        for rows, columns, values in row_products(matrix(left), matrix(right), most=4):
            out[rows, columns] += values
        assert (out == left @ right).all()
        back = matrix(left).transposed()
        assert (np.concatenate([[0], np.cumsum((left.T > 0).sum(1))]) == back.start).all()


def test_packed_matrix():
    row, column, times = np.array([0, 0, 2, 2, 5]), np.array([3, 9, 0, 70000, 1]), np.array([1, 4, 1, 1, 2])
    assert all((x == y).all() for x, y in zip(alignment._unpacked(alignment._packed(row, column, times)), (row, column, times)))
    assert all(len(x) == 0 for x in alignment._unpacked(alignment._packed(row[:0], column[:0], times[:0])))


def test_empty_table(spark):
    assert alignment.aligned(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []
