import hashlib
import random
import re

import pytest

from smogline.llm.substring_dedup import remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size):
    """{(id, text): (n_words, n_removed, kept)} by a dictionary of all windows."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    seen, out = set(), []
    for doc, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            key = tuple(words[i : i + size])
            if key in seen:
                gone[i : i + size] = [True] * size
            seen.add(key)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc, len(words), sum(gone), kept))
    return out


def same(spark, rows, size, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in remove_repeats(df, size=size, **kw).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[3], r[1:])
    assert sorted(got, key=key) == sorted(brute(rows, size), key=key)


def corpus(seed, n=60):
    r = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 3 else f"w{i}" for i in range(400)]
    passages = [[r.choice(vocabulary) for _ in range(r.randint(5, 40))] for _ in range(6)]
    rows = []
    for doc in range(n):
        words = [r.choice(vocabulary) for _ in range(r.randint(0, 60))]
        for p in r.sample(passages, r.randint(0, 3)):
            at = r.randint(0, len(words))
            words[at:at] = p
        rows.append((doc * 7, r.choice([" ", "  ", "\n", "\t "]).join(words)))
    rows += [(1000, rows[3][1]), (1001, rows[3][1] + " " + rows[3][1]), (1002, "a " * 50)]
    return rows


@pytest.mark.parametrize("chunk_bytes, slice_bits", [(1 << 24, 22), (700, 6), (100, 4)])
def test_same_as_all_windows(spark, chunk_bytes, slice_bits):
    same(spark, corpus(1), 5, chunk_bytes=chunk_bytes, slice_bits=slice_bits)


def test_edges(spark):
    rows = [
        (None, "a b c a b c"), (None, "a b c a b c"), (5, None), (5, ""), (5, "a b c a b c"),
        (5, "a b c a b c"), (6, "\x0b\x0c"), (7, "x\x1cy z"), (8, "x\x1cy z x\x1cy z"),
        (9, "é " * 3000),
    ]
    same(spark, rows, 2)
    same(spark, rows, 2, chunk_bytes=10, slice_bits=3)
    same(spark, [], 2)


def test_other_columns_are_left_alone(spark):
    df = spark.createDataFrame(
        [(1, "a b", 0, None), (2, "a b", 1, "x")],
        "doc_id long, text string, chunk int, kept string",
    )
    got = {r.id: r.kept for r in remove_repeats(df, size=2).collect()}
    assert got == {1: "a b", 2: ""}


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.id: (r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest())
           for r in remove_repeats(docs, chunk_bytes=50_000, slice_bits=12).collect()}
    want = {d: (n, m, hashlib.sha256(k.encode()).hexdigest()) for d, n, m, k in brute(rows, 20)}
    assert got == want
