import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from smogline.llm import near_dedup
from smogline.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, size=5):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    if len(w) < size:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def brute(rows):
    """[(id, n, component id)] by all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    low = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return [(d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(rows)]


def same(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.id, r.n_shingles, r.component_id) for r in near_dedup.near_groups(df, **kw).collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def corpus(seed):
    """Copies, chains of near copies around the threshold, and a passage in half of all texts."""
    r = random.Random(seed)
    fresh = lambda n: [f"w{r.randint(0, 5000)}" for _ in range(n)]
    passage, rows = fresh(40), []

    def add(words):
        rows.append((len(rows) * 3 + r.randint(0, 2), r.choice([" ", "\n"]).join(words)))

    for _ in range(40):
        base = fresh(r.randint(1, 250))
        if r.random() < 0.5:
            base[1:1] = passage
        add(base)
        for _ in range(r.choice([0, 0, 1, 5])):
            words = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 25))):
                words[r.randrange(len(words))] = f"x{r.randint(0, 9)}"
            add([w.upper() for w in words] if r.random() < 0.2 else words)
            if r.random() < 0.3:
                base = words
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_all_pairs(spark, seed):
    same(spark, corpus(seed))


def test_star_whose_base_is_not_the_centre(spark):
    r = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):  # variants are linked with the base, hardly with each other
        words = list(base)
        for at in r.sample(range(300), 10):
            words[at] = f"v{i}"
        rows.append((i, " ".join(words)))
    rows.append((99, " ".join(base)))
    same(spark, rows)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [
        (1, None), (2, ""), (3, " \n"), (None, "a b"), (None, "A B"), (7, "a b c"), (7, "a b c"),
        (7, "a b c d"), (8, "a b c d e"), (9, "a b c d e f"), (10, long), (11, long + " x"),
        (12, "É a b"), (13, "é a b"), (14, "a\x1cb"), (15, "a b"),
    ]
    same(spark, rows)
    same(spark, [])


def test_other_columns_are_left_alone(spark):
    df = spark.createDataFrame([(1, "a b", 2, None), (2, "a b", 1, 3.0)],
                               "doc_id long, text string, key int, n double")
    assert {(r.id, r.component_id) for r in near_dedup.near_groups(df).collect()} == {(1, 1), (2, 1)}


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    same(spark, [(r.doc_id, r.text) for r in docs.collect()])


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text("ab \né", max_size=40), max_size=5))
def test_sets(texts):
    import pyarrow as pa

    got = [len(s) for s in near_dedup.shingle_sets(pa.array(texts, pa.string()), 3)]
    assert got == [len(shingles(t, 3)) for t in texts]


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 160)]
    got = {x.v: x.comp for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {v: v for e in edges for v in e}
    for _ in want:
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
    assert got == want
