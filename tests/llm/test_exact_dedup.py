import hashlib
import random

import pytest

from smogline.llm.exact_dedup import RepeatFilter, drop_copies, mark_copies

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(d)
    out = []
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        free = 1
        for i in ids:
            kept = i == best and free
            free -= bool(kept)
            out.append((i, best, len(ids), bool(kept), hashlib.sha256(text.encode()).hexdigest()))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r[:4]) + (r[4],))


def corpus():
    r = random.Random(1)
    rows = [(i, "".join(r.choice("aAbBé \n") for _ in range(r.randint(0, 6)))) for i in range(800)]
    rows += [(1000 + i, "Hot " * 50) for i in range(500)] + [(None, "n"), (None, "N"), (5, None), (5, ""), (5, "É")]
    return rows + [(3000, "x"), (3000, "X"), (3001, "ſ"), (3002, "K"), (3003, "k")]


@pytest.mark.parametrize("options", [{}, {"bits_per_row": 1, "probes": 2},
                                     {"bits_per_row": 4096, "filter_bytes": 1 << 17}])
def test_same_as_a_dictionary(spark, options):
    df = spark.createDataFrame(corpus(), "doc_id long, text string").repartition(7)
    got = [(r.id, r.keep_id, r.group_size, r.kept, r.key.hex()) for r in mark_copies(df, **options).collect()]
    assert ordered(got) == ordered(brute(corpus()))


def test_rounds():
    assert RepeatFilter(10).rounds == 1
    assert RepeatFilter(1 << 30).rounds == 1 << 6  # 2 GB of bits, 32 MB at a time


def test_filter_lets_few_single_rows_pass(spark):
    df = spark.range(20000).selectExpr("unhex(sha2(cast(id as string), 256)) as key")
    sized = RepeatFilter(20000)
    n = df.where(sized.test(spark, sized.build(df))("key")).count()
    assert n < 400


@pytest.mark.parametrize("options", [{}, {"bits_per_row": 4096, "filter_bytes": 1 << 17}])
def test_drop_copies(spark, options):
    rows = [(d, t, i, None) for i, (d, t) in enumerate(corpus())]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int, maybe string")
    got = drop_copies(df, **options)
    assert got.columns == df.columns
    got = got.collect()
    assert len({r.key for r in got}) == len(got)
    kept = lambda x: sorted((d, t) for d, t in x if d is not None)
    assert kept((r.doc_id, (r.text or "").translate(LOWER)) for r in got) == kept(
        (b[0], next((t or "").translate(LOWER) for _, t in corpus()
                    if hashlib.sha256((t or "").translate(LOWER).encode()).hexdigest() == b[4]))
        for b in brute(corpus()) if b[3])


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert mark_copies(df).count() == 0 and drop_copies(df).count() == 0
