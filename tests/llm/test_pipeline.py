import random

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from smogline.llm import near_dedup, quality
from smogline.llm.catalog import byte_bpe
from test_decontaminate import brute as hits
from test_exact_dedup import LOWER
from test_near_dedup import brute as groups

SF = "/root/testdata/sf0.01"


def plain(rows, predicted, items):
    """The ids and tokens that are left, by plain loops."""
    rows = [r for r in rows if predicted[r[0]]]
    best = {}
    for d, t in rows:
        key = (t or "").translate(LOWER)
        best[key] = max(best.get(key, d), d)
    rows = [(d, t) for d, t in rows if best[(t or "").translate(LOWER)] == d]
    rows = [r for r, g in zip(rows, groups(rows)) if g[0] == g[2]]
    rows = [r for r, h in zip(rows, hits(rows, items)) if h[2] == 0]
    library = Tokenizer.from_file(byte_bpe())
    return sorted((d, library.encode(t, add_special_tokens=False).ids) for d, t in rows)


def test_same_as_plain_loops(spark):
    docs, labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    predicted = {r.id: r.predicted for r in quality.scored(docs, quality.fit_on(docs, labels)).collect()}
    want = plain([(r.doc_id, r.text) for r in docs.collect()], predicted, [tuple(r) for r in bench.collect()])
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.ids) for r in got) == want
    assert all(r.restored and r.n_tokens == len(r.ids) for r in got)


def test_stages_take_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    long = " ".join(f"w{i}" for i in range(20000))
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "a b", "en", "s", 3),
            (2, "a b", "en", "s", 3), (3, "A b", None, "s", 3), (4, long, "en", None, None)]
    df = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        for docs in (df, df.limit(0)):
            out = stage(spark, docs, SF)
            assert name == "bpe" or out.columns == docs.columns
            out.collect()


def test_one_of_each_group_stays(spark):
    r = random.Random(1)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(30):
        words = list(base)
        words[r.randrange(100)] = f"x{i}"
        rows.append((i // 2, " ".join(words), i))  # ids repeat
    rows += [(3, rows[6][1], 100), (None, " ".join(base), 101), (50, "", 102), (50, "", 103), (None, None, 104), (51, "other", 105)]
    df = spark.createDataFrame(rows, "doc_id long, text string, doc int")
    got = near_dedup.drop_near(df)
    assert got.columns == df.columns
    left = sorted(r.doc for r in got.collect())
    assert len(left) == 5 and left[0] in (0, 1) and left[1:] == [102, 103, 104, 105]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_names(name):
    assert len(name) <= 40
