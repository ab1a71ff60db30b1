import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from smogline.llm import langid, quality
from smogline.llm.crf import marginals


def all_paths(scores, first, moves):
    """Marginals and expected transitions by listing every path."""
    out, pairs = np.zeros_like(scores), np.zeros_like(moves)
    for a, b in zip(first[:-1], first[1:]):
        paths = list(itertools.product(range(scores.shape[1]), repeat=b - a))
        if b == a:
            continue
        weight = np.array([sum(scores[a + i, s] for i, s in enumerate(p)) + sum(moves[x, y] for x, y in zip(p, p[1:])) for p in paths])
        weight = np.exp(weight - weight.max())
        weight /= weight.sum()
        for w, p in zip(weight, paths):
            for i, s in enumerate(p):
                out[a + i, s] += w
            for x, y in zip(p, p[1:]):
                pairs[x, y] += w
    return out, pairs


def test_forward_backward():
    r = np.random.default_rng(1)
    first = np.cumsum([0, 3, 0, 1, 6, 5])
    scores, moves = r.normal(size=(first[-1], 3)) * 2, r.normal(size=(3, 3))
    got, want = marginals(scores, first, moves, True), all_paths(scores, first, moves)
    assert np.allclose(got[0], want[0]) and np.allclose(got[1], want[1])


def test_long_sequences_do_not_depend_on_their_neighbours():
    r = np.random.default_rng(2)
    first = np.cumsum([0, 64, 1, 500, 0, 129])
    scores, moves = r.normal(size=(first[-1], 4)), np.eye(4) * 3
    together = marginals(scores, first, moves)[0]
    for a, b in zip(first[:-1], first[1:]):
        assert np.allclose(together[a:b], marginals(scores[a:b], np.array([0, b - a]), moves)[0])
    assert marginals(np.zeros((0, 2)), np.array([0, 0]), np.zeros((2, 2)), True)[0].shape == (0, 2)


def corpus(spark):
    clean = "It was a fine day in the town.\nPeople went to the market and bought bread.\n"
    rows, labels = [], []
    for i in range(120):
        bad = i % 3 == 0
        text = clean + " ".join(f"word{i + j}" for j in range(i % 7)) + "\n" + clean
        if bad:
            text = "\n".join(["BUY!! NOW!! CHEAP!! !!", "x | y | z | w | v", "aa aa aa aa aa aa"][: 1 + i % 4] * 4)
        rows.append((i, text, "en"))
        labels.append((i, 0 if bad else 1))
    rows += [(None, None, None), (500, "", "en"), (500, " \n", None), (501, "x" * 200_000, "en")]
    labels += [(None, 1), (3, 1), (501, None), (999, 0)]
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string"),
            spark.createDataFrame(labels, "doc_id long, quality int"))


def test_quality(spark):
    docs, labels = corpus(spark)
    model = quality.fit_on(docs, labels)
    out = quality.scored(docs, model).collect()
    assert len(out) == docs.count()
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.id is not None and zlib.crc32(str(r.id).encode()) % 5 == 0)
        if r.id is not None and r.id < 120:
            assert r.predicted == int(r.id % 3 != 0)
        if r.id is None or r.id == 500:
            assert r.score == pytest.approx(model.prior)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in out)
    assert quality.scored(docs.limit(0), model).count() == 0


def test_quality_uses_neither_labels_of_held_out_rows_nor_other_columns(spark):
    docs, labels = corpus(spark)
    flipped = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = quality.fit_on(docs, labels), quality.fit_on(docs.withColumn("lang", F.lit("xx")), flipped)
    assert np.array_equal(one.weights, two.weights) and one.offset == two.offset
    assert quality.fit_on(docs, labels.limit(0)).prior == 0.5


def test_quality_held_out(spark):
    path = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.scored(docs, quality.fit_on(docs, labels)).join(labels.withColumnRenamed("doc_id", "id"), "id")
    rows = out.where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    assert all(r.predicted for r in rows if r.quality)


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.predicted(docs, langid.fit_on(docs)).join(docs.withColumnRenamed("doc_id", "id"), "id")
    rows = out.where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows)


def test_language_cases(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit_on(docs)
    rows = [(None, None), (1, ""), (1, "1234 … — 5!"), (2, "١٢٣"), (3, "the and of that with"), (4, "\n" * 1000), (5, "the " * 60_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.id, r.lang_pred, r.score) for r in langid.predicted(df, model).collect()]
    assert [g[1] for g in got] == ["und"] * 4 + ["en", "und", "en"]
    assert all(0 <= g[2] <= 1 for g in got) and [g[2] for g in got[:4]] == [0.0] * 4
    none = langid.fit_on(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in langid.predicted(df, none).collect()} == {"und"}
    words = langid.labels("the and with of that, und der die einung keit. le la des pour dans", model)
    assert [w[1] for w in words] == ["en"] * 5 + ["de"] * 5 + ["fr"] * 5
