"""Extra columns with clashing names, empty tables and very long texts, for operators that other tests do not cover so."""

import pytest
from pyspark.sql import functions as F

from smogline.llm import langid, licenses, near_dedup, pii, quality, token_files
from smogline.llm.catalog import byte_bpe

CLASH = ["id", "row", "words", "key", "kind", "n", "label", "match", "start", "end", "features", "score", "held", "part", "at", "ids", "level"]


def with_more(docs):
    """The same rows with other columns of the names that operators use inside."""
    return docs.select("doc_id", "text", "lang", *[F.lit("x").alias(c) for c in CLASH])


def same(one, two):
    rows = lambda frame: sorted(map(str, frame.collect()))
    assert one.columns == two.columns and rows(one) == rows(two)


@pytest.fixture(scope="module")
def docs(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    return rows.where("doc_id < 80")


@pytest.fixture(scope="module")
def labels(spark, small):
    return spark.read.parquet(f"{small}/labels.parquet")


def test_quality(spark, docs, labels):
    model = quality.fit_on(docs, labels)
    same(quality.scored(docs, model), quality.scored(with_more(docs), quality.fit_on(with_more(docs), labels)))
    assert quality.scored(docs.limit(0), quality.fit_on(docs.limit(0), labels)).count() == 0


def test_language(spark, docs):
    model = langid.fit_on(docs)
    same(langid.predicted(docs, model), langid.predicted(with_more(docs), langid.fit_on(with_more(docs))))
    nothing = langid.fit_on(docs.limit(0))
    assert langid.predicted(docs.limit(0), nothing).count() == 0
    assert {r.lang_pred for r in langid.predicted(docs, nothing).collect()} == {"und"}


def test_licenses_and_personal_data(spark, docs):
    same(licenses.scan(docs), licenses.scan(with_more(docs)))
    same(pii.personal_data(docs), pii.personal_data(with_more(docs)))


def test_token_files(spark, docs, tmp_path):
    for name, frame in (("a", docs), ("b", with_more(docs))):
        token_files.write_token_files(frame, str(tmp_path / name), byte_bpe())
    read = lambda name: token_files.read_token_files(spark, str(tmp_path / name)).select("id", "n_tokens", "ids")
    same(read("a"), read("b"))


def test_very_long_texts(spark, tmp_path):
    long = "the quick brown fox jumps over a dog " * 20000 + "write joe@example.org or 10.0.0.1 now"
    rows = [(1, long), (2, long), (3, long.replace("quick", "slow", 3)), (4, "short text of some six words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = {r.id: r.component_id for r in near_dedup.near_groups(docs).collect()}
    assert groups == {1: 1, 2: 1, 3: 1, 4: 4} or groups == {1: 1, 2: 1, 3: 3, 4: 4}
    spans = {r.id: [s.kind for s in r.base] for r in pii.personal_data(docs).collect()}
    assert spans == {1: [0, 1], 2: [0, 1], 3: [0, 1], 4: []}
    token_files.write_token_files(docs, str(tmp_path / "t"), byte_bpe(), shard_ids=1000)
    sizes = {r.id: r.n_tokens for r in token_files.read_token_files(spark, str(tmp_path / "t")).collect()}
    assert sizes[1] == sizes[2] > 100_000 and sizes[4] < 20
