"""Every registered query: against its SQL where there is one, and its columns."""

import pytest

import __spark_entry__
import oracle_check
from smogline.llm import catalog
from smogline.llm.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = {
    "op1_substring_dedup": "doc_id:bigint n_words:bigint n_removed:bigint kept_sha256:string",
    "op2_bpe_round_trip": "doc_id:bigint n_tokens:bigint ids_sha256:string decoded_sha256:string",
    "op3_exact_dedup": "doc_id:bigint keep_id:bigint group_size:bigint kept:boolean text_sha256:string",
    "op4_quality": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op5_decontaminate": "doc_id:bigint n_words:bigint n_hit:bigint n_items:bigint items_sha256:string contaminated:boolean",
    "op6_language": "doc_id:bigint held_out:boolean lang_pred:string score:double",
    "op7_licenses": "doc_id:bigint licenses:string best:string similarity:double",
    "op8_near_dedup": "doc_id:bigint n_shingles:bigint component_id:bigint kept:boolean",
    "op9_personal_data": "doc_id:bigint n_email:bigint n_ip:bigint n_card:bigint n_phone:bigint base_sha256:string spans:string",
    "op10_token_files": "doc_id:bigint start:bigint n_tokens:bigint ids_crc32:bigint",
    "op11_token_counts": "doc_id:bigint n_bytes:bigint n_tokens:bigint over_limit:boolean",
    "op12_alignment": "doc_id:bigint n_a:bigint n_b:bigint n_groups:bigint n_links:bigint n_best:bigint count_sum:bigint groups_sha256:string n_shared:bigint",
    "op13_hard_negatives": "anchor_id:bigint positive_id:bigint rank:int negative_id:bigint positive_score:bigint negative_score:bigint",
}


@pytest.fixture(scope="module")
def duck():
    return oracle_check.connect(SF_DIR)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, duck, name):
    result = catalog.QUERIES[name](spark, SF_DIR).toPandas()
    assert len(result) == 1000 or name == "op13_hard_negatives" and len(result) > 100
    assert oracle_check.differences(result, duck.sql(ORACLE[name]).df()) is None


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_columns(spark, small, name):
    frame = catalog.QUERIES[name](spark, small)
    assert " ".join(f"{c}:{t}" for c, t in frame.dtypes) == COLUMNS[name]
    if "doc_id" in frame.columns:
        assert frame.count() == spark.read.parquet(f"{small}/documents.parquet").count()


def test_all_are_registered():
    assert set(COLUMNS) == set(catalog.QUERIES)
    assert set(catalog.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())
