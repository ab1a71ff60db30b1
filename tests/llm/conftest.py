import pytest

from smogline.llm.workers import findable


@pytest.fixture(autouse=True)
def _workers(spark):
    findable(spark)
