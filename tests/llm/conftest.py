import pytest


@pytest.fixture(autouse=True)
def _importable(spark):
    from matchlab.llm.common import importable
    importable(spark)
