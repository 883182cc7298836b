import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from tillwork.llm.shipping import ship  # noqa: E402

DOCS = "doc_id long, text string"


@pytest.fixture(scope="session")
def corpus(spark):
    """Makes tables of (doc_id, text); the package is shipped to the workers."""
    ship(spark)
    return lambda *rows: spark.createDataFrame(list(rows), DOCS)
