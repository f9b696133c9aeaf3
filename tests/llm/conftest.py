import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def docs(spark):
    """(doc_id, text, source, lang, and columns whose names the operators use themselves)."""
    def make(rows):
        full = [(i, t, *(list(rest) + ["src", "en"][len(rest):]), "x", 1, -1, 0.5) for i, t, *rest in rows]
        return spark.createDataFrame(full, "doc_id long, text string, source string, lang string, id string, cls int, n long, score double")
    return make


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return SF
