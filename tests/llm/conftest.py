import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))


@pytest.fixture(scope="session")
def docs_table(spark):
    def make(rows, more=False):
        rows = [(i, t) if not more else (i, t, "x", "y", 1) for i, t in rows]
        return spark.createDataFrame(rows, "doc_id long, text string" + (", block string, digest string, words long" if more else "")).repartition(3)

    return make
