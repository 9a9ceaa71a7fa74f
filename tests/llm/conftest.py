import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture
def docs(spark):
    """Documents from (id, text) or (id, text, source) rows, with a column that clashes in case."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "s", "x") for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, source string, `KEY` string")

    return make
