import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id long, text string, lang string, source string, start string, score string, `rank` int"


@pytest.fixture
def frame(spark):
    """Documents with columns that clash with the operators' own."""
    def make(rows):
        return spark.createDataFrame([(i, t, lang, src, "x", "y", 1) for i, t, lang, src in rows], DOCS)
    return make

