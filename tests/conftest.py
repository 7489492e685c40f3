import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import oracle  # noqa: E402
from relink import lineage  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = oracle.session()
    yield s
    lineage.clear(s)
    s.stop()


@pytest.fixture
def col(spark):
    """Values of one expression over rows of one text column `v`."""
    def run(values, expression, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        return [r[0] for r in df.select(expression.alias("x"), "i").orderBy("i").select("x").collect()]

    return run
