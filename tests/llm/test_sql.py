"""The queries that SQL can express, next to it."""

import pytest
from compare import differences, duck

from gridspark.llm.queries import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"op6_line_dedup"}))
def test_twin(spark, name):
    rows, notes = differences(spark, duck(SF), SF, name)
    assert rows > 0 and not notes
