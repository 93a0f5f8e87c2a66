"""Connected components of small edge tables."""

import pytest

from assayloom.llm.components import components


def test_chain_and_no_edges(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(20)], "a long, b long")
    assert {tuple(r) for r in components(chain).collect()} == {(i, 0) for i in range(1, 21)}
    assert components(chain.limit(0)).count() == 0


def test_running_out_of_rounds_is_an_error(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(20)], "a long, b long")
    with pytest.raises(RuntimeError):
        components(chain, most_rounds=1)
