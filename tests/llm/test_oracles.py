"""The contract queries against their SQL."""

from __future__ import annotations

import pytest

from pixelmill.llm.oracles import ORACLES
from pixelmill.llm.queries import QUERIES
from tests.conftest import compare


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    compare(spark, name, QUERIES[name], ORACLES[name])
