"""Corpus queries that have SQL give the same rows in DuckDB, over whole tables."""

import pytest

from compare import connect, differences
from pairtables.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, sf_check, name):
    assert differences(QUERIES[name](spark, sf_check), connect(sf_check), ORACLES[name]) is None


def test_names():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
