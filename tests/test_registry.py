"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

from checks import registry
from checks.compare import database, difference

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")

# Trained at every call; test_jobs covers the same jobs on smaller input.
SLOW = {
    "situation_comparison", "situation_importances", "situation_predictions", "risk_comparison",
    "risk_permutation_importance", "request_comparison",
}


def test_names():
    assert set(registry.ORACLES) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - SLOW))
def test_query(spark, name):
    got = registry.QUERIES[name](spark, FOLDER).toPandas()
    if name in registry.ORACLES:
        assert difference(got, database(FOLDER).execute(registry.ORACLES[name]).df()) == ""
    else:
        assert len(got.columns) > 0
