"""Every registered query against its comparison SQL on the smallest tables."""

import os
import sys
from concurrent.futures import ThreadPoolExecutor

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check  # noqa: E402
from terrasheaf.plans import load_all  # noqa: E402
from terrasheaf.plans.registry import QUERIES  # noqa: E402

load_all()
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def outcomes(spark):
    con = check.duck(SF_DIR)

    def run(name):
        try:
            return name, check.compare(spark, con.cursor(), SF_DIR, name)
        except Exception as exc:  # each query reports for itself
            return name, (0, False, repr(exc)[:1500])

    with ThreadPoolExecutor(6) as pool:
        return dict(pool.map(run, QUERIES))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(outcomes, name):
    _rows, ok, note = outcomes[name]
    assert ok is not False, note
