"""Every registered query against its SQL twin on the smallest tables."""

import os
import subprocess
import sys

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare_all import compare, duck
from checks.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= queries().keys() and ORACLES.keys() <= oracle_sql().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert ok, note


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and {"journey_id", "event", "event_type", "confidence"} <= set(df.columns)


def test_entry_without_a_library_of_the_corpus_operators():
    """A missing dependency takes the corpus queries away, and no others."""
    code = (
        "import sys; sys.modules['xxhash'] = None\n"
        "import __spark_entry__ as e\n"
        "from checks.queries import QUERIES\n"
        "assert e.queries().keys() == QUERIES.keys() and len(QUERIES) > 100"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0
