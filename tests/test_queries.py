"""Every registered query of the library against its SQL, over whole tables."""

import os
import re
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect
from tidemark.plans import catalog

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    build, sql = catalog.QUERIES[name], catalog.ORACLES.get(name)
    assert sql is not None, "every query of the library has an oracle"
    compare(spark, name, build, sql, FOLDER, con)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_no_oracle_without_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_queries_are_read_without_a_session():
    """In a process of its own: here a session may be running already."""
    code = """
import __spark_entry__ as entry
from pyspark import SparkContext
print(*entry.queries())
print(*entry.oracle_sql())
assert SparkContext._active_spark_context is None
"""
    top = os.path.dirname(os.path.abspath(entry.__file__))
    ran = subprocess.run([sys.executable, "-c", code], cwd=top, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr
    names, oracles = (set(line.split()) for line in ran.stdout.splitlines())
    assert names == set(entry.queries()) and oracles == set(entry.oracle_sql())
    assert {int(m[1]) for m in (re.match(r"op(\d+)_", n) for n in names) if m} == set(range(1, 14))
