"""Every registered query against its SQL, on the smallest tables; those without SQL have a brute-force test."""

import importlib
import subprocess
import sys

import pytest

import __spark_entry__ as spark_entry
from compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_its_sql_or_a_brute_force_test():
    without = set(spark_entry.queries()) - set(spark_entry.oracle_sql())
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
    if without:
        named = importlib.import_module("tests.llm.brute_force").TESTS
        assert set(named) == without
        for module, test in named.values():
            assert callable(getattr(importlib.import_module(f"tests.llm.{module}"), test))


@pytest.mark.parametrize("name", list(spark_entry.oracle_sql()))
def test_agrees_with_sql(spark, connection, name):
    same, message = compare(spark, connection, name, SF_DIR)
    assert same, message


def test_an_absent_package_leaves_the_other_queries():
    code = "import sys; sys.modules['tallyhouse.llm'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=spark_entry.__file__.rsplit("/", 1)[0])
    queries, sql = map(int, done.stdout.split())
    assert queries == sql >= 38


def test_entry_has_rows(spark):
    assert spark_entry.entry(spark).count() > 0
