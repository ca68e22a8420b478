"""Every registered query on the smallest tables, against its SQL in DuckDB."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as contract
from check import canonical

SF_DIR = os.environ.get("EBBTIDE_TEST_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert len(got) > 0
    if name in ORACLES:
        want = db.execute(ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert canonical(got) == canonical(want)


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).columns == ["category", "line_items", "revenue"]


def test_the_rest_works_without_the_text_operators():
    code = "import sys; sys.modules['ebbtide.llm'] = None; import __spark_entry__ as e; print(len(e.queries()))"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) <= len(QUERIES)
