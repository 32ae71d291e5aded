"""Every registered query against its expected-result SQL, on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from conftest import ROOT

import __spark_entry__ as entry_module
from eventmart_checks import catalogue

TABLES = Path("/root/testdata/sf0.001")
EXPECTED = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def in_order(records, columns):
    names = sorted(columns)
    places = [columns.index(name) for name in names]
    return names, sorted(repr([record[place] for place in places]) for record in records)


@pytest.mark.parametrize("name", catalogue.QUERIES)
def test_query(spark, oracle, name):
    found = entry_module.queries()[name](spark, str(TABLES))
    cursor = oracle.execute(EXPECTED[name])
    columns = [column[0] for column in cursor.description]
    assert in_order(found.collect(), found.columns) == in_order(cursor.fetchall(), columns)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 5


def test_feed_has_the_documented_counts(oracle):
    counts = oracle.execute(
        EXPECTED["q06_reconciliation"]
    ).fetchone()
    assert counts[0] == 1037 and counts[2] == 959


def test_import_needs_no_session():
    code = "import __spark_entry__ as e; assert len(e.queries()) >= len(e.oracle_sql()) >= 97"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
