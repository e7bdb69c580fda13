"""Every registered query against its SQL counterpart, on whole generated tables."""

import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def _rows(table, columns):
    data = table.select(columns).to_pylist()
    return sorted((tuple(row[c] for c in columns) for row in data), key=repr)


def _type(arrow_type):
    return str(arrow_type).replace("large_", "").replace("timestamp[us, tz=UTC]", "timestamp[us]")


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR).toArrow()
    if name not in ORACLES:
        assert result.num_rows > 0
        return
    expected = duck.execute(ORACLES[name]).to_arrow_table()
    columns = sorted(expected.column_names)
    assert sorted(result.column_names) == columns
    types = {c: _type(result.schema.field(c).type) for c in columns}
    assert types == {c: _type(expected.schema.field(c).type) for c in columns}
    assert result.num_rows == expected.num_rows
    assert _rows(result, columns) == _rows(expected, columns)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() >= 2


def test_contract_without_the_training_data_part():
    code = (
        "import sys; sys.modules['segmill.llm'] = None; import __spark_entry__ as e; "
        "assert 'pipeline' not in e.queries() and 'word_counts' in e.queries() and set(e.oracle_sql()) <= set(e.queries())"
    )
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-500:]
