"""Every registered query against its SQL, on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    missing = contract.queries().keys() - contract.oracle_sql().keys()
    assert all(name == "pipeline" or name.startswith("op") for name in missing)


@pytest.mark.parametrize("name", contract.oracle_sql())
def test_query(spark, duck, name):
    ours = contract.queries()[name](spark, SF)
    theirs = duck.sql(contract.oracle_sql()[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    expected = theirs.fetchall()
    at = [theirs.columns.index(c) for c in columns]
    got = sorted(tuple(str(row[c]) for c in columns) for row in ours.collect())
    assert got == sorted(tuple(str(row[i]) for i in at) for row in expected)
    assert got


def test_entry(spark):
    day = contract.entry(spark)
    assert {str(row["date"]) for row in day.collect()} == {"2024-01-05"}
    assert day.columns == ["event_id", "user_id", "event_type", "value", "nation_id", "nation", "date"]


WITHOUT = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == sys.argv[1]:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as contract
assert "hits_tsv_scan" in contract.queries() and not any(name.startswith("op") for name in contract.queries())
"""


@pytest.mark.parametrize("missing", ["hitlake.llm", "corpus_pipeline", "zstandard", "xxhash"])
def test_without_an_optional_part(missing):
    root = Path(__file__).resolve().parent.parent
    found = subprocess.run([sys.executable, "-c", WITHOUT, missing], cwd=root, capture_output=True, text=True)
    assert found.returncode == 0, found.stderr


def test_standard_feed_sorts_before_it_widens(spark, monkeypatch):
    plans, own = [], DataFrameWriter.csv
    monkeypatch.setattr(DataFrameWriter, "csv", lambda self, path: (plans.append(self._df._jdf.queryExecution().optimizedPlan()), own(self, path)))
    monkeypatch.setattr(contract, "_once", lambda spark, sf_dir, label, make: make(contract.scratch_path(spark, label)))
    contract._standard_feed(spark, SF)
    assert plans[0].outputOrdering().mkString().startswith("feed_day")
