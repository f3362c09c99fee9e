"""The driver's contract on the smallest tables, and against DuckDB."""

from __future__ import annotations

import glob
import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from terraloom.plans import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


def shown(value) -> str:
    if isinstance(value, float):
        return f"{value:.6g}"
    return str(value)


QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    import duckdb

    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted("|".join(shown(r[c]) for c in columns) for r in df.collect())
    db = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        db.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    found = db.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    assert got == sorted("|".join(shown(r[names.index(c)]) for c in columns) for r in found.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 144


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_training_data_subpackage(tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(f"{root}/terraloom", tmp_path / "terraloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; from terraloom.plans import registry as r; assert e.queries() == r.QUERIES and e.oracle_sql() == r.ORACLES"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True)
