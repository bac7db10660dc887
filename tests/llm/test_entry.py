import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.check_oracle import frame_key

SQL = [k for k in entry.oracle_sql() if k.startswith("op")]


def test_one_query_for_each_operator():
    names = [k for k in entry.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", SQL)
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark", "labels", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    assert frame_key(entry.queries()[name](spark, SF_SMALL).toPandas()) == frame_key(con.execute(entry.oracle_sql()[name]).df())


def test_without_these_folders(tmp_path):
    """A copy without llm and the pipeline still registers the other queries."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for name in ("__spark_entry__.py", "marginflow"):
        subprocess.run(["cp", "-r", f"{root}/{name}", str(tmp_path)], check=True)
    (tmp_path / "marginflow" / "llm").rename(tmp_path / "gone")
    code = "import __spark_entry__ as e; n = list(e.queries()); print(len(n), [x for x in n if x[:2] == 'op' or x == 'pipeline'])"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={
        **os.environ, "PYTHONPATH": ""})
    assert out.returncode == 0, out.stderr
    assert out.stdout.split()[1] == "[]" and int(out.stdout.split()[0]) > 50
