import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from panelcast.llm import queries as training_data
from tests.llm.conftest import SF


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(training_data.ORACLES) <= set(names)


@pytest.mark.parametrize("name", sorted(training_data.ORACLES))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    got = training_data.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.execute(f"select {', '.join(columns)} from ({training_data.ORACLES[name]})").fetchall()
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(want, key=repr) and want


def test_the_rest_works_without_this_subpackage(tmp_path):
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('corpus_pipeline', 'panelcast.llm') or name.startswith('panelcast.llm.'):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not any(n.startswith('op') for n in e.queries()) and 'pipeline' not in e.queries()\n"
        "assert set(e.oracle_sql()) <= set(e.queries())\n")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
