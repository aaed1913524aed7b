import importlib
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DATA = "/root/testdata/sf0.001"


def test_every_sql_has_its_query():
    entry = importlib.import_module("__spark_entry__")
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 60


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_flagship(spark):
    entry = importlib.import_module("__spark_entry__")
    assert entry.entry(spark).count() == 10


def test_the_rest_imports_alone(tmp_path):
    """Without the training-data subpackage the entry points and all other queries are there."""
    import shutil

    shutil.copytree(os.path.join(ROOT, "docloom"), tmp_path / "docloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 60 and not [k for k in q if k.startswith('op') or k == 'pipeline'], q"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", ["slice_filter_group_order_limit", "filter_and_in_or", "agg_many", "agg_nest_two", "search_phrase", "triples_of_documents", "chunks_sidecar_n", "files_aggregate_xml", "store_upsert_and_delete"])
def test_queries_give_the_rows_of_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    entry = importlib.import_module("__spark_entry__")
    c = duckdb.connect()
    for t in os.listdir(DATA):
        c.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{t}'")
    df = entry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(repr([r[k] for k in columns]) for r in df.collect())
    want = c.execute(f"SELECT {', '.join(chr(34) + k + chr(34) for k in columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert got == sorted(repr(list(r)) for r in want)
