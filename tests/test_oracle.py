"""Every registered query against its DuckDB SQL on the smallest tables."""

import os

import duckdb
import pytest

from vistaloom import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def same(value):
    if isinstance(value, float):
        return None if value != value else round(value, 6) + 0.0
    return value


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, duck, name):
    got = catalog.QUERIES[name](spark, sf_dir)
    result = duck.execute(catalog.ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(got.columns)
    want = sorted(str(tuple(same(v) for v in r)) for r in result.fetchall())
    assert sorted(str(tuple(same(v) for v in r)) for r in got.select(*columns).collect()) == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_query_has_rows(spark, sf_dir, name):
    assert catalog.QUERIES[name](spark, sf_dir).count() > 0


def test_rest_works_without_the_language_model_operators(tmp_path):
    """With both folders and the corpus pipeline gone, the entry imports and the other tests are found and pass (the quick ones are run)."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/vistaloom", tmp_path / "vistaloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copytree(f"{root}/tests", tmp_path / "tests", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "pytest.ini", "bench.py"):
        shutil.copy(f"{root}/{name}", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), [n for n in e.queries() if n.startswith('op') or n == 'pipeline'])"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True).stdout
    assert out.strip().endswith("[]") and int(out.split()[0]) > 100
    found = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only"], cwd=tmp_path, capture_output=True, text=True)
    assert found.returncode == 0, found.stdout
    picked = "validate_schema or count_lines or paged_scan or template_fill"
    done = subprocess.run([sys.executable, "-m", "pytest", "tests/test_oracle.py", "-q", "-k", picked], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stdout


def test_a_broken_subpackage_is_an_error(tmp_path):
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/vistaloom", tmp_path / "vistaloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    (tmp_path / "vistaloom" / "llm").mkdir()
    (tmp_path / "vistaloom" / "llm" / "__init__.py").touch()
    (tmp_path / "vistaloom" / "llm" / "registry.py").write_text("import a_module_that_is_not_there\n")
    (tmp_path / "corpus_pipeline.py").touch()
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, capture_output=True, text=True)
    assert out.returncode and "a_module_that_is_not_there" in out.stderr


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    from vistaloom.session import shared_folder

    def get(key, default):
        return default

    spark = SimpleNamespace(conf=SimpleNamespace(get=get), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(spark)
