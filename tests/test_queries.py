"""Every registered query against its SQL in DuckDB, on the smallest test tables."""

import os

import oracle
import pytest

import __spark_entry__ as lake
from suite import registry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, duck, name):
    assert oracle.compare(spark, duck, QUERIES[name], SQL[name], SF) is None


def test_entry_has_rows(spark):
    assert lake.entry(spark).count() > 0


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace

    from tidemark import workspace

    def session(master, **conf):
        settings = {"spark.sql.warehouse.dir": "file:/home/x/spark-warehouse", **{k.replace("_", "."): v for k, v in conf.items()}}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, *d: settings.get(k, *d)), sparkContext=SimpleNamespace(master=master))
    assert workspace.shared_folder(session("local[8]")).startswith("file:/home/x")
    assert workspace.shared_folder(session("yarn", spark_checkpoint_dir="hdfs://n/c/")) == "hdfs://n/c"
    assert workspace.shared_folder(session("yarn", **{"spark_sql_warehouse_dir": "s3a://b/w"})) == "s3a://b/w/_staged"
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            workspace.shared_folder(session(master))


def test_entry_goes_without_the_optional_queries(tmp_path):
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name in ("tidemark", "suite"):
        shutil.copytree(f"{root}/{name}", tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    count = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"

    def run():
        return subprocess.run([sys.executable, "-c", count], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    gone = run()
    assert gone.returncode == 0 and "left out" not in gone.stderr and int(gone.stdout.split()[0]) > 60
    (tmp_path / "tidemark" / "llm").mkdir()
    (tmp_path / "tidemark" / "llm" / "__init__.py").write_text("")
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_library\n")
    broken = run()
    assert broken.stdout == gone.stdout and "no_such_library" in broken.stderr
