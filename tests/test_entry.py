import os
import shutil
import subprocess
import sys

import __spark_entry__

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["doc_id", "lang"] and df.count() > 0


def test_flagship_plan(spark):
    from sparkcurate.plans.queries import decontaminate_topk

    plan = decontaminate_topk(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "LeftAnti" in plan and "CartesianProduct" not in plan and "Python" not in plan


def test_queries_have_names_and_sql():
    q, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(q) and len(q) > 100


def test_works_without_the_llm_folders(tmp_path):
    shutil.copytree(f"{ROOT}/sparkcurate", tmp_path / "sparkcurate", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert len(e.queries()) > 40 and not any(n.startswith('op') for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True)


def test_works_without_what_the_llm_folder_needs(tmp_path):
    shutil.copytree(f"{ROOT}/sparkcurate", tmp_path / "sparkcurate", ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(f"{ROOT}/{name}", tmp_path)
    shutil.rmtree(tmp_path / "sparkcurate" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; assert len(e.queries()) > 40 and 'pipeline' not in e.queries() and set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True)
