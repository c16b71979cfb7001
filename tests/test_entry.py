"""The entry module, with and without the optional parts."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _names(path):
    code = "import __spark_entry__ as e; print(*sorted(e.queries()), '|', *sorted(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=path, env=os.environ | {"PYTHONPATH": path}, capture_output=True, text=True, check=True)
    return [set(x.split()) for x in out.stdout.split("|")]


def test_names_without_a_session():
    queries, oracles = _names(REPO)
    assert oracles <= queries and {"accept_group", "gbt_scores"} <= queries


def test_without_the_corpus_operators(tmp_path):
    path = str(tmp_path / "repo")
    shutil.copytree(REPO, path, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    queries, oracles = _names(path)
    assert "accept_group" in queries and oracles <= queries and not any(q.startswith("op") or q == "pipeline" for q in queries)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["source1_entity_id", "matched_entity_ids"]
