"""The library without its optional corpus part."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LOOK = """
import __spark_entry__ as e
q, s = e.queries(), e.oracle_sql()
assert set(s) <= set(q) and "fe05_applicant_features" in q and len(q) > 150
print(sum(k.startswith("op") or k == "pipeline" for k in q))
"""


def names(folder):
    done = subprocess.run([sys.executable, "-c", LOOK], cwd=folder, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": folder})
    assert done.returncode == 0, done.stderr
    return int(done.stdout)


def test_queries_without_the_corpus_part(tmp_path):
    for part in ((), ("llm",), ("llm", "corpus_pipeline.py")):
        folder = tmp_path / "-".join(["copy", *part])
        skip = shutil.ignore_patterns("__pycache__", *part)
        shutil.copytree(f"{ROOT}/riskspark", folder / "riskspark", ignore=skip)
        for f in ("__spark_entry__.py", "corpus_pipeline.py"):
            if f not in part and os.path.exists(f"{ROOT}/{f}"):
                shutil.copy(f"{ROOT}/{f}", folder / f)
        found = names(str(folder))
        assert found == 0 if part else found >= 0
