"""The library without its optional training-data part: a copy of the sources, without those folders."""

import os
import shutil
import subprocess
import sys

from conftest import ROOT

CODE = """
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
assert "stratified_split" in q and "stratified_split" in o
assert not any(n.startswith("op") and n[2].isdigit() for n in q) and "pipeline" not in q and "pipeline" not in o
assert set(o) <= set(q)
print(e.__file__)
"""


def _copy(to, *, pipeline):
    shutil.copytree(os.path.join(ROOT, "sftlake"), to / "sftlake", ignore=lambda d, names: [n for n in names if n == "__pycache__" or (n == "llm" and d.endswith("sftlake"))])
    for name in ("__spark_entry__.py", *(["corpus_pipeline.py"] if pipeline else [])):
        if os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), to / name)


def test_entry_without_the_optional_folders(tmp_path):
    for k, pipeline in enumerate((True, False)):
        to = tmp_path / str(k)
        to.mkdir()
        _copy(to, pipeline=pipeline)
        env = {**os.environ, "PYTHONPATH": str(to), "PYTHONDONTWRITEBYTECODE": "1"}
        out = subprocess.run([sys.executable, "-c", CODE], cwd=to, env=env, capture_output=True, text=True, timeout=120)
        assert out.returncode == 0, out.stderr
        assert str(to) in out.stdout
