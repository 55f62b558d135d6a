"""The rest of the library works where the training-data subpackage is absent."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_imports_and_registers_the_rest(tmp_path):
    shutil.copytree(ROOT / "barflow", tmp_path / "barflow",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = ("import __spark_entry__ as e, sys; q = e.queries(); assert 'rolling_features' in q; "
            "assert not [k for k in q if k.startswith('op') or k == 'pipeline']; "
            "assert set(e.oracle_sql()) == set(q); assert 'barflow.llm' not in sys.modules")
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120,
                   env={"PATH": "/usr/bin:/bin", "PYTHONPATH": f"{tmp_path}:{':'.join(p for p in sys.path if 'site-packages' in p)}"})


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "barflow").rglob("*.py"):
        if "llm" not in path.parts:
            assert "barflow.llm" not in path.read_text() and "corpus_pipeline" not in path.read_text()
