"""The entry module without the llm subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_the_llm_subpackage(tmp_path):
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{ROOT}/strata", tmp_path / "strata",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = ("import __spark_entry__ as e; names = set(e.queries()); "
            "assert 'mart_monthly_revenue' in names and 'pipeline' not in names; "
            "assert not any(n.startswith('op') and n[2].isdigit() for n in names); "
            "assert set(e.oracle_sql()) <= names")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
