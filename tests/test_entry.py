import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_names_need_no_session():
    """The driver lists queries and SQL before it starts Spark."""
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert len(q) > 100 and set(s) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
