"""Queries with Python on the workers run from any folder, in a process of their own."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = f"""
import sys
sys.path.insert(0, {REPO!r})
import __spark_entry__ as e
from millrace.session import get_session
spark = get_session("elsewhere", "local[2]", 2, {{"spark.ui.enabled": "false"}})
print("rows", e.queries()["q_barrier_exit"](spark, "/root/testdata/sf0.001").count())
"""


def test_a_query_runs_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "rows" in done.stdout, done.stderr[-2000:]


def test_no_machine_local_folders():
    for root, _, names in os.walk(os.path.join(REPO, "millrace")):
        for name in names:
            if name.endswith(".py"):
                assert "tempfile" not in open(os.path.join(root, name)).read(), name
