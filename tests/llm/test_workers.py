"""Operators that broadcast own objects, in a session started elsewhere: workers have no copy of the package on their path."""

import os
import subprocess
import sys

from conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
PROGRAM = """
import sys
sys.path.insert(0, sys.argv[1])
from tideline.session import get_session
from tideline.llm.queries import QUERIES
spark = get_session(master="local[4]", shuffle_partitions=4, app_name="elsewhere")

for name in sorted(QUERIES):
    if name.split("_")[0] in ("op1", "op2", "op6", "op9", "op10"):
        QUERIES[name](spark, sys.argv[2]).write.format("noop").mode("overwrite").save()
        print("ran", name)
"""


def test_workers_need_no_package(tmp_path):
    path = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and not os.path.isdir(os.path.join(p, "tideline"))]
    env = {**os.environ, "PYTHONPATH": os.pathsep.join(path)}
    done = subprocess.run([sys.executable, "-c", PROGRAM, REPO, SF_SMALL], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("ran op") == 5
