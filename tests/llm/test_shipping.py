"""Operators run on executors that cannot import this package, models included."""

import os
import subprocess
import sys
import tempfile

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from ledgerscope.session import build_session
from __spark_entry__ import queries
spark = build_session("local[2]", shuffle_partitions=2)
for name in sys.argv[1:]:
    print("ROWS", name, queries()[name](spark, "/root/testdata/sf0.001").count())
"""


@pytest.mark.parametrize("names", [["op1_suffix_array_dedup", "op4_cover_tree", "op7_kneser_ney_toxicity"],
                                   ["op12_token_alignment", "pipeline"]])
def test_models_reach_executors_without_the_package(names):
    cwd = tempfile.mkdtemp(prefix="ledgerscope-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", SCRIPT, *names], cwd=cwd, env=env, capture_output=True, text=True, timeout=900)
    assert [line.split()[1] for line in r.stdout.splitlines() if line.startswith("ROWS")] == names, r.stderr[-2000:]
