"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_all_queries_match_oracle():
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "compare_oracle.py"), SF],
                         capture_output=True, text=True, timeout=1800)
    tail = out.stdout[-4000:]
    assert out.returncode == 0, tail
    assert '"bad": 0' in out.stdout, tail
