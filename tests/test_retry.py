"""Results stay whole when tasks are lost and re-run (see retry_scenario.py)."""

import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_results_survive_task_retries():
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "retry_scenario.py")
    run = subprocess.run([sys.executable, script, SF], capture_output=True, text=True, timeout=600)
    line = [ln for ln in run.stdout.splitlines() if ln.startswith("RESULT")]
    assert line, run.stderr[-2000:]
    assert line[0].split()[1:3] == ["True", "True"], line[0]
