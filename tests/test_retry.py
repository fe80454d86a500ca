import json
import os
import subprocess
import sys

from testdata import SF_SMALL


def test_lost_worker_is_retried_with_identical_results():
    here = os.path.dirname(os.path.abspath(__file__))
    out = subprocess.run([sys.executable, os.path.join(here, "retry_job.py"), SF_SMALL],
                         capture_output=True, text=True, timeout=600)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("{")]
    assert line, out.stderr[-2000:]
    res = json.loads(line[-1])
    assert res["rows"] > 0 and res["equal"]
