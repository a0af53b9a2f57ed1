"""bench.py prints exactly one JSON line with the expected keys (run on sf0.001)."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="4", BENCH_DRIVER_MEMORY="2g")
    res = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], capture_output=True, text=True,
                         timeout=900, env=env, cwd=ROOT)
    lines = [ln for ln in res.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, res.stdout[-2000:] + res.stderr[-2000:]
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == 0.001 and out["failed"] == []
    assert {"lag_lead_features", "train_12_models", "fit_one_rf", "bootstrap_report"} <= set(out["queries"])
    assert out["value"] == round(sum(out["queries"].values()), 3)
