"""Task failures are retried and give the same result (separate process: local[4,4] allows retries)."""

import os
import subprocess
import sys
import textwrap

from tests.conftest import ROOT, SF_SMALL

SCRIPT = textwrap.dedent(f"""
    import sys
    sys.path.insert(0, {ROOT!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F
    spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from meteoframe.operators import impute as imp, series as ser
    from meteoframe.sources.observations import observations

    @F.udf("boolean")
    def fail_first_attempt(_):
        tc = TaskContext.get()
        if tc.attemptNumber() == 0 and tc.partitionId() % 2 == 0:
            raise RuntimeError("injected task failure")
        return True

    def run(flaky):
        obs = observations(spark, {SF_SMALL!r})
        if flaky:
            obs = obs.filter(fail_first_attempt(F.col("obs_id")))          # before the sorted cache
        out = ser.lag_lead_features(obs, prepare=imp.impute_mixed)
        if flaky:
            out = out.filter(fail_first_attempt(F.col("obs_id")))          # after the window
        return sorted(tuple(r) for r in out.collect())

    clean, flaky = run(False), run(True)
    print("SAME" if clean == flaky and len(clean) > 0 else "DIFFERENT", len(clean))
""")


def test_retried_tasks_give_same_features():
    env = dict(os.environ, PYTHONPATH=ROOT)
    res = subprocess.run([sys.executable, "-c", SCRIPT], capture_output=True, text=True, timeout=600, env=env)
    assert "SAME" in res.stdout, res.stdout[-2000:] + res.stderr[-4000:]
