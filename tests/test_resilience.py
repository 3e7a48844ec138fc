"""Task failures and retries leave the gold table unchanged.

Runs in its own process: a local master that allows task retries ("local[4,3]") and an
identity UDF that fails the first attempt of every task it runs in, placed (a) on the input
trades, before the range shuffle, and (b) on the output, in the halo window stage. Spark
re-runs the failed tasks from lineage and shuffle files; the numbering (written once) and
the windows (ordered by that numbering) are deterministic, so the results are identical.
"""

from __future__ import annotations

import json
import subprocess
import sys

from conftest import ROOT, SF_SMALL

SCRIPT = r"""
import json, os, sys, tempfile
sys.path.insert(0, {root!r})
MARKS = tempfile.mkdtemp(prefix="injected-")
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F

spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
from marketlake.plans import features as G
from marketlake.sources import testdata as TD


def flaky(tag):
    def fn(x):
        tc = TaskContext.get()
        if tc.attemptNumber() == 0:
            open(os.path.join(MARKS, f"{{tag}}-{{tc.stageId()}}-{{tc.partitionId()}}"), "w").close()
            raise RuntimeError("injected task failure")
        return x
    return F.udf(fn, "double")


ev = TD.load_events(spark, {sf!r})
trades, ticker = TD.trades(ev), TD.ticker(ev)
kw = dict(chunk_rows=512, quote_join="window", apply_filter=False)


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


clean = rows(G.build_features(trades, ticker, **kw))
early = rows(G.build_features(trades.withColumn("price", flaky("early")("price")), ticker, **kw))
late = rows(G.build_features(trades, ticker, **kw).withColumn("price", flaky("late")("price")))
marks = os.listdir(MARKS)
print("RESULT " + json.dumps({{"n": len(clean), "early": early == clean, "late": late == clean,
                              "early_failures": sum(m.startswith("early") for m in marks),
                              "late_failures": sum(m.startswith("late") for m in marks)}}))
"""


def test_task_retries_do_not_change_results():
    code = SCRIPT.format(root=ROOT, sf=SF_SMALL)
    proc = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=900)
    lines = [line for line in proc.stdout.splitlines() if line.startswith("RESULT ")]
    assert lines, proc.stderr[-3000:]
    res = json.loads(lines[-1][len("RESULT "):])
    assert res["n"] > 0 and res["early"] and res["late"], res
    # failures were really injected (and retried) in both places
    assert res["early_failures"] >= 1 and res["late_failures"] >= 1, res
