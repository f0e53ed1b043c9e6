"""Failed tasks are retried from lineage: with the first attempt of every task of the posts scan
failing, a report and its month write give exactly the rows of a clean run (no duplicates from
retried write tasks). Runs in its own process: local mode with task retries (local[4,4])."""

import json
import os
import subprocess
import sys
import tempfile

SCRIPT = r"""
import json, os, sys, tempfile
sys.path.insert(0, sys.argv[1]); sys.path.insert(0, os.path.join(sys.argv[1], "tests"))
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F, types as T
spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
from venue_analytics.session import configure
configure(spark)
from conftest import AS_OF, base_rows, make_tables
from venue_analytics.operators import reports as R
from venue_analytics.plans.jobs import run_reports
from venue_analytics.sources.sinks import read_report

t = make_tables(spark, *base_rows())
clean = sorted(map(str, R.content_types_map(t, "2015Feb", AS_OF).collect()))

marks = tempfile.mkdtemp(prefix="va-marks-")

def first_attempt_fails(x):   # test-only fault injection
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0:
        open(os.path.join(marks, f"{ctx.stageId()}-{ctx.partitionId()}"), "w").close()
        raise RuntimeError("injected task failure")
    return True

flaky = F.udf(first_attempt_fails, T.BooleanType())
t.posts = t.posts.repartition(4).filter(flaky(F.col("id")))
faulty = sorted(map(str, R.content_types_map(t, "2015Feb", AS_OF).collect()))
sink = tempfile.mkdtemp(prefix="va-fault-")
run_reports(spark, t, sink, "2015Feb", reports=["content", "posters"], as_of=AS_OF)
written = sorted(map(str, read_report(spark, os.path.join(sink, "content"), post_month="2015Feb").drop("post_month").collect()))
expected = sorted(map(str, R.content_types_map(make_tables(spark, *base_rows()), "2015Feb", AS_OF).drop("post_month").collect()))
print(json.dumps({"clean": clean, "faulty": faulty, "written": written, "expected": expected,
                  "injected": len(os.listdir(marks))}))
"""


def test_reports_survive_failed_tasks():
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with tempfile.NamedTemporaryFile("w", suffix=".py", delete=False) as fh:
        fh.write(SCRIPT)
    out = subprocess.run([sys.executable, fh.name, repo], capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.startswith("{")]
    assert lines, out.stderr[-3000:]
    got = json.loads(lines[-1])
    assert got["injected"] > 0                      # tasks really failed and were retried
    assert got["faulty"] == got["clean"] and len(got["clean"]) == 3
    assert got["written"] == got["expected"]


CKPT_SCRIPT = r"""
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from venue_analytics.session import checkpoint_dir
print("DIR", checkpoint_dir(s), s.sparkContext.getCheckpointDir())
"""


def test_checkpoint_folder_read_from_session_or_set_for_local_only():
    """With a configured spark.checkpoint.dir the session's folder is used; a local session
    without one gets a scratch folder through the context (the conf itself is start-up only)."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with tempfile.NamedTemporaryFile("w", suffix=".py", delete=False) as fh:
        fh.write(CKPT_SCRIPT)
    empty_conf = tempfile.mkdtemp(prefix="va-noconf-")
    out = subprocess.run([sys.executable, fh.name, repo], capture_output=True, text=True, timeout=300,
                         env={**os.environ, "SPARK_CONF_DIR": empty_conf})
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("DIR ")]
    assert line, out.stderr[-2000:]
    _, chosen, ctx = line[0].split(" ", 2)
    assert "va-ckpt-" in chosen and "va-ckpt-" in ctx
