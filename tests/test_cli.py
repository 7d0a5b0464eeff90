"""Command line of the whole run and the plan report."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import tempfile

import pyspark
from conftest import SF_SMALL

from regstat.plans import run as run_mod
from regstat.plans.show import summary
from regstat.sources.readers import fixture_frames, read_sources
from regstat.sources.sinks import write_sources


def test_cli_and_plan_summary(spark, capsys):
    root = tempfile.mkdtemp(prefix="regstat-cli-", dir="/tmp")
    write_sources(fixture_frames(spark, SF_SMALL), f"{root}/sources")
    assert run_mod.main(["--sources", f"{root}/sources", "--out", f"{root}/out", "--run-date", "x", "--no-csv"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["out"].endswith("profiles_2012_2025_x")
    assert [c["service"] for c in out["control"]] == ["SOM", "PHV", "TSB", "PHBU", "AVTPHV"]

    src = read_sources(spark, f"{root}/sources")
    text = summary(src.codes["SOM"].filter("code_type = 6").groupBy("stay_key").count())
    assert "exchanges: 1" in text and "PushedFilters" in text and "PartitionFilters" in text


def test_submitted_session_keeps_master_and_settings(spark):
    root = tempfile.mkdtemp(prefix="regstat-submit-", dir="/tmp")
    write_sources(fixture_frames(spark, SF_SMALL), f"{root}/sources")
    job = f"""
import json
from regstat.plans import run
run.main(["--sources", "{root}/sources", "--out", "{root}/out", "--run-date", "x", "--no-csv"])
from pyspark.sql import SparkSession
s = SparkSession.getActiveSession()
keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.forceOptimizeSkewedJoin"]
print(json.dumps([s.sparkContext.master, *[s.conf.get(k) for k in keys]]))
"""
    with open(f"{root}/job.py", "w") as f:
        f.write(job)
    os.mkdir(f"{root}/shared")
    conf = {"spark.sql.shuffle.partitions": "7", "spark.ui.enabled": "false", "spark.checkpoint.dir": f"{root}/shared"}
    args = [x for k, v in conf.items() for x in ("--conf", f"{k}={v}")]
    submit = os.path.join(os.path.dirname(pyspark.__file__), "bin", "spark-submit")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_GATEWAY_PORT"} | {"PYTHONPATH": repo, "PYSPARK_PYTHON": sys.executable}
    done = subprocess.run([submit, "--master", "local[2]", *args, f"{root}/job.py"], env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert json.loads(done.stdout.strip().splitlines()[-1]) == ["local[2]", "7", "true"]
    assert any(x.startswith("regstat-work-") for x in os.listdir(f"{root}/shared"))
