"""Whole run (P10): staged sources, written tables, read back and checked."""

from __future__ import annotations

import json
import os
import re
import subprocess
import sys
import tempfile

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from regstat import catalogue as cat
from regstat.operators import checks, episodes
from regstat.plans import run as run_mod
from regstat.plans.run import run
from regstat.sources.readers import STAY_TRIM, PERSON_TRIM, Sources, _by_service, fixture_frames, read_sources
from regstat.sources.schemas import CODES, PERSONS, RESIDENCE, STAYS, MissingColumnError, normalise
from regstat.sources.sinks import read_delivery, version_dir, versions, write_sources


def test_stage_then_run(spark):
    root = tempfile.mkdtemp(prefix="regstat-test-", dir="/tmp")
    write_sources(fixture_frames(spark, SF_SMALL), f"{root}/sources")
    src = read_sources(spark, f"{root}/sources")
    res = run(spark, src, f"{root}/out", run_date="2026-01-01", wide_residence=True)
    wide = spark.read.parquet(res.tables.pop("residence_wide") + "/parquet")
    assert wide.count() == spark.read.parquet(res.tables.pop("extract")).select("person_id").distinct().count()
    assert spark.read.parquet(res.tables.pop("residence_by_year")).count() == res.residence_rows

    checks = {"persons_per_service_year", "persons_per_service", "year_span", "sex_distribution",
              "care_level_distribution", "rule_violations", "residence_persons", "included_totals"}
    assert set(res.tables) == ({s.label for s in cat.SERVICES} | {cat.CONTROL_TABLE_NAME, cat.PRECHECK_TABLE_NAME}
                               | {f"checks/{c}" for c in checks})
    kontroll = spark.read.parquet(res.tables[cat.CONTROL_TABLE_NAME] + "/parquet")
    assert kontroll.columns == [h for _, h in cat.CONTROL_HEADERS]
    pre = spark.read.parquet(res.tables[cat.PRECHECK_TABLE_NAME] + "/parquet")
    assert pre.columns == [h for _, h in cat.PRECHECK_HEADERS]
    assert spark.read.parquet(res.tables["checks/rule_violations"] + "/parquet").count() == 0
    n = spark.read.parquet(res.tables["checks/persons_per_service"] + "/parquet").collect()
    assert len(n) == 5
    for path in res.tables.values():
        assert os.path.isdir(f"{path}/parquet") and os.path.isdir(f"{path}/csv")
    som = spark.read.parquet(res.tables["SOM"] + "/parquet")
    assert som.count() == 75
    control = {r["service"]: r for r in res.control}
    assert control["SOM"]["output_rows"] == 75
    assert control["SOM"]["extract_rows"] == 78
    assert res.duplicate_places == 1

    # whole years per file, sorted: municipality, sex, age (unknown age last)
    import csv
    import glob

    files = sorted(glob.glob(res.tables["SOM"] + "/csv/*.csv"))
    assert files
    seen = []
    for f in files:
        header, *rows = list(csv.reader(open(f)))
        assert header[:2] == ["Ar", "Bostedskommune"]
        key = [(int(r[0]), r[1], r[9], int(r[10]) if r[10] else 10**9) for r in rows]
        assert key == sorted(key)
        seen += {r[0] for r in rows}
    assert len(seen) == len(set(seen))  # a year is never split over files
    assert spark.read.parquet(res.tables["SOM"] + "/parquet").columns == header

    # the staged layout prunes by service directory and pushes the selector
    plan = src.codes["SOM"].filter("code_type = 6")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "service" in plan


@pytest.mark.parametrize("csv", [True, False])
@pytest.mark.parametrize("filled", [("SOM",), ()])
def test_empty_services(spark, csv, filled):
    root = tempfile.mkdtemp(prefix="regstat-empty-", dir="/tmp")
    frames = fixture_frames(spark, SF_SMALL)
    for name in ("codes", "stays"):
        frames[name] = frames[name].filter(frames[name].service.isin(*filled) if filled else "false")
    src = Sources(
        codes=_by_service(frames["codes"], CODES),
        stays=_by_service(frames["stays"], STAYS, STAY_TRIM),
        persons=normalise(frames["persons"], PERSONS, PERSON_TRIM),
        residence=normalise(frames["residence"], RESIDENCE),
        places=frames["places"],
    )
    res = run(spark, src, f"{root}/out", run_date="x", csv=csv)
    assert set(res.empty_services) == {s.label for s in cat.SERVICES} - {cat.service(f).label for f in filled}
    for s in cat.SERVICES:
        back = spark.read.parquet(f"{res.tables[s.label]}/parquet")
        assert back.columns[0] == "Ar"
        assert (back.count() > 0) == (s.name in filled)
        if csv:
            assert spark.read.option("header", True).csv(f"{res.tables[s.label]}/csv").columns == back.columns
    for row in res.control:
        if row["service"] in res.empty_services:
            assert row["extract_rows"] == row["output_rows"] == 0 and row["min_year"] is None
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    assert res.work_dir.startswith(f"{shared or root + '/out'}/")


def test_a_source_without_a_needed_column_is_refused(spark):
    root = tempfile.mkdtemp(prefix="regstat-cols-", dir="/tmp")
    frames = fixture_frames(spark, SF_SMALL)
    write_sources({**frames, "stays": frames["stays"].drop("care_level")}, f"{root}/all")
    with pytest.raises(MissingColumnError, match="50001.*care_level"):
        read_sources(spark, f"{root}/all")
    write_sources(frames, f"{root}/one")
    phv = spark.read.parquet(f"{root}/one/stays/service=PHV")
    phv.drop("care_level").write.partitionBy("year").parquet(f"{root}/phv")
    phv_path = f"{root}/one/stays/service=PHV"
    os.rename(phv_path, f"{root}/full")
    os.rename(f"{root}/phv", phv_path)
    with pytest.raises(MissingColumnError, match="PHV.stays.care_level"):
        read_sources(spark, f"{root}/one")


@pytest.fixture(scope="module")
def staged(spark):
    root = tempfile.mkdtemp(prefix="regstat-staged-", dir="/tmp")
    write_sources(fixture_frames(spark, SF_SMALL), f"{root}/sources")
    return root


def test_checks_seen_while_writing_equal_those_by_aggregates(spark, staged):
    src = read_sources(spark, f"{staged}/sources")
    res = run(spark, src, f"{staged}/seen", run_date="x", csv=False)
    extract = spark.read.parquet(res.tables["extract"])
    want = checks.quality_checks(spark, extract)
    avt = cat.service("AVT")
    want["included_totals"] = checks.included_totals(src.codes[avt.name], src.stays[avt.name])
    for name, df in want.items():
        got = read_delivery(spark, res.out_dir, f"checks/{name}")
        assert got.dtypes == df.dtypes, name
        assert sorted(map(str, got.collect())) == sorted(map(str, df.collect())), name
    control = checks.control_table(extract, spark.read.parquet(f"{res.work_dir}/profiles"), checks.service_list(spark))
    assert [r.asDict() for r in control.collect()] == res.control


def test_years_beyond_one_word(spark):
    extract = spark.createDataFrame(
        [("a", "SOM", 1950), ("a", "SOM", 2050), ("b", "SOM", 2050), ("b", "PHV", 1950), ("c", "PHV", 2011)],
        "person_id string, service string, year int",
    )
    people = checks.cohort_years(extract, cat.SERVICES, 1950, 2050)
    seen = people.agg(*checks.cohort_metrics(cat.SERVICES, 1950, 2050)).first().asDict()
    assert (seen["persons"], seen["SOM persons"], seen["PHV persons"], seen["TSB persons"]) == (3, 2, 2, 0)
    assert (seen["SOM persons 1950"], seen["SOM persons 2050"], seen["PHV persons 2011"], seen["PHV persons 2012"]) == (1, 2, 1, 0)


def test_a_bad_care_level_stops_the_writing_job(spark, staged, monkeypatch):
    src = read_sources(spark, f"{staged}/sources")
    plain = episodes.extract_all

    def spoilt(level):
        def extract(*args):
            df = plain(*args)
            return df.withColumn("care_level", F.when(F.col("service") == "TSB", F.lit(level).cast("int")).otherwise(F.col("care_level")))

        return extract

    for level, said in ((3, "TSB has care level 3 "), (None, "TSB has care level None ")):
        monkeypatch.setattr(episodes, "extract_all", spoilt(level))
        with pytest.raises(checks.CareLevelError, match=said):
            run(spark, src, f"{staged}/bad", run_date="x", csv=False)
    assert versions(spark, f"{staged}/bad/profiles_2012_2025_x") == []


def test_a_run_that_fails_leaves_the_delivery_before(spark, staged, monkeypatch):
    src = read_sources(spark, f"{staged}/sources")
    first = run(spark, src, f"{staged}/out", run_date="x", csv=False)
    before = sorted(map(str, read_delivery(spark, first.out_dir, "SOM").collect()))
    assert len(before) == 75

    def killed(*args, **kwargs):
        written(*args, **kwargs)
        raise KeyboardInterrupt

    written = run_mod.write_delivery
    monkeypatch.setattr(run_mod, "write_delivery", killed)
    with pytest.raises(KeyboardInterrupt):
        run(spark, src, f"{staged}/out", start=2014, run_date="x", csv=False)
    later = first.out_dir.replace("2012", "2014")
    assert versions(spark, later) == []
    with pytest.raises(KeyboardInterrupt):
        run(spark, src, f"{staged}/out", run_date="x", csv=False)
    assert [v for v, _ in versions(spark, first.out_dir)] == [first.version]
    assert sorted(map(str, read_delivery(spark, first.out_dir, "SOM").collect())) == before

    monkeypatch.undo()
    second = run(spark, src, f"{staged}/out", run_date="x", csv=False, keep_versions=1)
    assert [v for v, _ in versions(spark, first.out_dir)] == [second.version, first.version]
    assert sorted(map(str, read_delivery(spark, first.out_dir, "SOM").collect())) == before
    assert os.path.isdir(version_dir(first.out_dir, second.version)) and not os.path.isdir(version_dir(first.out_dir, first.version))
    with pytest.raises(KeyError, match="no table nothing"):
        read_delivery(spark, first.out_dir, "nothing")
    with pytest.raises(FileNotFoundError):
        read_delivery(spark, f"{staged}/nowhere", "SOM")


def test_the_extract_is_read_twice(staged):
    """Counted from the event log of a run of its own."""
    os.makedirs(f"{staged}/events")
    os.makedirs(f"{staged}/shared")
    job = f"""
import sys
from regstat.plans import run
run.main(["--sources", "{staged}/sources", "--out", "{staged}/logged", "--run-date", "x"])
"""
    conf = {
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{staged}/events", "spark.ui.enabled": "false",
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false", "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": f"{staged}/shared", "spark.sql.maxMetadataStringLength": "2000",
    }
    settings = "".join(f".config({k!r}, {v!r})" for k, v in conf.items())
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    made = f"from pyspark.sql import SparkSession\nSparkSession.builder.master('local[4]'){settings}.getOrCreate()\n"
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_GATEWAY_PORT"} | {"PYTHONPATH": repo}
    done = subprocess.run([sys.executable, "-c", made + job], env=env, capture_output=True, text=True, timeout=400)
    assert done.returncode == 0, done.stderr[-2000:]
    scans = []
    for name in os.listdir(f"{staged}/events"):
        for line in open(f"{staged}/events/{name}"):
            event = json.loads(line)
            if event["Event"].endswith("SQLExecutionStart"):
                scans += re.findall(r'"Location":"[^"]*?regstat-work-[0-9a-f]+/(\w+)', json.dumps(event["sparkPlanInfo"], separators=(",", ":")))
    assert scans.count("extract") == 2, scans
    assert scans.count("cohort") == 1 and scans.count("residence_by_year") == 1, scans


def test_no_copies_of_rows_for_distinct_counts(spark, staged):
    src = read_sources(spark, f"{staged}/sources")
    extract = episodes.extract_all(src)
    svc = checks.service_list(spark)
    plans = [
        checks.care_level_precheck(src.codes["AVT"], src.stays["AVT"]),
        checks.included_totals(src.codes["AVT"], src.stays["AVT"]),
        checks.persons_per_service_year(extract),
        checks.persons_per_service(extract, svc),
        checks.cohort_years(extract),
    ]
    for df in plans:
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()
