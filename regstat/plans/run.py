"""P10: the whole run, from sources to the delivered table set.

Stages and what crosses them:

  1. schema guards (no job)            stays must have care_level
  2. extracts, all services, one job   written to the work folder, read back; the
                                       care-level guard and the row checks are
                                       part of this job
  3. cohort with its years             written; the first pass over the extract,
                                       and every distinct count of persons
  4. residence by year for the cohort  written; counted in the same job
  5. profiles, all services, one pass  written, then split by service; the
                                       second and last pass over the extract
  6. control table, precheck, checks   from what was seen, and small aggregates
  7. the version of the delivery       published when all its tables are there

Intermediate tables live under the shared checkpoint folder the cluster
names in ``spark.checkpoint.dir``, or under the output folder when unset. Reading them
back cuts lineage: a lost executor recomputes at most
one stage from a written table, never the whole run.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from regstat import catalogue as cat
from regstat.operators import checks, episodes, places, residence, tabulate
from regstat.session import apply_recommended, configured_checkpoint_dir
from regstat.sources.readers import Sources
from regstat.sources.schemas import require_columns
from regstat.sources.sinks import drop_old_versions, new_version, publish, version_dir, write_delivery, write_table


@dataclass
class RunResult:
    out_dir: str
    work_dir: str
    version: str = ""
    tables: dict[str, str] = field(default_factory=dict)
    control: list[dict] = field(default_factory=list)
    empty_services: list[str] = field(default_factory=list)
    duplicate_places: int = 0
    residence_rows: int = 0
    stage_sec: dict[str, float] = field(default_factory=dict)


def _headers(df: DataFrame, headers) -> DataFrame:
    """Delivered column names (B23) for a check table."""
    return df.select(*[F.col(src).alias(dst) for src, dst in headers])


def _materialise(spark: SparkSession, df: DataFrame, path: str, partition_by=None) -> DataFrame:
    """Written and read back under its own schema: a partitioned table
    without rows leaves no file to infer one from."""
    write_table(df, path, partition_by)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def _observed(spark: SparkSession, df: DataFrame, metrics: list, path: str, partition_by=None) -> tuple[DataFrame, dict]:
    """``_materialise``, and the metrics of the rows that the job wrote. They are
    taken in the writing stage, where each partition counts once, however often
    its task had to run."""
    seen = Observation(f"written-{uuid.uuid4().hex}")
    back = _materialise(spark, df.observe(seen, *metrics), path, partition_by)
    return back, seen.get


def run(
    spark: SparkSession,
    sources: Sources,
    out: str,
    start: int = cat.START_YEAR,
    end: int = cat.END_YEAR,
    run_date: str | None = None,
    csv: bool = True,
    wide_residence: bool = False,
    keep_versions: int = 2,
) -> RunResult:
    """Run every step and write the delivered tables as the new version of
    ``out/profiles_<start>_<end>_<run_date>`` (read them by
    ``sinks.read_delivery``, or by the paths in ``RunResult.tables``); the data of
    all but the newest ``keep_versions`` go. The written extract and
    residence tables are listed in ``RunResult.tables`` too (``extract``,
    ``residence_by_year``); ``wide_residence`` also writes the 28-column
    residence table (P4) next to the delivered ones."""
    run_date = run_date or _dt.date.today().isoformat()
    base = configured_checkpoint_dir(spark) or f"{out.rstrip('/')}/_work"
    work = f"{base.rstrip('/')}/regstat-work-{uuid.uuid4().hex[:12]}"
    out_dir = f"{out.rstrip('/')}/profiles_{start}_{end}_{run_date}"
    version = new_version()
    data_dir = version_dir(out_dir, version)
    res = RunResult(out_dir=out_dir, work_dir=work, version=version)

    t0 = [time.time()]

    def mark(stage: str) -> None:
        now = time.time()
        res.stage_sec[stage] = round(now - t0[0], 3)
        t0[0] = now

    # 1. guards on schemas only
    sources.check()

    # 2. extracts of all services (P1 x 5, H3) - one job, partitioned by service,
    #    with the value guard (A17) and the row checks (E7-E10) in it
    plan = episodes.extract_all(sources, start, end)
    require_columns({"extract": plan}, ["care_level"], 50002)  # A14
    try:
        extract, seen = _observed(
            spark, checks.guarded(plan), checks.extract_metrics(sources.services), f"{work}/extract", ["service"]
        )
    except Exception as e:
        failed = checks.guard_error(e)
        if failed is None:
            raise
        raise failed from e
    mark("extract")

    # 3. cohort (P2) and the distinct counts of persons
    people, counted = _observed(
        spark,
        checks.cohort_years(extract, sources.services, start, end),
        checks.cohort_metrics(sources.services, start, end),
        f"{work}/cohort",
    )
    seen = {**seen, **counted}
    mark("cohort")

    # 4. residence for the cohort (P3). The cohort is a written table of distinct
    #    ids: without an aggregate above it AQE can split a hot person
    res_year, counted = _observed(
        spark,
        residence.residence_by_year(people.select("person_id"), sources.residence, start, end),
        [F.count(F.lit(1)).alias("rows")],
        f"{work}/residence_by_year",
    )
    res.residence_rows = counted["rows"]  # E15
    mark("residence")

    # places (P5) and duplicate warning
    raw_places = sources.places
    res.duplicate_places = checks.warn_duplicate_places(places.duplicates(raw_places))
    place_dim = places.places(raw_places)
    mark("places")

    # 5. all profiles in one pass (P6), then one delivered table per service
    joined = tabulate.episodes_with_residence(extract, res_year, start, end)
    counts = tabulate.profile_counts(joined, cat.ALL_GROUP_NAMES, extra_keys=("service",), with_rows=True)
    all_profiles = _materialise(
        spark, tabulate.with_places(counts, place_dim), f"{work}/profiles", ["service"]
    )
    # no global sort: the sink writes one directory per year, sorted within
    delivered = {s.label: tabulate.split_profile(all_profiles, s, sort=False) for s in sources.services}
    mark("profiles")

    # 6. control table (P9), precheck (P7), checks
    control_name, precheck_name = cat.CONTROL_TABLE_NAME, cat.PRECHECK_TABLE_NAME
    delivered[control_name] = _headers(
        checks.seen_control(spark, seen, all_profiles, sources.services), cat.CONTROL_HEADERS
    )
    avt = cat.service("AVT")
    pairs = _materialise(
        spark, checks.precheck_pairs(sources.codes[avt.name], sources.stays[avt.name], avt, start, end), f"{work}/precheck"
    )
    delivered[precheck_name] = _headers(checks.precheck_counts(pairs), cat.PRECHECK_HEADERS)
    quality = checks.seen_checks(spark, seen, sources.services, start, end)
    quality["included_totals"] = checks.totals_of(pairs)
    delivered.update({f"checks/{k}": v for k, v in quality.items()})
    mark("checks")
    labels = F.array(*[F.lit(s.label) for s in sources.services])
    profile_order = ["Bostedskommune", "Kjonn", F.col("Alder").asc_nulls_last()]
    orders = {s.label: profile_order for s in sources.services}
    service_header = dict(cat.CONTROL_HEADERS)["service"]
    orders[control_name] = [F.array_position(labels, F.col(service_header))]
    orders[precheck_name] = [F.col(dict(cat.PRECHECK_HEADERS)["care_level"]).asc_nulls_last()]
    orders["checks/persons_per_service_year"] = ["service", "year"]
    orders["checks/sex_distribution"] = ["service", "sex"]
    orders["checks/care_level_distribution"] = ["service", F.col("care_level").asc_nulls_last()]
    write_delivery(delivered, data_dir, csv=csv, orders=orders)
    mark("delivery")
    res.tables = {name: f"{data_dir}/{name}" for name in delivered}
    res.tables["extract"] = f"{work}/extract"
    res.tables["residence_by_year"] = f"{work}/residence_by_year"
    if wide_residence:
        wide = residence.residence_wide(people.select("person_id"), sources.residence, start, end)
        write_table(wide, f"{data_dir}/residence_wide/parquet")
        res.tables["residence_wide"] = f"{data_dir}/residence_wide"

    back = {h: c for c, h in cat.CONTROL_HEADERS}
    control = spark.read.parquet(f"{data_dir}/{control_name}/parquet")
    control = control.select(*[F.col(h).alias(back[h]) for h in back])
    res.empty_services = checks.warn_empty_services(control)  # A18
    res.control = [
        r.asDict() for r in control.orderBy(F.array_position(labels, F.col("service"))).collect()
    ]  # one row per service
    mark("control_readback")

    # 7. from here on readers get this version
    publish(spark, out_dir, version, [n for n in res.tables if n not in ("extract", "residence_by_year")])
    drop_old_versions(spark, out_dir, keep_versions)
    mark("publish")
    return res


def main(argv: list[str] | None = None) -> int:
    """Command line: ``python -m regstat.plans.run --sources ROOT --out DIR``.
    Uses the session it is submitted to, and sets only what that leaves unset."""
    import argparse
    import json

    from regstat.sources.readers import read_sources

    ap = argparse.ArgumentParser(description="Register profile statistics, whole run")
    ap.add_argument("--sources", required=True, help="staged layout: codes/ stays/ persons/ residence/ places/")
    ap.add_argument("--out", required=True, help="shared output folder")
    ap.add_argument("--start", type=int, default=cat.START_YEAR)
    ap.add_argument("--end", type=int, default=cat.END_YEAR)
    ap.add_argument("--run-date", default=None)
    ap.add_argument("--no-csv", action="store_true")
    ap.add_argument("--wide-residence", action="store_true", help="also write the 28-column residence table")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()  # the submitted session: its master and settings
    apply_recommended(spark)
    r = run(spark, read_sources(spark, a.sources), a.out, a.start, a.end, a.run_date,
            not a.no_csv, a.wide_residence)
    print(json.dumps({"out": r.out_dir, "control": r.control, "stage_sec": r.stage_sec,
                      "empty_services": r.empty_services, "residence_rows": r.residence_rows},
                     default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
