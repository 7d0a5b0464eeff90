"""Benchmark: time the headline operators at $BENCH_SF_DIR on local[$BENCH_CPUS].

Steps:
  1. stage the register inputs derived from the driver tables in the
     partitioned layout (codes/stays by service and year) - timed apart
  2. time each headline query end to end with a ``noop`` sink (every row is
     computed, nothing is collected), best of $BENCH_REPEAT runs
  3. print ONE JSON line

  episodes            E1: all five services, aggregate form
  episodes_window     E1 in window form (F1 + F2), for comparison
  residence_by_year   P3: explode over touched years, one aggregate
  residence_wide_long P4 + H6: 28-column form, then unpivot
  profiles            E12 two-level, all services in one pass
  profiles_distinct   E12 as countDistinct (Expand), for comparison
  whole_run           P10: extracts, residence, profiles, control, written
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from regstat import catalogue as cat  # noqa: E402
from regstat.operators import episodes, places, residence, tabulate  # noqa: E402
from regstat.plans.run import run  # noqa: E402
from regstat.session import local_session  # noqa: E402
from regstat.sources.readers import fixture_frames, read_sources  # noqa: E402
from regstat.sources.sinks import write_sources  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))


def _sf_of(path: str):
    tail = os.path.basename(path)
    try:
        return float(tail[2:]) if tail.startswith("sf") else tail
    except ValueError:
        return tail


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, max(8, CPUS * 2), app="regstat-bench")
    scratch = tempfile.mkdtemp(prefix="regstat-bench-", dir=os.environ.get("BENCH_SCRATCH", "/tmp"))

    t = time.time()
    write_sources(fixture_frames(spark, SF_DIR), f"{scratch}/sources")
    stage_sec = time.time() - t
    src = read_sources(spark, f"{scratch}/sources")

    def extract():
        return episodes.extract_all(src)

    def episodes_window():
        from functools import reduce

        parts = [
            episodes.episodes_window(src.codes[s.name], src.stays[s.name], src.persons, s)
            for s in cat.SERVICES
        ]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    # later stages read the written extract, as the whole run does
    ext_path = f"{scratch}/extract"
    extract().write.mode("overwrite").partitionBy("service").parquet(ext_path)
    ext = spark.read.parquet(ext_path)
    res_path = f"{scratch}/res"
    residence.residence_by_year(residence.cohort(ext), src.residence).write.mode("overwrite").parquet(res_path)
    res = spark.read.parquet(res_path)
    place_dim = places.places(src.places)
    joined = tabulate.episodes_with_residence(ext, res)

    headline = {
        "episodes": extract,
        "episodes_window": episodes_window,
        "residence_by_year": lambda: residence.residence_by_year(residence.cohort(ext), src.residence),
        "residence_wide_long": lambda: residence.wide_to_long(
            residence.residence_wide(residence.cohort(ext), src.residence)
        ),
        "profiles": lambda: tabulate.with_places(
            tabulate.profile_counts(joined, cat.ALL_GROUP_NAMES, extra_keys=("service",)), place_dim
        ),
        "profiles_distinct": lambda: tabulate.with_places(
            tabulate.profile_counts_distinct(joined, cat.ALL_GROUP_NAMES, extra_keys=("service",)),
            place_dim,
        ),
    }
    def best_of(action) -> float:
        best = None
        for i in range(REPEAT):
            t = time.time()
            action(i)
            d = time.time() - t
            best = d if best is None else min(best, d)
        return round(best, 3)

    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name, build in headline.items():
        try:
            times[name] = best_of(lambda _i, b=build: _noop(b()))
        except Exception as e:  # record and go on: one failure must not hide the rest
            times[name], errors[name] = None, f"{type(e).__name__}: {str(e)[:300]}"
    try:
        times["whole_run"] = best_of(
            lambda i: run(spark, src, f"{scratch}/out{i}", run_date="bench", csv=True)
        )
    except Exception as e:
        times["whole_run"], errors["whole_run"] = None, f"{type(e).__name__}: {str(e)[:300]}"

    parts = [times[k] for k in ("episodes", "residence_by_year", "profiles", "whole_run")]
    headline_total = sum(p for p in parts if p is not None)
    out = {
        "metric": "regstat_headline_total",
        "value": round(headline_total, 3),
        "unit": "sec",
        "queries": times,
        "stage_sources_sec": round(stage_sec, 3),
        "sf": _sf_of(SF_DIR),
        "cpus": CPUS,
        "repeat": REPEAT,
        "spark": spark.version,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
