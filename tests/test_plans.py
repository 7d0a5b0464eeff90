"""Plan shape at cluster size (broadcasts off): the exchange counts and the
filters that reach parquet are part of the design, so they are tested."""

from __future__ import annotations

import tempfile

from conftest import SF_SMALL

from regstat import catalogue as cat
from regstat.operators import episodes, residence, tabulate
from regstat.plans.show import AT_SCALE, summary
from regstat.sources.readers import fixture_frames, read_sources
from regstat.sources.sinks import write_sources


def _exchanges(text: str) -> int:
    return int(text.split("exchanges: ")[1].split()[0])


def test_plan_shapes_at_cluster_size(spark):
    root = tempfile.mkdtemp(prefix="regstat-plans-", dir="/tmp")
    write_sources(fixture_frames(spark, SF_SMALL), f"{root}/sources")
    saved = {k: spark.conf.get(k) for k in AT_SCALE}
    try:
        for k, v in AT_SCALE.items():
            spark.conf.set(k, v)
        src = read_sources(spark, f"{root}/sources")
        ext_plan = episodes.extract_all(src)
        text = summary(ext_plan)
        # fold, stays, person join (two sides), collapse - once for all services
        assert _exchanges(text) == 5
        assert "In(care_level, [1,2])" in text and "EqualTo(code_type,6)" in text
        assert "(service = SOM)" in text and "(year >= 2012)" in text

        ext_plan.write.mode("overwrite").partitionBy("service").parquet(f"{root}/extract")
        ext = spark.read.parquet(f"{root}/extract")
        res_plan = residence.residence_by_year(residence.cohort(ext), src.residence)
        assert _exchanges(summary(res_plan)) == 2  # semi join only; the reduction reuses it
        res_plan.write.mode("overwrite").parquet(f"{root}/res")
        res = spark.read.parquet(f"{root}/res")
        joined = tabulate.episodes_with_residence(ext, res)
        two_level = summary(tabulate.profile_counts(joined, cat.ALL_GROUP_NAMES, extra_keys=("service",)))
        assert _exchanges(two_level) == 3 and "Expand" not in two_level
        distinct = summary(tabulate.profile_counts_distinct(joined, cat.ALL_GROUP_NAMES, extra_keys=("service",)))
        assert "Expand" in distinct
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
