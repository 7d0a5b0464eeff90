"""Print the physical plans of the headline operators as a large cluster
would get them: broadcasts off, so every join is a shuffle join.

    python -m regstat.plans.show --sources ROOT > PLANS.md

For each operator: the operator tree, the exchange count and what reaches
each parquet scan (partition filters, pushed filters, read schema).
"""

from __future__ import annotations

import argparse
import contextlib
import io
import re
import uuid

from pyspark.sql import DataFrame

from regstat import catalogue as cat
from regstat.operators import episodes, places, residence, tabulate
from regstat.session import ensure_checkpoint_dir, local_session
from regstat.sources.readers import read_sources

AT_SCALE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def summary(df: DataFrame) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n\n")
    tree = tree.replace("== Physical Plan ==\n", "")
    lines = [tree.rstrip(), ""]
    lines.append(f"exchanges: {tree.count('Exchange')}")
    for block in details.split("\n\n"):
        if block.lstrip().startswith("(") and "Scan parquet" in block.split("\n")[0]:
            head = block.split("\n")[0].strip()
            keep = [ln.strip() for ln in block.split("\n")[1:]
                    if ln.startswith(("PartitionFilters", "PushedFilters", "ReadSchema"))]
            keep = [re.sub(r"#\d+L?", "", ln) for ln in keep]
            lines.append(f"{head}: " + " | ".join(keep))
    return "\n".join(lines)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sources", required=True)
    a = ap.parse_args(argv)
    spark = local_session(8, 16, extra=AT_SCALE)
    src = read_sources(spark, a.sources)
    # later stages read the written extract and residence, as the run does
    work = f"{ensure_checkpoint_dir(spark) or '/tmp'}/regstat-show-{uuid.uuid4().hex[:8]}"
    ext_plan = episodes.extract_all(src)
    ext_plan.write.mode("overwrite").partitionBy("service").parquet(f"{work}/extract")
    ext = spark.read.parquet(f"{work}/extract")
    res_plan = residence.residence_by_year(residence.cohort(ext), src.residence)
    res_plan.write.mode("overwrite").parquet(f"{work}/residence")
    res = spark.read.parquet(f"{work}/residence")
    joined = tabulate.episodes_with_residence(ext, res)
    shown = {
        "E1 / P1 - episodes of all five services (extract_all)": ext_plan,
        "P3 - residence by year for the cohort (reads the written extract)": res_plan,
        "E12 - profile counts, all services, two-level (reads the written tables)": tabulate.profile_counts(
            joined, cat.ALL_GROUP_NAMES, extra_keys=("service",)
        ),
        "E12 - the same with countDistinct (for comparison)": tabulate.profile_counts_distinct(
            joined, cat.ALL_GROUP_NAMES, extra_keys=("service",)
        ),
        "P5 - place dimension": places.places(src.places),
    }
    print("# Physical plans at cluster shape\n")
    print("Generated by `python -m regstat.plans.show --sources <staged sf0.1>` with broadcasts")
    print("disabled, so every join is planned as it would be at 100 TB. AQE is on; these are")
    print("the initial plans (AQE may still coalesce partitions or split skewed ones).\n")
    for title, df in shown.items():
        print(f"## {title}\n\n```\n{summary(df)}\n```\n")
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
