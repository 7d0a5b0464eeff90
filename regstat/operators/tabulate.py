"""Profile tables: distinct persons per (year, municipality, sex, age) and
diagnosis group, with place names attached.

Counting plan (E12). ``count(DISTINCT CASE WHEN flag = 1 THEN person_id END)``
for 6-9 groups makes Catalyst expand every row once per group before the
shuffle. The two-level form is exact and has no Expand:

  level 1: groupBy(keys + person_id) max(flag)   - runs on the join's
           partitioning (hash of person_id, year), so no extra shuffle
  level 2: groupBy(keys) sum(flag)               - one shuffle, partial
           aggregation first, so a large municipality adds at most one row
           per task and cell to the shuffle

A person counts once per cell; cells are not additive across groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regstat import catalogue as cat
from regstat.functions.scalar import care_level_ok

KEYS = ("year", "municipality", "sex", "age")


def episodes_with_residence(
    extract: DataFrame,
    res_by_year: DataFrame,
    start: int = cat.START_YEAR,
    end: int = cat.END_YEAR,
) -> DataFrame:
    """Extract rows (care level and period re-checked, B8/B11) with the
    person's municipality that year; persons without one drop."""
    e = extract.filter(care_level_ok("care_level") & F.col("year").between(start, end))
    return e.join(res_by_year, ["person_id", "year"], "inner")


def profile_counts(joined: DataFrame, groups, extra_keys=(), with_rows: bool = False) -> DataFrame:
    """Two-level distinct-person counts per cell (0 when none, never NULL).

    ``with_rows`` also carries ``n_rows``, the joined rows behind each cell,
    so the control table's "rows after the residence join" comes from this
    small result instead of a second pass over the join."""
    keys = [*extra_keys, *KEYS]
    level1 = [F.expr(f"max({g}) AS {g}") for g in groups]
    level2 = [F.expr(f"CAST(coalesce(sum({g}), 0) AS BIGINT) AS {g}") for g in groups]
    if with_rows:
        level1.append(F.expr("count(1) AS n_rows"))
        level2.append(F.expr("CAST(sum(n_rows) AS BIGINT) AS n_rows"))
    per_person = joined.groupBy(*keys, "person_id").agg(*level1)
    return per_person.groupBy(*keys).agg(*level2)


def profile_counts_distinct(joined: DataFrame, groups, extra_keys=()) -> DataFrame:
    """The same counts with conditional ``countDistinct`` (Catalyst Expand).
    Kept for the equivalence test and the benchmark."""
    keys = [*extra_keys, *KEYS]
    return joined.groupBy(*keys).agg(
        *[
            F.expr(f"CAST(count(DISTINCT CASE WHEN {g} = 1 THEN person_id END) AS BIGINT) AS {g}")
            for g in groups
        ]
    )


def with_places(counts: DataFrame, place_dim: DataFrame) -> DataFrame:
    """Attach names; an unknown code keeps its row with NULL names. The
    dimension is one row per code, so the join never multiplies rows."""
    p = place_dim.withColumnRenamed("kommunenr", "municipality")
    return counts.join(p, "municipality", "left")


def deliver(df: DataFrame, groups, sort: bool = True) -> DataFrame:
    """Delivery headers and column order, sorted by year,
    municipality, sex, age (unknown age last)."""
    if sort:
        df = df.orderBy("year", "municipality", "sex", F.col("age").asc_nulls_last())
    cols = [F.col(src).alias(dst) for src, dst in cat.PROFILE_KEY_HEADERS]
    return df.select(*cols, *[F.col(g) for g in groups])


def profile(
    extract: DataFrame,
    res_by_year: DataFrame,
    place_dim: DataFrame,
    spec,
    start: int = cat.START_YEAR,
    end: int = cat.END_YEAR,
    sort: bool = True,
) -> DataFrame:
    """The delivered profile table of one service."""
    e = extract.filter(F.col("service") == spec.name)
    joined = episodes_with_residence(e, res_by_year, start, end)
    counts = profile_counts(joined, spec.group_names)
    return deliver(with_places(counts, place_dim), spec.group_names, sort)


def profiles_all(
    extract: DataFrame,
    res_by_year: DataFrame,
    place_dim: DataFrame,
    start: int = cat.START_YEAR,
    end: int = cat.END_YEAR,
) -> DataFrame:
    """All services in one pass: one residence join and one two-level
    aggregate keyed by service, with every group column (0 where a group
    does not belong to the service) and ``n_rows``. Each delivered table is
    a filter on ``service`` of this result."""
    joined = episodes_with_residence(extract, res_by_year, start, end)
    counts = profile_counts(joined, cat.ALL_GROUP_NAMES, extra_keys=("service",), with_rows=True)
    return with_places(counts, place_dim)


def split_profile(all_counts: DataFrame, spec, sort: bool = True) -> DataFrame:
    """One service's delivered table out of ``profiles_all``."""
    return deliver(all_counts.filter(F.col("service") == spec.name), spec.group_names, sort)
