"""Episode extraction: select a service's relevant code rows, attach them to
their stay and the person dimension, and collapse to one row per stay.

Plan (per service), all lazy:

  codes --filter(selector, years, relevant code)--> flags     per service
  stays --filter(id, years, care level[, rehab, level])       per service
  ---- union of the services (extract_all), then once for all of them ----
  codes: groupBy(service, stay_key, year) max(flags)  partial agg before shuffle
  join on (service, stay_key, year)                   sort-merge (AQE may broadcast)
  left join persons on person_id
  groupBy(service, stay_key) max(flags),
                             min(struct(pick))        one row per episode

Folding code rows per (stay_key, year) before the join is exact: code rows
only contribute flags, and candidates for the representative row are stay x
person rows, which the fold does not change.

Representative row. The source job's pick is arbitrary (row_number ordered by
the partition key). We fix one whole row: the least by (year, person_id,
care_level, age, sex, home_municipality), NULLs last.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regstat import catalogue as cat
from regstat.catalogue import ServiceSpec
from regstat.functions.codes import cohort_predicate_sql, group_flag_sql, main_diagnosis_sql
from regstat.functions.scalar import age_at_sql, sex_label_sql, stay_conditions_sql

EPISODE_COLUMNS = (
    "person_id",
    "episode_id",
    "age",
    "sex",
    "home_municipality",
    "year",
    "service",
    "care_level",
)

# Order of the representative-row pick: (column, may be NULL).
PICK_ORDER = (
    ("year", False),
    ("person_id", False),
    ("care_level", False),
    ("age", True),
    ("sex", False),
    ("home_municipality", True),
)


def stay_filter_sql(spec: ServiceSpec, start: int, end: int) -> str:
    """SQL text of the stays predicate (B7, B8, B11-B13). The period, care
    level, rehab and level tests are plain comparisons, so parquet receives
    them as pushed filters; the id-length test runs right after the scan."""
    cond = [*stay_conditions_sql(), f"year BETWEEN {start} AND {end}"]
    if spec.somatic_stay_filter:
        cond.append(f"(is_rehab IS NULL OR is_rehab = {cat.REHAB_KEEP})")
        cond.append(f"niva <> '{cat.LEVEL_EXCLUDED}'")
    return " AND ".join(cond)


def stay_filter(spec: ServiceSpec, start: int, end: int):
    """Predicate on a stays table."""
    return F.expr(stay_filter_sql(spec, start, end))


def valid_stays(stays: DataFrame, spec: ServiceSpec, start: int, end: int) -> DataFrame:
    return stays.filter(stay_filter(spec, start, end))


def _main_sql(spec: ServiceSpec, start: int, end: int) -> str:
    return f"{main_diagnosis_sql(spec.selector)} AND year BETWEEN {start} AND {end}"


def main_diagnosis_rows(codes: DataFrame, spec: ServiceSpec, start: int, end: int) -> DataFrame:
    """Code rows that are a main diagnosis in the period."""
    return codes.filter(F.expr(_main_sql(spec, start, end)))


def main_diagnosis_rows_all(sources, specs, start: int = cat.START_YEAR, end: int = cat.END_YEAR) -> DataFrame:
    """``main_diagnosis_rows`` of several services with a ``service`` column. Where
    the codes come as one table that is one filter, not a union in which one task holds
    a part of the table once for each service."""
    if sources.codes_together is None:
        parts = [
            main_diagnosis_rows(sources.codes[s.name], s, start, end).selectExpr(f"'{s.name}' AS service", "*")
            for s in specs
        ]
        return reduce(lambda x, y: x.unionByName(y), parts)
    # the first two tests say less than the last, but each is on one side of a join
    # below, so they reach the scans
    names = ", ".join(f"'{s.name}'" for s in specs)
    selectors = " OR ".join(sorted({main_diagnosis_sql(s.selector) for s in specs}))
    own = " OR ".join(f"(service = '{s.name}' AND {_main_sql(s, start, end)})" for s in specs)
    return sources.codes_together.filter(F.expr(f"service IN ({names}) AND ({selectors}) AND ({own})"))


def marked_codes(codes: DataFrame, spec: ServiceSpec, start: int, end: int) -> DataFrame:
    """Relevant main-diagnosis code rows with one 0/1 flag per group."""
    cond = f"{_main_sql(spec, start, end)} AND {cohort_predicate_sql('code', spec)}"
    return codes.filter(F.expr(cond)).selectExpr(
        "stay_key", "year", *[group_flag_sql("code", g) for g in spec.groups]
    )


def _person_lookup(persons: DataFrame) -> DataFrame:
    return persons.selectExpr(
        "rtrim(CAST(person_id AS STRING)) AS person_id",
        "birth_year",
        "CAST(sex AS STRING) AS dim_sex",
    )


def _stay_side(stays: DataFrame, spec: ServiceSpec, start: int, end: int) -> DataFrame:
    return valid_stays(stays, spec, start, end).selectExpr(
        "stay_key",
        "year",
        "person_id",
        "CAST(sex AS STRING) AS stay_sex",
        "home_municipality",
        "care_level",
    )


_AGE = age_at_sql("year", "birth_year")
_SEX = sex_label_sql("dim_sex", "stay_sex")


def marked_rows(
    codes: DataFrame,
    stays: DataFrame,
    persons: DataFrame,
    spec: ServiceSpec,
    start: int = cat.START_YEAR,
    end: int = cat.END_YEAR,
) -> DataFrame:
    """One row per relevant code row joined to its stay (on key and year) and
    the person dimension (left). No collapse."""
    j = (
        marked_codes(codes, spec, start, end)
        .join(_stay_side(stays, spec, start, end), ["stay_key", "year"], "inner")
        .join(_person_lookup(persons), "person_id", "left")
    )
    return j.selectExpr(
        "stay_key",
        "person_id",
        f"concat('{spec.name}', CAST(stay_key AS STRING)) AS episode_id",
        f"{_AGE} AS age",
        f"{_SEX} AS sex",
        "home_municipality",
        "year",
        f"'{spec.name}' AS service",
        "care_level",
        *spec.group_names,
    )


def _pick_sql() -> str:
    """The representative row as one struct whose ordering is the pick order.
    Struct ordering puts NULL first, so each nullable field is preceded by
    an is-null flag that sends NULL last."""
    fields = []
    for name, nullable in PICK_ORDER:
        if nullable:
            fields.append(f"'{name}_isnull', {name} IS NULL")
        fields.append(f"'{name}', {name}")
    return f"named_struct({', '.join(fields)})"


def stay_rows(codes: DataFrame, stays: DataFrame, spec: ServiceSpec, start: int, end: int, flags) -> DataFrame:
    """The stay rows of one service (see ``stay_rows_all``)."""
    return stay_rows_all({spec.name: codes}, {spec.name: stays}, [spec], start, end, flags)


def stay_rows_all(codes: dict, stays: dict, specs, start: int, end: int, flags) -> DataFrame:
    """The service-specific part of P1, for any number of services at once:
    each service's relevant code rows (its own selector and groups) and
    valid stays (its own filters) are unioned with a ``service`` column; the
    code rows are folded to one row per (service, stay_key, year) with
    partial aggregation, whose shuffle is the join's; then one join on
    (service, stay_key, year). Two services may share a key space, so the
    service is part of the key. ``flags`` lists the output flag columns;
    those a service does not have are NULL."""
    def coded(spec):
        own = spec.group_names
        return marked_codes(codes[spec.name], spec, start, end).selectExpr(
            f"'{spec.name}' AS service",
            "stay_key",
            "year",
            *[g if g in own else f"CAST(NULL AS INT) AS {g}" for g in flags],
        )

    def stayed(spec):
        return _stay_side(stays[spec.name], spec, start, end).selectExpr(f"'{spec.name}' AS service", "*")

    all_codes = reduce(lambda x, y: x.unionByName(y), [coded(sp) for sp in specs])
    all_stays = reduce(lambda x, y: x.unionByName(y), [stayed(sp) for sp in specs])
    per_stay_year = all_codes.groupBy("service", "stay_key", "year").agg(
        *[F.expr(f"max({g}) AS {g}") for g in flags]
    )
    j = per_stay_year.join(all_stays, ["service", "stay_key", "year"], "inner")
    return j.selectExpr(
        "service",
        "stay_key",
        "year",
        "person_id",
        "stay_sex",
        "home_municipality",
        "care_level",
        *flags,
    )


def collapse(rows: DataFrame, persons: DataFrame, flags) -> DataFrame:
    """Person attributes (left join) and one row per (service, stay_key):
    OR of the flags and one whole representative row (E1). One person join
    and one aggregate serve every service in ``rows``."""
    j = rows.join(_person_lookup(persons), "person_id", "left")
    picked = j.selectExpr(
        "service",
        "stay_key",
        "person_id",
        "year",
        "care_level",
        f"{_AGE} AS age",
        f"{_SEX} AS sex",
        "home_municipality",
        *flags,
    )
    ep = picked.groupBy("service", "stay_key").agg(
        F.expr(f"min({_pick_sql()}) AS pick"), *[F.expr(f"max({g}) AS {g}") for g in flags]
    )
    return ep.selectExpr(
        "pick.person_id AS person_id",
        "concat(service, CAST(stay_key AS STRING)) AS episode_id",
        "pick.age AS age",
        "pick.sex AS sex",
        "pick.home_municipality AS home_municipality",
        "pick.year AS year",
        "service",
        "pick.care_level AS care_level",
        *flags,
    )


def episodes(
    codes: DataFrame,
    stays: DataFrame,
    persons: DataFrame,
    spec: ServiceSpec,
    start: int = cat.START_YEAR,
    end: int = cat.END_YEAR,
) -> DataFrame:
    """One row per episode of one service, with OR-ed group flags and
    one whole representative row (E1)."""
    flags = spec.group_names
    return collapse(stay_rows(codes, stays, spec, start, end, flags), persons, flags)


#: Parts that the rows of an episode are dealt to before its window.
WINDOW_PARTS = 64


def windowed_parts(marked: DataFrame, flags) -> DataFrame:
    """First phase of F1 + F2: of each part of an episode's rows the first one under
    the pick order, with the maximum of every flag over the part. Rows are dealt to
    ``WINDOW_PARTS`` parts in turn, so no task holds a hot episode and at most so
    many rows of it are left. Maximum and first row of a whole are those of
    its parts, however the rows were dealt."""
    dealt = marked.withColumn("__part", F.pmod(F.monotonically_increasing_id(), F.lit(WINDOW_PARTS)))
    return _first_of(dealt, ["episode_id", "__part"], flags)


def _first_of(rows: DataFrame, keys: list[str], flags) -> DataFrame:
    whole = Window.partitionBy(*keys)
    order = [F.col(n).asc_nulls_last() if nullable else F.col(n).asc() for n, nullable in PICK_ORDER]
    ranked = rows.select(
        *EPISODE_COLUMNS,
        *[F.max(g).over(whole).alias(g) for g in flags],
        F.row_number().over(whole.orderBy(*order)).alias("episode_row"),
    )
    return ranked.filter(F.col("episode_row") == 1).drop("episode_row")


def episodes_window(
    codes: DataFrame,
    stays: DataFrame,
    persons: DataFrame,
    spec: ServiceSpec,
    start: int = cat.START_YEAR,
    end: int = cat.END_YEAR,
) -> DataFrame:
    """The same result in window form (F1 + F2): MAX(flag) over the episode and
    ROW_NUMBER() = 1 under the fixed pick order, in two phases: over the parts of
    each episode, then over what the parts have left. ``episodes`` is the cheaper
    plan, since it folds an episode before any shuffle."""
    m = marked_rows(codes, stays, persons, spec, start, end)
    return _first_of(windowed_parts(m, spec.group_names), ["episode_id"], spec.group_names)


def extract_all(sources, start: int = cat.START_YEAR, end: int = cat.END_YEAR) -> DataFrame:
    """All services' episodes in one long DataFrame with a ``service`` column.
    The services' code rows and stays are unioned before the first shuffle,
    so the code fold, the stay join, the person join and the collapse each
    run once for all services. Flags of groups a service does not have are
    NULL."""
    flags = list(cat.ALL_GROUP_NAMES)
    rows = stay_rows_all(sources.codes, sources.stays, sources.services, start, end, flags)
    return collapse(rows, sources.persons, flags).select(*EPISODE_COLUMNS, *flags)
