"""Quality checks, the care-level precheck, guards and the control table.

Checks are aggregates over the extracts; results are small (bounded by the
number of services, years, sexes or care levels), so the only driver-side
work is the guards' single-row look.
"""

from __future__ import annotations

import re
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regstat import catalogue as cat
from regstat.catalogue import ServiceSpec
from regstat.functions.scalar import care_level_ok, valid_person_id
from regstat.operators.episodes import main_diagnosis_rows
from regstat.functions.codes import cohort_predicate

IN_EXTRACT = cat.STATUS_IN_EXTRACT
NOT_IN_EXTRACT = cat.STATUS_NOT_IN_EXTRACT


class CareLevelError(RuntimeError):
    """An extract holds a care level outside the allowed ones, or NULL."""


# ---------------------------------------------------------------- precheck


def precheck_pairs(
    codes: DataFrame,
    stays: DataFrame,
    spec: ServiceSpec = cat.service("AVT"),
    start: int = cat.START_YEAR,
    end: int = cat.END_YEAR,
) -> DataFrame:
    """``care_level, stay_key, person_id, n_code_rows``: relevant main-diagnosis code
    rows joined to stays on (key, year), with the id filter but *no* care-level
    filter and no person join (S15), counted per level, stay and person. Code rows
    are folded per (key, year) before the join, so a stay with very many of them
    is one row by then."""
    c = main_diagnosis_rows(codes, spec, start, end).filter(cohort_predicate("code", spec))
    c = c.groupBy("stay_key", "year").agg(F.count(F.lit(1)).alias("n"))
    s = stays.filter(valid_person_id("person_id")).select("stay_key", "year", "person_id", "care_level")
    joined = c.join(s, ["stay_key", "year"], "inner")
    return joined.groupBy("care_level", "stay_key", "person_id").agg(F.sum("n").alias("n_code_rows"))


def filter_status(care_level) -> F.Column:
    """Label; NULL goes to the not-in-extract label."""
    return F.when(care_level_ok(care_level), F.lit(IN_EXTRACT)).otherwise(F.lit(NOT_IN_EXTRACT))


def precheck_counts(pairs: DataFrame) -> DataFrame:
    """E2 from ``precheck_pairs``. Each distinct count has two levels of plain
    aggregates over the pairs (whose exchange both branches share), and the two are
    added up; ``countDistinct`` on two columns would copy every row (Expand)."""
    zero = F.lit(0).cast("long")
    per_stay = pairs.groupBy("care_level", "stay_key").agg(F.sum("n_code_rows").alias("n_code_rows"))
    per_person = pairs.select("care_level", "person_id").distinct()
    counted = per_stay.select("care_level", "n_code_rows", F.lit(1).alias("n_stays"), zero.alias("n_persons")).unionByName(
        per_person.select("care_level", zero.alias("n_code_rows"), F.lit(0).alias("n_stays"), F.lit(1).cast("long").alias("n_persons"))
    )
    return (
        counted.groupBy("care_level", filter_status("care_level").alias("status"))
        .agg(*[F.sum(n).cast("long").alias(n) for n in ("n_code_rows", "n_stays", "n_persons")])
        .orderBy(F.col("care_level").asc_nulls_last())
    )


def totals_of(pairs: DataFrame) -> DataFrame:
    """E4 from ``precheck_pairs``, counted like ``precheck_counts``."""
    kept = pairs.filter(care_level_ok("care_level"))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    counted = (
        kept.select("stay_key").distinct().select(one.alias("n_stays"), none.alias("n_persons")).unionByName(
            kept.select("person_id").distinct().select(none.alias("n_stays"), one.alias("n_persons"))
        )
    )
    return counted.agg(*[F.coalesce(F.sum(n), none).alias(n) for n in ("n_stays", "n_persons")])


def care_level_precheck(
    codes: DataFrame,
    stays: DataFrame,
    spec: ServiceSpec = cat.service("AVT"),
    start: int = cat.START_YEAR,
    end: int = cat.END_YEAR,
) -> DataFrame:
    """Per care level (NULL sorted last): code rows, distinct stays,
    distinct persons, and whether the level is in the extract."""
    return precheck_counts(precheck_pairs(codes, stays, spec, start, end))


def included_totals(
    codes: DataFrame,
    stays: DataFrame,
    spec: ServiceSpec = cat.service("AVT"),
    start: int = cat.START_YEAR,
    end: int = cat.END_YEAR,
) -> DataFrame:
    """Distinct stays and persons that pass the care-level filter."""
    return totals_of(precheck_pairs(codes, stays, spec, start, end))


# ---------------------------------------------------------- quality checks


def service_list(spark: SparkSession, services=cat.SERVICES) -> DataFrame:
    """The configured services (a handful of catalogue rows): the left side
    that gives empty services their row."""
    return spark.createDataFrame(
        [(s.name, s.label, i) for i, s in enumerate(services)],
        "service string, label string, service_order int",
    )


def persons_per_service_year(extract: DataFrame) -> DataFrame:
    """E5."""
    return (
        extract.groupBy("service", "year")
        .agg(F.countDistinct("person_id").alias("n_persons"))
        .orderBy("service", "year")
    )


def persons_per_service(extract: DataFrame, services: DataFrame) -> DataFrame:
    """One row per service, 0 when it has no rows."""
    n = extract.groupBy("service").agg(F.countDistinct("person_id").alias("n_persons"))
    return services.join(n, "service", "left").select(
        "service", F.coalesce("n_persons", F.lit(0)).cast("long").alias("n_persons")
    )


def year_span(extract: DataFrame, services: DataFrame) -> DataFrame:
    """One row per service, NULL years when it has no rows."""
    n = extract.groupBy("service").agg(
        F.min("year").alias("min_year"), F.max("year").alias("max_year")
    )
    return services.join(n, "service", "left").select("service", "min_year", "max_year")


def sex_distribution(extract: DataFrame) -> DataFrame:
    """Rows per service and sex (empty services absent)."""
    return extract.groupBy("service", "sex").agg(F.count(F.lit(1)).alias("n")).orderBy(
        "service", "sex"
    )


def care_level_distribution(extract: DataFrame) -> DataFrame:
    """Rows per service and care level; expected only 1 and 2."""
    return (
        extract.groupBy("service", "care_level")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("service", "care_level")
    )


def violation(care_level) -> F.Column:
    """``NOT IN (1, 2) OR IS NULL``."""
    c = F.col(care_level) if isinstance(care_level, str) else care_level
    return ~c.isin(*cat.CARE_LEVELS) | c.isNull()


def rule_violations(rows: DataFrame) -> DataFrame:
    """Rows breaking the care-level rule per service (expected: none)."""
    return (
        rows.filter(violation("care_level"))
        .groupBy("service")
        .agg(F.count(F.lit(1)).alias("n_invalid"))
        .orderBy("service")
    )


def residence_persons(wide: DataFrame) -> DataFrame:
    """E11."""
    return wide.agg(F.countDistinct("person_id").alias("n_persons"))


def residence_preview(wide: DataFrame, n: int = 5) -> DataFrame:
    """A peek at the wide residence table; ordered so it is repeatable
    (the top-n is the feature: it is a look at a few rows)."""
    return wide.orderBy("person_id").limit(n)


def quality_checks(spark: SparkSession, extract: DataFrame, services=cat.SERVICES) -> dict[str, DataFrame]:
    """P8 over a (unioned) extract that is there already, one aggregate for each
    check. ``run`` gets the same tables without a scan of their own (``seen_checks``)."""
    svc = service_list(spark, services)
    return {
        "persons_per_service_year": persons_per_service_year(extract),
        "persons_per_service": persons_per_service(extract, svc),
        "year_span": year_span(extract, svc),
        "sex_distribution": sex_distribution(extract),
        "care_level_distribution": care_level_distribution(extract),
        "rule_violations": rule_violations(extract),
        "residence_persons": residence_persons(extract.select("person_id").distinct()),
    }


# ------------------------------------------- metrics observed while writing
#
# The checks below are counted by ``DataFrame.observe`` in the very jobs that write
# the extract, the cohort and the residence table, so none of them reads a
# table again. They are bounded by services, years, sexes and care levels.

SEX_LABELS = (cat.SEX_MEN, cat.SEX_WOMEN, cat.SEX_UNKNOWN)
#: Years that one long value has a bit for.
YEARS_PER_WORD = 62


def extract_metrics(services=cat.SERVICES) -> list[F.Column]:
    """E7-E10 and the rows of E13, over an extract as it is written."""
    out = []
    for s in services:
        own = F.col("service") == s.name
        out.append(F.count_if(own).alias(f"{s.name} rows"))
        out += [F.count_if(own & (F.col("sex") == x)).alias(f"{s.name} sex {x}") for x in SEX_LABELS]
        out += [F.count_if(own & (F.col("care_level") == x)).alias(f"{s.name} level {x}") for x in cat.CARE_LEVELS]
        out.append(F.count_if(own & violation("care_level")).alias(f"{s.name} invalid"))
        out.append(F.min(F.when(own, F.col("year"))).alias(f"{s.name} first"))
        out.append(F.max(F.when(own, F.col("year"))).alias(f"{s.name} last"))
    return out


def _words(service: ServiceSpec, start: int, end: int) -> list[tuple[str, list[int]]]:
    """The columns that hold a service's years, and the years in each."""
    span = cat.years(start, end)
    cuts = range(0, len(span), YEARS_PER_WORD)
    return [(f"{service.name}_years{k or ''}", span[lo : lo + YEARS_PER_WORD]) for k, lo in enumerate(cuts)]


def cohort_years(
    extract: DataFrame, services=cat.SERVICES, start: int = cat.START_YEAR, end: int = cat.END_YEAR
) -> DataFrame:
    """P2 with a bitmap: one row per person, and for each service the years in which
    the person is in the extract, as the bits of a long. One aggregate with a
    partial step gives the cohort and every distinct count of persons."""
    bits = []
    for s in services:
        for name, span in _words(s, start, end):
            own = f"service = '{s.name}' AND year BETWEEN {span[0]} AND {span[-1]}"
            bits.append(F.expr(f"bit_or(CASE WHEN {own} THEN shiftleft(1L, year - {span[0]}) ELSE 0L END)").alias(name))
    return extract.groupBy("person_id").agg(*bits)


def cohort_metrics(services=cat.SERVICES, start: int = cat.START_YEAR, end: int = cat.END_YEAR) -> list[F.Column]:
    """E5, E6, E11 and the persons of E13, over ``cohort_years`` as it is written."""
    out = [F.count(F.lit(1)).alias("persons")]
    for s in services:
        words = _words(s, start, end)
        any_year = " OR ".join(f"{name} <> 0" for name, _ in words)
        out.append(F.expr(f"count_if({any_year})").alias(f"{s.name} persons"))
        for name, span in words:
            out += [F.expr(f"count_if((shiftright({name}, {y - span[0]}) & 1) = 1)").alias(f"{s.name} persons {y}") for y in span]
    return out


def seen_checks(spark: SparkSession, seen: dict, services=cat.SERVICES, start: int = cat.START_YEAR, end: int = cat.END_YEAR):
    """P8 from what ``extract_metrics`` and ``cohort_metrics`` saw: the same tables,
    with the same columns and types, as ``quality_checks`` gives."""

    def small(rows: list[tuple], kind: str) -> DataFrame:
        return spark.createDataFrame(rows, kind)

    def counted(name: str, values, kind: str) -> DataFrame:
        rows = [(s.name, v, seen[f"{s.name} {name} {v}"]) for s in services for v in values]
        return small([r for r in rows if r[2]], kind)

    return {
        "persons_per_service_year": counted("persons", cat.years(start, end), "service string, year int, n_persons long"),
        "persons_per_service": small([(s.name, seen[f"{s.name} persons"]) for s in services], "service string, n_persons long"),
        "year_span": small(
            [(s.name, seen[f"{s.name} first"], seen[f"{s.name} last"]) for s in services],
            "service string, min_year int, max_year int",
        ),
        "sex_distribution": counted("sex", SEX_LABELS, "service string, sex string, n long"),
        "care_level_distribution": counted("level", cat.CARE_LEVELS, "service string, care_level int, n long"),
        "rule_violations": small(
            [(s.name, seen[f"{s.name} invalid"]) for s in services if seen[f"{s.name} invalid"]], "service string, n_invalid long"
        ),
        "residence_persons": small([(seen["persons"],)], "n_persons long"),
    }


def seen_control(spark: SparkSession, seen: dict, profile_rows: DataFrame, services=cat.SERVICES) -> DataFrame:
    """P9 / E13 as ``control_table`` gives it: the extract's numbers as seen, the
    rest from the (small) profile rows."""
    rows = [
        (s.name, s.label, i, seen[f"{s.name} rows"], seen[f"{s.name} persons"], seen[f"{s.name} level 1"], seen[f"{s.name} level 2"])
        for i, s in enumerate(services)
    ]
    known = spark.createDataFrame(
        rows,
        "service string, label string, service_order int, extract_rows long, extract_persons long, "
        "rows_care_level_1 long, rows_care_level_2 long",
    )
    return _control(known, profile_rows)


# ------------------------------------------------------------------ guards


#: Marks the guard's error where it is raised inside a Spark job.
GUARD = "care level guard:"


def guarded(extract: DataFrame) -> DataFrame:
    """A17 inside the plan: ``extract`` unchanged, and a job that reads the care
    level of a row outside (1, 2), or NULL, fails (see ``guard_error``)."""
    level = F.coalesce(F.col("care_level").cast("string"), F.lit("None"))
    said = F.concat(
        F.lit(f"{GUARD} service "), F.col("service"), F.lit(" has care level "), level, F.lit(f" outside {cat.CARE_LEVELS}")
    )
    checked = F.when(violation("care_level"), F.raise_error(said).cast("int")).otherwise(F.col("care_level"))
    return extract.withColumn("care_level", checked)


def guard_error(failure: Exception) -> CareLevelError | None:
    """The guard's error in the failure of a job that wrote ``guarded`` rows."""
    found = re.search(rf"{GUARD} (service \S+ has care level .*? outside \([0-9, ]+\))", str(failure))
    return CareLevelError(found[1]) if found else None


def guard_care_levels(extract: DataFrame) -> None:
    """A17 for an extract that is there already: one job over the union; only one
    offending row reaches the driver."""
    bad = extract.filter(violation("care_level")).select("service", "care_level").limit(1).collect()
    if bad:
        r = bad[0]
        raise CareLevelError(
            f"service {r['service']} has care level {r['care_level']!r} outside {cat.CARE_LEVELS}"
        )


def warn_empty_services(control: DataFrame) -> list[str]:
    """Warn for every service whose extract is empty (read from the
    control table, which is one row per service)."""
    empty = [r["service"] for r in control.filter(F.col("extract_rows") == 0).collect()]
    for s in empty:
        warnings.warn(f"{s}: 0 rows after the care-level restriction", stacklevel=2)
    return empty


def warn_duplicate_places(dups: DataFrame) -> int:
    """Warn when place codes are duplicated; the first row is kept."""
    n = dups.count()
    if n:
        warnings.warn(f"place dimension has {n} duplicated code(s); first row kept", stacklevel=2)
    return n


# ----------------------------------------------------------- control table


def control_table(extract: DataFrame, profile_rows: DataFrame, services: DataFrame) -> DataFrame:
    """Per service - extract rows, distinct persons, rows at care
    level 1 and 2, rows after the residence join, rows in the delivered
    table, and its first and last year (NULL when empty). Every service has
    a row (S7).

    ``profile_rows`` is the all-service profile with ``n_rows`` (see
    ``tabulate.profile_counts(..., with_rows=True)``): rows after the join
    are summed from it, so the join is not run a second time. Both inputs
    are reduced to one row per service before the joins."""
    a = extract.groupBy("service").agg(
        F.count(F.lit(1)).alias("extract_rows"),
        F.countDistinct("person_id").alias("extract_persons"),
        F.count_if(F.col("care_level") == 1).alias("rows_care_level_1"),
        F.count_if(F.col("care_level") == 2).alias("rows_care_level_2"),
    )
    return _control(services.join(a, "service", "left"), profile_rows)


def _control(known: DataFrame, profile_rows: DataFrame) -> DataFrame:
    c = profile_rows.groupBy("service").agg(
        F.sum("n_rows").alias("rows_with_residence"),
        F.count(F.lit(1)).alias("output_rows"),
        F.min("year").alias("min_year"),
        F.max("year").alias("max_year"),
    )
    counts = ["extract_rows", "extract_persons", "rows_care_level_1", "rows_care_level_2",
              "rows_with_residence", "output_rows"]
    return known.join(c, "service", "left").orderBy("service_order").select(
        F.col("label").alias("service"),
        *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in counts],
        "min_year",
        "max_year",
    )
