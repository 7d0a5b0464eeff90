"""Registered queries: one per operator of the inventory, each a function
(spark, sf_dir) -> DataFrame over the driver tables (through the fixture
derivation in ``regstat.sources.fixtures``). Every query reads whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regstat import catalogue as cat
from regstat.functions.codes import cohort_predicate, group_flags
from regstat.operators import checks, episodes, places, residence, tabulate
from regstat.session import ensure_checkpoint_dir
from regstat.sources.readers import Sources, fixture_frames, fixture_sources, named_sources, read_sources
from regstat.sources.schemas import read_columns
from regstat.sources.sinks import write_table

Query = Callable[[SparkSession, str], DataFrame]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _per_service(src: Sources, fn) -> DataFrame:
    return _union([fn(s) for s in src.services])


# --------------------------------------------------------------- pieces


def code_group_flags(spark, sf_dir):
    """Relevant main-diagnosis code rows with their group flags."""
    src = fixture_sources(spark, sf_dir)

    def one(s):
        c = episodes.main_diagnosis_rows(src.codes[s.name], s, cat.START_YEAR, cat.END_YEAR)
        return c.filter(cohort_predicate("code", s)).select(
            F.lit(s.name).alias("service"), "stay_key", "year", "code", *group_flags("code", s.groups)
        )

    return _per_service(src, one).select("service", "stay_key", "year", "code", *cat.ALL_GROUP_NAMES)


def valid_stays(spark, sf_dir):
    """Stays passing id, period, care-level (and, for SOM,
    rehab and level) filters."""
    src = fixture_sources(spark, sf_dir)
    return _per_service(
        src,
        lambda s: episodes.valid_stays(src.stays[s.name], s, cat.START_YEAR, cat.END_YEAR).select(
            F.lit(s.name).alias("service"),
            "stay_key", "year", "person_id", "sex", "home_municipality", "care_level",
        ),
    )


def main_diagnosis_type(spark, sf_dir):
    """code_type / code_no selector (SOM, PHV, TSB, AVT)."""
    src = fixture_sources(spark, sf_dir)
    specs = [s for s in src.services if s.selector.kind == "type"]
    return episodes.main_diagnosis_rows_all(src, specs).select("service", "stay_key", "year", "code")


def main_diagnosis_axis(spark, sf_dir):
    """Axis / condition selector (PHBU)."""
    src = fixture_sources(spark, sf_dir)
    specs = [s for s in src.services if s.selector.kind == "axis"]
    return episodes.main_diagnosis_rows_all(src, specs).select("service", "stay_key", "year", "code")


def codes_join_stays(spark, sf_dir):
    """Relevant code rows x valid stays on (stay_key, year)."""
    src = fixture_sources(spark, sf_dir)

    def one(s):
        c = episodes.marked_codes(src.codes[s.name], s, cat.START_YEAR, cat.END_YEAR)
        st = episodes.valid_stays(src.stays[s.name], s, cat.START_YEAR, cat.END_YEAR)
        return c.join(st, ["stay_key", "year"], "inner").select(
            F.lit(s.name).alias("service"), "stay_key", "year", "person_id", "care_level",
            "home_municipality", *s.group_names,
        )

    return _per_service(src, one).select(
        "service", "stay_key", "year", "person_id", "care_level", "home_municipality",
        *cat.ALL_GROUP_NAMES,
    )


def stays_person_attributes(spark, sf_dir):
    """Code rows with episode id, age and sex label from the
    person dimension (left join)."""
    src = fixture_sources(spark, sf_dir)
    return _per_service(
        src,
        lambda s: episodes.marked_rows(src.codes[s.name], src.stays[s.name], src.persons, s),
    ).select("stay_key", *episodes.EPISODE_COLUMNS, *cat.ALL_GROUP_NAMES)


# -------------------------------------------------------------- episodes


def _episodes_query(name: str, window: bool = False) -> Callable:
    spec = cat.service(name)

    def q(spark, sf_dir):
        src = fixture_sources(spark, sf_dir)
        fn = episodes.episodes_window if window else episodes.episodes
        return fn(src.codes[spec.name], src.stays[spec.name], src.persons, spec)

    q.__doc__ = f"P1 / E1 for {spec.name}" + (" (window form F1 + F2)" if window else "")
    return q


def _extract(spark, sf_dir) -> tuple[Sources, DataFrame]:
    src = fixture_sources(spark, sf_dir)
    return src, episodes.extract_all(src)


def extract_from_service_folders(spark, sf_dir):
    """The extract of all services from staged folders in which each
    service has only the columns that it reads."""
    root = f"{ensure_checkpoint_dir(spark)}/regstat-staged-{uuid.uuid4().hex}"
    frames = fixture_frames(spark, sf_dir)
    # the codes of all services are derived once, not once for each service
    write_table(frames["codes"], f"{root}/all/codes")
    frames["codes"] = spark.read.schema(frames["codes"].schema).parquet(f"{root}/all/codes")
    for spec in cat.SERVICES:
        for kind, columns in read_columns(spec).items():
            own = frames[kind].filter(F.col("service") == spec.name).select(*columns)
            write_table(own, f"{root}/{kind}/service={spec.name}", ["year"])
    for name in ("persons", "residence", "places"):
        write_table(frames[name], f"{root}/{name}")
    return episodes.extract_all(read_sources(spark, root))


def extract_from_named_tables(spark, sf_dir):
    """The extract of all services from ten tables with the register's own
    names of tables, keys and columns."""
    frames = fixture_frames(spark, sf_dir)
    views = {}
    for service, (codes, stays, key) in cat.SERVICE_TABLES.items():
        for kind, name in (("codes", codes), ("stays", stays)):
            theirs = {**cat.SOURCE_COLUMNS[kind], "stay_key": key}
            own = frames[kind].filter(F.col("service") == service).drop("service")
            own.withColumnsRenamed(theirs).createOrReplaceTempView(views.setdefault(name, f"regstat_{name}"))
    other = {k: frames[k].withColumnsRenamed(cat.SOURCE_COLUMNS[k]) for k in ("persons", "residence")}
    return episodes.extract_all(named_sources(spark, views, other["persons"], other["residence"], frames["places"]))


def cohort_persons(spark, sf_dir):
    """P2 / H1."""
    _, e = _extract(spark, sf_dir)
    return residence.cohort(e)


def residence_by_year(spark, sf_dir):
    """Long form by explode over touched years."""
    src, e = _extract(spark, sf_dir)
    return residence.residence_by_year(e.select("person_id"), src.residence)


def residence_wide(spark, sf_dir):
    """28 dated columns, all-NULL rows kept."""
    src, e = _extract(spark, sf_dir)
    return residence.residence_wide(residence.cohort(e), src.residence, ids=e.select("person_id"))


def residence_by_year_from_wide(spark, sf_dir):
    """H6: the wide table unpivoted with stack; equals residence_by_year."""
    src, e = _extract(spark, sf_dir)
    return residence.wide_to_long(residence.residence_wide(residence.cohort(e), src.residence, ids=e.select("person_id")))


def places_clean(spark, sf_dir):
    """P5."""
    return places.places(fixture_sources(spark, sf_dir).places)


def places_duplicates(spark, sf_dir):
    """A19."""
    return places.duplicates(fixture_sources(spark, sf_dir).places)


def episodes_with_residence(spark, sf_dir):
    """D4 over all services."""
    src, e = _extract(spark, sf_dir)
    r = residence.residence_by_year(e.select("person_id"), src.residence)
    return tabulate.episodes_with_residence(e, r)


def _profile_query(name: str) -> Callable:
    spec = cat.service(name)

    def q(spark, sf_dir):
        src = fixture_sources(spark, sf_dir)
        e = episodes.episodes(src.codes[spec.name], src.stays[spec.name], src.persons, spec)
        r = residence.residence_by_year(e.select("person_id"), src.residence)
        return tabulate.profile(e, r, places.places(src.places), spec)

    q.__doc__ = f"P6 / E12 / D5: delivered profile table of {spec.label}"
    return q


def profiles_all_services(spark, sf_dir):
    """All five profile tables in one pass (service column, all groups)."""
    src, e = _extract(spark, sf_dir)
    r = residence.residence_by_year(e.select("person_id"), src.residence)
    return tabulate.profiles_all(e, r, places.places(src.places))


# ---------------------------------------------------------------- checks


def care_level_precheck(spark, sf_dir):
    """P7 / E2, B14, G1 (AVT)."""
    src = fixture_sources(spark, sf_dir)
    return checks.care_level_precheck(src.codes["AVT"], src.stays["AVT"])


def included_totals(spark, sf_dir):
    """E4 (AVT)."""
    src = fixture_sources(spark, sf_dir)
    return checks.included_totals(src.codes["AVT"], src.stays["AVT"])


def persons_per_service_year(spark, sf_dir):
    _, e = _extract(spark, sf_dir)
    return checks.persons_per_service_year(e)


def persons_per_service(spark, sf_dir):
    _, e = _extract(spark, sf_dir)
    return checks.persons_per_service(e, checks.service_list(spark))


def year_span(spark, sf_dir):
    _, e = _extract(spark, sf_dir)
    return checks.year_span(e, checks.service_list(spark))


def sex_distribution(spark, sf_dir):
    _, e = _extract(spark, sf_dir)
    return checks.sex_distribution(e)


def care_level_distribution(spark, sf_dir):
    _, e = _extract(spark, sf_dir)
    return checks.care_level_distribution(e)


def rule_violations(spark, sf_dir):
    """E10 on the extracts: expected empty."""
    _, e = _extract(spark, sf_dir)
    return checks.rule_violations(e)


def stay_rule_violations(spark, sf_dir):
    """E10 on the unfiltered stays: shows what the extract filter removes."""
    src = fixture_sources(spark, sf_dir)
    stays = _union(
        [src.stays[s.name].select(F.lit(s.name).alias("service"), "care_level") for s in src.services]
    )
    return checks.rule_violations(stays)


def residence_persons(spark, sf_dir):
    """E11."""
    src, e = _extract(spark, sf_dir)
    return checks.residence_persons(residence.residence_wide(residence.cohort(e), src.residence, ids=e.select("person_id")))


def residence_preview(spark, sf_dir):
    """G4, ordered by person."""
    src, e = _extract(spark, sf_dir)
    return checks.residence_preview(residence.residence_wide(residence.cohort(e), src.residence, ids=e.select("person_id")))


def control_table(spark, sf_dir):
    """P9 / E13-E15."""
    src, e = _extract(spark, sf_dir)
    r = residence.residence_by_year(e.select("person_id"), src.residence)
    joined = tabulate.episodes_with_residence(e, r)
    counts = tabulate.profile_counts(joined, cat.ALL_GROUP_NAMES, extra_keys=("service",), with_rows=True)
    return checks.control_table(e, counts, checks.service_list(spark))


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {
        "code_group_flags": code_group_flags,
        "valid_stays": valid_stays,
        "main_diagnosis_type": main_diagnosis_type,
        "main_diagnosis_axis": main_diagnosis_axis,
        "codes_join_stays": codes_join_stays,
        "stays_person_attributes": stays_person_attributes,
    }
    for s in cat.SERVICES:
        q[f"episodes_{s.name.lower()}"] = _episodes_query(s.name)
    q["episodes_window_som"] = _episodes_query("SOM", window=True)
    q.update(
        {
            "extract_from_service_folders": extract_from_service_folders,
            "extract_from_named_tables": extract_from_named_tables,
            "cohort_persons": cohort_persons,
            "residence_by_year": residence_by_year,
            "residence_wide": residence_wide,
            "residence_by_year_from_wide": residence_by_year_from_wide,
            "places_clean": places_clean,
            "places_duplicates": places_duplicates,
            "episodes_with_residence": episodes_with_residence,
        }
    )
    for s in cat.SERVICES:
        q[f"profile_{s.name.lower()}"] = _profile_query(s.name)
    q.update(
        {
            "profiles_all_services": profiles_all_services,
            "care_level_precheck": care_level_precheck,
            "included_totals": included_totals,
            "persons_per_service_year": persons_per_service_year,
            "persons_per_service": persons_per_service,
            "year_span": year_span,
            "sex_distribution": sex_distribution,
            "care_level_distribution": care_level_distribution,
            "rule_violations": rule_violations,
            "stay_rule_violations": stay_rule_violations,
            "residence_persons": residence_persons,
            "residence_preview": residence_preview,
            "control_table": control_table,
        }
    )
    return q
