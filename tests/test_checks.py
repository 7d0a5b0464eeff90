"""Checks, guards, control table and the required-column guard."""

from __future__ import annotations

import pytest
from conftest import D, code, make_sources, stay

from regstat import catalogue as cat
from regstat.operators import checks, episodes, places, residence, tabulate
from regstat.sources.schemas import MissingColumnError, missing_columns, normalise, require_columns
from regstat.sources.schemas import STAYS

AVT = cat.service("AVT")


def _som_only(spark):
    return make_sources(
        spark,
        codes=[code("SOM", 1, 2014, "I219"), code("AVT", 9, 2014, "F329")],
        stays=[stay("SOM", 1, 2014, "11", sex="1"), stay("AVT", 9, 2014, "11", care=3)],
        persons=[(11, 1950, "1")],
        residence=[(11, D("2010-01-01"), None, "0301")],
        places=[("0301", "Oslo", "0301", "Oslo", "03", "Oslo", "03", "Oslo")],
    )


def test_empty_service_rows(spark):
    src = _som_only(spark)
    e = episodes.extract_all(src)
    svc = checks.service_list(spark)
    n = {r["service"]: r["n_persons"] for r in checks.persons_per_service(e, svc).collect()}
    assert n == {"SOM": 1, "PHV": 0, "TSB": 0, "PHBU": 0, "AVT": 0}
    span = {r["service"]: (r["min_year"], r["max_year"]) for r in checks.year_span(e, svc).collect()}
    assert span["SOM"] == (2014, 2014) and span["AVT"] == (None, None)
    assert {r["service"] for r in checks.sex_distribution(e).collect()} == {"SOM"}

    r = residence.residence_by_year(residence.cohort(e), src.residence)
    joined = tabulate.episodes_with_residence(e, r)
    counts = tabulate.profile_counts(joined, cat.ALL_GROUP_NAMES, extra_keys=("service",), with_rows=True)
    control = checks.control_table(e, counts, svc)
    rows = {x["service"]: x.asDict() for x in control.collect()}
    assert rows["SOM"]["extract_rows"] == 1 and rows["SOM"]["output_rows"] == 1
    assert rows["SOM"]["rows_care_level_1"] == 1 and rows["SOM"]["rows_with_residence"] == 1
    assert rows["AVTPHV"]["extract_rows"] == 0 and rows["AVTPHV"]["min_year"] is None
    with pytest.warns(UserWarning, match="0 rows"):
        empty = checks.warn_empty_services(control)
    assert set(empty) == {"PHV", "TSB", "PHBU", "AVTPHV"}


def test_precheck_labels_and_null_last(spark):
    src = make_sources(
        spark,
        codes=[code("AVT", k, 2014, "F329") for k in range(1, 6)] + [code("AVT", 1, 2014, "F100")],
        stays=[stay("AVT", 1, 2014, "11", care=1), stay("AVT", 2, 2014, "12", care=2),
               stay("AVT", 3, 2014, "13", care=3), stay("AVT", 4, 2014, "14", care=None),
               stay("AVT", 5, 2014, "14", care=None)],
    )
    rows = [r.asDict() for r in checks.care_level_precheck(src.codes["AVT"], src.stays["AVT"]).collect()]
    assert [r["care_level"] for r in rows] == [1, 2, 3, None]
    yes, no = cat.STATUS_IN_EXTRACT, cat.STATUS_NOT_IN_EXTRACT
    assert [r["status"] for r in rows] == [yes, yes, no, no]
    assert rows[0]["n_code_rows"] == 2 and rows[0]["n_stays"] == 1
    assert (rows[3]["n_stays"], rows[3]["n_persons"]) == (2, 1)
    tot = checks.included_totals(src.codes["AVT"], src.stays["AVT"]).first()
    assert (tot["n_stays"], tot["n_persons"]) == (2, 2)


def test_guard_stops_on_bad_care_level(spark):
    bad = spark.createDataFrame([("SOM", 3), ("PHV", 1)], "service string, care_level int")
    with pytest.raises(checks.CareLevelError):
        checks.guard_care_levels(bad)
    nul = spark.createDataFrame([("SOM", None)], "service string, care_level int")
    with pytest.raises(checks.CareLevelError):
        checks.guard_care_levels(nul)
    checks.guard_care_levels(spark.createDataFrame([("SOM", 2)], "service string, care_level int"))


def test_rule_violations(spark):
    df = spark.createDataFrame([("SOM", 3), ("SOM", None), ("PHV", 1)], "service string, care_level int")
    assert [(r["service"], r["n_invalid"]) for r in checks.rule_violations(df).collect()] == [("SOM", 2)]


def test_missing_column_stops_before_any_job(spark):
    stays = spark.createDataFrame([(1, 2014, "11")], "stay_key long, year int, person_id string")
    with pytest.raises(MissingColumnError) as e:
        require_columns({"SOM.stays": stays}, ["care_level"])
    assert e.value.code == 50001 and e.value.missing == [("SOM.stays", "care_level")]
    require_columns({"x": stays.withColumnRenamed("year", "YEAR")}, ["year"])  # case-insensitive
    miss = missing_columns(spark, {"stays": stays}, [("stays", "care_level"), ("stays", "year")])
    assert [tuple(r) for r in miss.collect()] == [("stays", "care_level")]


def test_normalise_case_types_and_ids(spark):
    raw = spark.createDataFrame(
        [("5", "x", "123  ", 1, "2")], "STAY_KEY string, Year string, PID string, care_level long, sex string"
    ).withColumnRenamed("PID", "Person_ID")
    n = normalise(raw, STAYS, ["person_id"])
    r = n.first().asDict()
    assert n.columns == [f.name for f in STAYS.fields]
    assert (r["stay_key"], r["year"], r["person_id"], r["care_level"], r["is_rehab"]) == (5, None, "123", 1, None)


def test_duplicate_place_warning(spark):
    raw = spark.createDataFrame(
        [("301", "a", "b", "c", "d", "e", "f", "g"), ("0301", "a2", "b", "c", "d", "e", "f", "g")],
        ",".join(f"{c} string" for c in cat.PLACE_COLUMNS),
    )
    with pytest.warns(UserWarning, match="duplicated"):
        assert checks.warn_duplicate_places(places.duplicates(raw)) == 1
