"""Residence by year (P3), wide form (P4/H5) and unpivot (H6): S5, S6, B17-B21."""

from __future__ import annotations

from conftest import SF_MID, D, make_sources

from regstat.operators import episodes, residence
from regstat.sources.readers import fixture_sources


def _by_year(spark, rows, pids=("1",)):
    src = make_sources(spark, residence=rows)
    cohort = spark.createDataFrame([(p,) for p in pids], "person_id string")
    out = residence.residence_by_year(cohort, src.residence).collect()
    return {(r["person_id"], r["year"]): r["municipality"] for r in out}


def test_interval_ends_inclusive(spark):
    got = _by_year(spark, [(1, D("2014-01-01"), D("2014-12-31"), "301")])
    assert got == {("1", 2014): "0301"}


def test_open_interval(spark):
    got = _by_year(spark, [(1, D("2020-06-01"), None, "1103")])
    assert sorted(y for _, y in got) == [2020, 2021, 2022, 2023, 2024, 2025]


def test_null_from_date_never_matches(spark):
    assert _by_year(spark, [(1, None, D("2015-01-01"), "1103")]) == {}


def test_fallback_to_december(spark):
    got = _by_year(spark, [(1, D("2014-06-01"), D("2015-03-01"), "1103")])
    assert got == {("1", 2014): "1103", ("1", 2015): "1103"}


def test_both_missing_no_row_but_wide_keeps_person(spark):
    src = make_sources(spark, residence=[(1, D("2014-03-01"), D("2014-10-01"), "1103")])
    cohort = spark.createDataFrame([("1",), ("2",)], "person_id string")
    assert residence.residence_by_year(cohort, src.residence).count() == 0
    wide = residence.residence_wide(cohort, src.residence).collect()
    assert len(wide) == 2
    assert all(v is None for r in wide for k, v in r.asDict().items() if k != "person_id")


def test_sentinel_beats_real_then_falls_back(spark):
    rows = [
        (1, D("2013-06-01"), D("2014-06-01"), "9999"),
        (1, D("2013-06-01"), D("2014-06-01"), "0301"),
        (1, D("2014-06-02"), None, "1103"),
    ]
    got = _by_year(spark, rows)
    assert got[("1", 2014)] == "1103"


def test_max_is_textual(spark):
    rows = [(1, D("2013-06-01"), None, "301"), (1, D("2013-06-01"), None, "1103")]
    assert _by_year(spark, rows)[("1", 2014)] == "0301"


def test_too_long_code_does_not_fall_back(spark):
    rows = [(1, D("2013-06-01"), D("2014-06-01"), "12345"), (1, D("2014-06-02"), None, "1103")]
    got = _by_year(spark, rows)
    assert ("1", 2014) not in got and got[("1", 2015)] == "1103"


def test_empty_string_sentinel(spark):
    rows = [(1, D("2013-06-01"), D("2014-06-01"), ""), (1, D("2014-06-02"), None, "0220")]
    assert _by_year(spark, rows)[("1", 2014)] == "0220"


def test_reversed_interval_is_ignored(spark):
    assert _by_year(spark, [(1, D("2016-01-01"), D("2014-01-01"), "0301")]) == {}


def test_outside_period(spark):
    got = _by_year(spark, [(1, D("2005-01-01"), D("2012-01-01"), "0301"), (1, D("2026-01-01"), None, "0220")])
    assert got == {("1", 2012): "0301"}


def test_only_cohort_persons(spark):
    rows = [(1, D("2014-01-01"), None, "0301"), (2, D("2014-01-01"), None, "0301")]
    assert {p for p, _ in _by_year(spark, rows, pids=("2",))} == {"2"}


def test_one_row_per_person_year_and_wide_roundtrip(spark):
    src = fixture_sources(spark, SF_MID)
    e = episodes.extract_all(src)
    cohort = residence.cohort(e)
    long = residence.residence_by_year(cohort, src.residence)
    assert long.groupBy("person_id", "year").count().filter("count > 1").count() == 0
    via_wide = residence.wide_to_long(residence.residence_wide(cohort, src.residence))
    assert long.count() > 0
    assert long.exceptAll(via_wide).count() == 0 and via_wide.exceptAll(long).count() == 0
