"""Episode collapse (P1/E1) on literal fixtures, and the window form."""

from __future__ import annotations

from conftest import SF_MID, code, make_sources, stay

from regstat import catalogue as cat
from regstat.operators import episodes
from regstat.sources.readers import fixture_sources

SOM = cat.service("SOM")
PHV = cat.service("PHV")


def _ep(spark, codes, stays, persons=(), spec=SOM):
    src = make_sources(spark, codes=codes, stays=stays, persons=persons)
    return [r.asDict() for r in episodes.episodes(
        src.codes[spec.name], src.stays[spec.name], src.persons, spec
    ).collect()]


def test_flags_are_ored_within_a_stay(spark):
    rows = _ep(spark, [code("SOM", 1, 2014, "I219"), code("SOM", 1, 2014, "J449")],
               [stay("SOM", 1, 2014, "11")])
    assert len(rows) == 1
    r = rows[0]
    assert (r["I00_I99"], r["I21_I22"], r["J44"], r["M00_M99"]) == (1, 1, 1, 0)
    assert r["episode_id"] == "SOM1"


def test_key_in_two_years_is_one_episode(spark):
    rows = _ep(
        spark,
        [code("SOM", 7, 2013, "I219"), code("SOM", 7, 2014, "J449")],
        [stay("SOM", 7, 2013, "11"), stay("SOM", 7, 2014, "11")],
    )
    assert len(rows) == 1
    assert rows[0]["year"] == 2013 and rows[0]["I21_I22"] == 1 and rows[0]["J44"] == 1


def test_duplicate_person_rows_pick_smaller_age(spark):
    rows = _ep(spark, [code("SOM", 1, 2014, "I219")], [stay("SOM", 1, 2014, "11")],
               persons=[(11, 1950, "1"), (11, 1960, "1")])
    assert len(rows) == 1 and rows[0]["age"] == 54


def test_null_age_sorts_last_in_pick(spark):
    rows = _ep(
        spark,
        [code("SOM", 1, 2014, "I219")],
        [stay("SOM", 1, 2014, "11", care=1)],
        persons=[(11, None, "1"), (11, 1950, "1")],
    )
    assert rows[0]["age"] == 64


def test_whole_row_pick(spark):
    rows = _ep(
        spark,
        [code("SOM", 3, 2013, "I219"), code("SOM", 3, 2014, "I219")],
        [stay("SOM", 3, 2013, "11", care=2), stay("SOM", 3, 2014, "11", care=1)],
        persons=[(11, 1950, "1")],
    )
    assert (rows[0]["year"], rows[0]["age"], rows[0]["care_level"]) == (2013, 63, 2)


def test_rehab_and_level_filters(spark):
    stays = [
        stay("SOM", 1, 2014, "11", rehab=0, niva="A"),
        stay("SOM", 2, 2014, "11", rehab=1, niva="A"),
        stay("SOM", 3, 2014, "11", rehab=None, niva="A"),
        stay("SOM", 4, 2014, "11", rehab=0, niva="S"),
        stay("SOM", 5, 2014, "11", rehab=0, niva=None),
    ]
    codes = [code("SOM", k, 2014, "I219") for k in range(1, 6)]
    got = sorted(r["episode_id"] for r in _ep(spark, codes, stays))
    assert got == ["SOM1", "SOM3"]


def test_rehab_filter_only_for_somatic(spark):
    stays = [stay("PHV", 2, 2014, "11", rehab=1, niva="S")]
    assert len(_ep(spark, [code("PHV", 2, 2014, "F329")], stays, spec=PHV)) == 1


def test_year_mismatch_gives_no_row(spark):
    assert _ep(spark, [code("SOM", 1, 2014, "I219")], [stay("SOM", 1, 2015, "11")]) == []


def test_selector_period_and_care_level(spark):
    codes = [
        code("SOM", 1, 2014, "I219", code_type=5),
        code("SOM", 2, 2014, "I219", code_no=13),
        code("SOM", 3, 2011, "I219"),
        code("SOM", 4, 2014, "I219"),
        code("SOM", 5, 2014, "Z000"),
    ]
    stays = [stay("SOM", 1, 2014, "11"), stay("SOM", 2, 2014, "11"), stay("SOM", 3, 2011, "11"),
             stay("SOM", 4, 2014, "11", care=3), stay("SOM", 5, 2014, "11")]
    assert _ep(spark, codes, stays) == []


def test_sex_from_dimension_then_stay(spark):
    rows = _ep(
        spark,
        [code("SOM", 1, 2014, "I219"), code("SOM", 2, 2014, "I219")],
        [stay("SOM", 1, 2014, "11", sex="2"), stay("SOM", 2, 2014, "12", sex="2")],
        persons=[(11, 1950, "1")],
    )
    by_id = {r["episode_id"]: r for r in rows}
    assert by_id["SOM1"]["sex"] == cat.SEX_MEN and by_id["SOM2"]["sex"] == cat.SEX_WOMEN
    assert by_id["SOM2"]["age"] is None


def test_long_ids_drop(spark):
    rows = _ep(spark, [code("SOM", 1, 2014, "I219")], [stay("SOM", 1, 2014, "000000000001234")])
    assert rows == []


def test_axis_selector_for_phbu(spark):
    spec = cat.service("PHBU")
    codes = [code("PHBU", 1, 2014, "F329", code_type=1, axis=1, condition=1),
             code("PHBU", 2, 2014, "F329", axis=2, condition=1)]
    stays = [stay("PHBU", 1, 2014, "11"), stay("PHBU", 2, 2014, "11")]
    assert [r["episode_id"] for r in _ep(spark, codes, stays, spec=spec)] == ["PHBU1"]


def test_every_episode_has_a_flag(spark):
    src = fixture_sources(spark, SF_MID)
    for s in cat.SERVICES:
        e = episodes.episodes(src.codes[s.name], src.stays[s.name], src.persons, s)
        assert e.filter(" + ".join(s.group_names) + " = 0").count() == 0


def test_aggregate_equals_window_form(spark):
    src = fixture_sources(spark, SF_MID)
    for s in (cat.service("SOM"), cat.service("PHBU")):
        a = episodes.episodes(src.codes[s.name], src.stays[s.name], src.persons, s)
        b = episodes.episodes_window(src.codes[s.name], src.stays[s.name], src.persons, s)
        assert a.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_window_form_matches_on_literal_ties(spark):
    src = make_sources(
        spark,
        codes=[code("SOM", 3, 2013, "I219"), code("SOM", 3, 2014, "J449"), code("SOM", 3, 2014, "M170")],
        stays=[stay("SOM", 3, 2013, "11", care=2, home=None), stay("SOM", 3, 2013, "11", care=2, home="0301"),
               stay("SOM", 3, 2014, "11", care=1)],
        persons=[(11, None, "1"), (11, 1950, None)],
    )
    a = episodes.episodes(src.codes["SOM"], src.stays["SOM"], src.persons, SOM)
    b = episodes.episodes_window(src.codes["SOM"], src.stays["SOM"], src.persons, SOM)
    assert a.collect() == b.collect()
    r = a.first()
    assert (r["age"], r["home_municipality"], r["J44"], r["M00_M99"]) == (63, "0301", 1, 1)


def test_trailing_blanks_in_compared_codes(spark):
    from regstat.sources.readers import PERSON_TRIM, STAY_TRIM
    from regstat.sources.schemas import PERSONS, STAYS, normalise

    src = make_sources(
        spark,
        codes=[code("SOM", 1, 2014, "I219"), code("SOM", 2, 2014, "I219")],
        stays=[stay("SOM", 1, 2014, "11 ", sex="2 ", niva="A"), stay("SOM", 2, 2014, "12", niva="S ")],
        persons=[(11, 1950, None)],
    )
    stays = normalise(src.stays["SOM"], STAYS, STAY_TRIM)
    persons = normalise(src.persons, PERSONS, PERSON_TRIM)
    rows = episodes.episodes(src.codes["SOM"], stays, persons, SOM).collect()
    assert [(r["episode_id"], r["person_id"], r["sex"], r["age"]) for r in rows] == [
        ("SOM1", "11", cat.SEX_WOMEN, 64)
    ]


def test_shared_key_space_stays_apart_across_services(spark):
    """PHV and TSB draw stay keys from one key space: the same key and year in
    both services are two episodes, with their own flags and persons."""
    src = make_sources(
        spark,
        codes=[code("PHV", 5, 2014, "F100"), code("TSB", 5, 2014, "F329")],
        stays=[stay("PHV", 5, 2014, "11"), stay("TSB", 5, 2014, "12")],
        persons=[(11, 1950, "1"), (12, 1960, "2")],
    )
    rows = {r["episode_id"]: r.asDict() for r in episodes.extract_all(src).collect()}
    assert set(rows) == {"PHV5", "TSB5"}
    assert (rows["PHV5"]["person_id"], rows["PHV5"]["F10"], rows["PHV5"]["F30_F39"]) == ("11", 1, 0)
    assert (rows["TSB5"]["person_id"], rows["TSB5"]["F10"], rows["TSB5"]["F30_F39"]) == ("12", 0, 1)
    assert rows["PHV5"]["I00_I99"] is None  # a somatic group does not apply to PHV
