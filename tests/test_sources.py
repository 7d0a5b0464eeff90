"""Readers and name normalisation."""

from __future__ import annotations

import tempfile
from dataclasses import replace

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from regstat import catalogue as cat
from regstat.operators import episodes
from regstat.plans import queries
from regstat.sources import MissingColumnError, named_sources, normalise_names, read_sources, read_table, write_table
from regstat.sources.readers import fixture_frames, fixture_sources
from regstat.sources.schemas import read_columns


def test_read_table_by_path_and_by_name(spark):
    d = tempfile.mkdtemp(prefix="regstat-src-", dir="/tmp")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    df.write.mode("overwrite").parquet(f"{d}/t")
    assert read_table(spark, f"{d}/t").count() == 2
    df.createOrReplaceTempView("regstat_tmp_table")
    assert read_table(spark, "regstat_tmp_table").count() == 2
    df.write.mode("overwrite").option("header", True).csv(f"{d}/c")
    assert read_table(spark, f"{d}/c", "csv", header=True).count() == 2


def test_normalise_names_fixes_case_drift(spark):
    df = spark.createDataFrame([(1, 2)], "personid long, year int")
    out = normalise_names(df, ["PersonId"])
    assert out.columns == ["PersonId", "year"]


def test_fixture_frames_match_documented_counts(spark):
    f = fixture_frames(spark, SF_SMALL)
    counts = {k: v.count() for k, v in f.items()}
    assert counts == {"codes": 6000, "stays": 1500, "persons": 145, "residence": 1500, "places": 27}


@pytest.fixture(scope="module")
def extracted(spark):
    return sorted(map(str, episodes.extract_all(fixture_sources(spark, SF_SMALL)).collect()))


def _staged(spark, change=None) -> str:
    """Staged folders in which each service has only the columns that it reads;
    ``change(spec, kind, rows)`` may alter one."""
    root = tempfile.mkdtemp(prefix="regstat-own columns-", dir="/tmp")
    frames = fixture_frames(spark, SF_SMALL)
    for spec in cat.SERVICES:
        for kind, columns in read_columns(spec).items():
            own = frames[kind].filter(F.col("service") == spec.name).select(*columns)
            for part in (change or (lambda *x: [x[2]]))(spec, kind, own):
                part.write.mode("append").partitionBy("year").parquet(f"{root}/{kind}/service={spec.name}")
    for name in ("persons", "residence", "places"):
        write_table(frames[name], f"{root}/{name}")
    return root


def test_services_with_only_their_own_columns_all_come_through(spark, extracted):
    src = read_sources(spark, _staged(spark))
    got = episodes.extract_all(src)
    assert sorted(map(str, got.collect())) == extracted
    assert {r.service for r in got.select("service").distinct().collect()} == {s.name for s in cat.SERVICES}
    plan = src.codes["SOM"].filter("code_type = 6 and year = 2014")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(code_type,6)" in plan and "year" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_years_with_other_columns_order_case_and_types(spark, extracted):
    def change(spec, kind, rows):
        if kind == "codes":
            return [rows]
        old = rows.filter("year < 2014").withColumn("care_level", F.col("care_level").cast("string"))
        old = old.withColumn("only_then", F.lit(1))
        old = old.select(*reversed(old.columns)).withColumnRenamed("sex", "SEX")
        return [old, rows.filter("year >= 2014")]

    assert sorted(map(str, episodes.extract_all(read_sources(spark, _staged(spark, change))).collect())) == extracted


def test_a_year_without_care_level_is_refused(spark):
    def change(spec, kind, rows):
        if spec.name != "TSB" or kind != "stays":
            return [rows]
        return [rows.filter("year = 2013").drop("care_level"), rows.filter("year <> 2013")]

    with pytest.raises(MissingColumnError, match="50001.*TSB.stays/year=2013.care_level") as e:
        read_sources(spark, _staged(spark, change))
    assert e.value.missing == [("TSB.stays/year=2013", "care_level")]


def _named(spark) -> dict:
    frames = fixture_frames(spark, SF_SMALL)
    tables = {}
    for service, (codes, stays, key) in cat.SERVICE_TABLES.items():
        for kind, name in (("codes", codes), ("stays", stays)):
            own = frames[kind].filter(F.col("service") == service)
            # a column under one of our names that is not the register's
            tables[name] = own.withColumnsRenamed({**cat.SOURCE_COLUMNS[kind], "stay_key": key}).withColumn("year", F.lit(1))
    for kind in ("persons", "residence"):
        tables[kind] = frames[kind].withColumnsRenamed(cat.SOURCE_COLUMNS[kind])
    return tables | {"places": frames["places"]}


def test_ten_named_tables_give_the_same_extract(spark, extracted):
    tables = _named(spark)
    root = tempfile.mkdtemp(prefix="regstat-named-", dir="/tmp")
    refs = {}
    for i, (name, df) in enumerate(tables.items()):
        if i % 4 in (0, 3):  # some by path, some by view
            df.write.parquet(f"{root}/{name}")
            refs[name] = f"{root}/{name}"
        else:
            df.createOrReplaceTempView(f"regstat_test_{name}")
            refs[name] = f"regstat_test_{name}"
    src = named_sources(spark, refs, refs["persons"], refs["residence"], refs["places"])
    assert sorted(map(str, episodes.extract_all(src).collect())) == extracted
    by_path = next(s for s in cat.SERVICES if "/" in refs[cat.SERVICE_TABLES[s.name][0]])
    plan = src.codes[by_path.name].filter("year = 2014").select("code")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(aar,2014)" in plan.replace(" ", "") or "aar" in plan.split("PushedFilters")[1]


def test_a_named_table_that_is_missing_or_lacks_its_key(spark):
    tables = _named(spark)
    rest = [tables.pop(k) for k in ("persons", "residence", "places")]
    with pytest.raises(MissingColumnError, match="50001.*AVTHoved.asp_k"):
        named_sources(spark, {**tables, "AVTHoved": tables["AVTHoved"].drop("asp_k")}, *rest)
    with pytest.raises(MissingColumnError, match="SOMHoved.niva"):
        named_sources(spark, {**tables, "SOMHoved": tables["SOMHoved"].drop("niva")}, *rest)
    del tables["TSBKoder"]
    with pytest.raises(KeyError, match="TSBKoder"):
        named_sources(spark, tables, *rest)


def test_main_diagnosis_of_all_services_is_one_pass_over_the_codes(spark):
    src = fixture_sources(spark, SF_SMALL)
    got = queries.main_diagnosis_type(spark, SF_SMALL)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Union" not in plan
    specs = [s for s in cat.SERVICES if s.selector.kind == "type"]
    apart = episodes.main_diagnosis_rows_all(replace(src, codes_together=None), specs).select(*got.columns)
    assert got.exceptAll(apart).count() == 0 and apart.exceptAll(got).count() == 0
    assert got.count() > 1000


def test_service_folders_are_staged_from_one_derivation(spark, extracted, monkeypatch):
    plans = []

    def seen(df, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write_table(df, *args)

    monkeypatch.setattr(queries, "write_table", seen)
    got = queries.extract_from_service_folders(spark, SF_SMALL)
    assert sum("l_orderkey" in p for p in plans) == 1
    assert sorted(map(str, got.collect())) == extracted
