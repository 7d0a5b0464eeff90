"""Hot keys: one stay, one person and one municipality hold most rows. With
skew thresholds forced low, AQE splits the hot partitions; results must not
change (no row dropped, capped or sampled)."""

from __future__ import annotations

import datetime as dt

from conftest import D, code, make_sources, stay

from regstat import catalogue as cat
from regstat.operators import episodes, places, residence, tabulate

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _hot_sources(spark):
    phv = cat.service("PHV")
    codes = [code("PHV", 1, 2014, "F10" + str(i % 10)) for i in range(3000)]  # one hot stay
    codes += [code("PHV", k, 2014, "F329") for k in range(2, 400)]
    stays = [stay("PHV", 1, 2014, "11", sex="1")]
    stays += [stay("PHV", k, 2014, "11" if k % 2 else str(100 + k), sex="2") for k in range(2, 400)]
    persons = [(11, 1950, "1")] + [(100 + k, 1960 + k % 30, None) for k in range(2, 400)]
    start = dt.date(2010, 1, 1)
    res = [(11, start + dt.timedelta(days=i), start + dt.timedelta(days=i), "0301") for i in range(2000)]
    res += [(11, D("2013-12-01"), None, "0301")]
    res += [(100 + k, D("2012-01-01"), None, "0301" if k % 3 else "1103") for k in range(2, 400)]
    plc = [("0301", "Oslo", "0301", "Oslo", "03", "Oslo", "03", "Oslo")]
    return phv, make_sources(spark, codes=codes, stays=stays, persons=persons, residence=res, places=plc)


def _profile(spark, phv, src, plans=None):
    e = episodes.episodes(src.codes["PHV"], src.stays["PHV"], src.persons, phv)
    r = residence.residence_by_year(residence.cohort(e), src.residence)
    df = tabulate.profile(e, r, places.places(src.places), phv)
    rows = sorted(tuple(x) for x in df.collect())
    if plans is not None:
        plans.append(df._jdf.queryExecution().executedPlan().toString())
    return rows


def test_hot_keys_same_result_with_forced_splits(spark):
    phv, src = _hot_sources(spark)
    baseline = _profile(spark, phv, src)
    saved = {k: spark.conf.get(k) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        plans = []
        split = _profile(spark, phv, src, plans)
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert split == baseline
    assert "SortMergeJoin(skew=true)" in plans[0]  # AQE did split hot partitions
    hot = [r for r in baseline if r[1] == "0301" and r[10] == 64]
    assert hot and hot[0][11] == 1  # one person, counted once however many rows
    total = sum(r[11] for r in baseline)
    assert total == 1 + len({100 + k for k in range(2, 400) if k % 2 == 0})


def _split_plan(spark, build):
    """The rows of ``build()`` without and with forced splits, and the second plan."""
    before = sorted(map(str, build().collect()))
    saved = {k: spark.conf.get(k) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        df = build()
        after = sorted(map(str, df.collect()))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    return before, after, plan


def test_hot_person_is_split_in_the_residence_join_alone(spark):
    _, src = _hot_sources(spark)
    ids = spark.createDataFrame([("11",)] * 50 + [(str(100 + k),) for k in range(2, 300)], "person_id string").cache()
    before, after, plan = _split_plan(spark, lambda: residence.residence_by_year(ids, src.residence))
    assert before == after and len(before) > 298 * 14
    assert "SortMergeJoin(skew=true)" in plan

    def wide():
        return residence.residence_wide(ids.distinct(), src.residence, ids=ids)

    before, after, plan = _split_plan(spark, wide)
    assert before == after and len(before) == 299
    assert "SortMergeJoin(skew=true)" in plan
    assert before == sorted(map(str, residence.residence_wide(ids.distinct(), src.residence).collect()))


def test_window_form_deals_a_hot_episode_to_many_tasks(spark):
    phv, src = _hot_sources(spark)
    args = (src.codes["PHV"], src.stays["PHV"], src.persons, phv)
    marked = episodes.marked_rows(*args)
    hot = "episode_id = 'PHV1'"
    assert marked.filter(hot).count() == 3000
    parts = episodes.windowed_parts(marked, phv.group_names)
    left = parts.filter(hot).count()
    assert 1 < left <= episodes.WINDOW_PARTS
    window = sorted(map(str, episodes.episodes_window(*args).collect()))
    assert window == sorted(map(str, episodes.episodes(*args).select(*marked.columns[1:]).collect()))
    assert len(window) == 399


def test_distributed_lead_matches_window_on_hot_key(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from regstat.sources.fixtures import next_in_order

    hot = spark.range(0, 30000, 1, 8).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("c"),
        (F.col("id") * 7 % 1000).alias("d"),
    )
    a = next_in_order(hot, "c", ["d", "k"], "d")
    b = hot.select("*", F.lead("d").over(Window.partitionBy("c").orderBy("d", "k")).alias("next_d"))
    assert a.count() == 30000
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_lead_with_nulls_repeats_and_a_hot_key_day(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from regstat.sources.fixtures import next_in_order

    rows = [(k, c, d) for k in (1, 2, 2, None) for c in (5, 6, None) for d in (10, 11, None)]
    rows += [(k, 7, 10 + k // 500) for k in range(1000)]
    df = spark.createDataFrame(rows, "k long, c long, d long")
    a = next_in_order(df, "c", ["d", "k"], "d")
    order = [F.asc_nulls_last("d"), F.asc_nulls_last("k")]
    b = df.select("*", F.lead("d").over(Window.partitionBy("c").orderBy(*order)).alias("next_d"))
    assert a.count() == len(rows)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_residence_history_runs_to_the_next_order(spark, tmp_path):
    from regstat.sources import fixtures

    orders = [(1, 5, D("1996-01-10")), (2, 5, D("1996-03-01")), (13, 5, D("1996-03-01")), (4, 6, D("1997-05-05"))]
    df = spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate date")
    df.write.parquet(f"{tmp_path}/orders.parquet")
    got = sorted(tuple(r)[:3] for r in fixtures.residence(spark, str(tmp_path)).collect() if r["to_date"])
    assert got == [
        (5, D("2012-01-10"), D("2012-02-29")),
        (5, D("2012-03-01"), D("2012-02-29")),  # order 2, followed by 13 on its own day
    ]
    assert fixtures.residence(spark, str(tmp_path)).count() == 4
