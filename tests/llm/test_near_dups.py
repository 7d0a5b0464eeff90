"""Near-dedup on repeated and missing ids, and on large nodes."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_operators import linked, shingles

from regstat.llm import components as comp
from regstat.llm import near_dups

RNG = random.Random(3)
VOCAB = [f"w{i}" for i in range(700)]


def prose(n: int) -> str:
    return " ".join(RNG.choice(VOCAB) for _ in range(n))


def nearly(text: str) -> str:
    w = text.split()
    w[len(w) // 2] = "changed"
    return " ".join(w)


def components(spark, rows) -> dict:
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rep", F.lit("clash")).repartition(3)
    return {(r.doc_id, r.n_shingles): r.component_id for r in near_dups.near_duplicates(docs).collect()}


def test_an_id_with_two_texts_links_what_is_near_to_either(spark):
    first, second = prose(80), prose(90)
    got = components(spark, [(5, first), (5, second), (9, nearly(first)), (10, nearly(second)), (11, prose(50))])
    assert set(got.values()) == {5, 11} and {i for (i, _), x in got.items() if x == 5} == {5, 9, 10}
    # also where another document has the smaller id of one of the sets
    got = components(spark, [(5, first), (5, second), (3, second), (10, nearly(second)), (9, nearly(first)), (4, prose(40))])
    assert {i for (i, _), x in got.items() if x == 3} == {3, 5, 9, 10}


def test_repeated_rows_and_rows_without_an_id(spark):
    first, second = prose(80), prose(90)
    got = components(spark, [(7, first), (7, first), (8, nearly(first)), (None, first), (None, second), (6, None), (4, ""), (2, "a b")])
    assert got[7, 76] == got[None, 76] == 7 and [x for (i, _), x in got.items() if i == 8] == [7]
    assert got[None, 86] is None and got[6, 0] == 6 and got[4, 0] == 4 and got[2, 1] == 2


@pytest.mark.parametrize("unlike", [True, False])
def test_large_nodes(spark, unlike, monkeypatch):
    """Many documents with one long passage in common, unlike each other; and many
    near copies of few texts."""
    if unlike:
        passage = prose(120)
        texts = [f"{passage} {prose(60 + i % 7)}" for i in range(400)] + [f"{passage} {prose(4)}" for _ in range(30)]
    else:
        base = [prose(100) for _ in range(3)]
        texts = [nearly(b) if i % 5 else b + " " + prose(1 + i % 9) for i in range(300) for b in base]
    want = linked([shingles(t) for t in texts])
    got = {i: x for (i, _), x in components(spark, list(enumerate(texts))).items()}
    assert [got[i] for i in range(len(texts))] == want


def test_few_links_are_joined_in_few_jobs(spark):
    """A job of many partitions for each step of each round took most of the time of
    a small table with large groups."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 900 + i) for i in range(1, 40)], "a long, b long")
    spark.sparkContext.setJobGroup("components", "components")
    found = {r.node: r.component for r in comp.components(edges).collect()}
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("components")
    spark.sparkContext.setJobGroup("others", "others")
    assert found == {i: 0 for i in range(301)} | {i: 900 for i in range(900, 940)}
    assert len(jobs) <= 4


@pytest.mark.parametrize("size", [5, 60])
def test_links_over_many_slices(spark, size, monkeypatch):
    monkeypatch.setattr(comp, "SLICE_EDGES", size)
    edges = [(i, i + 1) for i in range(70)] + [(200 + i, 200) for i in range(70)] + [(7, 7), (8, 7), (300, 200)]
    RNG.shuffle(edges)
    want = {i: 0 for i in range(71)} | {200 + i: 200 for i in range(70)} | {300: 200}
    rows = comp.components(spark.createDataFrame(edges, "a long, b long").repartition(9)).collect()
    assert len(rows) == len(want) and {r.node: r.component for r in rows} == want
    # the slices of one task
    table = pa.RecordBatch.from_pydict({"a": [a for a, _ in edges], "b": [b for _, b in edges]})
    stars = [list(zip(*x.to_pydict().values(), strict=True)) for x in comp._sliced(iter([table.slice(0, 33), table.slice(33)]))]
    assert len(stars) == -(-len(edges) // size)
    for lo, got in zip(range(0, len(edges), size), stars, strict=True):
        assert {x for e in edges[lo : lo + size] for x in e} == {a for a, _ in got}
    whole = spark.createDataFrame([x for got in stars for x in got], "a long, b long")
    assert {r.node: r.component for r in comp.components(whole).collect()} == want
