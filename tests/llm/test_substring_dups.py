"""Suffix-array dedup on tables without repeats, with repeated and missing ids,
over few and many partitions, and with hot strings."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from regstat.llm import substring_dups


def brute(rows: list[tuple]) -> Counter:
    """doc_id, bytes, removed bytes, kept bytes; rows in the order of their ids,
    those without one first."""
    seen, out = set(), Counter()
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - 99):
            s = raw[k : k + 100]
            if s in seen:
                gone[k : k + 100] = True
            seen.add(s)
        out[doc_id, len(raw), int(gone.sum()), np.frombuffer(raw, np.uint8)[~gone].tobytes()] += 1
    return out


def found(spark, rows: list[tuple], parts: int, deal: int = 3) -> Counter:
    before = spark.conf.get("spark.sql.shuffle.partitions")
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("own_id", F.lit("clash")).repartition(deal)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = substring_dups.deduplicated(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    return Counter((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), bytes(r.kept)) for r in got)


def prose(rng: random.Random, n: int) -> str:
    return " ".join(f"w{rng.randrange(800)}" for _ in range(n))


def cases() -> dict[str, list[tuple]]:
    rng = random.Random(5)
    a, b = prose(rng, 60), prose(rng, 70)
    line = prose(rng, 14)[:63]
    passage = prose(rng, 40)[:130]
    return {
        "nothing repeats": [(1, a), (2, b)],
        "only short lines": [(1, "a"), (2, None), (3, "")],
        "a line of 63 bytes is shared": [(i, prose(rng, 12) + line + prose(rng, 12)) for i in range(300)],
        "a passage in every document": [(i, prose(rng, 9) + passage + prose(rng, 9)) for i in range(60)],
        "repeated rows": [(1, a), (1, a), (2, a + b)],
        "an id with two texts": [(1, a), (1, b), (2, b), (0, a[:110])],
        "no id": [(None, a), (None, a), (3, a), (None, b), (2, b)],
        "a run of one sign": [(4, "x" * 3000), (5, "x" * 200 + a), (6, "é" * 500)],
    }


@pytest.mark.parametrize("parts", [1, 4, 40])
@pytest.mark.parametrize("name", sorted(cases()))
def test_equals_brute_force(spark, name, parts):
    rows = cases()[name]
    if name in ("repeated rows", "an id with two texts", "no id"):
        # which of the rows of one id comes first is open: compare what does not depend on it
        strip = lambda c: Counter((k[0], k[1]) for k in c.elements())
        got, want = found(spark, rows, parts), brute(rows)
        assert strip(got) == strip(want)
        orders = [brute(order) for order in (rows, rows[::-1], sorted(rows, key=str), sorted(rows, key=lambda r: len(r[1])))]
        assert got in orders
    else:
        assert found(spark, rows, parts) == brute(rows)


def test_rows_out_do_not_grow_with_the_parts(spark):
    rng = random.Random(6)
    shared = [prose(rng, 40) for _ in range(20)]
    rows = [(i, " ".join([prose(rng, 20), rng.choice(shared), prose(rng, 20), rng.choice(shared)])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    counts = [
        substring_dups.met(substring_dups.dealt(docs, parts), parts).groupBy("kind").count().orderBy("kind").collect() for parts in (2, 40)
    ]
    assert counts[0] == counts[1] and all(r["count"] <= 300 for r in counts[0])


def test_hot_gram_by_partial_minimum(spark):
    """More than ``HOT`` different segments around one line; some share 100 bytes."""
    rng = random.Random(7)
    line = "a very common line of boiler plate text that stands in all of them"
    n = substring_dups.HOT + 500
    rows = [(i, f"{rng.random():.17f} {rng.random():.17f}{line}{(f'{rng.random():.17f} ' * 3) if i % 50 else ' and the same ending for some of the rows'}") for i in range(n)]
    kinds = substring_dups.met(substring_dups.dealt(spark.createDataFrame(rows, "doc_id long, text string"), 4), 4)
    assert kinds.where(f"kind = {substring_dups.CROWDED}").count() > substring_dups.HOT
    got = found(spark, rows, 4)
    assert got == brute(rows) and sum(k[2] > 0 for k in got) >= 90
