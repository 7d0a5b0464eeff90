"""Passages inside long and wrapped lines, and repeated rows, for the substring
dedup by paragraphs."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from regstat.llm import near_dups, paragraph_dups
from regstat.llm.common import U64, mix

RNG = random.Random(9)
VOCAB = [f"w{i}" for i in range(3000)]


def prose(n: int) -> list[str]:
    return [RNG.choice(VOCAB) for _ in range(n)]


def wrapped(words: list[str], width: int) -> str:
    return "\n".join(" ".join(words[i : i + width]) for i in range(0, len(words), width))


def found(spark, rows) -> list:
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("at", F.lit("clash")).repartition(3)
    return paragraph_dups.removals(docs).collect()


def test_cuts_are_the_least_pairs_around():
    word = mix(np.array([RNG.randrange(40) for _ in range(400)], U64))
    row = np.repeat(np.arange(8), 50)
    want = []
    for i in range(400):
        if i % 50 == 0:
            want.append(i)
            continue
        pair = lambda k: int(mix(word[k : k + 1] + np.uint64(0x9E3779B97F4A7C15 | 1) * word[k - 1 : k])[0])
        near = [k for k in range(max(i - 4, i - i % 50 + 1), min(i + 4, i - i % 50 + 49) + 1) if k != i]
        if all(pair(i) < pair(k) if k < i else pair(i) <= pair(k) for k in near):
            want.append(i)
    assert paragraph_dups.cuts(word, row).tolist() == want


def test_passages_in_long_and_wrapped_lines(spark):
    passages = [prose(55 + i % 9) for i in range(30)]
    rows, planted, texts = [], set(), {}
    for i in range(200):
        words = prose(100 + i)
        if i % 4 == 0:
            at = RNG.randrange(len(words))
            words[at:at] = passages[i // 4 % 30]
            if i // 4 >= 30:
                planted.add(i)
        texts[i] = [w.lower() for w in words]
        rows.append((i, " ".join(words) if i % 3 else wrapped(words, 7 + i % 5)))
    got = {r.doc_id: r.passages for r in found(spark, rows)}
    hit = {i for i, runs in got.items() if runs}
    assert hit <= planted and len(hit) >= 0.95 * len(planted)
    earlier = ""
    for i in range(200):
        for run in got[i]:  # each removed run stands earlier in the corpus
            assert run.n_words >= paragraph_dups.PASSAGE_WORDS
            assert " " + " ".join(texts[i][run.at : run.at + run.n_words]) + " " in earlier
        earlier += " " + " ".join(texts[i]) + " |"


def test_repeated_rows_lose_all_but_the_first(spark):
    line, other = " ".join(prose(40)), " ".join(prose(30))
    got = found(spark, [(5, line), (5, line), (None, other), (3, other + "\n" + line), (9, None), (8, "")])
    assert sorted((r.doc_id or 0, r.n_paragraphs, len(r.removed)) for r in got) == [(0, 1, 0), (3, 2, 1), (5, 1, 1), (5, 1, 1), (8, 0, 0), (9, 0, 0)]
    assert found(spark, []) == []


def test_large_buckets_of_near_copies(spark):
    """More near copies of a line, each with a set of its own, than a leaf holds."""
    base = prose(60)
    rows = [(i, " ".join([*base[: 5 + i % 50], f"x{i}", *base[6 + i % 50 :]])) for i in range(3 * near_dups.LEAF)]
    rows += [(1000 + i, " ".join(prose(60))) for i in range(20)]
    got = {r.doc_id: [x.line for x in r.removed] for r in found(spark, rows)}
    assert got == {i: [0] if 0 < i < 1000 else [] for i, _ in rows}
