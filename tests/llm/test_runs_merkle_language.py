"""Periodic runs, the Merkle manifest and language identification against
brute force on small fixtures."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from conftest import SF_MID, SF_SMALL
from pyspark.sql import functions as F

from regstat.llm import common, language, merkle, oracle, periodic_runs, queries
from regstat.plans.compare import compare, duck

RNG = random.Random(11)
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op12_merkle_manifest"])
@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_oracle(spark, name, sf):
    con = duck(sf)
    r = compare(spark, con, name, queries.registry()[name], oracle.build()[name], sf)
    assert r["columns_match"] and r["spark_rows"] == r["oracle_rows"] and r["values_match"], r


# --- periodic runs


def brute_runs(w) -> set[tuple[int, int, int]]:
    """Start, length and period of all runs, by the definition."""
    n, found = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return {(start, length, q) for (start, length), q in found.items()}


@pytest.mark.parametrize("signs", [1, 2, 3, 5])
def test_runs_of_random_words(signs):
    texts = [[RNG.randrange(signs) for _ in range(n)] for n in range(80)]
    for size in (3, 7, 12, 21):
        part = [RNG.randrange(signs) for _ in range(size)]
        texts.append([9, 8] + (part * 9)[: 4 * size + RNG.randrange(size)] + [7] * RNG.randrange(9))
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=at[1:])
    row, start, length, period = periodic_runs.runs_of(np.array(sum(texts, []), np.int64), at)
    got = defaultdict(list)
    for r, s, n, q in zip(row, start, length, period, strict=True):
        got[int(r)].append((int(s), int(n), int(q)))
    for i, t in enumerate(texts):
        assert got[i] == sorted(brute_runs(t), key=lambda x: (x[0], x[2])), t


def brute_planted(words: list[str], doc_id) -> list[str]:
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


@pytest.fixture(scope="module")
def run_texts() -> list[str | None]:
    words = [f"w{i}" for i in range(400)] + ["é", "日本"]
    prose = lambda n: " ".join(RNG.choice(words) for _ in range(n))
    out = [None, "", " \n\t\x0b", "a", "a a a a a", "a a a a a a", "a\nb a\tb a b a b c", "x " * 30_000, prose(20_000)]
    out += ["a b c " * 5 + prose(20) + " d e" * 6 + " d d d d d d", "u v " * 4 + "u w " * 4]  # two of exponent 6, and ties
    out += ["k l m n " * 4 + prose(5) + " k l m n" * 4, "no\x1cblank " * 8, "a b" + " a b" * 3 + "  c" * 8]
    return out + [prose(RNG.randrange(12, 90)) for _ in range(120)]


def test_periodic_runs(spark, run_texts):
    rows = list(enumerate(run_texts)) + [(None, "a a a a a a b"), (3, "p q " * 5), (3, "p q " * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("runs", "top", "start", "collapsed", "row"):
        docs = docs.withColumn(name, F.lit("clash"))
    got = Counter()
    for r in periodic_runs.periodic_runs(docs.repartition(5), plant=True).collect():
        got[r.doc_id, tuple((x.start, x.length, x.period) for x in r.runs), r.top, r.collapsed] += 1
    want = Counter()
    for doc_id, text in rows:
        w = brute_planted(SPACE_WORD.findall(text or ""), doc_id)
        # by brute force the long texts take too long; x x x ... is one run, prose has none but the planted one
        if len(w) < 1000:
            runs = sorted(brute_runs(w), key=lambda x: (x[0], x[2]))
        else:
            a = next((i for i in range(len(w)) if w[i:] == w[i : i + 1] * (len(w) - i)), None)
            runs = [(a, len(w) - a, 1)] if a is not None and len(w) - a >= 6 else None
        if runs is None:
            h = zlib.crc32(str(doc_id).encode())
            assert h % 10, "choose another id for the long prose"
            runs = []
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        top = min(range(len(runs)), key=lambda k: (-Fraction(runs[k][1], runs[k][2]), runs[k][0], runs[k][2]), default=None)
        want[doc_id, tuple(runs), top, " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    assert got == want
    assert periodic_runs.periodic_runs(docs.where("false")).collect() == []


# --- Merkle manifest


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def brute_tree(nodes: list[str]) -> tuple[str, list[list[tuple[int, list[str]]]]]:
    """The root, and for each node its place and siblings on every level."""
    paths = [[] for _ in nodes]
    owners = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, up_owners = [], []
        for lo in range(0, len(nodes), 8):
            run = nodes[lo : lo + 8]
            for k in range(len(run)):
                for i in owners[lo + k]:
                    paths[i].append((k, run[:k] + run[k + 1 :]))
            up.append(sha("".join(run)))
            up_owners.append(sum(owners[lo : lo + 8], []))
        nodes, owners = up, up_owners
    return nodes[0], paths


def brute_manifest(rows: list[tuple]) -> Counter:
    """Rows of the query: doc_id, leaf, subroot, root, proof, folded root, verified."""
    lower = lambda t: None if t is None else re.sub("[A-Z]", lambda m: m[0].lower(), t)
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        leaf = sha("".join(map(field, (doc_id, source, lang, n_chars, text))))
        new = leaf
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
            new = sha("".join(map(field, (doc_id, source, lang, n_chars, lower(text)))))
        groups[lang].append((doc_id is not None, doc_id, leaf, new))
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        groups[lang].sort()
        trees[lang] = brute_tree([x[2] for x in groups[lang]])
    root, upper = brute_tree([trees[lang][0] for lang in order])
    out = Counter()
    for lang, above in zip(order, upper, strict=True):
        subroot, paths = trees[lang]
        for (_, doc_id, leaf, node), path in zip(groups[lang], paths, strict=True):
            proof = ""
            for at, others in path + above:
                proof += "".join(others)
                node = sha("".join([*others[:at], node, *others[at:]]))
            out[doc_id, leaf, subroot, root, sha(proof), node, node == root] += 1
    return out


MANIFEST = "doc_id long, text string, lang string, source string, n_chars long"


def queried(spark, rows, tmp_path, parts: int) -> Counter:
    docs = spark.createDataFrame(rows, MANIFEST).withColumn("grp", F.lit("clash")).withColumn("pos", F.lit("clash"))
    docs.repartition(parts).write.parquet(f"{tmp_path}/documents.parquet")
    return Counter(tuple(r) for r in queries.op12_merkle_manifest(spark, str(tmp_path)).collect())


@pytest.mark.parametrize("parts", [1, 6])
def test_manifest_of_several_tiers(spark, tmp_path, parts):
    rows = [(i, f"Text {i}", "en" if i % 9 else "zz", "s", i) for i in range(9300)]
    rows += [(9, "A", "de", None, None), (8, None, "de", "B", 1), (7, "", "de", "", 0)]
    got, want = queried(spark, rows, tmp_path, parts), brute_manifest(rows)
    assert got == want
    assert not all(k[-1] for k in got) and any(k[-1] for k in got)


def test_manifest_of_odd_rows(spark, tmp_path):
    same = [(5, "Same", "en", "s", 4)] * 20
    rows = [*same, (None, "A", "en", "s", 1), (None, None, None, None, None), (-3, "É A", None, "s", 3), (5, "other", "en", "s", 5)]
    rows += [(i, "L" * 100_000, "Ω", "s", 9) for i in (3, 2, 1)] + [(4, "X", "", "s", 1), (6, "Y", "-", "s", 1)]
    assert queried(spark, rows, tmp_path, 3) == brute_manifest(rows)


@pytest.mark.parametrize("rows", [[], [(3, "Only One", "en", "s", 8)], [(2, None, None, None, None)]])
def test_manifest_of_few_rows(spark, tmp_path, rows):
    assert queried(spark, rows, tmp_path, 1) == (brute_manifest(rows) if rows else Counter())


def test_versions_share_all_but_the_path(spark):
    docs = spark.createDataFrame([(i, f"T{i}", "en", "s", i) for i in range(70)], MANIFEST)
    found = merkle.manifest(docs, F.col("doc_id") == 9, text=F.lit("changed"))
    made = {r.level: (r.version, r.node) for r in merkle.versions(found).collect()}
    row = found.where("doc_id = 9").first()
    assert set(made) == {0, 1, 2} and made[2] == (9, row.folded_root)
    assert row.folded_root != row.root and [len(s.others) for s in row.path] == [7, 7, 1]
    assert found.where("folded_root <> root").count() == 1


# --- language


def grams(text: str) -> list[str]:
    import unicodedata

    out = []
    for word in "".join(x if unicodedata.category(x)[0] in "LM" else " " for x in text.lower()).split():
        for n in language.ORDERS:
            padded = f" {word} "
            out += [padded[i : i + n] for i in range(len(padded) - n + 1)]
    return out


def cell(gram: str) -> int:
    h = 0
    for x in gram:
        h = (h * int(common.BASE) + ord(x)) % 2**64
    h = (h + len(gram)) % 2**64
    return common.mix_int(h) % language.BUCKETS


def brute_predictions(rows) -> Counter:
    counts, texts = defaultdict(Counter), Counter()
    for doc_id, text, lang in rows:
        if lang is None or text is None or doc_id is None or zlib.crc32(str(doc_id).encode()) % 4 == 2:
            continue
        texts[lang] += any(map(str.isalpha, text))
        counts[lang].update(map(cell, grams(text)))
    langs = sorted(x for x in texts if texts[x])
    out = Counter()
    for doc_id, text, _ in rows:
        if not langs or not any(map(str.isalpha, text or "")):
            out[doc_id, "und", 0.0] += 1
            continue
        logs = []
        for lang in langs:
            total = sum(counts[lang].values()) + language.ALPHA * language.BUCKETS
            own = [math.log((counts[lang][x] + language.ALPHA) / total) for x in map(cell, grams(text))]
            logs.append(math.log(texts[lang] / sum(texts.values())) + sum(own))
        best = max(range(len(langs)), key=lambda k: (logs[k], -k))
        out[doc_id, langs[best], round(1 / sum(math.exp(x - logs[best]) for x in logs), 6)] += 1
    return out


def predicted(docs, counts) -> Counter:
    return Counter((r.doc_id, r.lang_pred, round(r.score, 6)) for r in language.predict(docs, counts).collect())


@pytest.fixture(scope="module")
def spoken() -> list[tuple]:
    syllables = {"aa": ["lo", "mi", "ra"], "bb": ["sch", "tz", "ü"], "cc": ["ção", "nh", "lo"], "dd": ["ни", "ка", "лж"]}
    rows = []
    for i in range(160):
        lang = RNG.choice(list(syllables))
        text = " ".join("".join(RNG.choices(syllables[lang], k=RNG.randrange(1, 4))) for _ in range(RNG.randrange(0, 30)))
        rows.append((i, text.title() if i % 3 else text, lang if i % 7 else None))
    rows += [(200, None, "aa"), (201, "", "bb"), (202, "12 -- \n", "aa"), (203, "日本", None), (204, "q", None), (205, "É", "cc")]
    return [*rows, (None, "lo mi ra", "bb"), (210, "ni lo", "aa"), (210, "ni lo", "aa"), (211, "lomira " * 20_000, "aa")]


def test_language_equals_brute_force(spark, spoken):
    docs = spark.createDataFrame(spoken, "doc_id long, text string, lang string")
    for name in ("cell", "n", "top", "total", "row"):
        docs = docs.withColumn(name, F.lit("clash"))
    assert predicted(docs, language.model(docs.repartition(4))) == brute_predictions(spoken)


def test_language_of_more_languages_than_a_task_holds(spark):
    rows = [(i, f"{chr(0x4E00 + k)}{chr(0x5E00 + k)} " * (1 + i % 3), f"l{k:03d}") for i, k in enumerate(k for k in range(150) for _ in range(3))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert predicted(docs, language.model(docs.repartition(2))) == brute_predictions(rows)


def test_language_without_anything_learnt(spark, spoken):
    docs = spark.createDataFrame(spoken, "doc_id long, text string, lang string")
    none = language.model(docs.where("lang is null"))
    assert {(r.lang_pred, r.score) for r in language.predict(docs, none).collect()} == {("und", 0.0)}
    assert language.predict(docs.where("false"), language.model(docs)).collect() == []


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    found = queries.op13_language_id(spark, SF_MID).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.98


def test_long_text_in_slices(monkeypatch):
    text = "Straße naïve 日本語 lomira ж1x " * 40
    block = common.Block(np.arange(3), np.frombuffer((text + "ab" + text).encode(), np.uint8), np.cumsum([0, len(text.encode()), 2, len(text.encode())]))
    whole = sorted((int(c), int(r)) for cells, rows in language.Characters(block).grams() for c, r in zip(cells, rows, strict=True))
    monkeypatch.setattr(language, "SLICE", 37)
    assert whole == sorted((int(c), int(r)) for cells, rows in language.Characters(block).grams() for c, r in zip(cells, rows, strict=True))
    assert [c for c, r in whole if r == 1] == sorted(map(cell, grams("ab")))
