"""The document operators against brute force on small fixtures."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from regstat.llm import (
    bpe,
    components,
    decontaminate,
    licenses,
    near_dups,
    paragraph_dups,
    quality_model,
    quality_rules,
    queries,
    secrets,
    substring_dups,
    token_blocks,
)

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
RNG = random.Random(7)
VOCAB = [f"w{i}" for i in range(900)] + ["Straße", "naïve", "日本"]


def prose(n: int) -> str:
    return " ".join(RNG.choice(VOCAB) for _ in range(n))


def changed(text: str, k: int) -> str:
    w = text.split(" ")
    for _ in range(k):
        w[RNG.randrange(len(w))] = RNG.choice(VOCAB)
    return " ".join(w)


@pytest.fixture(scope="module")
def texts() -> list[str | None]:
    base = [prose(RNG.randint(30, 160)) for _ in range(6)]
    passage = prose(60)
    out: list[str | None] = [*base, *base[:3]]
    out += [changed(base[i % 2], RNG.randint(1, 6)) for i in range(150)]
    out += [prose(40) + "\n" + passage + "\n" + prose(35) for _ in range(4)]
    out += [None, "", " \n\t ", "a b", "A  b", "x" * 30_000, "Der " * 400, prose(20_000)]
    out += ["café " * 60, "café x\x1cy <|endoftext|> it's", base[0].upper()]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    """With extra columns whose names the operators use inside."""
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for name in ("rep", "node", "component", "spans", "part", "row", "words", "n"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(5).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def lower(t: str | None) -> str:
    return "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in t or "")


def test_substring_dups_equals_brute_force(docs, texts):
    seen, want = set(), {}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - 99):
            s = raw[k : k + 100]
            if s in seen:
                gone[k : k + 100] = True
            seen.add(s)
        want[i] = (len(raw), int(gone.sum()), np.frombuffer(raw, np.uint8)[~gone].tobytes())
    for r in substring_dups.deduplicated(docs).collect():
        assert (r.n_bytes, sum(s.end - s.start for s in r.spans), bytes(r.kept)) == want[r.doc_id]


@pytest.mark.parametrize("signs", [1, 2, 3, 9])
def test_suffix_array(signs):
    for n in range(1, 60):
        s = [RNG.randrange(signs) for _ in range(n)]
        assert substring_dups.suffix_array(s) == sorted(range(n), key=lambda i: s[i:])


def shingles(t: str | None) -> frozenset:
    w = SPACE_WORD.findall(lower(t))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def linked(sets: list[frozenset]) -> list[int]:
    root = list(range(len(sets)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                lo, hi = sorted((top(a), top(b)))
                root[hi] = lo
    return [top(i) for i in range(len(sets))]


@pytest.mark.parametrize("leaf", [64, 8])
def test_near_duplicates_equals_brute_force(docs, texts, leaf, monkeypatch):
    monkeypatch.setattr(near_dups, "LEAF", leaf)  # 8: the large-node path
    sets = [shingles(t) for t in texts]
    want = linked(sets)
    for r in near_dups.near_duplicates(docs).collect():
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), want[r.doc_id])


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    got = {r.node: r.component for r in found}
    assert len(found) == len(got)
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def test_secret_base_and_method(spark):
    t = "password = \"hunter22\" Token:short AKIA" + "A1" * 8 + " id " + "0f" * 12 + " api-key: no é SECRET=abc/def.1"
    key = "q9Zx7Lk2Vw8Rt4Yp1Nc6Jb3Hs5"
    digest = hashlib.sha256(b"x").hexdigest()
    rows = [(1, t), (2, f"é {key}"), (3, None), (4, ""), (5, "someLongIdentifierName2 another_long_variable_name_1"), (6, digest.upper())]
    found = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"), queries.BYTE_BPE).collect()
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in found}
    got[1] = [x for x in got[1] if x[0] != "random"]  # the key and the hex run are random, too
    assert [k for k, _, _ in got[1]] == ["assign", "access", "hex", "assign"]
    assert t[got[1][0][1] : got[1][0][2]] == 'password = "hunter22'
    assert got[2] == [("random", 2, 2 + len(key))]
    assert got[3] == got[4] == got[5] == got[6] == []
    assert secrets.redact("ab cd ef", [(0, 0, 4), (3, 1, 5)], "*") == "* ef"


@pytest.mark.parametrize(
    ("signs", "size", "least"),
    [
        ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 32, 0.99),
        ("abcdefghijklmnopqrstuvwxyz0123456789", 24, 0.99),
        ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 24, 0.99),
        ("abcdefghijklmnopqrstuvwxyz0123456789", 16, 0.8),
    ],
)
def test_random_runs_of_any_alphabet(signs, size, least):
    vocab, rng = secrets.vocabulary(queries.BYTE_BPE), random.Random(11)
    keys = ["".join(rng.choice(signs) for _ in range(size)) for _ in range(500)]
    assert sum(secrets.find(f"key {k} x", vocab) == [(4, 3, 4 + size)] for k in keys) >= least * 500
    names = "getUserAccountSettingsById2 MAX_CONNECTIONS_PER_HOST_2 tests/llm/test_operators2 KOMMUNEHELSESAMARBEIDET2020"
    assert secrets.find(names + " DONAUDAMPFSCHIFFFAHRTSGESELLSCHAFT 2024-01-15T10 00-1a-2b-3c-4d-5e", vocab) == []


def test_quality_model(spark):
    good = [prose(RNG.randint(5, 80)) for _ in range(150)]
    bad = [" ".join(w.upper() + "!!" for w in prose(RNG.randint(5, 80)).split()) for _ in range(150)]
    rows = list(enumerate(good + bad)) + [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(300)] + [(5, None)], "doc_id long, quality int")
    scored = quality_model.score(docs, quality_model.model(docs, labels)).collect()
    held = [r for r in scored if r.doc_id < 300 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([(r.score >= 0.3) == (r.doc_id < 150) for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in scored) and len(scored) == len(rows)
    none = quality_model.score(docs, quality_model.model(docs, labels.where("false"))).collect()
    assert {r.score for r in none} == {0.5}


def test_quality_model_fits_one_text_of_each_present_id(spark, monkeypatch):
    rows = [(i, prose(20)) for i in range(30)] + [(7, prose(20)) for _ in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality_model, "MAX_TRAIN", 12)
    monkeypatch.setattr(quality_model, "fit", lambda x, y, held: seen.append(len(x)))
    quality_model.model(docs, labels)
    assert seen == [12]


def test_token_blocks_round_trip(docs, texts):
    library = Tokenizer.from_file(queries.WORD_BPE)
    blocks, freq = token_blocks.written_blocks(docs, queries.WORD_BPE)
    got = {r.doc_id: r for r in token_blocks.read_documents(blocks, freq).collect()}
    at = 0
    for i, t in enumerate(texts):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, token_blocks.END]
        assert (got[i].start, got[i].n_tokens) == (at, len(ids))
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids
        at += len(ids)


def test_token_blocks_checkpoints_and_checksums(docs):
    ids = np.random.default_rng(1).geometric(0.01, 100_000).astype(np.int64)
    coder = token_blocks.Coder(token_blocks.table_of(np.bincount(ids, minlength=1 << 12)))
    words, states, marks = coder.encode(ids)
    row = {"words": words, "states": states, "marks": marks, "n": len(ids)}
    assert (coder.decode(words, states, len(ids)) == ids).all()
    n = len(marks) // 8 // (token_blocks.LANES + 2)
    assert n > 1
    step = token_blocks.LANES * token_blocks.CHECKPOINT
    for k in range(n):
        assert (token_blocks.from_checkpoint(row, coder, k) == ids[k * step :]).all()
    blocks, freq = token_blocks.written_blocks(docs.limit(3), queries.WORD_BPE)
    broken = blocks.withColumn("crc", F.col("crc") + 1)
    with pytest.raises(Exception, match="checksum"):
        token_blocks.decoded(broken, freq).collect()


def test_licenses(spark):
    rows = [
        (1, "Intro.\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0."),
        (2, "A driving license is needed."),
        (3, None),
        (4, "This work is licensed under the GNU General Public License, version 3."),
        (5, "Licensed under the Apache License, Version 2.0."),
        (6, prose(50)),
    ]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {r.doc_id: [(x["at"], x.family) for x in r.found] for r in found}
    want = {1: [(1, "MIT"), (2, "CC-BY-NC-4.0")], 2: [], 3: [], 4: [(0, "GPL-3.0")], 5: [(0, "Apache-2.0")], 6: []}
    assert got == want


def families_of(spark, rows):
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {r.doc_id: [(x["at"], x.family) for x in r.found] for r in found}


def test_license_wordings(spark):
    mit = "Copyright (c) 2020 A\n\nPermission is hereby granted, free of charge, to any\nperson obtaining a copy of this software"
    bsd = "Redistribution and use in source and binary\nforms, with or without modification, are permitted provided that"
    gpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version {} of the License, or\n(at your option) any later version."
    wordings = [
        ("Licensed under the MIT License", [(0, "MIT")]),
        ("Licensed under the ISC license", [(0, "ISC")]),
        ("Licensed under the Apache License 2.0", [(0, "Apache-2.0")]),
        ("# SPDX-License-Identifier: MIT", [(0, "MIT")]),
        ("SPDX-License-Identifier: Apache-2.0 OR MIT", [(0, "Apache-2.0"), (0, "MIT")]),
        ("Licensed under the GNU General Public License, version 3.", [(0, "GPL-3.0")]),
        ("Licensed under the GNU General Public License, version 2.", [(0, "GPL-2.0")]),
        ("GNU Lesser General Public License v2.1", [(0, "LGPL-2.1")]),
        ("Available under the GPLv3", [(0, "GPL-3.0")]),
        (mit, [(2, "MIT")]),
        (bsd + " the following\nconditions are met:", [(0, "BSD-2-Clause")]),
        (bsd + " the following\nconditions are met:\n\n3. Neither the name of A", [(0, "BSD-3-Clause")]),
        (gpl.format(2), [(1, "GPL-2.0")]),
        (gpl.format(3), [(1, "GPL-3.0")]),
        ("This work is under a Creative Commons Attribution-ShareAlike 4.0 International License", [(0, "CC-BY-SA-4.0")]),
        ("This is free and unencumbered software released into the public domain.", [(0, "Unlicense")]),
        ("The license plate and version 3 of the general report for the public", []),
        ("EPL-2.0", [(0, "EPL-2.0")]),
        ("Distributed under the Boost Software License, Version 1.0.", [(0, "BSL-1.0")]),
        ("EUPL-1.2", [(0, "EUPL-1.2")]),
        ("LGPL-2.0-only", [(0, "LGPL-2.0")]),
        ("BSD-4-Clause", [(0, "BSD-4-Clause")]),
        ("CC BY-SA 3.0", [(0, "CC-BY-SA-3.0")]),
        ("He was released under the MIT roof", []),
        ("Under version 2 of the Apache tribe treaty", []),
        ("We studied at MIT or Apache helicopters", []),
        ("They met under the MIT bridge of 1990", []),
    ]
    got = families_of(spark, [(i, t) for i, (t, _) in enumerate(wordings)] + [(100 + i, prose(60)) for i in range(40)])
    assert {wordings[i][0]: got[i] for i in range(len(wordings))} == dict(wordings)
    assert not any(got[100 + i] for i in range(40))


def test_license_in_a_long_line(spark):
    text = " ".join([prose(4000), "licensed under the MIT license.", prose(4000), "SPDX-License-Identifier: ISC", prose(90)])
    got = families_of(spark, [(1, text), (2, prose(3000) + " a license " + prose(3000)), (3, "x\n" + text + "\n" + text)])
    assert got == {1: [(0, "ISC"), (0, "MIT")], 2: [], 3: [(1, "ISC"), (1, "MIT"), (2, "ISC"), (2, "MIT")]}
    rows = [(i, "\n".join(f"{prose(9)} license {prose(9)}" for _ in range(300))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = licenses.keyed(docs, "doc_id", "text")
    drawn = licenses.training(spark, known, licenses.candidates(known)).where("label = 0").count()
    assert drawn <= 2 * licenses.SAMPLE + len(licenses.OTHERS)


def test_decontamination_equals_brute_force(spark, docs, texts):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    cut = [word.findall(lower(t)) for t in texts]
    items = [(1, " ".join(cut[0][3:20])), (2, "w1"), (3, None), (4, "!?"), (5, prose(15)), (6, "W2, w3"), (1, cut[9][0])]
    items.append((7, " ".join(cut[1][:10]) + " " + " ".join(cut[2][:10])))
    test = spark.createDataFrame([(a, b, "x") for a, b in items], "item_id long, text string, words string")
    windows: dict[tuple, set[str]] = {}
    for i, t in items:
        w = word.findall(lower(t))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(str(i))
    found = {r.doc_id: r for r in decontaminate.contamination(docs, test).collect()}
    assert len(found) == len(texts)
    for i, w in enumerate(cut):
        hit, ids = set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if s := windows.get(tuple(w[k : k + size])):
                    ids |= s
                    hit.update(range(k, k + size))
        r = found[i]
        assert (r.n_words, r.n_hit, list(r["items"])) == (len(w), len(hit), sorted(ids))
    none = decontaminate.contamination(docs, test.where("false")).agg(F.sum("n_hit")).first()[0]
    assert none == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "x alpha mid beta y"), (2, "alpha beta"), (3, "beta z z z alpha")], "doc_id long, text string")
    wins = spark.createDataFrame([(9, ["alpha", "beta"])], "wid long, window array<string>")
    index = decontaminate.postings(docs, wins.selectExpr("explode(window) as term"))
    rare = decontaminate.rarest_terms(wins, index)
    near = {(r.doc_id) for r in decontaminate.proximity(index, rare, 1).collect()}
    assert near == {1, 2}


def test_quality_ledger_and_ablations(docs, texts):
    led = quality_rules.ledger(docs)
    got = {r.doc_id: r for r in led.collect()}
    for i, t in enumerate(texts):
        w = SPACE_WORD.findall(t or "")
        three = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        hit = {k + d for k, x in enumerate(three) if three.count(x) > 1 for d in range(3)} if len(w) < 2000 else None
        lines = [x for x in (t or "").split("\n") if SPACE_WORD.search(x)]
        r = got[i]
        assert (r.n_words, r.word_chars) == (len(w), sum(map(len, w)))
        assert (r.n_lines, r.n_dup_lines) == (len(lines), len(lines) - len(set(lines)))
        assert hit is None or r.n_repeat_words == len(hit)
    rules = {r.rule: r for r in quality_rules.ablations(led).collect()}
    whole = quality_rules.mask(quality_rules.POLICIES[quality_rules.CURRENT])
    bit = quality_rules.mask(("few_words",))
    assert rules["few_words"].n_failed == sum(bool(r.failed & bit) for r in got.values())
    assert rules["few_words"].n_alone == sum(r.failed & whole == bit for r in got.values())


def test_paragraph_removals(docs, texts):
    paras = [
        (i, k, x) for i, t in enumerate(texts) for k, x in enumerate((t or "").split("\n")) if len(SPACE_WORD.findall(x)) >= 20
    ]
    comp = linked([shingles(x) for _, _, x in paras])
    want = {(i, k) for n, (i, k, _) in enumerate(paras) if comp[n] != n}
    got = {(r.doc_id, x.line) for r in paragraph_dups.removals(docs).collect() for x in r.removed}
    assert got == want


def test_bpe_equals_the_library(docs, texts):
    library = Tokenizer.from_file(queries.WORD_BPE)
    for r in bpe.encode_decode(docs, queries.WORD_BPE).collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert list(r.ids) == ids
        assert r.decoded == library.decode(ids, skip_special_tokens=False)


def test_bpe_stream_is_stable_and_text_decoding_round_trips():
    enc = bpe.encoder(queries.WORD_BPE)
    library = Tokenizer.from_file(queries.WORD_BPE)
    word = "".join(RNG.choice("thingeraos") for _ in range(6 * enc.lookahead))
    raw = word.encode()
    symbols = [enc.symbol[b] for b in raw[:-1]] + [enc.final[raw[-1]]]
    assert list(enc.stream(iter(symbols))) == library.encode(word, add_special_tokens=False).ids
    text = "café 日本 it 's"
    assert bpe.decode(enc.encode(text).tolist(), enc, "text").split() == text.split()


def test_bpe_decodes_stretches_as_single_ids(monkeypatch):
    enc = bpe.encoder(queries.WORD_BPE)
    library = Tokenizer.from_file(queries.WORD_BPE)
    text = "café 日本語 <|endoftext|> it's 😀 " + prose(40)
    ids = enc.encode(text).tolist()
    assert ids == library.encode(text, add_special_tokens=False).ids
    for form in ("joined", "text"):
        machine = bpe.Decoder(enc, form)
        single = "".join(map(machine.feed, ids)) + machine.end()
        machine = bpe.Decoder(enc, form)
        assert "".join(machine.feed_all(ids[k : k + 3]) for k in range(0, len(ids) + 3, 3)) + machine.end() == single
        for size in (1, 7, 4096):
            monkeypatch.setattr(bpe, "STRETCH", size)
            assert bpe.decode(iter(ids), enc, form) == single
            assert bpe.decode([], enc, form) == ""
    assert bpe.decode(ids, enc) == library.decode(ids, skip_special_tokens=False)


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    blocks, freq = token_blocks.written_blocks(empty, queries.WORD_BPE)
    for df in (
        substring_dups.deduplicated(empty),
        near_dups.near_duplicates(empty),
        secrets.scan(empty, queries.BYTE_BPE),
        quality_model.score(empty, quality_model.model(empty, labels)),
        token_blocks.read_documents(blocks, freq),
        licenses.scan(empty),
        quality_rules.ledger(empty),
        paragraph_dups.removals(empty),
        bpe.encode_decode(empty, queries.WORD_BPE),
    ):
        assert df.count() == 0


def test_rows_without_an_id(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (None, "")], "doc_id long, text string")
    assert near_dups.near_duplicates(docs).count() == 3
    assert quality_rules.ledger(docs).count() == 3
    assert paragraph_dups.removals(docs).where("doc_id = 3").count() == 1
    assert bpe.encode_decode(docs, queries.WORD_BPE).count() == 3


def test_decontamination_of_rows_without_an_id(spark):
    texts = [prose(30) for _ in range(3)]
    rows = [(None, texts[0]), (None, texts[1]), (5, texts[0]), (None, None), (None, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    test = spark.createDataFrame([(1, " ".join(texts[0].split()[4:20]))], "item_id long, text string")
    found = decontaminate.contamination(docs, test).collect()
    assert sorted((r.doc_id or 0, r.n_hit) for r in found) == [(0, 0), (0, 0), (0, 16), (0, 16), (5, 16)]


def test_license_fit_reads_one_written_table(spark, monkeypatch):
    """The jobs of the fit have no shuffle behind them, their rows one order."""
    seen = []

    def fit(self, rows):
        seen.append(rows)
        raise InterruptedError

    monkeypatch.setattr(licenses.LogisticRegression, "fit", fit)
    texts = ["licensed under the MIT license", "the license of the car", "a walk by the river and the old bridge of the town", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id long, text string")
    known = licenses.keyed(docs, "doc_id", "text")
    found = licenses.candidates(known)
    with pytest.raises(InterruptedError):
        licenses.fitted(spark, known, found)
    assert "Exchange" not in seen[0]._jdf.queryExecution().executedPlan().toString()
    assert seen[0].rdd.getNumPartitions() == 1
    got = [(r.label, r.window) for r in seen[0].collect()]
    want = licenses.training(spark, known, found).where("not held").select("label", "window").collect()
    assert got == sorted(got) == sorted(map(tuple, want))


def test_license_fit_of_few_documents_has_names_amid_words(spark):
    def named(rows):
        known = licenses.keyed(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
        return licenses.training(spark, known, licenses.candidates(known)).where("label > 0 and not held").count()

    assert named([(1, "licensed under the MIT license"), (2, None)]) == len(licenses.templates()) + licenses.SAMPLE
    many = [(i, " ".join(f"x{i}y{k}" for k in range(60))) for i in range(200)]  # enough stretches of their own
    assert len(licenses.templates()) < named(many) < len(licenses.templates()) + licenses.SAMPLE
