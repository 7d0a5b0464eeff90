"""Token blocks of a vocabulary over 65,536 ids."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from regstat.llm import queries, token_blocks


def test_ids_wider_than_16_bits(spark):
    rng = np.random.default_rng(4)
    rows = [(i, np.append(rng.integers(0, 70_000, 50 + i), 69_999)) for i in range(40)]
    raw = [(i, bytearray(x.astype("<u4").tobytes())) for i, x in rows]
    coded = spark.createDataFrame(raw, "doc_id long, ids binary")
    counts = token_blocks.counts(coded, "<u4", 70_000)
    assert (counts == np.bincount(np.concatenate([x for _, x in rows]), minlength=70_000)).all()
    freq = token_blocks.table_of(counts)
    found = token_blocks.read_documents(token_blocks.encoded(coded, freq, "<u4"), freq).orderBy(F.col("doc_id")).collect()
    start = 0
    for r, (i, ids) in zip(found, rows, strict=True):
        assert (r.doc_id, r.start, r.n_tokens) == (i, start, len(ids))
        assert (np.frombuffer(r.ids, "<u4") == ids).all()
        start += len(ids)


def test_runs_give_the_librarys_ids():
    """Rare white space, special strings, composed letters, long runs, also
    where the table of runs changes its generation."""
    rng = random.Random(3)
    signs = [*"aAbBHWJ'stredlvm09. \t\n\x0b\x1c\x1f\x85\xa0\u2003\u3000ΣσςİßÉé日本😀<|>½", "e\u0301", "\u0331"]
    signs += ["<|endoftext|>", "<|startoftext|>", "'ll", "don't", " "]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["", "x" * 5000, " ", "\xa0", "H\u0331 h\u0331 J\u030c"]
    runs = token_blocks.Runs(queries.WORD_BPE)
    for lo in range(0, len(texts), 700):
        part = texts[lo : lo + 700]
        ids, n = runs.encode(pa.array(part))
        want = [runs.library.encode(t, add_special_tokens=False).ids for t in part]
        assert n.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
        assert max(map(len, runs.young)) <= token_blocks.RUN_CHARS
        runs.old, runs.young = runs.young, {}


def test_signs_behind_letters_and_known_pieces():
    rng = random.Random(5)
    signs = [*"abzAZ'sS.,;:!?ªºÀÖ×ØÞßàö÷øÿĀſΣσİ̸́;\x1c\x7f 1(", "́,", "'S,", "É.", "...", "日", " ̧"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["É, É, H̱. a,̸ a;́", "I'LL, DON'T! x.'s"]
    runs = token_blocks.Runs(queries.WORD_BPE)
    for lo in range(0, len(texts), 500):
        ids, n = runs.encode(pa.array(texts[lo : lo + 500]))
        want = [runs.library.encode(t, add_special_tokens=False).ids for t in texts[lo : lo + 500]]
        assert n.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def test_known_pieces_are_not_asked_for_again(monkeypatch):
    runs = token_blocks.Runs(queries.WORD_BPE)
    runs.encode(pa.array(["Every wörd here", ". , ( )"]))
    asked, pieces = [], runs.pieces
    monkeypatch.setattr(runs, "pieces", lambda p: asked.extend(p) or pieces(p))
    ids, _ = runs.encode(pa.array(["Every, wörd. (here)"]))
    assert ids.tolist() == runs.library.encode("Every, wörd. (here)", add_special_tokens=False).ids
    assert asked == []
