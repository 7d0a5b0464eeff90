"""What the steps on whole texts hold, and hand back to Spark, at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from regstat.llm import bpe, common, queries, secrets
from regstat.llm import quality_model as q

TEXTS = [None, "", *[f"token = abcdefgh{i} ü" for i in range(1400)], "w " * common.SLICE_BYTES, *["word " * 60_000] * 9, "end"]
BATCH = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(TEXTS)), pa.int64()), "text": pa.array(TEXTS), "extra": pa.array(range(len(TEXTS)))})


class Docs:
    """Stands for a DataFrame; keeps the function that tasks would run."""

    schema = None

    def mapInArrow(self, run, schema):
        return list(run(iter([BATCH, BATCH.slice(1200), BATCH.slice(0, 0)])))

    def select(self, *columns):
        return self


def bounded(parts: list[pa.RecordBatch]) -> None:
    for p in parts:
        size = sum(len(TEXTS[i] or "") for i in p.column("doc_id").to_pylist())
        assert p.num_rows == 1 or p.num_rows <= common.SLICE_ROWS and size <= common.SLICE_BYTES


def ids(parts: list[pa.RecordBatch]) -> list[int]:
    return [i for p in parts for i in p.column("doc_id").to_pylist()]


ALL = [*range(len(TEXTS)), *range(1200, len(TEXTS))]


def test_quality_hands_back_slices(monkeypatch):
    monkeypatch.setattr(q, "scores", lambda texts, *fitted: (np.arange(len(texts)) % 3 > 0).astype(float))
    parts = q.accepted(Docs(), (None, None), 0.5)
    bounded(parts)
    assert ids(parts) == [i for i in ALL if i % 3]
    assert all(p.column("text").to_pylist() == [TEXTS[i] for i in p.column("extra").to_pylist()] for p in parts)


def test_secrets_hand_back_slices():
    parts = secrets.redacted(Docs(), queries.BYTE_BPE)
    bounded(parts)
    assert ids(parts) == ALL
    texts = [t for p in parts for t in p.column("text").to_pylist()]
    assert texts[:4] == [None, "", "[secret] ü", "[secret] ü"] and texts[1402:1404] == TEXTS[1402:1404]


@pytest.mark.parametrize("step", ["scan", "encode_decode"])
def test_scans_and_encoding_hand_back_slices(monkeypatch, step):
    module, path = (secrets, queries.BYTE_BPE) if step == "scan" else (bpe, queries.WORD_BPE)
    known = BATCH.set_column(1, "text", BATCH.column("text").fill_null(""))
    monkeypatch.setattr(module, "keyed", lambda docs, *columns: Docs())
    monkeypatch.setitem(globals(), "BATCH", known)
    parts = getattr(module, step)(Docs(), path)
    bounded(parts)
    assert ids(parts) == ALL
