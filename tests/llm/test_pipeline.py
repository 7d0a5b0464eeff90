"""The pipeline, stage by stage, on a small folder of tables."""

from __future__ import annotations

import random

import corpus_pipeline
from regstat.llm.common import table


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(600)]
    prose = [" ".join(rng.choice(vocab) for _ in range(60)) for _ in range(80)]
    shout = [" ".join(w.upper() + "!!" for w in p.split()) for p in prose[:40]]
    item = " ".join(prose[7].split()[10:25])
    texts = [*prose, *shout, prose[3], prose[5] + " password=abcdefgh9", " ".join(reversed(prose[11].split())) + " secret: zzzzzzzz"]
    rows = [(i, t, "en", "s", len(t), "extra") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, __id string")
    labels = spark.createDataFrame([(i, int(i < 80), 0) for i in range(120)], "doc_id long, quality int, toxic int")
    for name, df in (
        ("documents", docs),
        ("labels", labels),
        ("benchmark", spark.createDataFrame([(1, item)], "item_id long, text string")),
    ):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    now = table(spark, str(tmp_path), "documents").drop("__id")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == now.columns
        out.write.parquet(f"{tmp_path}/stage{k}")
        now = spark.read.parquet(f"{tmp_path}/stage{k}")
        kept[name] = {r.doc_id: r for r in now.collect()}
    assert set(range(80)) <= set(kept["quality"]) and not set(range(80, 120)) & set(kept["quality"])
    assert set(kept["quality"]) - set(kept["near_dedup"]) == {120, 121}
    assert set(kept["near_dedup"]) - set(kept["decontaminate"]) == {7}
    assert "zzzzzzzz" not in kept["secrets"][122].text and kept["secrets"][122].n_chars == len(kept["secrets"][122].text)
    assert set(kept["tokens"]) == set(kept["secrets"]) == set(kept["decontaminate"])


def test_rows_without_an_id_pass_no_stage_unseen(spark, tmp_path):
    rng = random.Random(4)
    prose = [" ".join(f"w{rng.randrange(600)}" for _ in range(60)) for _ in range(5)]
    item = " ".join(prose[2].split()[10:25])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(9, prose[0]), (None, prose[0]), (None, prose[1]), (None, prose[1]), (None, prose[2]), (None, prose[3]), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    texts = lambda df: sorted((r.doc_id or 0, r.text or "") for r in df.collect())
    left = [(0, ""), (0, ""), (0, prose[1]), (0, prose[2]), (0, prose[3]), (9, prose[0])]
    assert texts(kept) == sorted(left)
    clean = corpus_pipeline.decontaminated(spark, docs, str(tmp_path))
    assert texts(clean) == sorted((r[0] or 0, r[1] or "") for r in rows if r[1] != prose[2])
