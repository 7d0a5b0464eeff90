"""Substring dedup (9): paragraph MinHash banding, and passages inside lines.

*Paragraphs* are lines of at least ``MIN_WORDS`` words, as the set of their
5-word shingles. Minimum hashes are cut into bands; :func:`tuned` picks the
fewest bands that reach the target recall at the similarity threshold.
Paragraphs that collide in a band are compared (exact Jaccard similarity on
the full sets), and the linked ones form components. In each component the
first paragraph of the corpus stays, by document id and line; the others are
removals. Paragraphs with equal sets are one representative from the start,
so copies are never paired.

*Passages.* A passage in a longer line, or wrapped at other places, is no line of
its own. So each whole text, line breaks or not, is also cut into pieces where its
words say so: before a word whose pair with the one before it has the least hash
among its ``REACH`` neighbours on each side. Inside a passage that stands in two
documents both are cut alike, but for its first and last words. Pieces that an earlier
place of the corpus has too, and that follow each other, are one run; runs of at least
``PASSAGE_WORDS`` words are removals.

Defined results: null and empty texts have no paragraphs; rows that repeat an id are
documents of their own, so all but the first of repeated rows lose their lines; rows
without an id come before all others; an empty table gives an empty table; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regstat.llm import common as c
from regstat.llm import near_dups as nd
from regstat.llm.substring_dups import numbered as numbered_rows

MIN_WORDS = 20
SIMILARITY = 0.75
RECALL = 0.998
#: Words on each side that a cut between pieces depends on.
REACH = 4
#: Words of a run of repeated pieces from which it is a passage.
PASSAGE_WORDS = 24
ROWS_PER_BAND = 3


def tuned(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS_PER_BAND) -> int:
    """The fewest bands that find a pair of ``similarity`` with probability
    ``recall`` or more."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))


BANDS = tuned()
SCHEMA = "doc_id long, line int, n_words int, key long, text string, bands array<long>, sketch binary"


def lines_of(block: c.Block) -> list[tuple[int, int, int, int, int]]:
    """(row, line number, start, end, words) of the paragraphs of a block."""
    start, _, _ = c.word_spans(block)
    cuts = np.flatnonzero(block.buf == 0x0A)
    begin = np.sort(np.concatenate([block.at[:-1], cuts + 1]))
    end = np.sort(np.concatenate([cuts, block.at[1:]]))
    n = np.searchsorted(start, end) - np.searchsorted(start, begin)
    keep = np.flatnonzero(n >= MIN_WORDS)
    row = block.rows_of(begin[keep])
    line = np.searchsorted(cuts, begin[keep]) - np.searchsorted(cuts, block.at[row])
    return list(zip(row.tolist(), line.tolist(), begin[keep].tolist(), end[keep].tolist(), n[keep].tolist(), strict=True))


def paragraphs(docs: DataFrame) -> DataFrame:
    """All paragraphs with the key of their set, bands and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in c.blocks(batches):
            found = lines_of(block)
            ids = np.array([block.ids[f[0]] for f in found], object)
            edges = np.array([f[2:4] for f in found], np.int64).reshape(-1, 2)
            at = np.concatenate([[0], np.cumsum(edges[:, 1] - edges[:, 0])])
            buf = np.concatenate([block.buf[a:b] for a, b in edges.tolist()]) if len(edges) else block.buf[:0]
            sets = nd.shingle_sets(c.Block(ids, buf, at))
            mins = np.array([nd.minimums(s) for s in sets], np.uint32).reshape(-1, nd.MINS)
            band = mins[:, : BANDS * ROWS_PER_BAND].reshape(len(sets), BANDS, ROWS_PER_BAND).astype(c.U64)
            band = c.mix(band[..., 0] + c.BASE * (band[..., 1] + c.BASE * (band[..., 2] + c.BASE)))
            band = c.mix(band + np.arange(BANDS, dtype=c.U64)[None, :])
            key = np.array([c.mix(s).sum(dtype=c.U64) for s in sets], c.U64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([f[1] for f in found], pa.int32()),
                    pa.array([f[4] for f in found], pa.int32()),
                    pa.array(key.view(np.int64)),
                    pa.array([buf[a:b].tobytes().decode() for a, b in zip(at[:-1], at[1:], strict=True)], pa.string()),
                    c.lists(band.view(np.int64).ravel(), np.full(len(sets), BANDS), pa.int64()),
                    pa.array([m.tobytes() for m in mins.astype(np.uint8)], pa.binary()),
                ],
                [f.split()[0] for f in SCHEMA.split(", ")],
            )

    return docs.mapInArrow(run, SCHEMA)


_CODES = c.byte_codes(9)


def cuts(word: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Places of the words that begin a piece: the first of each text, and those
    whose pair with the word before has the least hash around."""
    begin = np.ones(len(word), bool)
    begin[1:] = row[1:] != row[:-1]
    pair = np.zeros(len(word), c.U64)
    pair[1:] = c.mix(word[1:] + c.BASE * word[:-1])
    pair[begin] = np.iinfo(np.uint64).max  # never the least
    least = ~begin
    for d in range(1, REACH + 1):
        same = row[d:] == row[:-d]
        least[d:] &= ~same | (pair[d:] < pair[:-d])
        least[:-d] &= ~same | (pair[:-d] <= pair[d:])
    return np.flatnonzero(begin | least)


def pieces(docs: DataFrame) -> DataFrame:
    """``doc_id, at, n_words, key``: the pieces of every text, ``at`` in words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in c.blocks(batches):
            low = c.Block(block.ids, c.lower_ascii(block.buf), block.at)
            start, end, row = c.word_spans(low)
            word = c.SpanHash(low.buf, _CODES)(start, end)
            first = cuts(word, row)
            last = np.append(first[1:], len(word))[: len(first)]
            up, down = c.powers(len(word) + 1)
            sums = np.zeros(len(word) + 1, c.U64)
            np.cumsum(word * up[:-1], out=sums[1:])
            key = c.mix((sums[last] - sums[first]) * down[first] + (last - first).astype(c.U64))
            head = np.searchsorted(row, row[first], side="left")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block.ids[row[first]], pa.int64()),
                    pa.array((first - head).astype(np.int32)),
                    pa.array((last - first).astype(np.int32)),
                    pa.array(key.view(np.int64)),
                ],
                ["doc_id", "at", "n_words", "key"],
            )

    return docs.mapInArrow(run, "doc_id long, at int, n_words int, key long")


def passages(docs: DataFrame) -> DataFrame:
    """``doc_id, runs``: the repeated passages of each document that has any
    (array of ``at, n_words``)."""
    every = c.written(pieces(docs), "pieces")
    place = F.struct("doc_id", "at")
    shared = every.groupBy("key").agg(F.min(place).alias("first"), F.count("*").alias("m")).where("m > 1")
    later = every.join(shared.select("key", "first"), "key").where(place != F.col("first"))
    found = later.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("at", "n_words"))).alias("found"))
    # of the pieces in order, those that follow each other as one
    merged = F.expr(
        "aggregate(found, cast(array() as array<struct<at:int,n_words:int>>), (a, p) -> "
        "if(size(a) > 0 and try_element_at(a, -1).at + try_element_at(a, -1).n_words = p.at, "
        "concat(slice(a, 1, size(a) - 1), array(named_struct('at', try_element_at(a, -1).at, 'n_words', try_element_at(a, -1).n_words + p.n_words))), "
        "concat(a, array(p))))"
    )
    long = found.select("doc_id", F.filter(merged, lambda r: r["n_words"] >= PASSAGE_WORDS).alias("runs"))
    return long.where("size(runs) > 0")


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_paragraphs, removed`` (the removed
    paragraphs: array of ``line, n_words, component``) and ``passages`` (the removed
    passages: array of ``at, n_words``, in words of the whole text)."""
    numbered = numbered_rows(docs, id_col, text_col)
    known = numbered.select("doc_id", "text")
    every = paragraphs(known)
    places = c.written(every.drop("text"), "paragraphs")
    reps = places.groupBy("key").agg(F.min("bands").alias("bands"), F.min("sketch").alias("sketch"))
    buckets = reps.select(F.col("key").alias("rep"), F.explode("bands").alias("node"))
    sizes = buckets.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
    sketches = places.select(F.col("key").alias("rep"), "sketch").dropDuplicates(["rep"])
    shared = c.written(buckets.join(sizes, "node").join(sketches, "rep"), "buckets")
    leaves = shared.where(F.col("n") <= nd.LEAF).drop("n")
    dense = shared.where(F.col("n") > nd.LEAF).withColumnRenamed("n", "among")

    pairs = c.written(nd.leaf_pairs(leaves.withColumn("comp", F.col("rep")), every=False), "pairs")
    live = pairs.select(F.explode(F.array("a", "b")).alias("key")).unionByName(dense.select(F.col("rep").alias("key")))
    texts = every.select("key", "text").join(live.distinct(), "key", "left_semi").dropDuplicates(["key"])
    sets = c.written(nd.full_sets(texts.select(F.col("key").alias("doc_id"), "text")), "sets")
    found = nd.linked(leaves, dense, pairs, sets).select(F.col("node").alias("key"), "component")

    joined = places.select("doc_id", "line", "n_words", "key").join(found, "key", "left")
    joined = joined.withColumn("component", F.coalesce("component", "key"))
    place = F.struct("doc_id", "line")
    first = joined.groupBy("component").agg(F.min(place).alias("first"), F.count("*").alias("m")).where("m > 1")
    gone = joined.join(first, "component").where(place != F.col("first"))
    removed = gone.groupBy(F.col("doc_id").alias("__id")).agg(
        F.array_sort(F.collect_list(F.struct("line", "n_words", "component"))).alias("removed")
    )
    counts = places.groupBy(F.col("doc_id").alias("__doc")).agg(F.count("*").alias("n_paragraphs"))
    inside = passages(known).select(F.col("doc_id").alias("__own"), "runs")
    out = numbered.select("doc_id", "own_id").join(counts, F.col("doc_id") == F.col("__doc"), "left")
    out = out.join(removed, F.col("doc_id") == F.col("__id"), "left")
    out = out.join(inside, F.col("doc_id") == F.col("__own"), "left")
    none = F.expr("cast(array() as array<struct<line:int,n_words:int,component:bigint>>)")
    no_runs = F.expr("cast(array() as array<struct<at:int,n_words:int>>)")
    return out.select(
        F.col("own_id").alias("doc_id"),
        F.coalesce("n_paragraphs", F.lit(0)).alias("n_paragraphs"),
        F.coalesce("removed", none).alias("removed"),
        F.coalesce("runs", no_runs).alias("passages"),
    )
