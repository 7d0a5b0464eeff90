"""Periodic runs (11): stretches of words that repeat with a period four times
or more, by a dictionary of basic factors.

For every power of two the dictionary names the factors (stretches of that
many words) of a text: equal names, equal factors. The names of one
length come from pairs of names of half the length. Where the next occurrence of
a factor, at most twice its length on, lies the same distance on for consecutive
places, these occurrences form arithmetic progressions, and the distance is
proposed as a period of the stretch they cover. Proposals are extended word
by word while the period holds, and equal ones of several lengths are one run.

Why none is missed: in a run of period q and at least 4 q words, take the
least power of two of q words or more. Each of its factors in the run comes
again exactly q words on, since the period is the smallest one, so the run is
one progression from its first word to its last. Only factors that occur twice
in their text are named in the next length, which leaves few of them in prose.

Defined results: a null, empty or blank text has no words and no run; a row
without an id has nothing planted by its id; repeated rows are looked at one by
one; an empty table gives an empty table; other columns are not looked at. A
task holds about 60 bytes for each word of a block of texts (or of one
longer text).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from regstat.llm import common as c

#: A run has at least so many words, and so many times its period.
LEAST_WORDS = 6
LEAST_POWER = 4

Runs = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def runs_of(words: np.ndarray, at: np.ndarray) -> Runs:
    """Row, start, length and period of every run of the texts ``words``
    (numbers, equal for equal words) with row offsets ``at``; ordered by row,
    start and period."""
    rows = np.repeat(np.arange(len(at) - 1), np.diff(at))
    end = at[1:][rows]
    # names differ between texts from here on
    name, place = _named(words + at[:-1][rows], np.arange(len(words)))
    found = []
    size = 1
    while len(place):
        found.append(_proposed(name, place, size, rows))
        # the next length: both halves occur again, within the text
        at_place = np.full(len(words), -1, np.int64)
        at_place[place] = name
        place = np.sort(place)
        place = place[place + 2 * size <= end[place]]
        place = place[at_place[place + size] >= 0]
        pair = at_place[place] * (len(words) + 1) + at_place[place + size]
        size *= 2
        if not len(place) or 4 * (size // 2 + 1) > np.diff(at).max():
            break  # no text is long enough for a period over half this length
        name, place = _named(pair, place)
    start, length, period = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 3
    start, length = _extended(words, at[:-1], end, rows, start, length, period)
    unique = np.unique(np.stack([rows[start] if len(start) else start, start, period, length]), axis=1)
    row, start, period, length = unique
    return row, start - at[row], length, period


def _named(keys: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the factors with ``keys`` at ``place`` (in order) that occur
    twice or more, with their places; ordered by name, then place."""
    order = np.argsort(keys, kind="stable")
    keys, place = keys[order], place[order]
    same = keys[1:] == keys[:-1]
    name = np.zeros(len(keys), np.int64)
    np.cumsum(~same, out=name[1:])
    again = np.zeros(len(keys), bool)
    again[1:] |= same
    again[:-1] |= same
    return name[again], place[again]


def _proposed(name: np.ndarray, place: np.ndarray, size: int, rows: np.ndarray) -> Runs:
    """Start, length and period of the stretches whose factors of ``size``
    words follow at one distance, at most twice the size."""
    gap = place[1:] - place[:-1]
    near = (name[1:] == name[:-1]) & (gap <= 2 * size)
    first, gap = place[:-1][near], gap[near]
    order = np.argsort(first, kind="stable")
    first, gap = first[order], gap[order]
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] != first[:-1] + 1) | (gap[1:] != gap[:-1]) | (rows[first[1:]] != rows[first[:-1]])
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(first)) - 1
    start, period = first[begin], gap[begin]
    length = first[last] - start + size + period if len(begin) else start
    long = length >= np.maximum(LEAST_WORDS, LEAST_POWER * period)
    return start[long], length[long], period[long]


def _extended(words, begin, end, rows, start, length, period):
    """Starts and lengths, moved out while the neighbouring word keeps the
    period."""
    start, stop = start.copy(), start + length
    if not len(start):
        return start, length
    low, high = begin[rows[start]], end[start]
    while True:
        left = (start > low) & (words[np.maximum(start - 1, 0)] == words[np.maximum(start - 1, 0) + period])
        right = (stop < high) & (words[np.minimum(stop, len(words) - 1)] == words[np.minimum(stop, len(words) - 1) - period])
        if not (left.any() or right.any()):
            return start, stop - start
        start, stop = start - left, stop + right


def planted(n: int, doc_id: int | None) -> np.ndarray:
    """Which word of the text stands at each place: the text itself, and for
    every tenth id (by crc32) a period from some word on."""
    place = np.arange(n)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return place
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place[a:] = a + (place[a:] - a) % p
    return place


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``runs`` (start, length, period; by
    start, then period), ``top`` (the index of the run with the greatest length
    in periods) and ``collapsed`` (the words that are in no run, or in its first
    period, joined by blanks). ``plant``: see ``planted``."""
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in c.blocks(batches):
            texts, numbers = [], []
            for i, doc_id in enumerate(block.ids):
                words = block.text(i).split()  # at 0x20 and 0x09-0x0D
                table: dict[bytes, int] = {}
                own = np.fromiter((table.setdefault(w, len(table)) for w in words), np.int64, len(words))
                if plant:
                    order = planted(len(words), doc_id)
                    own, words = own[order], [words[k] for k in order] if len(words) and order[-1] != len(words) - 1 else words
                texts.append(words)
                numbers.append(own)
            at = np.zeros(len(texts) + 1, np.int64)
            np.cumsum([len(w) for w in numbers], out=at[1:])
            row, start, length, period = runs_of(np.concatenate(numbers), at)
            top, joined = [None] * len(texts), [b" ".join(w) for w in texts]
            cuts = np.searchsorted(row, np.arange(len(texts) + 1))
            for i in np.unique(row):
                own = [(int(start[k]), int(length[k]), int(period[k])) for k in range(cuts[i], cuts[i + 1])]
                top[i] = max(range(len(own)), key=lambda k: (Fraction(own[k][1], own[k][2]), -own[k][0], -own[k][2]))
                joined[i] = b" ".join(_kept(texts[i], own))
            values = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], fields=list(run_type))
            runs = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.ids, pa.int64()), runs, pa.array(top, pa.int64()), pa.array(joined, pa.binary()).view(pa.string())],
                ["doc_id", "runs", "top", "collapsed"],
            )

    kind = "doc_id long, runs array<struct<start: long, length: long, period: long>>, top long, collapsed string"
    return c.keyed(docs, id_col, text_col).mapInArrow(run, kind)


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    inside = np.cumsum(change)
    return [w for w, n in zip(words, inside, strict=False) if not n]
