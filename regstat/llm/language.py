"""Language identification (13): multinomial naive Bayes over hashed character
n-grams.

A text is lower-cased; its words are runs of letters and marks, with one
blank around each. The grams are the 2 to 4 consecutive characters inside such
a padded word, hashed into ``BUCKETS`` cells. Learning counts the grams of
every labelled text per language, in one table of fixed size a task and
language, summed by Spark. The log-probabilities (add ``ALPHA``) and the share
of each language among the labelled texts form a matrix of languages by cells,
broadcast for ``LANGUAGES`` languages at a time. A batch is scored as a sparse
matrix of its grams, summed language by language.

Defined results: a null text, or one without a letter, is ``und`` with score
0, and so is every text if nothing could be learnt. Equal scores go to the
language that sorts first. A text with letters whose grams were never seen gets
the probabilities of the smoothing. Repeated rows are learnt from and
scored one by one; rows without a language are scored and not learnt from; an
empty table gives an empty table; other columns are not looked at. A text is
read whole, ``SLICE`` characters at a time.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regstat.llm import common as c

BUCKETS = 1 << 15
ORDERS = (2, 3, 4)
ALPHA = 0.5
#: Languages whose log-probabilities a task holds at a time (8 bytes a cell).
LANGUAGES = 64
#: Characters whose grams a task holds at a time.
SLICE = 1 << 19
NONE = "und"
#: Cell under which the number of texts of a language is counted.
_TEXTS = -1


@cache
def word_characters() -> np.ndarray:
    """Which code points are letters or marks."""
    return np.array([unicodedata.category(chr(i))[0] in "LM" for i in range(0x110000)])


class Characters:
    """The lower-cased characters of a block's texts, a line break around
    each text."""

    def __init__(self, block: c.Block):
        texts = [block.text(i).decode("utf-8", "replace").lower() for i in range(len(block.ids))]
        self.letter = np.array([any(map(str.isalpha, t)) for t in texts], bool)
        self.points = np.frombuffer(("\n" + "".join(t + "\n" for t in texts)).encode("utf-32-le"), np.uint32)
        # the break before a text is its own: its first grams start there
        self.row = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + 1 for t in texts])

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Cell and text of every gram, of one order and at most ``SLICE``
        characters at a time, texts in order."""
        for lo in range(0, len(self.row), SLICE):
            part = self.points[lo : lo + SLICE + max(ORDERS) - 1]
            inside = word_characters()[part]
            x = np.where(inside, part, 0x20).astype(c.U64)
            row = self.row[lo : lo + SLICE]
            for n in ORDERS:
                size = min(len(x) - n + 1, len(row))
                if size <= 0:
                    continue
                ok = inside[1 : size + 1] | inside[:size] if n == 2 else inside[1 : size + 1].copy()
                h = x[:size].copy()
                for j in range(1, n):
                    h = h * c.BASE + x[j : size + j]
                    if 1 < j < n - 1:
                        ok &= inside[j : size + j]
                first = np.flatnonzero(ok)
                yield (c.mix(h[first] + c.U64(n)) & c.U64(BUCKETS - 1)).astype(np.int64), row[first]


def fold(id_col: str) -> Column:
    """crc32 of the id's text modulo 4; null without an id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def gram_counts(texts: DataFrame) -> DataFrame:
    """``lang, cell, n`` over all rows of ``lang, text``: how often each
    language has each cell, and under ``_TEXTS`` its number of texts."""

    def rows_of(totals: dict[str, np.ndarray], texts: dict[str, int]) -> Iterator[pa.RecordBatch]:
        for lang, total in totals.items():
            used = np.flatnonzero(total)
            cell = np.append(used, _TEXTS)
            n = np.append(total[used], texts[lang])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cell), pa.string()), pa.array(cell), pa.array(n)], ["lang", "cell", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        number: dict[str, int] = {}
        for batch in batches:
            names = batch.column("lang").to_pylist()
            batch = batch.set_column(batch.schema.get_field_index("doc_id"), "doc_id", pa.array(np.arange(len(names))))
            for block in c.blocks(iter([batch])):
                chars = Characters(block)
                langs = sorted({names[i] for i in block.ids})
                place = {lang: k for k, lang in enumerate(langs)}
                of_row = np.array([place[names[i]] for i in block.ids], np.int64)
                for lang in langs:
                    totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    number.setdefault(lang, 0)
                for i in np.flatnonzero(chars.letter):
                    number[langs[of_row[i]]] += 1
                for cell, row in chars.grams():
                    whose = of_row[row]
                    for k in np.unique(whose):
                        totals[langs[k]] += np.bincount(cell[whose == k], minlength=BUCKETS)
                if len(totals) > LANGUAGES:  # a task holds a bounded number of tables
                    yield from rows_of(totals, number)
                    totals, number = {}, {}
        yield from rows_of(totals, number)

    parts = texts.select(F.lit(0).cast("long").alias("doc_id"), "lang", "text").mapInArrow(run, "lang string, cell long, n long")
    return parts.groupBy("lang", "cell").agg(F.sum("n").alias("n")).where("n > 0")


def model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The counts (see ``gram_counts``, written) of the rows with a language
    whose fold is not 2."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (fold(id_col) != 2))
    return c.written(gram_counts(rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))), "language-model")


def weights(counts: DataFrame, langs: list[tuple[str, int]], texts: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Names, log shares and log-probabilities (languages by cells) of some
    languages, at most ``LANGUAGES``."""
    place = {lang: k for k, (lang, _) in enumerate(langs)}
    table = np.full((len(langs), BUCKETS), ALPHA)
    chosen = counts.where(F.col("lang").isin(list(place)) & (F.col("cell") != _TEXTS))
    # at most LANGUAGES * BUCKETS cells, a language's at a time
    for lang, k in place.items():
        found = chosen.where(F.col("lang") == lang).select("cell", "n").toArrow()
        table[k, found["cell"].to_numpy()] += found["n"].to_numpy()
    share = np.log(np.array([n for _, n in langs]) / texts)
    return list(place), share, np.log(table) - np.log(table.sum(axis=1, keepdims=True))


def log_scores(chars: Characters, share: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Log-probability of each text with each language."""
    out = np.tile(share, (len(chars.letter), 1))
    for cell, row in chars.grams():
        if not len(cell):
            continue
        first = np.flatnonzero(np.diff(row, prepend=-1))
        for k in range(len(share)):
            out[row[first], k] += np.add.reduceat(table[k][cell], first)
    return out


#: What a pass over some languages leaves for the next: the best language so
#: far, its log-probability, and the sum of all relative to it.
_STATE = "doc_id long, text string, lang string, top double, total double"


def predict(docs: DataFrame, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for each row of ``docs``."""
    number = counts.where(F.col("cell") == _TEXTS)
    texts = number.agg(F.sum("n")).first()[0] or 0
    found = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.lit(None).cast("string").alias("lang"),
        F.lit(float("-inf")).alias("top"),
        F.lit(0.0).alias("total"),
    )
    last = None
    while texts:  # one round unless there are more than LANGUAGES languages
        rest = number if last is None else number.where(F.col("lang") > last)
        langs = [(r["lang"], r["n"]) for r in rest.orderBy("lang").limit(LANGUAGES).collect()]
        if not langs:
            break
        last = langs[-1][0]
        found = found.mapInArrow(_scorer(*weights(counts, langs, texts)), _STATE)
    return found.select(
        "doc_id",
        F.coalesce("lang", F.lit(NONE)).alias("lang_pred"),
        F.when(F.col("lang").isNull(), 0.0).otherwise(1 / F.col("total")).alias("score"),
    )


def _scorer(names: list[str], share: np.ndarray, table: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            best = batch.column("lang").to_pylist()
            top = batch.column("top").to_numpy(zero_copy_only=False).copy()
            total = batch.column("total").to_numpy(zero_copy_only=False).copy()
            rows = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), text.fill_null("")], ["doc_id", "text"])
            for block in c.blocks(iter([rows])):
                chars = Characters(block)
                scores = log_scores(chars, share, table)
                for i in np.flatnonzero(chars.letter):
                    own, at = scores[i], block.ids[i]
                    k = int(np.argmax(own))  # the first of equal ones
                    most = max(top[at], own[k])
                    before = total[at] * np.exp(top[at] - most) if total[at] else 0.0
                    if own[k] > top[at]:
                        best[at] = names[k]
                    total[at] = before + np.exp(own - most).sum()
                    top[at] = most
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), text, pa.array(best, pa.string()), pa.array(top), pa.array(total)],
                ["doc_id", "text", "lang", "top", "total"],
            )

    return run
