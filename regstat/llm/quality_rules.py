"""Quality rules (8): a ledger of rule bits.

Every rule is evaluated once per document. The ledger stores the
measurements and one bit per failed rule; policies are versioned bit masks
over it. A new policy, or the effect of leaving a rule out, is a bitwise
aggregation over the ledger and never looks at a text again.

Words are runs of bytes other than 0x20 and 0x09-0x0D; lines are split at
0x0A. Defined results: a null or empty text has no words and measures 0
everywhere (it fails ``few_words``); repeated rows are judged one by one; an
empty table gives an empty ledger; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regstat.llm import common as c

#: Rules in bit order. Each is an exact integer comparison over measurements.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "100 * n_dup_lines > 30 * n_lines",
    "short_mean_word": "word_chars < 2 * n_words",
    "long_mean_word": "word_chars > 20 * n_words",
    "shouting": "2 * n_shout_words > n_words",
}
#: Rules that the contract calls the base.
BASE = ("few_words", "repeated_words")
#: Policies by version: the rules that drop a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "duplicate_lines"),
    "v3": tuple(RULES),
}
CURRENT = "v3"

LEDGER = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, "
    "n_repeat_words long, n_shout_words long"
)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CODES = c.byte_codes(8)


def measure(block: c.Block) -> list[np.ndarray]:
    """The columns of ``LEDGER`` for one block."""
    rows, buf, at = len(block.ids), block.buf, block.at
    start, end, row = c.word_spans(block)
    n_words = c.counts_by_row(row, rows)
    spans = c.SpanHash(buf, _CODES)
    word = spans(start, end)

    leading = (buf & 0xC0) != 0x80
    inside = ~c._SPACE[buf]
    word_chars = c.sums_by_row(leading & inside, at)
    n_symbols = c.sums_by_row(_SYMBOL[buf], at)

    # a word shouts with two or more capitals and no small letter
    capital = np.zeros(len(buf) + 1, np.int64)
    small = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf >= 0x41) & (buf <= 0x5A), out=capital[1:])
    np.cumsum((buf >= 0x61) & (buf <= 0x7A), out=small[1:])
    shouts = (capital[end] - capital[start] >= 2) & (small[end] == small[start])
    n_shout = c.counts_by_row(row[shouts], rows)

    # lines: the pieces between newlines and document ends that hold a word
    cuts = np.flatnonzero(buf == 0x0A)
    line_start = np.sort(np.concatenate([at[:-1], cuts + 1]))
    line_end = np.sort(np.concatenate([cuts, at[1:]]))
    holds = np.searchsorted(start, line_end, side="left") > np.searchsorted(start, line_start, side="left")
    line_start, line_end = line_start[holds], line_end[holds]
    line_row = block.rows_of(line_start)
    n_lines = c.counts_by_row(line_row, rows)
    line = salted(spans(line_start, line_end), line_row)
    distinct = np.unique(line, return_index=True)[1]
    n_dup = n_lines - c.counts_by_row(line_row[distinct], rows)

    # words in windows of three that occur twice or more in the text
    repeated = np.zeros(len(word) + 2, bool)
    if len(word) >= 3:
        whole = row[2:] == row[:-2]
        first = np.flatnonzero(whole)
        three = word[first] + c.BASE * (word[first + 1] + c.BASE * word[first + 2])
        key = salted(c.mix(three), row[first])
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = first[twice]
        for k in range(3):
            repeated[hit + k] = True
    n_repeat = c.counts_by_row(row[repeated[: len(word)]], rows)
    return [block.ids, n_words, word_chars, n_symbols, n_lines, n_dup, n_repeat, n_shout]


def salted(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hashes that differ between rows."""
    return c.mix(h ^ c.mix(row.astype(c.U64) + c.U64(1)))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements and ``failed`` (bit i set: rule i of ``RULES`` fails), one
    row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in LEDGER.split(", ")]
        for block in c.blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in measure(block)], names)

    measured = c.keyed(docs, id_col, text_col).mapInArrow(run, LEDGER)
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES.values())]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measured.withColumn("failed", failed.cast("long"))


def mask(rules: tuple[str, ...]) -> int:
    order = list(RULES)
    return sum(1 << order.index(r) for r in rules)


def passes(version: str = CURRENT) -> Column:
    """True where no rule of the policy fails."""
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[version]))) == 0


def ablations(led: DataFrame, version: str = CURRENT) -> DataFrame:
    """Per rule of the policy: documents it fails, documents it alone fails
    (kept again without it), and documents that fail any rule. The ledger is
    first counted by its distinct bit sets, at most 2 ** len(RULES) rows."""
    whole = mask(POLICIES[version])
    sets = led.groupBy("failed").agg(F.count("*").alias("n"))
    rules = F.array(
        *[F.struct(F.lit(r).alias("rule"), F.lit(mask((r,))).alias("bit")) for r in POLICIES[version]]
    )
    hit = F.col("failed").bitwiseAND(F.lit(whole))
    return (
        sets.select("failed", "n", F.explode(rules).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(hit.bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(hit == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_alone"),
            F.sum(F.when(hit != 0, F.col("n")).otherwise(0)).alias("n_any"),
        )
    )
