"""Token-ID / binary output (5): static range asymmetric numeral system.

Documents are tokenized with the ``tokenizers`` library where they are read;
only their ids, about half as large, are dealt by ranges of the document id
and written in ascending order as a Parquet dataset of independent blocks. A block holds
the ids of whole documents, coded with one frequency table that all blocks
share (counted over all ids). ``LANES`` interleaved coders write into one
word stream, so numpy codes a row of ``LANES`` ids at a time. Every
``CHECKPOINT`` rows the coder states and the stream position are stored; a
reader can start at any of them, in parallel. A CRC-32 per block guards the
ids.

Defined results: null and empty texts are the end id alone; documents that
repeat an id are written in the order of their ids' bytes; an empty table gives an
empty dataset; other columns are not looked at.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from regstat.llm import common as c

LANES = 1024
BLOCK_IDS = 1 << 18
CHECKPOINT = 64
SCALE_BITS = 20
LOW = np.uint64(1 << 31)
END = 1
#: Runs remembered per worker process and generation.
TABLE_RUNS = 600_000
#: Bytes of text whose runs are looked up at a time. A longer text is a block of
#: its own.
BLOCK_TEXT = 1 << 22
#: Runs up to this length are remembered.
RUN_CHARS = 64

_SPACES = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PIECE = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACES}\p{{L}}\p{{N}}]+")

#: A letter and a sign behind it: never of one piece, and no rule joins them.
_LETTER_SIGN = r"([A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?])"
#: No text without these has signs that compose with others.
_COMPOSING = r"[^\x{0}-\x{2ff}]"


def normal(run: str) -> str:
    """A run as the tokenizer normalises it; no rule looks past white space."""
    if not unicodedata.is_normalized("NFC", run):
        run = unicodedata.normalize("NFC", run)
    return run.replace("Σ", "σ").lower()  # lower case goes by single characters


class Runs:
    """The library's ids of texts, looked up by runs without white space.

    The tokenizer never joins two such runs, so a run has the same ids in
    every text. Arrow cuts the texts, also between a letter and a sign behind
    it, and numbers their distinct runs, Python looks at those only, and numpy
    puts the ids in the texts' order. The unknown pieces of unknown runs go to
    the library; texts with special strings go there whole."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model.tokenize
        vocab = self.library.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for s, i in vocab.items() if s.endswith("</w>")]] = True
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return array("i", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def pieces(self, pieces: list[str]) -> dict[str, bytes]:
        # of lower-case ASCII signs only the library's model is left to ask
        plain = [p for p in pieces if p.isascii() and p.isprintable()]
        found = {p: array("i", [t.id for t in self.model(p)]).tobytes() for p in plain}
        return found | self.together([p for p in pieces if p not in found])

    def together(self, pieces: list[str]) -> dict[str, bytes]:
        if not pieces:
            return {}
        joined = self.library.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)[0]
        ids = np.array(joined.ids, np.int32)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(pieces):  # some piece is split again: one by one
            return {p: self.whole(p) for p in pieces}
        raw, at = ids.tobytes(), [0, *(4 * ends).tolist()]
        return {p: raw[lo:hi] for p, lo, hi in zip(pieces, at, at[1:], strict=False)}

    def learn(self, words: list[str]) -> list[bytes]:
        """Ids of runs that no table holds."""
        plain = [w if w.isascii() else normal(w) for w in words]
        # signs that lower case has put in another order: the library would sort them
        odd = {p for p in plain if not p.isascii() and not unicodedata.is_normalized("NFC", p)}
        parts = {p: _PIECE.findall(p) for p in plain if not p.isalpha()}
        pieces = list(set(plain).difference(parts).union(*parts.values()))
        known = dict(zip(pieces, map(self.young.get, pieces), strict=True))
        new = self.pieces([p for p in pieces if known[p] is None])
        known |= new
        self.remember(new)
        found = [b"".join(map(known.__getitem__, parts[p])) if p in parts else known[p] for p in plain]
        for k in [k for k, p in enumerate(plain) if p in odd] if odd else []:
            found[k] = self.whole(words[k])
        return found

    def lookup(self, words: list[str]) -> list[bytes]:
        """Ids of distinct runs."""
        if len(self.young) >= TABLE_RUNS:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, words))
        if self.old:
            again = [k for k, ids in enumerate(found) if ids is None and words[k] in self.old]
            for k in again:
                found[k] = self.young[words[k]] = self.old[words[k]]
        at = [k for k, ids in enumerate(found) if ids is None]
        new = [words[k] for k in at]
        ids = self.learn(new)
        for k, x in zip(at, ids, strict=True):
            found[k] = x
        self.remember(dict(zip(new, ids, strict=True)))
        return found

    def remember(self, ids: dict[str, bytes]) -> None:
        self.young.update(ids)
        for w in [w for w in ids if len(w) > RUN_CHARS]:
            del self.young[w]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and each text's count."""
        odd = np.zeros(len(texts), bool)
        for s in self.special:
            odd |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        # lower case goes by single characters, but only where none of them composes
        composing = pc.match_substring_regex(plain, _COMPOSING)
        lower = pc.if_else(composing, plain, pc.ascii_lower(plain))
        cut = pc.ascii_split_whitespace(pc.replace_substring_regex(lower, _LETTER_SIGN, r"\1 \2"))
        runs = cut.flatten()
        if pc.any(composing).as_py():
            runs = pc.if_else(pc.string_is_ascii(runs), pc.ascii_lower(runs), runs)
        runs = runs.dictionary_encode()
        found = self.lookup(runs.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(found), np.int32)
        size = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        at, run = np.cumsum(size) - size, runs.indices.to_numpy()
        end = np.concatenate([[0], np.cumsum(size[run])])
        ids = flat[np.repeat(at[run] - end[:-1], size[run]) + np.arange(end[-1])]
        edge = cut.offsets.to_numpy().astype(np.int64)
        edge = end[edge - edge[0]]
        if odd.any():
            own = [ids[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]
            for k in np.flatnonzero(odd).tolist():
                own[k] = np.frombuffer(self.whole(texts[k].as_py()), np.int32)
            return np.concatenate(own), np.array(list(map(len, own)), np.int64)
        return ids, np.diff(edge)


@lru_cache(maxsize=2)
def runs(path: str) -> Runs:
    return Runs(path)


class Coder:
    """rANS over one table of frequencies that sum to 2 ** SCALE_BITS."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(c.U64)
        self.base = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(c.U64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.int32), freq)

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
        """(words, lane states, checkpoints) of a block. Rows are coded last
        to first, so that a reader goes first to last."""
        rows = -(-len(ids) // LANES)
        full = np.zeros(rows * LANES, np.int64)
        full[: len(ids)] = ids
        if rows * LANES > len(ids):
            full[len(ids) :] = ids[-1]
        full = full.reshape(rows, LANES)
        state = np.full(LANES, LOW, c.U64)
        out: list[np.ndarray] = []
        marks: list[np.ndarray] = []
        written = 0
        limit = (LOW >> c.U64(SCALE_BITS)) << c.U64(32)
        for r in range(rows - 1, -1, -1):
            f, b = self.freq[full[r]], self.base[full[r]]
            big = state >= limit * f
            words = state[big].astype(np.uint32)
            out.append(words[::-1])
            written += len(words)
            state = np.where(big, state >> c.U64(32), state)
            q = state // f
            state = (q << c.U64(SCALE_BITS)) + (state - q * f) + b
            if r % CHECKPOINT == 0:
                marks.append(np.concatenate([np.array([r, written], c.U64), state]))
        stream = np.concatenate(out)[::-1] if out else np.zeros(0, np.uint32)
        for m in marks:  # from the end of the stream to its start
            m[1] = written - m[1]
        return stream.tobytes(), state.tobytes(), np.array(marks[::-1], c.U64).tobytes()

    def decode(self, stream: bytes, states: bytes, n: int, first_row: int = 0) -> np.ndarray:
        """The ids from ``first_row`` on; ``stream`` and ``states`` as they
        stand there."""
        words = np.frombuffer(stream, np.uint32).astype(c.U64)
        state = np.frombuffer(states, c.U64)
        rows = -(-n // LANES)
        out = np.empty((rows - first_row, LANES), np.int32)
        at, mask = 0, c.U64((1 << SCALE_BITS) - 1)
        for r in range(rows - first_row):
            slot = state & mask
            s = self.symbol[slot.astype(np.int64)]
            out[r] = s
            state = self.freq[s] * (state >> c.U64(SCALE_BITS)) + slot - self.base[s]
            small = np.flatnonzero(state < LOW)
            if len(small):
                state[small] = (state[small] << c.U64(32)) | words[at : at + len(small)]
                at += len(small)
        return out.ravel()[: n - first_row * LANES]


def table_of(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2 ** SCALE_BITS, at least 1 for each id that
    occurs."""
    total = 1 << SCALE_BITS
    freq = np.zeros(len(counts), np.int64)
    used = counts > 0
    if not used.any():
        freq[0] = total
        return freq
    share = counts[used] / counts.sum() * (total - used.sum())
    freq[used] = 1 + np.floor(share).astype(np.int64)
    freq[int(np.argmax(freq))] += total - freq.sum()
    return freq


BLOCKS = (
    "part int, start long, ids array<long>, sizes array<int>, n int, crc long, "
    "words binary, states binary, marks binary"
)


def wide_enough(path: str) -> str:
    """The little-endian unsigned type that holds every id of a vocabulary."""
    return "<u2" if max(Tokenizer.from_file(path).get_vocab().values()) < 1 << 16 else "<u4"


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``BLOCK_TEXT`` bytes of text."""
    end = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(end):
        limit = BLOCK_TEXT + (end[lo - 1] if lo else 0)
        hi = max(lo + 1, int(np.searchsorted(end, limit, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def tokens(docs: DataFrame, path: str, kind: str) -> DataFrame:
    """``doc_id, ids`` (of type ``kind``, with the end id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
        known = runs(path)
        for batch in batches:
            for part in slices(batch):
                ids, n = known.encode(part.column("text"))
                data = np.insert(ids, np.cumsum(n), END).astype(kind)
                at = np.concatenate([[0], np.cumsum(n + 1)]) * data.itemsize
                raw = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(n), [None, pa.py_buffer(at), pa.py_buffer(data)]
                ).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), raw], ["doc_id", "ids"])

    return docs.mapInArrow(run, "doc_id long, ids binary")


def counts(coded: DataFrame, kind: str, size: int) -> np.ndarray:
    """How often each of ``size`` ids occurs, over all documents; at most one row
    per id of the vocabulary reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        held: list[bytes] = []
        n = 0
        for batch in batches:
            for raw in batch.column("ids").to_pylist():
                held.append(raw)
                n += len(raw)
                if n > 1 << 22:
                    total += np.bincount(np.frombuffer(b"".join(held), kind), minlength=size)
                    held, n = [], 0
        total += np.bincount(np.frombuffer(b"".join(held), kind), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    rows = coded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(size, np.int64)
    for r in rows:
        out[r["id"]] = r["n"]
    return out


def encoded(coded: DataFrame, freq: np.ndarray, kind: str) -> DataFrame:
    """The blocks of each part, a range of document ids, in order; ``start``
    counts from the part's first id."""
    n = int(coded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = coded.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        part, start = None, 0
        held: list[tuple[int | None, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            nonlocal start, held
            ids = np.concatenate([x for _, x in held]).astype(np.int64)
            words, states, marks = coder.encode(ids)
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            row = [part, start, [d for d, _ in held], [len(x) for _, x in held], len(ids), crc, words, states, marks]
            start, held = start + len(ids), []
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

        names = [f.split()[0] for f in BLOCKS.split(", ")]
        types = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32(), pa.int64()]
        types += [pa.binary()] * 3
        size = 0
        for batch in batches:
            for p, d, raw in zip(*[batch.column(k).to_pylist() for k in ("part", "doc_id", "ids")], strict=True):
                if held and (p != part or size >= BLOCK_IDS):
                    yield flush()
                    size = 0
                if p != part:
                    part, start = p, 0
                held.append((d, np.frombuffer(raw, kind)))
                size += len(held[-1][1])
        if held:
            yield flush()

    return ordered.withColumn("part", F.spark_partition_id()).mapInArrow(run, BLOCKS)


def decoded(blocks: DataFrame, freq: np.ndarray) -> DataFrame:
    """One row per document from its block: ``part, at`` (place of its first
    id in the part), ``doc_id, ids``. A block whose checksum fails raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for batch in batches:
            for r in batch.to_pylist():
                ids = coder.decode(r["words"], r["states"], r["n"])
                raw = ids.astype("<u4").tobytes()
                if zlib.crc32(raw) != r["crc"]:
                    raise ValueError(f"block at {r['part']}:{r['start']}: checksum differs")
                sizes = np.array(r["sizes"], np.int64)
                at = np.concatenate([[0], np.cumsum(sizes)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(sizes), r["part"]), pa.int32()),
                        pa.array(r["start"] + at[:-1]),
                        pa.array(r["ids"], pa.int64()),
                        pa.array([raw[4 * a : 4 * b] for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                    ],
                    ["part", "at", "doc_id", "ids"],
                )

    return blocks.mapInArrow(run, "part int, at long, doc_id long, ids binary")


def from_checkpoint(row: dict, coder: Coder, mark: int) -> np.ndarray:
    """The ids of a block from its checkpoint number ``mark`` on."""
    m = np.frombuffer(row["marks"], c.U64).reshape(-1, LANES + 2)[mark]
    return coder.decode(row["words"][4 * int(m[1]) :], m[2:].tobytes(), row["n"], int(m[0]))


def written_blocks(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, np.ndarray]:
    """The dataset of blocks, written in the shared folder, and its table."""
    kind = wide_enough(path)
    coded = c.written(tokens(c.keyed(docs, id_col, text_col), path, kind), "tokens")
    vocab = Tokenizer.from_file(path).get_vocab().values()
    freq = table_of(counts(coded, kind, max([END, *vocab]) + 1))
    return c.written(encoded(coded, freq, kind), "blocks"), freq


def read_documents(blocks: DataFrame, freq: np.ndarray) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` from the blocks; ``start`` is the
    number of ids of all documents before it. Parts are as many as shuffle
    partitions, so their running sum is small."""
    parts = blocks.groupBy("part").agg(F.sum("n").alias("n"))
    before = parts.select(
        F.col("part").alias("__part"),
        (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"),
    )
    rows = decoded(blocks, freq).join(F.broadcast(before), F.col("part") == F.col("__part"))
    return rows.select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), F.expr("length(ids) div 4").alias("n_tokens"), "ids"
    )
