"""Secret scans (3): known patterns plus a token-efficiency test.

Base patterns find assignments (``password = ...``), access keys and long hex
runs. The method adds spans of its own: a run of key-like characters is put
through a byte-level BPE vocabulary; prose and names need few tokens, random
strings need many, so a low number of characters per token exposes them.
Known digests (hex of the usual digest lengths, UUIDs) and identifiers (names
and paths whose letter parts are words, that is need few tokens themselves)
are excluded from that test; runs under ``LONG_RUN`` characters are tested
where they mix letters, digits and cases, and are not hex.

Offsets are code points, end exclusive. Defined results: null and empty
texts have no spans; repeated rows are scanned one by one; spans of different
kinds may overlap and are all kept; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from regstat.llm.common import keyed, slices

#: Fixed patterns of the base.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more is matched whole, a shorter one fails
MIN_ASSIGN, MIN_ACCESS = 6, 20

#: Runs that the token test looks at, and the characters per token below
#: which one is random.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
MAX_CHARS_PER_TOKEN = 2.0
#: A shorter run is only tested if it goes between letters and digits, or from
#: small letters to capitals, this often.
LONG_RUN, SWITCHES = 20, 3
#: Characters per token from which the letter parts of a run are words; those
#: of random runs of 20 and more reach 2.4.
WORD_CHARS_PER_TOKEN = 2.5
#: Lengths of hex digests: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGESTS = (32, 40, 56, 64, 96, 128)
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
IS_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
SWITCH = re.compile(r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[a-z])(?=[A-Z])")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

KINDS = ("assign", "access", "hex", "random")
SCHEMA = "doc_id long, spans array<struct<kind:string,start:int,end:int>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tiktoken.Encoding:
    """A byte-level vocabulary from its rank file; the whole run is one piece."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("secrets", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})


def efficiency(parts: list[str], vocab: tiktoken.Encoding) -> float:
    """Characters per token; capitals count as the better of both cases."""
    cost = sum(
        min(len(vocab.encode_ordinary(q)) for q in ({p, p.lower()} if p.isupper() else {p})) for p in parts
    )
    return sum(map(len, parts)) / max(cost, 1)


def identifier(run: str, vocab: tiktoken.Encoding) -> bool:
    """Made of words of three or more letters: at most a third of the letters
    and digits stand outside them, and they need few tokens, as words do."""
    parts = WORDS.findall(run)
    size = sum(map(len, parts))
    words = [p for p in parts if len(p) >= 3 and p.isalpha()]
    return 3 * sum(map(len, words)) >= 2 * size and efficiency(words, vocab) >= WORD_CHARS_PER_TOKEN


def random_run(run: str, vocab: tiktoken.Encoding, most: float = MAX_CHARS_PER_TOKEN) -> bool:
    """The token-efficiency test with its exclusions."""
    if not any(map(str.isalpha, run)):
        return False
    if len(run) < LONG_RUN and (len(SWITCH.findall(run)) < SWITCHES or IS_HEX.fullmatch(run.replace("-", ""))):
        return False
    if len(run) in DIGESTS and IS_HEX.fullmatch(run) or UUID.fullmatch(run):
        return False
    return efficiency([run], vocab) <= most and not identifier(run, vocab)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), unordered."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def find(text: str, vocab: tiktoken.Encoding) -> list[tuple[int, int, int]]:
    """All spans by start, then kind."""
    out = base_spans(text)
    out += [(m.start(), 3, m.end()) for m in RUN.finditer(text) if random_run(m[0], vocab)]
    return sorted(out)


def scan(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and its ``spans``, by start and kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(vocab_path)
        for part in (p for batch in batches for p in slices(batch, "text")):
            found = [
                [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in find(t, vocab)]
                for t in part.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(found, pa.list_(_SPAN))], ["doc_id", "spans"]
            )

    return keyed(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "[secret]") -> str:
    """``text`` with the union of the spans replaced by ``mark``."""
    out, at = [], 0
    for start, _, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, vocab_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with every span in ``text_col`` replaced; other columns, and
    null texts, as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(vocab_path)
        for part in (p for batch in batches for p in slices(batch, text_col)):
            at = part.schema.get_field_index(text_col)
            texts = [t if t is None else redact(t, find(t, vocab)) for t in part.column(at).to_pylist()]
            yield part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
