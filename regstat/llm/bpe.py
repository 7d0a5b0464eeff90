"""BPE encoding and decoding (10): a bounded-lookahead streaming transducer.

The vocabulary is a ``tokenizers`` JSON file: byte-level BPE with an
end-of-word suffix, lower case, white space dropped, contractions, letters,
single digits and other signs split apart. Its path is a parameter; every
executor reads its own installed copy.

*Encoding.* From the merge list alone :func:`sufficient_lookahead` computes
how many symbols to the right can still change a token. A word is fed symbol
by symbol; as soon as the buffer holds more than that, the tokens that end
before the lookahead are stable and are emitted. A boundary that no merge
crosses splits a word into two independent ones, so what was emitted never
has to be looked at again: memory is bounded by the lookahead, however long
the word. Words that repeat take their tokens from a bounded table.

*Decoding* is a state machine fed one id, or a stretch of ids, at a time. ``"joined"`` gives what
``Tokenizer.decode(ids, skip_special_tokens=False)`` gives for a file without
decoder (token strings joined by a space); ``"text"`` maps tokens back to
bytes and to text, holding at most one unfinished UTF-8 character.

Defined results: null and empty texts have no ids and decode to ''; special
strings in a text become their ids, as in the library; repeated rows, ties
and extra columns do not matter (one output row per input row); an empty
table gives an empty table.
"""

from __future__ import annotations

import codecs
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from regstat.llm.common import keyed, lists, slices

#: Words kept per generation of the table of a worker process.
TABLE_WORDS = 120_000
#: Ids that the decoder takes at a time.
STRETCH = 4096
NO_RULE = 1 << 62

_SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_SPACE = re.compile(f"[{_SPACES}]+")
_ODD = re.compile("[\x1c-\x1f]")  # str.split() cuts there, the tokenizer doesn't
_WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACES}\p{{L}}\p{{N}}]+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level
    vocabulary: itself where printable, else the next free one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def sufficient_lookahead(merges: list[tuple[str, str]], suffix: str) -> int:
    """Symbols right of a token that can still change it.

    A merge (x, y) fails only if y is taken by an earlier merge (y, z) first,
    which fails only if z is taken by a still earlier one, and so on; z itself
    may be undone in the same way through the right parts it was made of. The
    longest such chain is found in one pass over the list, in rank order."""
    reach: dict[str, int] = {}  # of chains of earlier merges that take a token from the right
    right: dict[str, str] = {}  # the right part a token was made of

    def size(token: str) -> int:
        return len(token.removesuffix(suffix))

    def beyond(token: str | None) -> int:
        most = 0
        while token is not None:
            most = max(most, reach.get(token, 0))
            token = right.get(token)
        return most

    longest = 1
    for x, y in merges:
        chain = size(y) + beyond(y)
        longest = max(longest, chain, size(x + y))
        reach[x] = max(reach.get(x, 0), chain)
        right.setdefault(x + y, y)
    return longest


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.lookahead = sufficient_lookahead(merges, self.suffix)
        ids = self.ids
        none: dict[int, int] = {}  # shared by the ids that no rule starts with
        self.after = [none] * (max(ids.values()) + 1)
        for rank, (a, b) in enumerate(merges):
            if self.after[ids[a]] is none:
                self.after[ids[a]] = {}
            self.after[ids[a]][ids[b]] = rank
        self.made = [ids[a + b] for a, b in merges]
        letters = byte_alphabet()
        self.symbol = [ids[c] for c in letters]
        self.final = [ids[c + self.suffix] for c in letters]
        self.byte = {c: b for b, c in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_ids = set(self.special.values())
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        self.strings = {i: s for s, i in [*ids.items(), *self.special.items()]}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    # -- one word ---------------------------------------------------------

    def merged(self, parts: list[int]) -> list[int]:
        """Apply the merge list to one sequence of symbols: always the
        earliest rule, leftmost first."""
        after, made = self.after, self.made
        ranks = [after[a].get(b, NO_RULE) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == NO_RULE:
                break
            at = ranks.index(best)
            new = made[best]
            parts[at : at + 2] = [new]
            del ranks[at]
            if at:
                ranks[at - 1] = after[parts[at - 1]].get(new, NO_RULE)
            if at < len(ranks):
                ranks[at] = after[new].get(parts[at + 1], NO_RULE)
        return parts

    def stream(self, symbols: Iterable[int], sizes: dict[int, int] | None = None) -> Iterator[int]:
        """Tokens of one word from its symbols, each as soon as it is stable.
        Holds at most three lookaheads of symbols."""
        room = 3 * self.lookahead
        held: list[int] = []
        for s in symbols:
            held.append(s)
            if len(held) >= room:
                safe, done = len(held) - self.lookahead, 0
                for token in self.merged(held.copy()):
                    n = self.length(token)
                    if done + n > safe:
                        break
                    done += n
                    yield token
                del held[:done]
        yield from self.merged(held)

    def length(self, token: int) -> int:
        return len(self.strings[token].removesuffix(self.suffix))

    def word(self, word: str) -> list[int]:
        raw = word.encode()
        symbols = [self.symbol[b] for b in raw[:-1]] + [self.final[raw[-1]]]
        if len(symbols) <= 3 * self.lookahead and len(symbols) <= 64:
            return self.merged(symbols)
        return list(self.stream(symbols))

    # -- texts ------------------------------------------------------------

    def pieces(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is special, piece) in order."""
        if self.special_cut is None or not self.special_cut.search(text):
            yield False, text
            return
        for piece in self.special_cut.split(text):
            if piece:
                yield piece in self.special, piece

    def chunks(self, piece: str) -> list[str]:
        """Normalised runs without white space."""
        if not piece.isascii():
            if not unicodedata.is_normalized("NFC", piece):
                piece = unicodedata.normalize("NFC", piece)
            if "Σ" in piece:  # lower case goes by single characters: no final sigma
                piece = piece.replace("Σ", "σ")
        piece = piece.lower()
        return [c for c in _SPACE.split(piece) if c] if _ODD.search(piece) else piece.split()

    def lookup(self, run: str) -> bytes | None:
        found = self.young.get(run)
        if found is None:
            found = self.old.get(run)
            if found is not None:
                self.keep(run, found)
        return found

    def keep(self, run: str, ids: bytes) -> None:
        """Remember a run in the young generation; a full one becomes the old
        one, so a run that comes again within two generations stays."""
        if len(run) > 64:
            return
        if len(self.young) >= TABLE_WORDS:
            self.old, self.young = self.young, {}
        self.young[run] = ids

    def entry(self, chunk: str) -> bytes:
        """Ids (as bytes) of a run without white space."""
        found = self.lookup(chunk)
        if found is not None:
            return found
        if chunk.isalpha():
            found = array("i", self.word(chunk)).tobytes()
        else:
            found = b""
            for w in _WORD.findall(chunk):
                ids = self.lookup(w)
                if ids is None:
                    ids = array("i", self.word(w)).tobytes()
                    self.keep(w, ids)
                found += ids
        self.keep(chunk, found)
        return found

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text."""
        out: list[bytes] = []
        for special, piece in self.pieces(text):
            if special:
                out.append(array("i", [self.special[piece]]).tobytes())
                continue
            chunks = self.chunks(piece)
            found = list(map(self.young.get, chunks))
            if None in found:
                found = [self.entry(c) if f is None else f for c, f in zip(chunks, found, strict=True)]
            out += found
        return np.frombuffer(b"".join(out), np.int32)


class Decoder:
    """State machine: ``feed`` takes one id and returns the text it settles,
    ``feed_all`` does so for a stretch of ids, ``end`` gives what is left. State: whether anything was written, and at most
    one unfinished character."""

    def __init__(self, encoder: Encoder, form: str = "joined"):
        self.strings, self.suffix, self.form = encoder.strings, encoder.suffix, form
        self.special, self.byte = encoder.special_ids, encoder.byte
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")
        self.begun = False

    def feed(self, token: int) -> str:
        s = self.strings[token]
        if self.form == "joined":
            begun, self.begun = self.begun, True
            return f" {s}" if begun else s
        if token in self.special:
            return self.utf8.decode(b"", True) + s
        word = s.removesuffix(self.suffix)
        out = self.utf8.decode(bytes(self.byte[c] for c in word))
        return out + (self.utf8.decode(b"", True) + " " if len(word) < len(s) else "")

    def feed_all(self, tokens: list[int]) -> str:
        if self.form != "joined" or not tokens:
            return "".join(map(self.feed, tokens))
        begun, self.begun = self.begun, True
        out = " ".join(map(self.strings.__getitem__, tokens))
        return f" {out}" if begun else out

    def end(self) -> str:
        return self.utf8.decode(b"", True) if self.form == "text" else ""


def decode(ids: Iterable[int], encoder: Encoder, form: str = "joined") -> str:
    """All of ``ids`` through one machine, ``STRETCH`` at a time."""
    machine, ids = Decoder(encoder, form), iter(ids)
    out = []
    while stretch := list(islice(ids, STRETCH)):
        out.append(machine.feed_all(stretch))
    return "".join(out) + machine.end()


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One per worker process and vocabulary."""
    return Encoder(path)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``ids`` (array of int) and
    ``decoded``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for part in slices(batch, "text"):
                done = [enc.encode(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        lists(np.concatenate(done), np.array([len(ids) for ids in done]), pa.int32()),
                        pa.array([decode(ids.tolist(), enc) for ids in done], pa.string()),
                    ],
                    ["doc_id", "ids", "decoded"],
                )

    return keyed(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")
