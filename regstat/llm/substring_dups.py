"""Suffix-array dedup (1): bytes covered by a ``LENGTH``-byte string that also
starts earlier in the corpus are removed.

*Meeting places.* Every string of ``LENGTH`` bytes picks the last of the
``GRAM``-byte grams in it with the least hash. Equal strings pick the same
gram at the same place, so they meet in that gram's group. Consecutive
strings of a document that pick the same gram form one segment of at most
``2 * LENGTH - GRAM - 1`` bytes. Of equal segments all but the first are
removed as a whole. Only first segments that share a gram with a different
one are compared byte by byte.

*Suffix array.* The segments of a group are one text, whose suffix array is
built by linear grouping: suffixes are grouped by their first byte; from the
highest group down, each group's suffixes find their previous smaller suffix
by pointers, and those it is the next smaller one of move to a group whose
common prefix (their Lyndon prefix in the end) is longer. A last pass over
the suffixes in order drops each suffix whose next smaller one was just
placed into its group's next free place; nothing is renamed. Neighbours that
agree in their first ``LENGTH`` bytes are equal strings.

*Hot strings.* A task that reads texts keeps only the first of equal segments; all
others are removed there and then, so a passage in very many documents is one
record a task. Where more than ``HOT`` different segments share a gram (a common line
with other text around it), their strings meet by their hashes in a partial
minimum instead of a suffix array in one task.

Defined results: null and empty texts, and texts under ``LENGTH`` bytes,
lose nothing; a copy of a whole text loses all of it. Rows that repeat an id are
documents of their own, one after the other, so the first of repeated rows keeps
what is new in it; rows without an id come before all others. An
empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regstat.llm import common as c
from regstat.llm import merkle

LENGTH = 100
GRAM = 40
SPAN = LENGTH - GRAM + 1  # grams in a string
#: Anchors that a task holds before it deals them out.
HELD = 1 << 18
#: Bytes of text whose grams a task holds at a time.
GRAM_BYTES = 1 << 18
#: Different segments of one gram that one task compares by a suffix array.
HOT = 4096
#: Kinds of records: removed segments; first segments that share a gram with
#: another one; the same where there are more than ``HOT``; not yet met.
GONE, SHARED, CROWDED, UNMET = range(4)

_CODES = c.byte_codes(1)
_CODES2 = c.byte_codes(11)
ANCHOR = np.dtype([("gram", "<u8"), ("key", "<u8"), ("doc", "<i8"), ("at", "<i4"), ("n", "<i2")])


def sliding(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over each run of ``width`` values, by doubling."""
    have = 1
    while 2 * have <= width:
        x = pick(x[:-have], x[have:])
        have *= 2
    if have < width:
        x = pick(x[: len(x) - (width - have)], x[width - have :])
    return x


def anchors(block: c.Block) -> np.ndarray:
    """The segments of a block, as ``ANCHOR`` records: gram, key of the
    segment's bytes, document, first string start, number of strings."""
    n = len(block.buf)
    if n < LENGTH:
        return np.zeros(0, ANCHOR)
    spans = c.SpanHash(block.buf, _CODES)
    at = np.arange(n - GRAM + 1)
    gram = spans(at, at + GRAM)
    least = sliding(gram, SPAN, np.minimum)  # of the string starting at each place
    starts = np.arange(len(least))
    last = starts + SPAN - 1
    chosen = np.where(gram[last] == least, last, 0)
    left = np.zeros(len(least), bool)  # the least gram so far has just left the string
    left[0] = True
    left[1:] = least[1:] > least[:-1]
    lost = np.flatnonzero(left & (chosen == 0))
    for lo in range(0, len(lost), 1 << 14):
        s = lost[lo : lo + (1 << 14)]
        window = gram[s[:, None] + np.arange(SPAN)[None, :]] == least[s][:, None]
        chosen[s] = s + SPAN - 1 - np.argmax(window[:, ::-1], axis=1)
    chosen = np.maximum.accumulate(chosen)
    row = block.rows_of(starts)
    inside = starts + LENGTH <= block.at[row + 1]
    cut = np.ones(len(starts), bool)
    cut[1:] = (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(cut)
    size = np.diff(np.append(first, len(starts)))
    keep = inside[first]
    first, size = first[keep], size[keep]
    end = first + size - 1 + LENGTH
    out = np.zeros(len(first), ANCHOR)
    out["gram"], out["key"] = gram[chosen[first]], c.SpanHash(block.buf, _CODES2)(first, end)
    out["doc"], out["at"], out["n"] = block.ids[row[first]], first - block.at[row[first]], size
    return out


def ordered(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segments by gram, key and place, and which are the first of equal ones."""
    found = found[np.lexsort((found["at"], found["doc"], found["key"], found["gram"]))]
    first = np.ones(len(found), bool)
    first[1:] = (found["key"][1:] != found["key"][:-1]) | (found["gram"][1:] != found["gram"][:-1])
    return found, first


def packed(found: np.ndarray, kind: int, part: np.ndarray) -> pa.RecordBatch:
    """Records by the part that each goes to, many to a row."""
    order = np.argsort(part, kind="stable")
    found, part = found[order], part[order]
    edges = np.flatnonzero(np.diff(part, prepend=-1))
    data = [found[a:b].tobytes() for a, b in zip(edges, np.append(edges, len(found))[1:], strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(part[edges], pa.int32()), pa.array(np.full(len(edges), kind), pa.int32()), pa.array(data, pa.binary())],
        ["part", "kind", "data"],
    )


_PACKED = "part int, kind int, data binary"


def part_of(values: np.ndarray, parts: int) -> np.ndarray:
    return (c.mix(values.astype(c.U64)) % c.U64(parts)).astype(np.int64)


def dealt(docs: DataFrame, parts: int) -> DataFrame:
    """First segments of each task's texts by their gram, and by their document
    those that an earlier one in the task equals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            every, first = ordered(np.concatenate(held))
            yield packed(every[first], UNMET, part_of(every["gram"][first], parts))
            yield packed(every[~first], GONE, part_of(every["doc"][~first], parts))

        held: list[np.ndarray] = []
        size = 0
        for block in c.blocks(batches, GRAM_BYTES):
            held.append(anchors(block))
            size += len(held[-1])
            if size >= HELD:
                yield from rows(held)
                held, size = [], 0
        if size:
            yield from rows(held)

    return docs.mapInArrow(run, _PACKED).repartition(parts, "part")


def met(rows: DataFrame, parts: int) -> DataFrame:
    """From dealt segments, by their document: those equal to an earlier
    one, and first segments that share a gram with a different one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = []
        for batch in batches:
            unmet = pa.array(batch.column("kind").to_numpy() == UNMET)
            raw += [np.frombuffer(x, ANCHOR) for x in batch.filter(unmet).column("data").to_pylist()]
            yield batch.filter(pa.array(batch.column("kind").to_numpy() != UNMET))  # by document already
        if not raw:
            return
        every = np.concatenate(raw)
        del raw
        every, first = ordered(every)
        yield packed(every[~first], GONE, part_of(every["doc"][~first], parts))
        firsts = every[first]
        heads = np.flatnonzero(np.diff(firsts["gram"], prepend=firsts["gram"][0] + c.U64(1)))
        size = np.diff(np.append(heads, len(firsts)))
        size = np.repeat(size, size)
        for kind, own in ((SHARED, (size > 1) & (size <= HOT)), (CROWDED, size > HOT)):
            yield packed(firsts[own], kind, part_of(firsts["doc"][own], parts))

    return by_document(rows.mapInArrow(run, _PACKED), parts)


def by_document(rows: DataFrame, parts: int) -> DataFrame:
    """``doc_id, kind, data``: one row for each document and kind of record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for kind, x in zip(batch.column("kind").to_pylist(), batch.column("data").to_pylist(), strict=True):
                held.setdefault(kind, []).append(np.frombuffer(x, ANCHOR))
        for kind, found in sorted(held.items()):
            every = np.concatenate(found)
            every = every[np.argsort(every["doc"], kind="stable")]
            edges = np.flatnonzero(np.diff(every["doc"], prepend=every["doc"][0] - 1))
            data = [every[a:b].tobytes() for a, b in zip(edges, np.append(edges, len(every))[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(every["doc"][edges]), pa.array(np.full(len(edges), kind), pa.int32()), pa.array(data, pa.binary())],
                ["doc_id", "kind", "data"],
            )

    return rows.repartition(parts, "part").mapInArrow(run, "doc_id long, kind int, data binary")


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array by linear grouping (see the module's docstring)."""
    n = len(text)
    values = sorted(set(text))
    number = {v: g for g, v in enumerate(values)}
    group = [number[v] for v in text]
    members: list[set[int]] = [set() for _ in values]
    for i, g in enumerate(group):
        members[g].add(i)
    # per group: the next higher and lower one not yet done
    above = [*range(1, len(values)), -1]
    below = list(range(-1, len(values) - 1))
    length = [1] * n
    before = [-1] * n  # previous smaller suffix of a finished one
    done = bytearray(n)
    place = [0] * n
    end, g = n, len(members) - 1
    while g >= 0:
        own = members[g]
        end -= len(own)
        times: dict[int, int] = {}
        for i in sorted(own) if len(own) > 1 else own:
            done[i] = 1
            place[i] = end
            p = i - 1
            while p >= 0 and done[p]:
                p = before[p]
            before[i] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
            step = length[i]
        moved: dict[tuple[int, int], list[int]] = {}
        for p, k in times.items():
            moved.setdefault((group[p], k), []).append(p)
        highest: dict[int, int] = {}  # per group, what last moved out of it
        for h, k in sorted(moved, key=lambda x: x[1]) if len(moved) > 1 else moved:  # more repeats of the prefix: higher
            movers = moved[h, k]
            for p in movers:
                length[p] += k * step
            if len(movers) == len(members[h]) and h not in highest:
                continue  # the whole group: it stays where it is
            new = len(members)
            members.append(set(movers))
            members[h].difference_update(movers)
            for p in movers:
                group[p] = new
            # directly above the rest of h and what fewer repeats moved out of it
            under = highest.get(h, h)
            highest[h] = new
            over = above[under]
            above.append(over)
            below.append(under)
            above[under] = new
            if over != -1:
                below[over] = new
        low = below[g]
        if low >= 0:
            above[low] = -1
        g = low
    order = [-1] * n
    free = list(range(n))  # next free place of the group whose first place this is
    p, k = n, -1
    while True:
        j = p - 1
        while j >= 0 and j + length[j] == p:
            at = place[j]
            order[free[at]] = j
            free[at] += 1
            j = before[j]
        k += 1
        if k == n:
            return order
        p = order[k]


def repeats(segments: list[tuple[int, int, bytes]]) -> list[tuple[int, int]]:
    """(document, start) of the strings of the segments ``(document, start,
    bytes)`` that an earlier one equals."""
    text: list[int] = []
    owner: list[tuple[int, int] | None] = []
    for doc, at, raw in segments:
        text += raw
        owner += [(doc, at + i) for i in range(len(raw) - LENGTH + 1)] + [None] * LENGTH
        text.append(-1)
    joined = b"\0".join(raw for _, _, raw in segments)
    out: list[tuple[int, int]] = []
    run: list[tuple[int, int]] = []
    string = None  # that the suffixes of the run start with
    for i in suffix_array(text):
        if owner[i] is None:  # ends before its string does
            continue
        own = joined[i : i + LENGTH]
        if own != string:
            run.sort()
            out += run[1:]
            run, string = [], own
        run.append(owner[i])
    run.sort()
    return out + run[1:]


def segments(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``gram, doc_id, at, raw`` of the wanted segments, from the texts."""
    both = docs.join(wanted.select(F.col("doc_id").alias("__id"), "data"), F.col("doc_id") == F.col("__id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                gram, doc, at, raw = [], [], [], []
                for r in batch.slice(lo, 200).to_pylist():
                    text = r["text"].encode()
                    for a in np.frombuffer(r["data"], ANCHOR):
                        gram.append(int(a["gram"].view(np.int64)))
                        doc.append(r["doc_id"])
                        at.append(int(a["at"]))
                        raw.append(text[a["at"] : int(a["at"]) + int(a["n"]) - 1 + LENGTH])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram, pa.int64()), pa.array(doc, pa.int64()), pa.array(at, pa.int32()), pa.array(raw, pa.binary())],
                    ["gram", "doc_id", "at", "raw"],
                )

    return both.select("doc_id", "text", "data").mapInArrow(run, "gram long, doc_id long, at int, raw binary")


def singles(doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Strings as segments of one string each."""
    out = np.zeros(len(doc), ANCHOR)
    out["doc"], out["at"], out["n"] = doc, at, 1
    return out


def compared(rows: DataFrame, parts: int) -> DataFrame:
    """Repeated strings among segments that share a gram, one suffix array
    per group of at most ``HOT``, by their document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(found: list[tuple[int, int]]) -> pa.RecordBatch:
            out = singles(*np.array(found, np.int64).reshape(-1, 2).T)
            return packed(out, GONE, part_of(out["doc"], parts))

        gram, group, found = None, [], []
        for batch in batches:
            for g, d, a, raw in zip(*[batch.column(k).to_pylist() for k in ("gram", "doc_id", "at", "raw")], strict=True):
                if g != gram:
                    found += repeats(group) if len(group) > 1 else []
                    gram, group = g, []
                    if len(found) > 100_000:
                        yield result(found)
                        found = []
                group.append((d, a, raw))
        found += repeats(group) if len(group) > 1 else []
        yield result(found)

    in_order = rows.repartition("gram").sortWithinPartitions("gram", "doc_id", "at")
    return by_document(in_order.mapInArrow(run, _PACKED), parts)


def crowded(rows: DataFrame, parts: int) -> DataFrame:
    """Repeated strings among the segments of hot grams: each string by two
    hashes, the first place of each by a partial minimum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                raw = part.column("raw").to_pylist()
                sizes = np.array([len(x) for x in raw], np.int64)
                buf, ends = np.frombuffer(b"".join(raw), np.uint8), np.cumsum(sizes)
                own = np.repeat(np.arange(len(raw)), sizes - LENGTH + 1)
                n = sizes - LENGTH + 1
                inside = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
                start = (ends - sizes)[own] + inside
                h1, h2 = (c.SpanHash(buf, codes)(start, start + LENGTH).view(np.int64) for codes in (_CODES, _CODES2))
                doc, at = (part.column(k).to_numpy().astype(np.int64) for k in ("doc_id", "at"))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h1, h2, doc[own], at[own] + inside)], ["h1", "h2", "doc_id", "at"])

    strings = c.written(rows.mapInArrow(run, "h1 long, h2 long, doc_id long, at long"), "strings")
    least = strings.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "at")).alias("least"), F.count("*").alias("n")).where("n > 1")
    later = strings.join(least, ["h1", "h2"]).where("struct(doc_id, at) <> least").select("doc_id", "at")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = singles(*[batch.column(k).to_numpy() for k in ("doc_id", "at")])
            yield packed(out, GONE, part_of(out["doc"], parts))

    return by_document(later.mapInArrow(pack, _PACKED), parts)


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text, own_id``: ``own_id`` is the id, and ``doc_id`` a number of each
    row's own in the order of the ids: the id itself unless some id is null or
    repeats, and otherwise the place among all rows (then written once)."""
    known = c.keyed(docs, id_col, text_col)
    repeated = known.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null")
    if repeated.isEmpty():
        return known.withColumn("own_id", F.col("doc_id"))
    rows = c.written(known.withColumn("__row", F.monotonically_increasing_id()), "rows")
    places = merkle.numbered(rows.select("__row", "doc_id", F.lit("").alias("grp")), "grp", ["doc_id", "__row"])
    places = places.select("__row", F.col("pos").alias("place"))
    return c.written(rows.join(places, "__row").select(F.col("place").alias("doc_id"), "text", F.col("doc_id").alias("own_id")), "numbered")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, spans`` (maximal removed byte
    runs, end exclusive) and ``kept`` (the remaining bytes)."""
    known = numbered(docs, id_col, text_col)
    texts = known.select("doc_id", "text")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = c.written(met(dealt(texts, parts), parts), "segments")
    more = c.written(compared(segments(texts, first.where(f"kind = {SHARED}")), parts), "repeats")
    found = first.where(f"kind = {GONE}").unionByName(more)
    hot = first.where(f"kind = {CROWDED}")
    if not hot.isEmpty():
        found = found.unionByName(c.written(crowded(segments(texts, hot), parts), "crowded"))
    gone = found.groupBy(F.col("doc_id").alias("__id")).agg(F.collect_list("data").alias("data"))  # at most three rows a document
    both = known.join(gone, F.col("doc_id") == F.col("__id"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                sizes, spans, kept = [], [], []
                for text, data in zip(part.column("text").to_pylist(), part.column("data").to_pylist(), strict=True):
                    raw = np.frombuffer(text.encode(), np.uint8)
                    edge = np.zeros(len(raw) + 1, np.int64)
                    for x in data or []:
                        a = np.frombuffer(x, ANCHOR)
                        at = a["at"].astype(np.int64)
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + a["n"] - 1 + LENGTH, -1)
                    out = np.cumsum(edge)[:-1] > 0
                    step = np.diff(out.astype(np.int8), prepend=0, append=0)
                    sizes.append(len(raw))
                    spans.append([{"start": s, "end": e} for s, e in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True)])
                    kept.append(raw[~out].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("own_id"), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(_SPAN)), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "spans", "kept"],
                )

    schema = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    return both.select("own_id", "text", "data").mapInArrow(run, schema)


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


