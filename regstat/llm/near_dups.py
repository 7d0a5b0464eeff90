"""MinHash near-dedup (2): a chosen-path set similarity join.

A document is the set of its 5-word shingles. Documents with equal sets are
one class; only classes are joined.

*Trees.* Each of ``TREES`` independent trees branches every document into one
child per selected minwise token: two of the ``MINS`` minimum hashes per tree
and level, so two documents of similarity s share each child with probability
s. A node of at most ``LEAF`` documents is a leaf, and its documents are all
compared; a larger node branches again, up to ``LEVELS`` levels, unless its
members are nearly all alike. With similarity 0.75 a tree loses a pair with probability at most 0.112 at any
depth, so six trees lose at most 2e-6 of the pairs (6e-8 of those that meet
in leaves of the first level).

*Comparison* in a leaf uses the minimum hashes that the rows carry: pairs
that agree in fewer than ``AGREE`` of ``MINS`` are dropped (a pair of
similarity 0.75 is, with probability 5e-6). The rest are confirmed on the full
sets. First the pairs of a forest that spans each leaf's similar pairs; once
these are confirmed, only pairs that still lie in different components.

*Nodes that stay large* (thousands of near copies) are tied to their
medoid instead, along with the forests: the member nearest to what most
members agree on, the text that the others were copied from, if it is there.
At the end each document outside a node's largest component is compared with
the members of all other components, on the full sets. So no pair is lost, and a group of near copies costs about as
many comparisons as it has members.

Words are runs of bytes other than 0x20 and 0x09-0x0D after lower-casing A-Z;
a text with fewer than five words is one shingle. Defined results: a null or
empty text has an empty set, is linked with nothing and is its own component;
rows that repeat an id are one node, linked with whatever one of its texts is
linked with; rows without an id are linked with none, and take the smallest id
of the documents with an equal set; equal sets are linked (similarity 1); an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regstat.llm import common as c
from regstat.llm.components import components, extended

SHINGLE = 5
#: Pairs with PER_CENT * union <= 100 * intersection are linked.
PER_CENT = 75
TREES = 6
LEVELS = 3
MINS = 2 * TREES * LEVELS
AGREE = 16
LEAF = 64
#: Members of a large node that one task compares with those outside.
SLICE = 512
#: Rounds in which the members of large nodes are tied to a medoid.
MEDOID_ROUNDS = 2
#: Members of a large node, about, that choose its pivot.
VOTERS = 24

_CODES = c.byte_codes(2)
_MULTIPLY = c.mix(np.arange(1, MINS + 1, dtype=c.U64)) | c.U64(1)


def shingle_sets(block: c.Block, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    low = c.Block(block.ids, c.lower_ascii(block.buf), block.at)
    start, end, row = c.word_spans(low)
    word = c.SpanHash(low.buf, _CODES)(start, end)
    n = c.counts_by_row(row, len(block.ids))
    at = np.concatenate([[0], np.cumsum(n)])
    whole = word.copy() if len(word) else word
    run = np.zeros(len(word), c.U64)
    for k in range(size):  # hash of up to `size` words from each place on
        moved = np.zeros_like(run)
        moved[: len(word) - k] = whole[k:]
        run = run * c.BASE + moved
    run = c.mix(run)
    out = []
    for r in range(len(block.ids)):
        a, b = at[r], at[r + 1]
        if b - a >= size:
            out.append(np.unique(run[a : b - size + 1]))
        elif b > a:
            h = c.U64(b - a)
            with np.errstate(over="ignore"):
                for w in word[a:b]:
                    h = h * c.BASE + w
            out.append(c.mix(np.array([h], c.U64)))
        else:
            out.append(np.zeros(0, c.U64))
    return out


def keys_of(values: np.ndarray) -> tuple[int, int]:
    """A 128-bit key of a set, as two signed numbers."""
    k = np.array([c.mix(values).sum(dtype=c.U64), np.bitwise_xor.reduce(c.mix(values * c.BASE))], c.U64).view(np.int64)
    return int(k[0]), int(k[1])


def minimums(values: np.ndarray) -> np.ndarray:
    """The ``MINS`` minimum hashes of a set, 32 bits each."""
    if len(values) > 1 << 16:  # a very long text, in parts
        return np.min([minimums(v) for v in np.array_split(values, -(-len(values) >> 16) + 1) if len(v)], axis=0)
    return ((values[None, :] * _MULTIPLY[:, None]).min(axis=1) >> c.U64(32)).astype(np.uint32)


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, k1, k2`` (a 128-bit key of the set) and the
    minimum hashes, ``mins`` (of the first level) and ``sketch`` (one byte of
    each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in c.blocks(batches):
            sets = shingle_sets(block)
            n = np.array([len(s) for s in sets], np.int64)
            k1, k2 = np.array([keys_of(s) for s in sets], np.int64).reshape(-1, 2).T
            mins = np.array([minimums(s) if len(s) else np.zeros(MINS, np.uint32) for s in sets], np.uint32)
            first = mins[:, : 2 * TREES].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block.ids, pa.int64()),
                    pa.array(n),
                    pa.array(k1),
                    pa.array(k2),
                    c.lists(first.ravel(), np.full(len(sets), 2 * TREES), pa.int64()),
                    pa.array([m.tobytes() for m in mins.astype(np.uint8)], pa.binary()),
                ],
                ["doc_id", "n_shingles", "k1", "k2", "mins", "sketch"],
            )

    return docs.mapInArrow(
        run, "doc_id long, n_shingles long, k1 long, k2 long, mins array<long>, sketch binary"
    )


def forest(agree: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j) of a leaf in a forest that spans those that agree often
    enough, by the best-agreeing ones."""
    i, j = np.nonzero(np.triu(agree >= AGREE, 1))
    order = np.argsort(-agree[i, j], kind="stable")
    root = list(range(len(agree)))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for n, a, b in zip(order.tolist(), i[order].tolist(), j[order].tolist(), strict=True):
        ra, rb = top(a), top(b)
        if ra != rb:
            root[ra] = rb
            kept.append(n)
    return i[kept], j[kept]


def leaf_pairs(rows: DataFrame, every: bool = True) -> DataFrame:
    """Similar pairs ``a, b`` (a < b) in leaves between different components:
    ``every`` one, or a forest that spans them. ``rows`` have ``node, rep,
    sketch, comp``; a leaf has at most ``LEAF`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compared(nodes: np.ndarray, reps: np.ndarray, comps: np.ndarray, sketch: np.ndarray) -> pa.RecordBatch:
            out: list[list[np.ndarray]] = [[], []]
            cuts = np.flatnonzero(np.diff(nodes)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(nodes)], strict=True):
                if hi - lo < 2:
                    continue
                s, comp = sketch[lo:hi], comps[lo:hi]
                agree = (s[:, None, :] == s[None, :, :]).sum(axis=2)
                agree = np.where(comp[:, None] == comp[None, :], 0, agree)
                i, j = np.nonzero(np.triu(agree >= AGREE, 1)) if every else forest(agree)
                a, b = reps[lo:hi][i], reps[lo:hi][j]
                out[0].append(np.minimum(a, b))
                out[1].append(np.maximum(a, b))
            a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        kept: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [
                batch.column("node").to_numpy(),
                batch.column("rep").to_numpy(),
                batch.column("comp").to_numpy(),
                np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(-1, MINS),
            ]
            if kept is not None:
                now = [np.concatenate(x) for x in zip(kept, now, strict=True)]
            last = int(np.searchsorted(now[0], now[0][-1], side="left"))  # this node may go on
            yield compared(*[x[:last] for x in now])
            kept = [x[last:] for x in now]
        if kept is not None:
            yield compared(*kept)

    dealt = rows.select("node", "rep", "comp", "sketch").repartition("node").sortWithinPartitions("node", "rep")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def alike_nodes(large: DataFrame) -> DataFrame:
    """``node``: the large nodes whose members, but for at most ``LEAF`` and at most a
    quarter, are like what most of them agree on. Branching doesn't part such
    a group of near copies, and its few other members cost the exact rest little."""
    near = F.expr(agreement("sketch", "usual"))
    unlike = F.count_if(near < AGREE).alias("unlike")
    read = large.select("node", "rep", "sketch").join(usual_values(large), "node")
    told = read.groupBy("node").agg(unlike, F.count("*").alias("members"))
    return told.where(f"unlike <= {LEAF} and 4 * unlike <= members").select("node")


def trees(reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leaf rows, rows of nodes that stayed large), both ``node, rep,
    sketch``, the latter with ``among``, the number of members of their node.
    ``reps`` has ``rep, mins, sketch``. On the first level most nodes hold one
    document; the sketch is fetched only for the others. Only nodes whose
    members differ branch again."""
    rows = reps.select("rep", F.posexplode("mins").alias("at", "value")).select(
        F.xxhash64("at", "value").alias("node"), F.expr("cast(at div 2 as int)").alias("tree"), "rep"
    )
    leaves: DataFrame | None = None
    dense: DataFrame | None = None
    for level in range(1, LEVELS + 1):
        sizes = rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
        sized = rows.join(sizes, "node")
        if level == 1:
            sized = sized.join(reps.select("rep", "sketch"), "rep")
        sized = c.written(sized, f"tree{level}")
        small = sized.where(F.col("n") <= LEAF).select("node", "rep", "sketch")
        leaves = small if leaves is None else leaves.unionByName(small)
        large = sized.where(F.col("n") > LEAF).withColumnRenamed("n", "among")
        stay = large
        if level < LEVELS:
            alike = c.written(alike_nodes(large), f"alike{level}")
            stay, large = large.join(alike, "node", "left_semi"), large.join(alike, "node", "left_anti")
        stay = c.written(stay.select("node", "rep", "sketch", "among"), "dense")  # read several times
        dense = stay if dense is None else dense.unionByName(stay)
        if level == LEVELS:
            return leaves, dense
        at = F.expr(f"{2 * TREES * level} + 2 * tree + side")
        rows = large.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1)))).select(
            F.xxhash64("node", "side", F.substring("sketch", at + 1, F.lit(1))).alias("node"),
            "tree",
            "rep",
            "sketch",
        )
    raise AssertionError


def full_sets(texts: DataFrame) -> DataFrame:
    """``doc_id, items``: the whole shingle sets, 8 bytes a shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in c.blocks(batches):
            items = [s.tobytes() for s in shingle_sets(block)]
            yield pa.RecordBatch.from_arrays([pa.array(block.ids, pa.int64()), pa.array(items, pa.binary())], ["doc_id", "items"])

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id long, items binary")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("items").alias("y"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), c.U64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= PER_CENT * (len(x) + len(y) - both) > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def in_components(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with ``comp``, the component of ``rep`` so far."""
    known = found.select(F.col("node").alias("__rep"), "component")
    joined = rows.join(known, F.col("rep") == F.col("__rep"), "left")
    return joined.withColumn("comp", F.coalesce("component", "rep")).drop("__rep", "component")


def mixed(rows: DataFrame) -> DataFrame:
    """The rows of nodes whose members lie in more than one component, with
    ``main``, the largest of these, ``size``, the number of members, and
    ``among``, that of those outside ``main`` and one of it."""
    sizes = rows.groupBy("node", "comp").agg(F.count("*").alias("m"))
    main = sizes.groupBy("node").agg(F.max(F.struct("m", "comp")).alias("top"), F.count("*").alias("parts"), F.sum("m").alias("size"))
    main = main.where("parts > 1").select("node", "top.comp", "size", F.expr("size - top.m + 1").alias("among"))
    return rows.drop("among").join(main.withColumnRenamed("comp", "main"), "node")


def agreement(x: str, y: str) -> str:
    """SQL for the number of minimum hashes in which two sketches agree."""
    return f"aggregate(sequence(1, {MINS}), 0, (n, i) -> n + int(substring({x}, i, 1) = substring({y}, i, 1)))"


def usual_values(among: DataFrame) -> DataFrame:
    """``node, usual``: the value that most of about ``VOTERS`` members of each node
    (those whose hash falls into one of their number ``among`` over ``VOTERS``
    shares) have in each place of the sketch. Only a pivot is chosen by it: which
    members vote decides how many pairs a round settles, not which are found in the end."""
    votes = among.where(f"pmod(xxhash64(rep, node), cast(ceil(among / {VOTERS}) as bigint)) = 0")
    votes = votes.groupBy("node").agg(F.collect_list("sketch").alias("votes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            usual = []
            for own in batch.column("votes").to_pylist():
                values = np.frombuffer(b"".join(own), np.uint8).reshape(-1, MINS)
                usual.append(bytes(int(np.bincount(column).argmax()) for column in values.T))
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(usual, pa.binary())], ["node", "usual"])

    return votes.mapInArrow(run, "node long, usual binary")


def medoid_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of each member of a large node with the medoid of its node, where
    they agree often enough and lie in different components; a pair may come
    from several nodes. The medoid is taken among members outside the main
    component, if there are any."""
    among = rows.where("comp <> main or comp = rep").select("node", "rep", "comp", "sketch", "among")
    near = F.expr(agreement("sketch", "usual"))
    medoid = (
        among.join(usual_values(among), "node")
        .groupBy("node")
        .agg(F.max(F.struct(near.alias("n"), "rep", "comp", "sketch")).alias("p"))
    )
    pairs = rows.join(medoid, "node").where(
        F.expr(f"comp <> p.comp and {agreement('sketch', 'p.sketch')} >= {AGREE}")
    )
    return pairs.select(F.least("rep", "p.rep").alias("a"), F.greatest("rep", "p.rep").alias("b"))


class Members:
    """Full sets of a slice of members, as postings by shingle."""

    def __init__(self, reps: np.ndarray, comps: np.ndarray, sets: list[np.ndarray]):
        self.reps, self.comps = reps, comps
        self.sizes = np.array([len(s) for s in sets], np.int64)
        values = np.concatenate(sets)
        order = np.argsort(values, kind="stable")
        self.values, self.owner = values[order], np.repeat(np.arange(len(sets)), self.sizes)[order]

    def linked(self, comp: int, own: np.ndarray) -> np.ndarray:
        """One member of each other component that the set ``own`` is linked
        with."""
        both = np.zeros(len(self.reps), np.int64)
        for at in range(0, len(own), 4096):
            first = np.searchsorted(self.values, own[at : at + 4096], side="left")
            n = np.searchsorted(self.values, own[at : at + 4096], side="right") - first
            places = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
            both += np.bincount(self.owner[places], minlength=len(both))
        near = (both > 0) & (100 * both >= PER_CENT * (len(own) + self.sizes - both)) & (self.comps != comp)
        _, one = np.unique(self.comps[near], return_index=True)
        return self.reps[near][one]


def rest_pairs(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """What the medoids left open: in each large node, the members outside
    its main component against the members of all other components, on full
    sets. A node is cut into slices of about ``SLICE`` members, one task's work
    each; the rows outside go to every slice of their node. Only links come
    out, one for each row outside, slice and component of each node; they need
    no other confirmation."""
    slices = f"cast(ceil(size / {SLICE}) as int)"
    full = sets.select(F.col("doc_id").alias("rep"), "items")
    known = rows.select("node", "rep", "comp", "main", "size").join(full, "rep")
    members = known.withColumn("slice", F.expr(f"cast(pmod(xxhash64(rep), {slices}) as int)")).withColumn("side", F.lit(0))
    outside = known.where("comp <> main").withColumn("slice", F.expr(f"explode(sequence(0, {slices} - 1))"))
    every = members.unionByName(outside.withColumn("side", F.lit(1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, members = None, [], None
        for batch in batches:
            node, part, side, rep, comp = (batch.column(k).to_numpy() for k in ("node", "slice", "side", "rep", "comp"))
            a, b = [], []
            for i, raw in enumerate(batch.column("items").to_pylist()):
                if (node[i], part[i]) != key:
                    key, held, members = (node[i], part[i]), [], None
                own = np.frombuffer(raw, c.U64)
                if side[i] == 0:
                    held.append((rep[i], comp[i], own))
                elif held:  # some member fell into this slice
                    if members is None:
                        reps, comps, own_sets = zip(*held, strict=True)
                        members = Members(np.array(reps), np.array(comps), list(own_sets))
                    found = members.linked(comp[i], own)
                    a.append(np.minimum(found, rep[i]))
                    b.append(np.maximum(found, rep[i]))
            a, b = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (a, b))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    dealt = every.select("node", "slice", "side", "rep", "comp", "items").repartition("node", "slice")
    return dealt.sortWithinPartitions("node", "slice", "side").mapInArrow(run, "a long, b long")


def linked(leaves: DataFrame, dense: DataFrame, pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``node, component`` of all similar pairs: first the forests' ``pairs``
    and the medoids of large nodes, then, in nodes whose members still lie in
    different components, medoids again, and last all that is open. The links
    of a round only extend the components found before."""

    def still_open(rows: DataFrame) -> DataFrame:
        return c.written(mixed(in_components(rows, found)), "open")

    def more(links: DataFrame) -> DataFrame:
        links = c.written(links, "links")
        return found if links.isEmpty() else extended(found, links)

    large = not dense.isEmpty()
    if large:
        alone = dense.select("*", F.col("rep").alias("comp"), F.col("rep").alias("main"))
        pairs = pairs.select("a", "b").unionByName(medoid_pairs(alone)).distinct()
    found = components(c.written(confirmed(pairs, sets), "links"))
    for _ in range(MEDOID_ROUNDS - 1 if large else 0):
        found = more(confirmed(medoid_pairs(still_open(dense)).distinct(), sets))
    links = confirmed(leaf_pairs(still_open(leaves)), sets)
    if large:
        links = links.unionByName(rest_pairs(still_open(dense), sets))
    return more(links)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``."""
    known = c.keyed(docs, id_col, text_col)
    marks = c.written(sketches(known), "sketches")
    filled = marks.where("n_shingles > 0")
    least = F.min(F.struct(F.col("doc_id").alias("rep"), "mins", "sketch")).alias("least")
    reps = filled.where("doc_id is not null").groupBy("k1", "k2").agg(least).select("k1", "k2", "least.*")
    reps = c.written(reps, "reps")
    leaves, dense = trees(reps)
    pairs = c.written(leaf_pairs(leaves.withColumn("comp", F.col("rep")), every=False), "pairs")

    # ids that stand in several rows, and whether with different sets
    unlike = F.expr("min(k1) <> max(k1) or min(k2) <> max(k2)").alias("unlike")
    repeated = filled.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows"), unlike).where("rows > 1")
    repeated = c.written(repeated, "repeated")

    live = pairs.select(F.explode(F.array("a", "b")).alias("rep")).unionByName(dense.select("rep")).distinct()
    # ids alone, of a size known to the plan: a small table is broadcast, and no text is shuffled
    live = c.written(live, "live")
    classes = reps.select("k1", "k2", "rep")
    sets = keyed_sets(known.join(live, F.col("doc_id") == F.col("rep"), "left_semi"))
    if not repeated.isEmpty():
        # once each, and of an id with several texts only those that it represents
        own = classes.withColumnRenamed("rep", "doc_id")
        sets = c.written(sets, "texts").join(own, ["doc_id", "k1", "k2"], "left_semi").distinct()
    found = linked(leaves, dense, pairs, c.written(sets.select("doc_id", "items"), "sets"))
    if not repeated.where("unlike").isEmpty():
        several = filled.join(repeated.where("unlike").select("doc_id"), "doc_id").join(classes, ["k1", "k2"])
        first = several.groupBy("doc_id").agg(F.min("rep").alias("a"))
        links = several.join(first, "doc_id").select("a", F.col("rep").alias("b")).where("a <> b").distinct()
        found = extended(found, c.written(links, "links"))
    found = found.select(F.col("node").alias("rep"), "component")
    out = marks.join(classes, ["k1", "k2"], "left").join(found, "rep", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "rep")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))


def keyed_sets(texts: DataFrame) -> DataFrame:
    """``doc_id, k1, k2, items``: the full sets with their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in c.blocks(batches):
            sets = shingle_sets(block)
            k1, k2 = np.array([keys_of(s) for s in sets], np.int64).reshape(-1, 2).T
            columns = [pa.array(block.ids, pa.int64()), pa.array(k1), pa.array(k2), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "k1", "k2", "items"])

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id long, k1 long, k2 long, items binary")
