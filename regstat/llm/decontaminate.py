"""Benchmark decontamination (7): a distributed positional inverted index.

Only DataFrame operations are used. The index stores a posting
``(term, doc_id, pos)`` for every training word that any test item uses. For
each test window the rarest terms in the training text are looked up: their
posting lists, each moved back by the term's offset in the window, meet at
the places where the window can start. A place that all of them name is then
checked word by word, so matches are exact.

Words are runs of bytes other than 0x00-0x2F, 0x3A-0x60 and 0x7B-0x7F after
lower-casing A-Z. A window is ``size`` consecutive words of an item; an item
with fewer words is one window.

Defined results: a null or empty text has no words, hits nothing and is hit
by nothing; equal windows of different items count for each item; items that
repeat an id are one item; documents that repeat an id, or have none, are
checked one by one; an empty table on either side gives no hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regstat.llm.common import keyed, written

SIZE = 10
#: Rarest terms of a window whose posting lists are intersected.
RAREST = 2
#: Terms up to which the test vocabulary is broadcast; a larger one is joined
#: by a shuffle.
BROADCAST_TERMS = 200_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_CUT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text, in order; none for null."""
    cut = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower()), _CUT)
    return F.filter(cut, lambda w: w != "")


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def windows(items: DataFrame, size: int = SIZE) -> DataFrame:
    """``item_id, window`` (array of words), distinct."""
    n = F.size("words")
    starts = F.expr(f"sequence(1, greatest(1, size(words) - {size - 1}))")
    return (
        items.select("item_id", words(F.col("text")).alias("words"))
        .where(n > 0)
        .select("item_id", "words", F.explode(starts).alias("at"))
        .select("item_id", F.expr(f"slice(words, at, {size})").alias("window"))
        .distinct()
    )


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The index: ``term, doc_id, pos`` (from 0) of all words among ``terms``."""
    every = docs.select("doc_id", F.posexplode(words(F.col("text"))).alias("pos", "term"))
    return every.join(sized(terms, BROADCAST_TERMS), "term").select("term", "doc_id", "pos")


def rarest_terms(wins: DataFrame, index: DataFrame, rarest: int = RAREST) -> DataFrame:
    """``wid, term, off, k, n_terms``: the ``rarest`` places of each window by
    training frequency. A window with a term that no document has is dropped."""
    counts = index.groupBy("term").agg(F.count("*").alias("freq"))
    places = wins.select("wid", F.size("window").alias("n"), F.posexplode("window").alias("off", "term"))
    found = places.join(counts, "term")
    by_window = Window.partitionBy("wid")
    return (
        found.withColumn("known", F.count("*").over(by_window))
        .withColumn("k", F.row_number().over(by_window.orderBy("freq", "off")))
        .where((F.col("known") == F.col("n")) & (F.col("k") <= rarest))
        .select("wid", "term", "off", "k", F.least(F.col("n"), F.lit(rarest)).alias("n_terms"))
    )


def candidates(index: DataFrame, rare: DataFrame, rarest: int = RAREST) -> DataFrame:
    """``wid, doc_id, start`` where the lists of all the rarest terms meet,
    from the rarest list on."""
    start = (F.col("pos") - F.col("off")).alias("start")

    def moved(k: int) -> DataFrame:
        term = rare.where(F.col("k") == k)
        return index.join(term, "term").select("wid", "doc_id", start, "n_terms").where("start >= 0")

    met = moved(1)
    for k in range(2, rarest + 1):
        more = moved(k).drop("n_terms")
        done = met.where(F.col("n_terms") < k)
        met = met.where(F.col("n_terms") >= k).join(more, ["wid", "doc_id", "start"]).unionByName(done)
    return met.select("wid", "doc_id", "start")


def proximity(index: DataFrame, rare: DataFrame, slop: int) -> DataFrame:
    """``wid, doc_id, start``: places where the two rarest terms of a window
    stand as far apart as in the window, give or take ``slop`` words. The
    posting lists meet on (document, cell of ``2 * slop + 1`` places), so a
    common pair of terms is never joined over a whole document."""
    cell = 2 * slop + 1
    start = F.col("pos") - F.col("off")

    def lists(k: int) -> DataFrame:
        return index.join(rare.where(F.col("k") == k), "term").select("wid", "doc_id", start.alias("start"))

    near = F.explode(F.array(*[F.floor(F.col("start") / cell) + d for d in (-1, 0, 1)])).alias("cell")
    first = lists(1).withColumn("cell", F.floor(F.col("start") / cell))
    second = lists(2).select("wid", "doc_id", F.col("start").alias("other"), near)
    return (
        first.join(second, ["wid", "doc_id", "cell"])
        .where(F.abs(F.col("start") - F.col("other")) <= slop)
        .select("wid", "doc_id", "start")
        .distinct()
    )


def matches(docs: DataFrame, items: DataFrame, size: int = SIZE) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, items`` (sorted ids, as
    text, of the items with a window in it)."""
    # Rows of one key share their places, and each place is checked in the row's
    # own words: a text's hash serves as key where there is no id.
    docs = docs.withColumn("key", F.coalesce("doc_id", F.xxhash64("text")))
    found = windows(items, size)
    ids = F.collect_set(F.col("item_id").cast("string")).alias("ids")
    wid = F.xxhash64(F.concat_ws(" ", "window"))
    wins = written(found.groupBy("window").agg(ids).withColumn("wid", wid), "windows")
    terms = wins.select(F.explode("window").alias("term")).distinct()
    index = written(postings(docs.select(F.col("key").alias("doc_id"), "text"), terms), "postings")
    rare = written(rarest_terms(wins, index), "rarest")
    places = candidates(index, sized(rare, BROADCAST_TERMS))
    by_doc = (
        places.join(sized(wins, BROADCAST_TERMS), "wid")
        .groupBy(F.col("doc_id").alias("key"))
        .agg(F.collect_set(F.struct("start", "window", "ids")).alias("places"))
    )
    joined = docs.select("doc_id", "key", words(F.col("text")).alias("words")).join(by_doc, "key", "left")
    exact = F.expr(
        "filter(coalesce(places, array()), p -> slice(words, p.start + 1, size(p.window)) = p.window)"
    )
    covered = F.expr(
        "size(array_distinct(flatten(transform(hits, p -> sequence(p.start, p.start + size(p.window) - 1)))))"
    )
    return joined.select("doc_id", F.size("words").alias("n_words"), exact.alias("hits")).select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        covered.cast("long").alias("n_hit"),
        F.expr("array_sort(array_distinct(flatten(transform(hits, p -> p.ids))))").alias("items"),
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    size: int = SIZE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """:func:`matches` over tables with any column names."""
    test = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    return matches(keyed(docs, id_col, text_col), test, size)
