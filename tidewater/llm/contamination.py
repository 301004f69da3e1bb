"""Benchmark decontamination over a distributed positional inverted index.

The index has a row for every (term, document) with the term's positions. A phrase is
found by taking its terms from the rarest: the rarest term's positions, less its offset in
the phrase, are the candidate starts; the next term's list, adjusted by its own
offset, is intersected with them, and so on.

:func:`contamination` runs this for every window of every benchmark item. How often each
benchmark term occurs in the corpus is counted first (a term that doesn't occur rules its
windows out), postings are stored for the two rarest terms of each window, their
adjusted lists are intersected, and the few places left are compared word by word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import HashBits, alnum_words, map_texts, materialise, signed, small_batches, word_hashes

WINDOW = 13
#: A document is contaminated if at least one word in SHARE is hit.
SHARE = 20
_FLUSH = 200_000


def positions_by_term(h: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    """(term, ascending positions) of every distinct hash in ``h``."""
    order = np.argsort(h, kind="stable")
    terms, first = np.unique(h[order], return_index=True)
    for term, at in zip(signed(terms).tolist(), np.split(order, first[1:]), strict=True):
        yield term, at.tolist()


def _doc_key(doc_id, text: str | None) -> int:
    return xxhash.xxh3_64_intdigest(f"{doc_id}\0{text}".encode()) - (1 << 63)


def forward_index(docs: DataFrame, id_col: str, text_col: str, keep: HashBits | None = None) -> DataFrame:
    """``doc_id, k, n_words, postings``: one row per document; ``k`` is a hash of id and
    text, ``postings`` an array of (term, positions) of the terms that ``keep`` lets through."""
    def make():
        def fn(doc_id, text) -> Iterator[tuple]:
            h = word_hashes(alnum_words(text))
            n = len(h)
            at = np.arange(n) if keep is None else keep.test(h).nonzero()[0]
            postings = [(t, at[p].tolist()) for t, p in positions_by_term(h[at])] if len(at) else []
            yield doc_id, _doc_key(doc_id, text), n, postings
        return fn

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, [id_col], text_col,
                     f"{id_col} {kind}, k long, n_words long, postings array<struct<term:long,positions:array<int>>>", make)


def inverted(forward: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The index proper: ``doc_id, k, term, positions``."""
    return forward.select(id_col, "k", F.explode("postings").alias("p")).select(id_col, "k", "p.term", "p.positions")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: HashBits | None = None) -> DataFrame:
    """The stored positional index of ``docs``. Null and empty texts have no postings."""
    return inverted(materialise(docs.sparkSession, forward_index(docs, id_col, text_col, keep), "index"), id_col)


def phrase_terms(phrases: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``phrase_id, off, term, n`` of every word of every phrase."""
    def make():
        def fn(phrase_id, text) -> Iterator[tuple]:
            h = signed(word_hashes(alnum_words(text))).tolist()
            for off, term in enumerate(h):
                yield phrase_id, off, term, len(h)
        return fn

    kind = phrases.schema[id_col].dataType.simpleString()
    return map_texts(phrases, [id_col], text_col, f"phrase_id {kind}, off int, term long, n int", make)


def phrase_matches(index: DataFrame, phrases: DataFrame, phrase_id: str = "phrase_id", text_col: str = "text",
                   id_col: str = "doc_id") -> DataFrame:
    """Exact places: ``doc_id, phrase_id, start`` (words from 0), each once.

    ``index`` holds all terms. Phrases without words match nothing; ids of phrases are unique.
    """
    terms = phrase_terms(phrases, phrase_id, text_col)
    df = index.groupBy("term").agg(F.sum(F.size("positions")).alias("freq"))
    ranked = terms.join(df, "term", "left").fillna(0, ["freq"]).withColumn(
        "rank", F.row_number().over(Window.partitionBy("phrase_id").orderBy("freq", "term", "off")))
    seeds = ranked.where("rank = 1 AND freq > 0").select("phrase_id", "off", "term", "n")
    starts = index.join(seeds, "term").select(id_col, "k", "phrase_id", "n", F.explode("positions").alias("q"), "off")
    starts = starts.select(id_col, "k", "phrase_id", "n", (F.col("q") - F.col("off")).alias("start")).where("start >= 0")
    rest = ranked.where("rank > 1").select("phrase_id", F.col("off").alias("o"), F.col("term").alias("t"))
    lists = index.select(F.col(id_col).alias("_d"), F.col("k").alias("_k"), F.col("term").alias("t"), "positions")
    held = (starts.join(rest, "phrase_id").join(lists, F.col("k").eqNullSafe(F.col("_k")) & F.col(id_col).eqNullSafe(F.col("_d"))
                                                & (lists["t"] == rest["t"]))
            .where(F.array_contains("positions", F.col("start") + F.col("o")))
            .groupBy(id_col, "k", "phrase_id", "start", "n").agg(F.count("*").alias("held")).where("held = n - 1"))
    return held.select(id_col, "phrase_id", "start").unionAll(starts.where("n = 1").select(id_col, "phrase_id", "start")).distinct()


def proximity_matches(index: DataFrame, pairs: DataFrame, within: int, id_col: str = "doc_id") -> DataFrame:
    """Places of two terms at most ``within`` words apart: ``doc_id, pair_id, a_at, b_at``.

    ``pairs`` has ``pair_id, a, b``, two single words each. Overlapping places all count;
    a word is not near itself."""
    def side(col):
        t = phrase_terms(pairs.select("pair_id", F.col(col).alias("text")), "pair_id", "text").where("off = 0")
        return index.join(t.select("phrase_id", "term"), "term").select(id_col, "k", F.col("phrase_id").alias("pair_id"), F.col("positions").alias(col))

    same = side("a").join(side("b").select(F.col(id_col).alias("_d"), F.col("k").alias("_k"), F.col("pair_id").alias("_p"), "b"),
                          F.col("k").eqNullSafe(F.col("_k")) & F.col(id_col).eqNullSafe(F.col("_d")) & (F.col("pair_id") == F.col("_p")))
    at = same.select(id_col, "pair_id", "b", F.explode("a").alias("a_at"))
    near = F.filter("b", lambda q: (F.abs(q - F.col("a_at")) <= within) & (q != F.col("a_at")))
    return at.select(id_col, "pair_id", "a_at", F.explode(near).alias("b_at"))


def _term_counts(docs: DataFrame, text_col: str, keep: HashBits) -> DataFrame:
    """``term, n``: how often the terms of ``keep`` (and some more) occur in the corpus.
    Counts leave a task whenever it holds ``_FLUSH`` terms, and at its end."""
    schema = T._parse_datatype_string("term long, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                words = [w for t in batch.slice(lo, 128).column(0).to_pylist() for w in alnum_words(t)]
                h = word_hashes(words)
                terms, n = np.unique(h[keep.test(h)], return_counts=True)
                for t, c in zip(signed(terms).tolist(), n.tolist(), strict=True):
                    counts[t] += c
                if len(counts) > _FLUSH:
                    yield out()
        if counts:
            yield out()

    small_batches(docs.sparkSession)
    return docs.select(text_col).mapInArrow(run, schema).groupBy("term").agg(F.sum("n").alias("n"))


def _items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item_id, words``: distinct word sequences of each item; items without words are none."""
    def make():
        def fn(item_id, text) -> Iterator[tuple]:
            words = [w.decode() for w in alnum_words(text)]
            if words and item_id is not None:
                yield item_id, words, signed(word_hashes([w.encode() for w in words])).tolist()
        return fn

    kind = items.schema[id_col].dataType.simpleString()
    out = map_texts(items, [id_col], text_col, f"item_id {kind}, words array<string>, terms array<long>", make)
    return out.dropDuplicates(["item_id", "words"]).withColumn("item_key", F.xxhash64("item_id", F.array_join("words", " ")))


def _anchors(items: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """``item_key, p1, t1, p2, t2``: the places and terms of the two rarest words of each
    window (for one-word items, the word twice). Windows with a word that the corpus lacks have none."""
    words = items.select("item_key", F.posexplode("terms").alias("pos", "term")).join(counts, "term", "left")
    ranked = words.groupBy("item_key").agg(F.array_sort(F.collect_list(F.struct(
        "pos", F.coalesce("n", F.lit(0)).alias("n"), "term"))).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    windows = F.transform(starts, lambda i: F.array_sort(F.transform(
        F.slice("w", i + 1, window), lambda x: F.struct(x["n"].alias("n"), x["term"].alias("term"), x["pos"].alias("pos")))))
    each = ranked.select("item_key", F.explode(windows).alias("r")).where(F.col("r")[0]["n"] > 0)
    second = F.coalesce(F.get("r", F.lit(1)), F.col("r")[0])
    return each.select("item_key", F.col("r")[0]["pos"].alias("p1"), F.col("r")[0]["term"].alias("t1"),
                       second["pos"].alias("p2"), second["term"].alias("t2")).distinct()


def _compare(doc: list[bytes], places: list, window: int) -> tuple[list[int], list]:
    """(hit positions, item ids) of the places (item_id, start, words, whole) in a document.
    ``start`` is where the first of ``words`` would stand; runs of at least
    ``window`` equal words count, or all of a shorter item."""
    hit: set[int] = set()
    found = set()
    for item_id, start, words, whole in places:
        need = min(window, whole)
        run = 0
        for i, w in enumerate(words):
            at = start + i
            run = run + 1 if 0 <= at < len(doc) and doc[at] == w else 0
            if run == need:
                hit.update(range(at - need + 1, at + 1))
                found.add(item_id)
            elif run > need:
                hit.add(at)
    return sorted(hit), sorted(found)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items, contaminated``.

    A window is ``window`` consecutive words of an item; an item of fewer words is one
    window. Words of a document inside any occurrence of a window are hit; ``items`` lists
    the items with occurring windows. ``contaminated``: some word is hit and
    ``share * n_hit >= n_words``. Null and empty texts have no words; items without words
    or with a null id have no windows. Rows that repeat id and text get the same result
    each; rows that share an id only are judged by their own texts. Empty tables are fine on
    either side. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    known = materialise(spark, _items(items, item_id, item_text), "items")
    counts = _term_counts(docs, "text", HashBits.of(known.select(F.explode("terms").alias("term")), "term"))
    anchors = materialise(spark, _anchors(known, counts, window), "anchors")
    wanted = anchors.select(F.explode(F.array("t1", "t2")).alias("term"))
    forward = materialise(spark, forward_index(docs, id_col, "text", HashBits.of(wanted, "term")), "index")
    index = inverted(forward, id_col)

    first = index.join(anchors, index["term"] == anchors["t1"]).select(
        id_col, "k", "item_key", "p1", "p2", "t2", F.explode("positions").alias("q"))
    first = first.select(id_col, "k", "item_key", "p1", "p2", "t2", (F.col("q") - F.col("p1")).alias("diagonal"))
    lists = index.select(F.col(id_col).alias("_d"), F.col("k").alias("_k"), F.col("term").alias("_t"), "positions")
    both = first.join(lists, (F.col("k") == F.col("_k")) & F.col(id_col).eqNullSafe(F.col("_d")) & (F.col("t2") == F.col("_t"))).where(
        F.array_contains("positions", F.col("diagonal") + F.col("p2")))
    # Every window with its rarest word at p1 lies within `window - 1` words of it.
    places = both.groupBy(id_col, "k", "item_key", "diagonal").agg(
        F.greatest(F.min("p1") - (window - 1), F.lit(0)).alias("lo"), (F.max("p1") + (window - 1)).alias("hi"))
    places = places.join(known.select("item_key", "item_id", "words"), "item_key").select(
        id_col, "k", F.struct("item_id", (F.col("diagonal") + F.col("lo")).alias("start"),
                              F.slice("words", F.col("lo") + 1, F.col("hi") - F.col("lo") + 1).alias("words"),
                              F.size("words").alias("whole")).alias("place"))
    places = materialise(spark, places.groupBy(F.col(id_col).alias("_d"), F.col("k").alias("_k")).agg(F.collect_list("place").alias("places")), "places")

    judged = _judge(docs, places, id_col, items.schema[item_id].dataType.simpleString(), window)
    out = forward.select(id_col, "k", "n_words").join(
        judged, F.col("k").eqNullSafe(F.col("_k")) & F.col(id_col).eqNullSafe(F.col("_d")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listed = F.coalesce("items", F.array().cast(judged.schema["items"].dataType))
    return out.select(id_col, "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"), listed.alias("items"),
                      ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"))


def _judge(docs: DataFrame, places: DataFrame, id_col: str, item_kind: str, window: int) -> DataFrame:
    """``_d, _k, n_hit, items`` of the documents in ``places``. A bitmap sized by them keeps
    most other texts out of the join."""
    keep = HashBits.of(places, "_k")
    kind = docs.schema[id_col].dataType.simpleString()

    def pick():
        def fn(doc_id, text) -> Iterator[tuple]:
            k = _doc_key(doc_id, text)
            if keep.test(np.array([k]).view(np.uint64))[0]:
                yield doc_id, k, text
        return fn

    texts = map_texts(docs, [id_col], "text", f"{id_col} {kind}, k long, text string", pick)
    met = texts.join(places, F.col("k").eqNullSafe(F.col("_k")) & F.col(id_col).eqNullSafe(F.col("_d"))).select("_d", "_k", "places", "text")

    def judge():
        def fn(doc_id, k, places, text) -> Iterator[tuple]:
            at = [(p["item_id"], p["start"], [w.encode() for w in p["words"]], p["whole"]) for p in places]
            hit, found = _compare(alnum_words(text), at, window)
            yield doc_id, k, len(hit), found
        return fn

    return map_texts(met, ["_d", "_k", "places"], "text", f"_d {kind}, _k long, n_hit long, items array<{item_kind}>", judge).dropDuplicates(["_d", "_k"])
