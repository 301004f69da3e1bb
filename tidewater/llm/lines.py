"""Line deduplication: equal normalised units across a corpus keep their first occurrence.

Units are of two kinds. Whole lines (or paragraphs) are equal as they stand. Passages may stand
anywhere, inside lines or over several: anchors, the words whose hash is the smallest of every
``WINDOW`` word groups, fall alike wherever the same text stands, and the words from one anchor to
the first anchor at least ``REACH`` words on are a unit. Each unit is normalised (case and white
space) and hashed to 128 bits, and the digests are grouped globally; of every digest the
occurrence that comes first by ``(id, offset)`` stays. Matched units that overlap are joined to chains,
each chain is widened word by word to the whole common passage, and passages of fewer than
``MIN_PASSAGE`` words stay: a common phrase is no copy.

A passage of ``MIN_PASSAGE`` words always holds a unit: its first window has an anchor among its
first 12 words, and the window 25 words on, which ends within the passage, has one too. Windows
that reach out of the passage add none between the two.

For all documents only the first half of each digest is shuffled, to count it; units whose half
occurs once are left out by a filter before their places move. Of documents with a match the text is
read again, for the words about the ends of chains and for windows. The groupings combine on the map
side, so a line that is in every document is one row a task. Python works on several texts at a time,
joined: most are short, and a numpy call for each would cost more than their words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewater.llm.common import U64, HashBits, materialise, signed, small_batches

UNITS = {"line": re.compile(r"[^\n]+"), "paragraph": re.compile(r"(?:[^\n]|\n(?![^\S\n]*\n))+")}
#: Shorter lines and passages always stay.
MIN_LINE_WORDS = 3
MIN_PASSAGE = 51
#: Words in a group, groups in a window, words a unit has at least. A passage of
#: ``REACH + 2 * WINDOW + GROUP - 2`` words, 51, holds a unit.
GROUP, WINDOW, REACH = 4, 12, 25
#: Units of one passage start at most ``WINDOW`` words apart, so neighbours share this many words.
SHARED = REACH - WINDOW
#: A chain may lack this many words at either end: its passage would else hold one unit more.
CONTEXT = 2 * WINDOW + GROUP
#: Rows of units or contexts that leave a Python worker at once.
OUT_ROWS = 8192
#: Bytes of texts that are worked on at once; a longer text is by itself.
JOINED = 1 << 18
#: White space by code point; there is none beyond.
_SPACE = np.array([chr(c).isspace() for c in range(0x3002)])
#: 1 for every byte of Latin-1 that belongs to a word.
_LATIN = bytes((~_SPACE[:256]).astype(np.uint8))
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_MASK = (1 << 64) - 1


class _Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, as many as the longest text needs."""

    def __init__(self, base: int):
        self.bases = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (np.multiply.accumulate(np.concatenate([np.ones(1, U64), np.full(2 * n - 1, b, U64)]))
                                  for b in self.bases)
        return self.up[:n], self.down[:n]


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words of ``texts`` joined by one character, case-folded for the hash."""
    words, marks = [], []
    for text in texts:
        # Case folding goes by single characters and makes no white space, so the words stay the same ones.
        words += text.casefold().split()
        try:
            marks.append(text.encode("latin-1").translate(_LATIN))
        except UnicodeEncodeError:
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            marks.append((~_SPACE[np.minimum(points, len(_SPACE) - 1)]).tobytes())
    inside = np.frombuffer(b"\0" + b"\0".join(marks) + b"\0", bool)
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    try:
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))
    except UnicodeEncodeError:
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), U64, len(words))
    return turns[::2], turns[1::2], hashes


class _Joined:
    """The words of several texts, numbered through; null is empty. ``offset`` and ``first`` are each text's
    first character and word, and behind the last text's; ``text`` is each word's text."""

    def __init__(self, texts: list[str | None]):
        self.texts = [t or "" for t in texts]
        self.offset = np.cumsum([0, *(len(t) + 1 for t in self.texts)])
        self.starts, self.ends, self.hashes = words_of(self.texts)
        self.first = np.searchsorted(self.starts, self.offset)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, _Joined]]:
    """The rows of ``batch`` with their texts, the second column, ``JOINED`` bytes at a time or one longer text."""
    lo, size = 0, 0
    for k, n in enumerate([*pc.binary_length(batch.column(1)).fill_null(0).to_pylist(), 0]):
        if k > lo and size + n > JOINED or k == batch.num_rows > lo:
            part = batch.slice(lo, k - lo)
            yield part, _Joined(part.column(1).to_pylist())
            lo, size = k, 0
        size += n


def _ranges(lo: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``lo, lo + 1, ...`` of each size, one after another."""
    return np.arange(sizes.sum()) + np.repeat(lo - np.cumsum(sizes) + sizes, sizes)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(31))) * U64(0x7FB5D329728EA185)
    return h ^ (h >> U64(29))


def anchors(t: _Joined) -> np.ndarray:
    """Places of the smallest word group of every window within a text, the leftmost of equals."""
    n = len(t.hashes) - GROUP + 1
    if n < WINDOW:
        return np.zeros(0, np.int64)
    least = np.zeros(n, U64)
    for k in range(GROUP):
        least = _mix(least * U64(_BASES[0]) + t.hashes[k:k + n])
    picked, width = np.arange(n), 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        picked = np.where(least[step:] < least[:-step], picked[step:], picked[:-step])
        least = np.minimum(least[step:], least[:-step])
        width += step
    picked = picked[t.text[:len(picked)] == t.text[-len(picked):]]
    return picked[np.diff(picked, prepend=-1) > 0]


def spans(t: _Joined, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, word after the last) of each passage unit of the texts of ``min_words`` words or more."""
    a = anchors(t)
    a = a[np.diff(t.first)[t.text[a]] >= min_words]
    to = np.searchsorted(a, a + REACH)
    a, b = a[to < len(a)], a[to[to < len(a)]]
    same = t.text[a] == t.text[b]
    return a[same], b[same]


def _pieces(t: _Joined, unit: str) -> np.ndarray:
    """(start, end) of the lines or paragraphs, in the joined texts; some are empty."""
    if unit == "line":
        sizes = np.fromiter((len(line) for text in t.texts for line in text.split("\n")), np.int64)
        ends = np.cumsum(sizes + 1) - 1
        return np.stack([ends - sizes, ends], axis=1)
    found = [(m.start() + o, m.end() + o) for text, o in zip(t.texts, t.offset.tolist(), strict=False) for m in UNITS[unit].finditer(text)]
    return np.array(found, np.int64).reshape(-1, 2)


def _digests(hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray, powers: list[_Powers]) -> list[np.ndarray]:
    """Two 64-bit digests of the words ``lo`` to ``hi``, from sums of all words up to each place."""
    out = []
    for k, p in enumerate(powers):
        up, down = p.upto(len(hashes) + 1)
        sums = np.concatenate([np.zeros(1, U64), np.cumsum((_mix(hashes) if k else hashes) * up[:-1], dtype=U64)])
        out.append(_mix((sums[hi] - sums[lo]) * down[lo] + (hi - lo).astype(U64)))
    return out


def units_of(t: _Joined, unit: str, min_words: int, min_passage: int, powers: list[_Powers]) -> list[np.ndarray]:
    """Columns ``text, piece, start, end, at, words, hi, lo`` of the units of some texts; ``at`` counts a text's words."""
    lines = _pieces(t, unit)
    lo, hi = np.searchsorted(t.starts, lines.T)
    long = hi - lo >= max(1, min_words)
    lo, hi, lines = lo[long], hi[long], lines[long]
    a, b = spans(t, min_passage)
    first, to = np.concatenate([lo, a]), np.concatenate([hi, b])
    h, g = _digests(t.hashes, first, to, powers)
    piece, text = np.arange(len(h)) >= len(lo), t.text[first]
    # A line never equals a passage unit: each kind has its own rule.
    h = h ^ np.where(piece, U64(0), U64(_BASES[1]))
    start, end = np.concatenate([lines[:, 0], t.starts[a]]), np.concatenate([lines[:, 1], t.ends[b - 1]])
    places = [start - t.offset[text], end - t.offset[text], first - t.first[text], to - first]
    return [text, piece, *(p.astype(np.int32) for p in places), signed(h), signed(g)]


def _table(batch: pa.RecordBatch, rows: np.ndarray, cols: list, schema: pa.Schema) -> pa.RecordBatch:
    """The ids, ``batch``'s first column, of ``rows`` beside ``cols``."""
    ids = batch.column(0).take(pa.array(rows)).cast(schema[0].type)
    return pa.RecordBatch.from_arrays([ids, *(c if isinstance(c, pa.Array) else pa.array(c) for c in cols)], schema=schema)


def unit_digests(docs: DataFrame, id_col: str, text_col: str, unit: str, min_words: int, min_passage: int) -> DataFrame:
    """``id, piece, start, end, at, words, hi, lo``: one row per unit."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = T.StructType([docs.schema["id"], *T._parse_datatype_string(
        "piece boolean, start int, end int, at int, words int, hi long, lo long")])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = [_Powers(b) for b in _BASES]
        for batch in batches:
            for part, t in _slices(batch):
                text, *cols = units_of(t, unit, min_words, min_passage, powers)
                for k in range(0, len(text), OUT_ROWS):
                    yield _table(part, text[k:k + OUT_ROWS], [c[k:k + OUT_ROWS] for c in cols], arrow)

    return docs.mapInArrow(run, out)


def within(df: DataFrame, key: Column, members: DataFrame) -> DataFrame:
    """``df`` without most rows whose ``key`` isn't in ``members``, of one column of longs; no row of a member goes.

    A bitmap of 16 MB at most (:class:`HashBits`) decides, so rows that can't join are never shuffled."""
    keep = HashBits.of(members, members.columns[0])

    @F.arrow_udf("boolean")
    def member(h: pa.Array) -> pa.Array:
        return pa.array(keep.test(h.to_numpy(zero_copy_only=False).view(U64)))

    return df.where(member(key))


def _texts_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id, text`` of the documents whose id is in ``wanted``, and of a few others."""
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    return within(texts, F.xxhash64("_id"), wanted.select("id").distinct().select(F.xxhash64("id").alias("key")))


def contexts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The words before or after places: ``id, at, after, hashes, edges, here``.

    ``wanted`` has ``id, at, after``. ``hashes`` goes outward from the place, up to ``CONTEXT``
    words in 32 bits each, ``edges`` how many more characters a passage has with each of them, ``here`` is the place's offset. A
    document's places are at most its own words, and leave in batches."""
    small_batches(docs.sparkSession)
    lists = wanted.groupBy("id").agg(F.collect_set(F.when(F.col("after"), F.col("at"))).alias("right"),
                                     F.collect_set(F.when(~F.col("after"), F.col("at"))).alias("left"))
    texts = _texts_of(docs, wanted, id_col, text_col)
    joined = texts.join(lists, F.col("_id").eqNullSafe(F.col("id"))).select("id", "text", "left", "right")
    out = T.StructType([wanted.schema["id"], *T._parse_datatype_string(
        "at int, after boolean, hashes array<int>, edges array<int>, here int")])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, t in _slices(batch):
                hashes = (t.hashes >> U64(32)).astype(np.uint32).view(np.int32)
                # Characters from one word's end to the next one's, and from its start to the last one's.
                more, less = np.diff(t.ends, prepend=0).astype(np.int32), np.diff(t.starts, append=0).astype(np.int32)
                for after, edges, places in ((False, less, part.column(2)), (True, more, part.column(3))):
                    text = np.repeat(np.arange(len(places)), places.value_lengths().to_numpy(zero_copy_only=False))
                    at = places.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                    there = at <= np.diff(t.first)[text] - (not after)
                    text, at = text[there], at[there]
                    for k in range(0, len(at), OUT_ROWS):
                        i, n = text[k:k + OUT_ROWS], at[k:k + OUT_ROWS]
                        place = n + t.first[i]
                        sizes = np.minimum(CONTEXT, t.first[i + 1] - place if after else n)
                        # Words from the place on, or from the one before it back.
                        words = _ranges(place, sizes) if after else -_ranges(1 - place, sizes)
                        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                        lists = [pa.ListArray.from_arrays(offsets, pa.array(c[words]), type=arrow.field(name).type)
                                 for name, c in (("hashes", hashes), ("edges", edges))]
                        here = (t.ends[place - 1] if after else t.starts[place]) - t.offset[i]
                        yield _table(part, i, [n.astype(np.int32), np.full(len(n), after), *lists, here.astype(np.int32)], arrow)

    # Rows of one id with several texts: one answer a place, the same every time.
    found = joined.mapInArrow(run, out)
    return found.groupBy("id", "at", "after").agg(F.min(F.struct("hashes", "edges", "here")).alias("c")).select(
        "id", "at", "after", "c.hashes", "c.edges", "c.here")


def windows(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``id, at, to, start, end, hi, lo``: all windows of ``size`` words about the units ``wanted``, ``id, at, to``.

    At most ``size - REACH + 1`` windows a unit."""
    small_batches(docs.sparkSession)
    lists = wanted.groupBy("id").agg(F.collect_set(F.struct("at", "to")).alias("units"))
    lists = lists.select("id", F.transform("units", lambda u: u["at"]).alias("ats"), F.transform("units", lambda u: u["to"]).alias("tos"))
    texts = _texts_of(docs, wanted, id_col, text_col)
    joined = texts.join(lists, F.col("_id").eqNullSafe(F.col("id"))).select("id", "text", "ats", "tos")
    out = T.StructType([wanted.schema["id"], *T._parse_datatype_string(
        "at int, to int, start int, end int, hi long, lo long")])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = [_Powers(b) for b in _BASES]
        for batch in batches:
            for part, t in _slices(batch):
                text = np.repeat(np.arange(len(part)), part.column(2).value_lengths().to_numpy(zero_copy_only=False))
                ats, tos = (part.column(c).flatten().to_numpy(zero_copy_only=False) for c in (2, 3))
                lo = np.maximum(0, tos - size) + t.first[text]
                hi = np.minimum(ats, np.diff(t.first)[text] - size) + t.first[text] + 1
                lo, hi = lo[lo < hi], hi[lo < hi]
                n = len(t.hashes) + 1
                at = np.flatnonzero(np.cumsum(np.bincount(lo, minlength=n) - np.bincount(hi, minlength=n)))
                hi, lo = _digests(t.hashes, at, at + size, powers)
                text = t.text[at]
                places = at - t.first[text], at + size - t.first[text], t.starts[at] - t.offset[text], t.ends[at + size - 1] - t.offset[text]
                cols = [*(c.astype(np.int32) for c in places), signed(hi), signed(lo)]
                for k in range(0, len(at), OUT_ROWS):
                    yield _table(part, text[k:k + OUT_ROWS], [c[k:k + OUT_ROWS] for c in cols], arrow)

    return joined.mapInArrow(run, out)


def later(units: DataFrame, groups: DataFrame) -> DataFrame:
    """The ``units`` that aren't the first of their digest, with the place of that one."""
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("start") == F.col("kept_start"))
    return units.join(groups, ["hi", "lo"]).where(~same).withColumn("shift", F.col("at") - F.col("kept_at")).drop("kept_at")


def firsts(units: DataFrame) -> DataFrame:
    """Digests that occur more than once, with their first occurrence by (id, start)."""
    kept = units.groupBy("hi", "lo").agg(F.min(F.struct("id", "start", "at")).alias("kept"), F.count("*").alias("copies"))
    return kept.where("copies > 1").select("hi", "lo", F.col("kept.id").alias("kept_id"), F.col("kept.start").alias("kept_start"),
                                           F.col("kept.at").alias("kept_at"), "copies")


def chained(found: DataFrame, *kinds: str) -> DataFrame:
    """``found`` with ``chain``: matched units of one document, and of one of ``kinds``, that overlap as units of one text do share its number."""
    order = Window.partitionBy("id", *kinds).orderBy("at", "to")
    before = F.max("to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    t = found.withColumn("opens", F.when(before - F.col("at") >= F.least(F.lit(SHARED), F.col("to") - F.col("at")), 0).otherwise(1))
    return t.withColumn("chain", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("opens")


def chains(links: DataFrame) -> DataFrame:
    """One row a chain: its words and offsets, what its first and its last unit repeat, where the earliest
    document that any of them repeats would have its first word (``early_id, early_at``), and whether all
    its units repeat one place that nothing else repeats (``settled``)."""
    left = F.struct("at", "kept_id", (F.col("at") - F.col("shift")).alias("kept_at"))
    early = F.struct("kept_id", "kept_start", "shift")
    right = F.struct("to", "kept_id", (F.col("to") - F.col("shift")).alias("kept_to"))
    place = F.struct("kept_id", "shift")
    t = links.groupBy("id", "chain").agg(
        F.min(left).alias("l"), F.max(right).alias("r"), F.min("start").alias("start"), F.max("end").alias("end"),
        F.min(early).alias("e"), F.max("copies").alias("copies"), (F.min(place) == F.max(place)).alias("one"))
    return t.select("id", "chain", "l.at", "r.to", "start", "end", F.col("l.kept_id").alias("kept_id"), F.col("e.kept_id").alias("early_id"),
                    F.greatest(F.col("l.at") - F.col("e.shift"), F.lit(0)).alias("early_at"), F.col("e.kept_start").alias("early_start"),
                    F.col("l.kept_at").alias("kept_at"), F.col("r.kept_id").alias("last_id"), F.col("r.kept_to").alias("kept_to"),
                    "copies", (F.coalesce("one", F.lit(False)) & (F.col("copies") == 2)).alias("settled"))


def _gain(here: str, there: str) -> Column:
    """How many words two contexts share from their place on."""
    n = F.least(F.size(here), F.size(there))
    equal = F.zip_with(F.slice(here, 1, n), F.slice(there, 1, n), lambda a, b: a == b)
    stop = F.array_position(equal, False)
    return F.when(stop > 0, stop - 1).otherwise(n).cast("int")


def _chars(edges: str, gain: str) -> Column:
    return F.aggregate(F.slice(edges, F.lit(1), F.col(gain)), F.lit(0), lambda a, b: a + b)


def widened(docs: DataFrame, t: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each chain grown at its two ends as far as the words there are the same in both documents."""
    sides = (("id", "at", False, "l"), ("kept_id", "kept_at", False, "kl"), ("early_id", "early_at", False, "el"),
             ("id", "to", True, "r"), ("last_id", "kept_to", True, "kr"))
    ask = [t.select(F.col(i).alias("id"), F.col(at).alias("at"), F.lit(after).alias("after")) for i, at, after, _ in sides]
    wanted = materialise(docs.sparkSession, reduce(DataFrame.unionByName, ask).distinct(), "places")
    seen = materialise(docs.sparkSession, contexts(docs, wanted, id_col, text_col), "contexts")
    for i, at, after, name in sides:
        side = seen.where(F.col("after") if after else ~F.col("after")).select(
            F.col("id").alias("_id"), F.col("at").alias("_at"), F.col("hashes").alias(name), F.col("edges").alias(name + "_edges"),
            F.col("here").alias(name + "_here"))
        side = side.drop("kl_edges", "kr_edges", "el", "l_here", "kl_here", "r_here", "kr_here")
        # A document of another text under an equal id may lack the earliest place; the unit's own start stands in.
        t = t.join(side, F.col(i).eqNullSafe(F.col("_id")) & (F.col(at) == F.col("_at")), "left" if name == "el" else "inner").drop("_id", "_at")
        if name == "kl":
            t = t.withColumn("left", _gain("l", "kl")).withColumn("down", _chars("l_edges", "left")).drop("l", "kl", "l_edges")
        if name == "el":
            begins = F.coalesce(F.col("el_here") - _chars("el_edges", "left"), F.col("early_start"))
            t = t.withColumn("kept_start", begins).drop("el_here", "el_edges")
    t = t.withColumn("right", _gain("r", "kr"))
    return t.select("id", "chain", (F.col("at") - F.col("left")).alias("at"), (F.col("to") + F.col("right")).alias("to"),
                    (F.col("start") - F.col("down")).alias("start"), (F.col("end") + _chars("r_edges", "right")).alias("end"),
                    F.col("early_id").alias("kept_id"), "kept_start", "copies", "settled")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line",
            min_words: int = MIN_LINE_WORDS, min_passage: int = MIN_PASSAGE) -> DataFrame:
    """The occurrences to remove: ``doc_id, start, end, piece, kept_doc_id, kept_start, copies``.

    One row for every line that isn't the first of its digest by (id, start), and, with
    ``piece`` true, for every passage of ``min_passage`` words or more (51 at least) that stands
    earlier too, whether in a line, a line itself or over several: its place in its own document
    (code points, end exclusive), the place of the one that stays (of a passage put together from
    several, where its earliest part's document has its first word), and how often the line, or the passage's commonest unit, occurs.
    What two rows would both cover belongs to the one that starts first, a line before a passage,
    so places never overlap. Lines of fewer than ``min_words`` words always stay. Null and
    empty texts have no units. Ids order the corpus, null first. Rows that share an id share
    its places: units at equal offsets of both are one occurrence. An empty table gives no
    rows. Other columns are ignored.

    Each unit is compared with its first occurrence. Where what comes of it is too short,
    another may share more: then all windows of ``min_passage`` words about all occurrences of the
    units are compared, so every passage of that length is found. Of a longer one, words at an end
    stay if the units there stand still earlier in another passage that stops before them.
    """
    if min_passage < MIN_PASSAGE:
        raise ValueError(f"passages of fewer than {MIN_PASSAGE} words need not hold a unit")
    spark = docs.sparkSession
    units = materialise(spark, unit_digests(docs, id_col, text_col, unit, min_words, min_passage), "units")
    # Digests that can repeat, by their first half: a digest that occurs twice is always among them.
    again = materialise(spark, units.groupBy("hi").count().where("count > 1").select("hi"), "again")
    units = materialise(spark, within(units, F.col("hi"), again), "candidates")
    # As a table of its own, so that both sides of the join are plain shuffles: digests are unique
    # on the right, a hot digest only lengthens the left side, and Spark splits that.
    groups = materialise(spark, firsts(units), "groups")
    found = later(units.withColumn("to", F.col("at") + F.col("words")).drop("words"), groups)
    found = materialise(spark, chained(found, "piece"), "repeats")
    links = found.where("piece")
    ends = materialise(spark, chains(links), "chains")
    wide = materialise(spark, widened(docs, ends, id_col, text_col), "widened")
    short = wide.where((F.col("to") - F.col("at") < min_passage) & ~F.col("settled")).select(F.col("id").alias("_id"), F.col("chain").alias("_chain"))
    open_ = links.join(short, F.col("id").eqNullSafe(F.col("_id")) & (F.col("chain") == F.col("_chain"))).select("hi", "lo").distinct()
    wanted = units.where("piece").join(open_, ["hi", "lo"]).select("id", "at", (F.col("at") + F.col("words")).alias("to")).distinct()
    wanted = materialise(spark, wanted, "wanted")
    exact = materialise(spark, windows(docs, wanted, id_col, text_col, min_passage), "windows")
    more = chains(chained(later(exact, firsts(exact))))
    cols = ["id", "start", "end", F.lit(True).alias("piece"), "kept_id", "kept_start", "copies"]
    more = more.withColumn("kept_id", F.col("early_id")).withColumn("kept_start", F.col("early_start"))
    pieces = wide.where(F.col("to") - F.col("at") >= min_passage).select(cols).unionByName(more.select(cols))
    both = found.where("NOT piece").select(pieces.columns).unionByName(pieces)
    order = Window.partitionBy("id").orderBy("start", "piece", F.desc("end"), "kept_id", "kept_start", F.desc("copies"))
    both = both.withColumn("cut", F.greatest("start", F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), "start")))
    return both.where("cut < end").select(
        F.col("id").alias(id_col), F.col("cut").cast("int").alias("start"), F.col("end").cast("int").alias("end"), "piece",
        F.col("kept_id").alias("kept_doc_id"), (F.col("kept_start") + F.col("cut") - F.col("start")).cast("int").alias("kept_start"), "copies")


def without(text: Column, cuts: Column) -> Column:
    """``text`` without the ``cuts``, an array of (start, end) sorted by start."""
    ends = F.concat(F.array(F.lit(0)), F.transform(cuts, lambda c: c["end"]))
    starts = F.concat(F.transform(cuts, lambda c: c["start"]), F.array(F.length(text)))
    parts = F.zip_with(ends, starts, lambda a, b: F.substring(text, a + 1, b - a))
    return F.array_join(parts, "")


def remove(docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the units of ``removed`` (from :func:`repeats`). All rows and columns stay.

    What a document loses is gathered for each document, at most its own units."""
    cuts = removed.groupBy(id_col).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("cuts"))
    joined = docs.alias("docs").join(cuts.alias("gone"), F.col(f"docs.{id_col}").eqNullSafe(F.col(f"gone.{id_col}")), "left")
    text, lost = F.col(f"docs.{text_col}"), F.col("gone.cuts")
    text = F.when(lost.isNull(), text).otherwise(without(text, lost)).alias(text_col)
    return joined.select(*[text if c == text_col else F.col(f"docs.`{c}`") for c in docs.columns])
