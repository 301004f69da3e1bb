"""Secret scans: fixed patterns plus a battery of randomness tests.

Base spans come from three patterns (assignments, access keys, long hex). The method
adds strings that no pattern names: every run of key-like characters is a candidate; its
encoding is inferred (hex, base32, base36, base62, base64) and three tests are made on
its symbols: chi-squared uniformity over the alphabet, Wald-Wolfowitz runs about the
alphabet's middle, and lag-1 serial correlation. Their statistics make one distance from
uniform randomness: small for random keys, large for words, numbers and repeats.

The null is the corpus itself without its base spans and candidates. All words of every
document are joined and cut into
consecutive strings of each band's length and measured the same way; their distances form
one histogram for each band (a fixed number of cells, whatever the input). A fixed null,
worth ``PRIOR`` strings, is added to each, so that small inputs decide by it and large
ones by their own words. A candidate's p-value is the share of null
strings of its band that look at least as random, and Benjamini-Hochberg over the
candidates of a band at level ``q`` decides. Short strings have wide null histograms, so
they need to look more random: the control is aware of length. Every candidate is tested
and counted. Of those that the control accepts, one whose own distance is above
``MAX_DISTANCE`` fails the battery whatever the null.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import materialise, small_batches

# The patterns of the base scan, the order of kinds in results.
ASSIGN = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

_LONG_HEX = re.compile(r"[0-9a-f]{24,}")  # same spans as HEX and the length rule, found faster
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
ALPHABETS = (("hex", "0123456789abcdef"), ("HEX", "0123456789ABCDEF"), ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
             ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
             ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
             ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
             ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"))
_INDEX = {name: {c: i for i, c in enumerate(a)} for name, a in ALPHABETS}
_SETS = [(name, frozenset(a), len(a)) for name, a in ALPHABETS]
#: Lower ends of the length bands; longer strings share the last one.
BANDS = (20, 28, 40, 64, 128)
CELLS = 400
CELL = 0.05
Q = 0.01
MAX_DISTANCE = 6.0
#: The fixed null: the shares of each band's strings up to ends of cells, between them by
#: their logarithm. Counted on the words of 10,000 documents (sf0.1) outside key-like strings.
PRIOR = 10_000
NULL_CELLS = (0, 4, 8, 12, 16, 20, 24, 28, 32, 36, 40, 60, 80, 120, 160)
NULL_SHARES = (
    (2.0e-4, 4.4e-4, 2.5e-3, 7.6e-3, 1.9e-2, 4.0e-2, 7.1e-2, 1.2e-1, 1.8e-1, 2.5e-1, 3.3e-1, 8.0e-1, 9.8e-1, 1, 1),
    (4.4e-6, 4.4e-6, 2.3e-5, 1.2e-4, 4.2e-4, 1.2e-3, 3.3e-3, 8.6e-3, 1.9e-2, 3.9e-2, 7.2e-2, 4.5e-1, 9.0e-1, 1, 1),
    (1e-6, 1e-6, 1e-6, 1e-6, 2.1e-6, 2.1e-6, 1.0e-5, 5.6e-5, 1.6e-4, 4.8e-4, 1.4e-3, 9.5e-2, 5.3e-1, 9.9e-1, 1),
    (1e-6, 1e-6, 1e-6, 1e-6, 1e-6, 1e-6, 1e-6, 1e-6, 1e-6, 3.3e-6, 3.3e-6, 3.5e-4, 5.2e-2, 9.7e-1, 1),
    (1e-6, 1e-6, 1e-6, 1e-6, 1e-6, 1e-6, 1e-6, 1e-6, 1e-6, 1e-6, 1e-6, 1e-6, 1e-6, 9.7e-2, 9.9e-1))
#: Rows measured together, and null strings of a band.
SLICE, STRINGS = 256, 4096


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base spans, in order."""
    if not text:
        return []
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(out)


def infer_encoding(s: str) -> str | None:
    """The smallest alphabet that holds every symbol, padding left out."""
    seen = set(s.rstrip("="))
    return next((name for name, letters, _ in _SETS if seen <= letters), None)


def batteries(x: np.ndarray, k: int) -> np.ndarray:
    """Distance from uniform randomness of each row of ``x``, symbols 0 to ``k - 1``: the
    tests' normal scores, squared and averaged.

    About 1 for random strings of any length; grows with length for any other."""
    rows, n = x.shape
    if n < 4:
        return np.full(rows, float(CELLS))
    counts = np.bincount((np.arange(rows)[:, None] * k + x).ravel(), minlength=rows * k).reshape(rows, k)
    chi = ((counts - n / k) ** 2).sum(axis=1) * k / n
    z_chi = np.maximum(0.0, (chi - (k - 1)) / math.sqrt(2 * (k - 1) * (1 - 1 / n)))
    high = x >= k / 2
    n1 = high.sum(axis=1)
    n0 = n - n1
    mean = 1 + 2 * n0 * n1 / n
    var = (mean - 1) * (mean - 2) / (n - 1)
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    z_runs = np.where(n0 * n1 > 0, (runs - mean) / np.sqrt(np.maximum(var, 1e-9)), math.sqrt(n))
    z_half = (n1 - n0) / math.sqrt(n)
    c = x - (k - 1) / 2
    z_serial = (c[:, 1:] * c[:, :-1]).sum(axis=1) / ((k * k - 1) / 12 * math.sqrt(n - 1))
    return (z_chi ** 2 + z_runs ** 2 + z_serial ** 2 + z_half ** 2) / 4


def battery(s: str, encoding: str) -> float:
    index = _INDEX[encoding]
    return float(batteries(np.array([[index[c] for c in s.rstrip("=")]], dtype=np.int64), len(index))[0])


def band_of(n: int) -> int:
    return sum(n >= b for b in BANDS) - 1


def cell_of(distance: float) -> int:
    """Cells are even on a log scale, so small distances are told apart."""
    return int(min(CELLS - 1, math.log1p(distance) / CELL))


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, str | None, float]]:
    """(start, end, encoding, distance) of all key-like strings outside the base spans;
    symbols of no one alphabet are infinitely far."""
    out = []
    for m in CANDIDATE.finditer(text):
        if not any(b[0] < m.end() and m.start() < b[2] for b in base):
            name = infer_encoding(m[0])
            out.append((m.start(), m.end(), name, battery(m[0], name) if name else math.inf))
    return out


_NOT_WORDS = bytes(c for c in range(256) if not (chr(c).isascii() and chr(c).isalnum()))
#: Of each byte, the alphabets (a bit each) that hold it; of each alphabet, its symbols' numbers.
_HELD = np.array([sum((chr(b) in letters) << i for i, (_, letters, _) in enumerate(_SETS)) for b in range(256)], np.uint8)
_NUMBERS = [np.array([_INDEX[name].get(chr(b), 0) for b in range(256)], np.int64) for name, _ in ALPHABETS]


def outside(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without ``spans``: what secrets are told from must not hold them, or a corpus
    with many would hide them all."""
    if not spans:
        return text
    out, at = [], 0
    for a, b in sorted(spans):
        if a > at:
            out.append(text[at:a])
        at = max(at, b)
    return " ".join([*out, text[at:]])


def null_counts(texts: list[str]) -> dict[int, int]:
    """``band * CELLS + cell`` of the strings that the joined words of each whole text are
    cut into, for every band, with their counts. The last string ends where the text does."""
    out = np.zeros(len(BANDS) * CELLS, np.int64)
    joined = [np.frombuffer(t.encode("utf-8", "surrogatepass").translate(None, _NOT_WORDS), np.uint8) for t in texts]
    for band, n in enumerate(BANDS):
        whole = [w for w in joined if len(w) >= n]
        cuts = [x for w in whole for x in (w[:len(w) // n * n], w[len(w) - (n if len(w) % n else 0):])]
        strings = np.concatenate(cuts).reshape(-1, n) if cuts else np.empty((0, n), np.uint8)
        for at in range(0, len(strings), STRINGS):
            part = strings[at:at + STRINGS]
            held = np.bitwise_and.reduce(_HELD[part], axis=1)
            for i, (_, _, k) in enumerate(_SETS):
                mine = part[held & -held.astype(np.int16) == 1 << i]
                if len(mine):
                    cells = np.minimum(CELLS - 1, (np.log1p(batteries(_NUMBERS[i][mine], k)) / CELL).astype(np.int64))
                    out += np.bincount(band * CELLS + cells, minlength=len(out))
    return {int(c): int(out[c]) for c in out.nonzero()[0]}


FOUND = "array<struct<start:int,end:int,encoding:string,band:int,cell:int,near:boolean>>"


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its base spans, its candidates with their cells; the first document of
    every ``SLICE`` holds the null cells of all of them, with their counts."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = T._parse_datatype_string(f"{id_col} {kind}, base array<struct<kind:string,start:int,end:int>>, "
                                      f"found {FOUND}, null_cells array<struct<c:int,n:long>>")
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                ids, texts = (c.to_pylist() for c in batch.slice(lo, SLICE).columns)
                texts = [t or "" for t in texts]
                bases = [base_spans(t) for t in texts]
                found = [[(a, b, name, band_of(b - a), cell_of(d), d <= MAX_DISTANCE) for a, b, name, d in candidates(t, base)]
                         for t, base in zip(texts, bases, strict=True)]
                plain = [outside(t, [(a, b) for a, _, b in base] + [f[:2] for f in mine]) for t, base, mine in zip(texts, bases, found, strict=True)]
                cells = [list(null_counts(plain).items())] + [[]] * (len(texts) - 1)
                cols = ids, [[(KINDS[k], a, b) for a, k, b in base] for base in bases], found, cells
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def null_share(band: int, cell: int) -> float:
    """The share of the fixed null's strings in cells up to this one."""
    return float(np.exp(np.interp(cell + 1, NULL_CELLS, np.log(NULL_SHARES[band]))))


def cutoffs(measured: DataFrame, q: float) -> dict[int, int]:
    """The largest cell that Benjamini-Hochberg accepts, by band.

    Everything is counted by (band, cell) first, so what the window sorts has at most
    ``len(BANDS) * CELLS`` rows and the driver gets at most ``len(BANDS)`` numbers,
    whatever the input."""
    marks = F.concat(F.transform("null_cells", lambda x: F.struct(x["c"].alias("c"), x["n"].alias("n"), F.lit(0).alias("f"))),
                     F.transform("found", lambda x: F.struct((x["band"] * CELLS + x["cell"]).alias("c"),
                                                             F.lit(0).cast("long").alias("n"), F.lit(1).alias("f"))))
    cells = (measured.select(F.explode(marks).alias("x")).groupBy("x.c").agg(F.sum("x.n").alias("n"), F.sum("x.f").alias("f"))
             .select(F.floor(F.col("c") / CELLS).cast("int").alias("band"), (F.col("c") % CELLS).alias("cell"), "n", "f"))
    upto, whole = Window.partitionBy("band").orderBy("cell"), Window.partitionBy("band")
    steps = cells.select("band", "cell", F.sum("f").over(upto).alias("r"), F.sum("f").over(whole).alias("t"),
                         F.sum("n").over(upto).alias("k"), F.sum("n").over(whole).alias("m"))
    fixed = F.array(*[F.lit(PRIOR * null_share(b, c)) for b in range(len(BANDS)) for c in range(CELLS)])
    p = (F.col("k") + F.get(fixed, F.col("band") * CELLS + F.col("cell")) + 1) / (F.col("m") + PRIOR + 1)
    cut = (steps.where((F.col("r") > 0) & (p <= F.lit(q) * F.col("r") / F.col("t")))
           .groupBy("band").agg(F.max("cell").alias("cut")))
    return {r["band"]: r["cut"] for r in cut.collect()}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = Q) -> DataFrame:
    """One row per document: ``doc_id, spans``, an array of (start, kind_no, end, kind,
    encoding) sorted by start, then kind as listed in ``KINDS``.

    Offsets count code points, ends are exclusive. Null text is empty. Rows are handled
    one by one, so null or repeated ids and repeated rows keep their own results. An empty
    table gives no rows. Other columns are ignored, whatever their names.
    """
    measured = materialise(docs.sparkSession, measure(docs, id_col, text_col), "secrets")
    cuts = cutoffs(measured, q)
    order = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    cut = F.create_map(*[x for b in range(len(BANDS)) for x in (F.lit(b), F.lit(cuts.get(b, -1)))])
    base = F.transform("base", lambda b: F.struct(
        b["start"].alias("start"), order[b["kind"]].alias("kind_no"), b["end"].alias("end"), b["kind"].alias("kind"),
        F.lit(None).cast("string").alias("encoding")))
    more = F.transform(F.filter("found", lambda x: x["near"] & (x["cell"] <= cut[x["band"]])), lambda x: F.struct(
        x["start"].alias("start"), F.lit(len(KINDS) - 1).alias("kind_no"), x["end"].alias("end"),
        F.lit(KINDS[-1]).alias("kind"), x["encoding"].alias("encoding")))
    return measured.select(id_col, F.array_sort(F.concat(base, more)).alias("spans"))


def digest_columns(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, span strings and the digest of the base spans."""
    def line(s):
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != KINDS[-1])
    return scanned.select(
        id_col, count("assign"), count("access"), count("hex"),
        F.sha2(F.array_join(F.transform(base, line), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", line), ",").alias("spans"), count("random"))


def redact(docs: DataFrame, text_col: str = "text", q: float = Q, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of a text replaced by ``mark``; all rows and columns stay.

    Spans that overlap are replaced together. Null text stays null. The corpus is read
    twice: once for the cut-offs, of which the driver gets one number a band, once to cut.
    """
    cuts = cutoffs(measure(docs.select(F.lit(0).alias("_id"), F.col(text_col).alias("_text")), "_id", "_text"), q)

    @F.udf("string", useArrow=True)
    def clean(text):
        if not text:
            return text
        base = base_spans(text)
        spans = [(a, b) for a, _, b in base]
        spans += [(a, b) for a, b, _, d in candidates(text, base)
                  if d <= MAX_DISTANCE and cell_of(d) <= cuts.get(band_of(b - a), -1)]
        out, at = [], 0
        for a, b in sorted(spans):
            if a >= at:
                out += [text[at:a], mark]
            at = max(at, b)
        return "".join([*out, text[at:]])

    return docs.withColumn(text_col, clean(F.col(text_col)))
