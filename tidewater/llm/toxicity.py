"""Toxicity by a learned lexicon, Levenshtein automata and context windows.

The lexicon is learned from labelled text: words, and stems that families of words share,
that mark toxic documents. It is kept as a trie. The trie and the Levenshtein automaton
are run together as one automaton over the word's characters, whose states (sets of trie
node and edits so far) are made when first reached; most words die after a few
characters. Terms of five letters and more are also caught with one edit, of nine and more with two: whole
words as such, stems at the start of a word. The words of a stem's family stand beside it, so their
misspellings are caught by their own length.

Every hit is then read in its context: inside quotation marks or after a word of
reporting it counts as quotation, else as abuse. A logistic curve over the counts of
abuse, quotation and misspelling, fitted on the labelled text, is the score.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import map_texts, materialise
from tidewater.llm.quality import _logistic

#: Bounds of the labelled sample: rows for each label, characters of a row.
FIT_ROWS = 8000
FIT_CHARS = 50_000
MAX_TERMS = 5000
CANDIDATES = 20_000
STEMS = (4, 5, 6, 7)
#: A term is in so many toxic documents, whatever the sample's size, and so many times likelier there.
MIN_LIFT = 30
MIN_DOCS = 4
#: Bound on the terms that chance alone is expected to bring into the lexicon.
FALSE_TERMS = 1.0
CONTEXT_CHARS = 60
END = "$"

_SEPARATE = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
# Marks of quotation and words of reporting.
_OPEN, _CLOSE = "\"“„«", "\"”“»"
_REPORT = frozenset("said says saying quote quoted quotes wrote writes called calls reported reports dit disait écrit "
                    "cité sagte sagt schrieb zitiert nannte dijo dice escribió citó llamó".split())


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_SEPARATE).split()


class Automaton:
    """The lexicon's trie with its edits, determinised as words need it."""

    def __init__(self, terms: list[str], safe: frozenset[str] = frozenset()):
        """``terms`` ending in ``END`` are whole words, others stems; ``safe`` words are no misspellings."""
        self.terms, self.safe = terms, safe
        self.child: list[dict[str, int]] = [{}]
        self.whole: dict[int, int] = {}
        self.stem: dict[int, int] = {}
        self.budget: list[int] = [0]
        self.limit: dict[int, int] = {}
        self.reach: dict[int, int] = {}
        for number, term in enumerate(terms):
            word = term.removesuffix(END)
            edits = edits_for(len(word))
            node = 0
            self.budget[0] = max(self.budget[0], edits)
            for c in word:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.budget.append(0)
                node = self.child[node][c]
                self.budget[node] = max(self.budget[node], edits)
            if term.endswith(END):
                self.whole[node], self.limit[node] = number, edits
            else:
                self.stem[node], self.reach[node] = number, edits
        self.letters = {c for d in self.child for c in d}
        self.states: list[tuple[tuple[int, int], ...]] = []
        self.number: dict[tuple[tuple[int, int], ...], int] = {}
        self.next: dict[tuple[int, str], int] = {}
        self.accept: list[tuple[int, int] | None] = []
        self.stems: list[tuple[int, int] | None] = []
        self.start = self._state({(0, 0)})

    def _state(self, items: set[tuple[int, int]]) -> int:
        """The number of the state of ``items`` and all that leaving out letters reaches; -1 if none."""
        best: dict[int, int] = {}
        todo = list(items)
        while todo:
            node, e = todo.pop()
            if e <= self.budget[node] and e < best.get(node, 99):
                best[node] = e
                todo += [(n, e + 1) for n in self.child[node].values()]
        if not best:
            return -1
        key = tuple(sorted(best.items()))
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            self.accept.append(min(((e, self.whole[n]) for n, e in key if n in self.whole and e <= self.limit[n]), default=None))
            self.stems.append(min(((e, self.stem[n]) for n, e in key if n in self.stem and e <= self.reach[n]), default=None))
        return self.number[key]

    def _step(self, state: int, c: str) -> int:
        out: set[tuple[int, int]] = set()
        for node, e in self.states[state]:
            out.add((node, e + 1))
            for letter, n in self.child[node].items():
                out.add((n, e + (letter != c)))
        return self._state(out)

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, number of the term) that the word is nearest to, or none."""
        state, found = self.start, None
        for c in word:
            key = (state, c if c in self.letters else "")
            at = self.next.get(key)
            if at is None:
                at = self.next[key] = self._step(*key)
            state = at
            if state < 0:
                break
            if stem := self.stems[state]:
                if not stem[0]:
                    return stem
                found = min(found or stem, stem)
        if state >= 0 and (whole := self.accept[state]):
            found = min(found or whole, whole)
        return None if found and found[0] and word in self.safe else found


def edits_for(length: int) -> int:
    return 2 if length >= 9 else 1 if length >= 5 else 0


def is_quoted(text: str, start: int, end: int) -> bool:
    """The place stands inside quotation marks or right after a word of reporting."""
    before, after = text[max(0, start - CONTEXT_CHARS):start], text[end:end + CONTEXT_CHARS]
    opened = max((before.rfind(c) for c in _OPEN), default=-1)
    if opened >= 0 and before.count('"') % 2 == (before[opened] == '"') and any(c in after for c in _CLOSE):
        return True
    return any(w in _REPORT for w in re.findall(r"\w+", before)[-4:])


class Reader:
    """Features of a text by one automaton; remembers words that match nothing."""

    def __init__(self, automaton: Automaton, memory: int = 200_000, trust: tuple[float, ...] = ()):
        self.automaton, self.memory, self.clean, self.trust = automaton, memory, set(), trust

    def hits(self, text: str | None) -> dict[str, tuple[int, int]]:
        """The distinct words of the whole text that match, with (edits, term)."""
        new = set(words_of(text)) - self.clean
        found = {}
        for w in new:
            word = w.decode()
            m = self.automaton.match(word)
            if m:
                found[word] = m
            else:
                self.clean.add(w)
        if len(self.clean) > self.memory:
            self.clean.clear()
        return found

    def features(self, text: str | None) -> tuple[float, float, float, float]:
        """(any abuse, log of distinct abusive words, quotation only, misspelling), each hit by its term's trust."""
        found = self.hits(text)
        if not found:
            return 0.0, 0.0, 0.0, 0.0
        low = text.lower()
        abuse: list[float] = []
        quoted, fuzzy = 0.0, 0.0
        for word, (edits, term) in sorted(found.items()):
            trust = self.trust[term] if self.trust else 1.0
            places = re.finditer(rf"(?<![0-9a-z\x80-\U0010ffff]){re.escape(word)}(?![0-9a-z\x80-\U0010ffff])", low)
            if all(is_quoted(low, m.start(), m.end()) for m in places):
                quoted = max(quoted, trust)
            elif edits:
                fuzzy = max(fuzzy, trust)
            else:
                abuse.append(trust)
        return max(abuse, default=0.0), math.log1p(sum(abuse)), 0.0 if abuse else quoted, fuzzy


@dataclass(frozen=True)
class Model:
    terms: tuple[str, ...]
    safe: frozenset[str]
    weight: tuple[float, ...] = ()
    offset: float = 0.0
    #: What a hit of each term counts, up to 1; rare terms count less. All 1 if empty.
    trust: tuple[float, ...] = ()

    def reader(self) -> Reader:
        return Reader(Automaton(list(self.terms), self.safe), trust=self.trust)

    def probability(self, features: tuple[float, ...]) -> float:
        z = self.offset + sum(w * x for w, x in zip(self.weight, features, strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def stems_of(text: str | None) -> set[str]:
    """Whole words and stems of a text that may be terms."""
    out = set()
    for w in {w.decode() for w in set(words_of(text))}:
        if len(w) <= 40 and not w.isdigit():
            out.add(w + END)
            out.update(w[:n] for n in STEMS if len(w) > n)
    return out


def log_chance(t: Column, c: Column, n_toxic: int, n_clean: int) -> Column:
    """Chernoff's bound on the log of the chance that a word in ``t + c`` documents, as likely in either
    kind, is in ``t`` toxic ones or more."""
    toxic = n_toxic / (n_toxic + n_clean)
    share = t / (t + c)
    clean = F.when(c > 0, c * F.log((1 - share) / (1 - toxic))).otherwise(0.0)
    return F.when(share > toxic, -(t * F.log(share / toxic) + clean)).otherwise(0.0)


def choose_terms(good: dict[str, int]) -> list[str]:
    """Terms from {stem: toxic documents}: the longest form of each family that loses next
    to nothing, never a term and its own stem."""
    names = sorted(good)
    chosen: set[str] = set()
    for s in sorted(good, key=lambda s: (len(s), s)):
        if any(s[:n] in chosen for n in range(1, len(s))):
            continue
        family = names[bisect_left(names, s) + 1:bisect_left(names, s + "\U0010ffff")]
        if s.endswith(END) or not any(good[x] >= 0.8 * good[s] for x in family):
            chosen.add(s)
    return sorted(chosen, key=lambda s: (-good[s], s))[:MAX_TERMS]


def _sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, train) -> DataFrame:
    """``y, text``: at most ``FIT_ROWS`` rows of each label, distinct texts."""
    marked = (labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("y"))
              .where(F.col("y").isin(0, 1) & F.col("_id").isNotNull()))
    if train is not None:
        marked = marked.where(train(F.col("_id")))
    marked = marked.groupBy("_id").agg(F.max("y").alias("y"))
    # Ids only, at most FIT_ROWS of each label: small enough to send to every task.
    few = [marked.where(F.col("y") == y).orderBy(F.xxhash64("_id"), "_id").limit(FIT_ROWS) for y in (0, 1)]
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).where(F.length("text").between(1, FIT_CHARS))
    return texts.join(F.broadcast(few[0].unionAll(few[1])), "_id").dropDuplicates(["y", "text"]).select("y", "text")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", train=None) -> Model:
    """Learn from labelled rows where ``train`` (a condition on the id column of ``labels``) holds.

    At most ``FIT_ROWS`` rows for each label (the first by a hash of the id) of at most
    ``FIT_CHARS`` characters are read; all counting runs on Spark, and at most ``CANDIDATES``
    stems and the sample's features (four numbers a row) come to the driver. Rows with a
    null id, text or label, or a label other than 0 and 1, teach nothing. With rows of one
    kind only, or none, there is nothing to tell apart: the lexicon is empty and every text
    scores the same, one half at most, so a filter keeps them all.
    """
    spark = docs.sparkSession
    sample = materialise(spark, _sample(docs, labels, label, id_col, text_col, train), "sample")
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)

    def count_stems():
        def fn(y, text) -> Iterator[tuple]:
            for s in stems_of(text):
                yield s, y
        return fn

    counts = (map_texts(sample, ["y"], "text", "s string, y int", count_stems).groupBy("s")
              .agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c")).where("t > 0"))
    each = materialise(spark, counts, "term-counts")
    counts = each.where(F.col("t") >= MIN_DOCS)
    tested = counts.count()  # one chance in so many for each, or less: FALSE_TERMS expected in all
    seen: dict[str, int] = {}
    if n_toxic and n_clean:
        lift = F.col("t") / n_toxic >= MIN_LIFT * (F.col("c") + 0.5) / n_clean
        sure = log_chance(F.col("t"), F.col("c"), n_toxic, n_clean) <= math.log(FALSE_TERMS / max(1, tested))
        seen = {r["s"]: r["t"] for r in counts.where(lift & sure).orderBy(F.desc("t"), "s").limit(CANDIDATES).collect()}
    terms = choose_terms(seen)
    trust = [seen[s] / (seen[s] + MIN_DOCS) for s in terms]
    stems = {s: w for s, w in zip(terms, trust, strict=True) if not s.endswith(END)}
    if stems:  # their families' words, with the trust of the stem
        stem = F.coalesce(*[F.when((start := F.substring("s", 1, n)).isin([s for s in stems if len(s) == n]), start) for n in STEMS])
        family = (each.where(F.col("s").endswith(END)).withColumn("stem", stem).where("stem IS NOT NULL")
                  .orderBy(F.desc("t"), "s").limit(CANDIDATES).collect())
        terms += [r["s"] for r in family]
        trust += [stems[r["stem"]] for r in family]

    draft = Model(tuple(terms), frozenset(), trust=tuple(trust))

    def near_words():
        reader = draft.reader()

        def fn(y, text) -> Iterator[tuple]:
            for word, (edits, _) in reader.hits(text).items():
                if edits:
                    yield (word,)
        return fn

    # Words of clean text that only look like a term; bounded like the candidates.
    safe = map_texts(sample.where("y = 0"), ["y"], "text", "w string", near_words).groupBy("w").agg(F.count("*").alias("n"))
    draft = replace(draft, safe=frozenset(r["w"] for r in safe.orderBy(F.desc("n"), "w").limit(CANDIDATES).collect()))

    def measure():
        reader = draft.reader()

        def fn(y, text) -> Iterator[tuple]:
            yield (y, *reader.features(text))
        return fn

    # At most 2 * FIT_ROWS rows of four numbers, equal ones counted together.
    rows = (map_texts(sample, ["y"], "text", "y int, a double, b double, c double, d double", measure)
            .groupBy("y", "a", "b", "c", "d").agg(F.count("*").alias("n")).collect())
    if not n_toxic or not n_clean:
        share = min(0.5, (n_toxic + 1) / (n_toxic + n_clean + 3))
        return replace(draft, weight=(0.0,) * 4, offset=math.log(share / (1 - share)))
    x = np.array([[r["a"], r["b"], r["c"], r["d"]] for r in rows for _ in range(r["n"])])
    y = np.array([float(r["y"]) for r in rows for _ in range(r["n"])])
    w = _logistic(x, y)
    return replace(draft, weight=tuple(map(float, w[:-1])), offset=float(w[-1]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, terms`` for every row by its whole text; ``terms`` are the lexicon's
    terms found, sorted.

    Null and empty texts have no hits. Null or repeated ids and repeated rows keep their own
    results; an empty table gives no rows; other columns are ignored. One scan, no shuffle.
    """
    def make():
        reader = model.reader()

        def fn(doc_id, text) -> Iterator[tuple]:
            found = reader.hits(text)
            p = model.probability(reader.features(text) if found else (0.0,) * 4)
            yield doc_id, p, sorted({model.terms[t].rstrip(END) for _, t in found.values()})
        return fn

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, [id_col], text_col, f"{id_col} {kind}, score double, terms array<string>", make)


def scorer(model: Model):
    """The score as a function of a text column, for filters that keep all columns."""
    readers: list[Reader] = []

    @F.udf("double", useArrow=True)
    def probability(text):
        if not readers:
            readers.append(model.reader())
        return model.probability(readers[0].features(text))
    return probability
