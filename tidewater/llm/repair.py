"""Conversation structure repair: cheapest edits to ``(s?(ua)+)?`` by a grammar-compressed DP.

A conversation is a string with one symbol for each row: the role's class and its fault.
What the edits of a row can do is a 4 x 4 min-plus matrix over the states nothing,
system, user, assistant; the entries carry their cost and the rope of their edits. Re-Pair
replaces frequent neighbours in all strings by rules, each rule's matrix is the product of
its two parts, made once, bottom-up, and every distinct string is evaluated once, over its
compressed form, for all conversations that share it.

Rows never gather by conversation before they are symbols: they are sorted by range, so a
conversation of any size spreads over tasks, and each task sends the string of its own
stretch. Only the digest of the repaired text, one running SHA-256 by its nature, reads a
conversation's rows in order in one task, and holds one row at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import materialise, small_batches

CLASSES = "suao"
OK, TRUNCATED, BLANK, DUPLICATE = range(4)
#: One symbol for each class and fault; rows of ``SYMBOLS[fault]`` are in the order of ``CLASSES``.
SYMBOLS = ("suao", "SUAO", "1234", "5678")
KEEP, REROLE, DELETE, INSERT, STAYS_TRUNCATED = 0, 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"
#: States: nothing yet, system, user, assistant.
STATES = range(4)
ROUNDS = 5
RULES_PER_ROUND = 12
FIRST_RULE = 0xE000
#: Symbols of one stretch of a conversation that a task sends at once.
STRETCH = 1 << 16

Rope = str | tuple
Matrix = dict[tuple[int, int], tuple[int, Rope]]


# --- ropes and min-plus matrices (driver and workers) ---

def flat(rope: Rope) -> str:
    """The text of a rope: a string, or a pair of ropes."""
    out, todo = [], [rope]
    while todo:
        r = todo.pop()
        if isinstance(r, str):
            out.append(r)
        else:
            todo += (r[1], r[0])
    return "".join(out)


def _better(a: tuple[int, Rope], b: tuple[int, Rope] | None) -> bool:
    return b is None or a[0] < b[0] or (a[0] == b[0] and flat(a[1]) < flat(b[1]))


def product(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product; among equal costs the ASCII-least edits. Edits of the same rows that
    cost the same are never prefixes of each other, so the least stays least when more follow."""
    out: Matrix = {}
    for (i, k), (cost, rope) in a.items():
        for j in STATES:
            if (k, j) in b:
                one = (cost + b[k, j][0], (rope, b[k, j][1]))
                if _better(one, out.get((i, j))):
                    out[i, j] = one
    return out


#: Rows inserted between two others.
INSERTS: Matrix = {(i, i): (0, "") for i in STATES} | {
    (0, 2): (INSERT, "I"), (1, 2): (INSERT, "I"), (3, 2): (INSERT, "I"), (2, 3): (INSERT, "I"),
    (0, 3): (2 * INSERT, "II"), (1, 3): (2 * INSERT, "II")}
#: Cost and edits that end a conversation from each state.
ENDINGS: dict[int, tuple[int, str]] = {0: (0, ""), 1: (2 * INSERT, "II"), 2: (INSERT, "I"), 3: (0, "")}


def row_matrix(kind: str, fault: int) -> Matrix:
    """What inserts before a row and one edit of it do."""
    edit: Matrix = {(i, i): (DELETE, "D") for i in STATES}
    if fault in (OK, TRUNCATED):
        more = STAYS_TRUNCATED if fault == TRUNCATED else 0
        to_user, to_assistant = [(i, 2) for i in (0, 1, 3)], [(2, 3)]
        for move in to_user + to_assistant:
            edit[move] = (REROLE + more, "R")
        for move in {"s": [(0, 1)], "u": to_user, "a": to_assistant}.get(kind, []):
            edit[move] = (KEEP + more, "K")
    return product(INSERTS, edit)


TERMINALS = {SYMBOLS[f][c]: row_matrix(CLASSES[c], f) for f in range(4) for c in range(4)}


def matrices(rules: Sequence[tuple[str, str, str]]) -> dict[str, Matrix]:
    """Matrices of all symbols; ``rules`` (symbol, left, right) name earlier symbols only."""
    known = dict(TERMINALS)
    for symbol, left, right in rules:
        known[symbol] = product(known[left], known[right])
    return known


def plain_texts(known: dict[str, Matrix]) -> dict[str, dict[tuple[int, int], tuple[int, str]]]:
    """The matrices with their ropes written out, each once."""
    return {symbol: {move: (cost, flat(rope)) for move, (cost, rope) in m.items()} for symbol, m in known.items()}


def evaluate(symbols: str, known: dict[str, dict[tuple[int, int], tuple[int, str]]]) -> tuple[int, str]:
    """Cost and edits of a (compressed) string, from its end to its start.

    For each state the best way to finish is kept as a chain, with its rank among the four by
    text. Edits of one symbol differ or are equal, and are never prefixes of each other, so
    (edits, rank of the rest) decides without reading the rest.
    """
    cost = {i: c for i, (c, _) in ENDINGS.items()}
    chain = {i: (text, None) for i, (_, text) in ENDINGS.items()}
    texts = sorted({text for _, text in ENDINGS.values()})
    rank = {i: texts.index(text) for i, (_, text) in ENDINGS.items()}
    for symbol in reversed(symbols):
        step: dict[int, tuple] = {}
        for (i, j), (c, piece) in known[symbol].items():
            one = (c + cost[j], piece, rank[j], j)
            if i not in step or one < step[i]:
                step[i] = one
        cost = {i: s[0] for i, s in step.items()}
        chain = {i: (s[1], chain[s[3]]) for i, s in step.items()}
        keys = sorted({s[1:3] for s in step.values()})
        rank = {i: keys.index(s[1:3]) for i, s in step.items()}
    out, link = [], chain[0]
    while link is not None:
        out.append(link[0])
        link = link[1]
    return cost[0], "".join(out)


def expand(symbols: str, rules: Sequence[tuple[str, str, str]]) -> str:
    for symbol, left, right in reversed(rules):
        symbols = symbols.replace(symbol, left + right)
    return symbols


def facts(plain: str) -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated rows, and neighbours whose classes are not su, ua or au."""
    counts = [sum(map(plain.count, SYMBOLS[f])) for f in (BLANK, DUPLICATE, TRUNCATED)]
    classes = plain.translate({ord(SYMBOLS[f][c]): CLASSES[c] for f in range(4) for c in range(4)})
    legal = sum(map(classes.count, ("su", "ua", "au")))
    return counts[0], counts[1], counts[2], max(0, len(plain) - 1) - legal


# --- rows (Spark) ---

def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text, copies``: the test damage, by crc32 of ``conv:turn`` modulo 20.

    0 drops the row (``copies`` 0), 1 empties its text, 2 takes its ``[.!?]`` out, 3 doubles it
    (``copies`` 2), 4 makes it a user's. Null roles and texts, and null parts of the
    hashed key, are one space."""
    key = F.concat(F.coalesce(F.col(conv).cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col(turn).cast("string"), F.lit(" ")))
    h = F.crc32(key.cast("binary")) % 20
    rows = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(text), F.lit(" ")).alias("text"), h.alias("h"))
    return rows.select("conv", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                       F.when(F.col("h") == 0, 0).when(F.col("h") == 3, 2).otherwise(1).alias("copies"))


def undamaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows as they are, in the form :func:`repair` takes; null roles and texts are one space."""
    return rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(text), F.lit(" ")).alias("text"), F.lit(1).alias("copies"))


def _digest() -> Column:
    """MD5 of role and text: tells repeats, and orders rows of equal turn and role."""
    return F.unhex(F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text")))


def _features(rows: DataFrame) -> DataFrame:
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(end == "", BLANK).when(F.right(end, F.lit(1)).isin(".", "!", "?"), OK).otherwise(TRUNCATED)
    kind = F.instr(F.lit(CLASSES[:3]), F.when(F.col("role") != "", F.left("role", F.lit(1))).otherwise(F.lit("-")))
    return rows.where("copies > 0").select(
        "conv", "turn", "role", _digest().alias("digest"), "copies", fault.cast("int").alias("fault"),
        F.when(kind > 0, kind - 1).otherwise(3).cast("int").alias("kind"))


def _with_repeats(features: DataFrame) -> DataFrame:
    """Adds ``late``: the same role and text stand at an earlier turn (nulls are first). Only
    texts that occur twice are looked up; rows of equal turn are told apart by their order."""
    twice = (features.where(F.col("fault") != BLANK).groupBy("conv", "digest")
             .agg(F.count(F.lit(1)).alias("n"), F.min("turn").alias("at"), F.max(F.col("turn").isNull()).alias("null_at"))
             .where("n > 1").select(F.col("conv").alias("c"), F.col("digest").alias("d"), "at", "null_at"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
    late = F.col("turn").isNotNull() & (F.col("null_at") | (F.col("turn") > F.col("at")))
    return features.join(twice, same, "left").withColumn("late", F.coalesce(late, F.lit(False))).drop("c", "d", "at", "null_at")


def strings(rows: DataFrame) -> DataFrame:
    """``conv, symbols``: the symbol string of every conversation with rows left."""
    spark = rows.sparkSession
    features = materialise(spark, _features(rows), "repair-rows")
    order = ["conv", "turn", "role", "digest"]
    sorted_rows = _with_repeats(features).repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", "turn", "digest", "kind", "fault", "late", "copies")
    kind = features.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        now, before, symbols, done = None, None, [], []

        def send(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], types[0]), pa.array([r[1] for r in rows], pa.int32()),
                                               pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows])],
                                              names=["conv", "part", "seq", "symbols"])
        types = None
        for batch in batches:
            types = [batch.schema.field(0).type]
            for conv, turn, digest, kind_of, fault, late, copies in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if symbols and (conv != now or len(symbols) >= STRETCH):
                    done.append((now, part, seq, "".join(symbols)))
                    seq, symbols = seq + 1, []
                now = conv
                for _ in range(copies):
                    again = late or before == (conv, turn, digest)
                    symbols.append(SYMBOLS[DUPLICATE if again and fault != BLANK else fault][kind_of])
                    before = (conv, turn, digest)
            if len(done) >= 1024:
                yield send(done)
                done = []
        if symbols:
            done.append((now, part, seq, "".join(symbols)))
        if done:
            yield send(done)

    stretches = sorted_rows.mapInArrow(run, f"conv {kind}, part int, seq int, symbols string")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "seq", "symbols"))), lambda s: s["symbols"]), "")
    return materialise(spark, stretches.groupBy("conv").agg(whole.alias("symbols")), "repair-strings")


def _compressed(rules: Sequence[tuple[str, str, str]]) -> Column:
    out = F.col("symbols")
    for symbol, left, right in rules:
        out = F.replace(out, F.lit(left + right), F.lit(symbol))
    return out


def grammar(distinct: DataFrame, rounds: int = ROUNDS, per_round: int = RULES_PER_ROUND) -> list[tuple[str, str, str]]:
    """Re-Pair rules (symbol, left, right) over the strings of ``distinct``. A round counts all
    neighbours in the strings as compressed so far and takes the most frequent ones that
    share no symbol, so that one replacement doesn't undo the count of another."""
    rules: list[tuple[str, str, str]] = []
    for _ in range(rounds):
        s = distinct.select(F.split(_compressed(rules), "").alias("s")).where(F.size("s") > 1)
        n = F.size("s") - 1
        pairs = F.zip_with(F.slice("s", 1, n), F.slice("s", 2, n), lambda a, b: F.concat(a, b))
        # symbols are few, so their pairs are: (16 + ROUNDS * RULES_PER_ROUND) squared at most
        counted = s.select(F.explode(pairs).alias("pair")).groupBy("pair").count().where("count > 1").collect()
        used: set[str] = set()
        fresh = []
        for r in sorted(counted, key=lambda r: (-r["count"], r["pair"])):
            if len(fresh) < per_round and not used & set(r["pair"]):
                used |= set(r["pair"])
                fresh.append((chr(FIRST_RULE + len(rules) + len(fresh)), r["pair"][0], r["pair"][1]))
        if not fresh:
            break
        rules += fresh
    return rules


FACTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def solve(strings_of: DataFrame) -> DataFrame:
    """``conv`` with :data:`FACTS` and ``audit``; each distinct string is evaluated once."""
    spark = strings_of.sparkSession
    distinct = materialise(spark, strings_of.select("symbols").distinct(), "repair-distinct")
    rules = grammar(distinct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = plain_texts(matrices(rules))
        for batch in batches:
            plain, short = (c.to_pylist() for c in batch.columns)
            rows = [(*facts(p), *evaluate(s, known)) for p, s in zip(plain, short, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([r[k] for r in rows], pa.int64()) for k in range(5)], pa.array([r[5] for r in rows], pa.string())],
                names=["symbols", *FACTS, "audit"])

    answers = distinct.select("symbols", _compressed(rules).alias("short")).mapInArrow(
        run, "symbols string, " + ", ".join(f"{f} long" for f in FACTS) + ", audit string")
    return strings_of.join(answers, "symbols").drop("symbols")


class Repaired:
    """Digest and turn statistics of one conversation, from its edits and its rows in order."""

    def __init__(self, conv):
        self.conv, self.facts, self.edits, self.at, self.last = conv, [0] * len(FACTS), "", 0, ""
        self.digest, self.lines = hashlib.sha256(), 0
        self.first_turn = self.turn = None
        self.turns = 0

    def _put(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines, self.last = self.lines + 1, role[0]

    def _next_role(self) -> str:
        return "assistant" if self.last == "u" else "user"

    def _inserts(self) -> None:
        while self.edits[self.at:self.at + 1] == "I":
            self._put(self._next_role(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit, self.at = self.edits[self.at], self.at + 1
        if edit != "D":
            self._put(role if edit == "K" else self._next_role(), text)

    def see_turn(self, turn: int | None) -> None:
        if turn is not None and turn != self.turn:
            self.first_turn = turn if self.turn is None else self.first_turn
            self.turn, self.turns = turn, self.turns + 1

    def result(self) -> tuple:
        self._inserts()
        gaps = self.turn - self.first_turn + 1 - self.turns if self.turns else 0
        return self.conv, gaps, *self.facts, self.edits, self.digest.hexdigest()


def repair(rows: DataFrame) -> DataFrame:
    """``conv, gaps``, :data:`FACTS`, ``audit, repaired_sha256`` for every conversation of ``rows``.

    ``rows`` comes from :func:`damage` or :func:`undamaged`. Rows go by turn (nulls first),
    then role, then MD5 of role and text; equal rows are repeats of the first. Null
    conversation ids form one conversation, which keeps the null. Conversations without a row left have zeros,
    empty edits and the hash of the empty string; an empty table gives no rows.
    """
    spark = rows.sparkSession
    answers = solve(strings(rows))
    head = answers.select("conv", F.lit(0).alias("step"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
                          F.col("audit").alias("text"), F.lit(0).alias("copies"), F.lit(None).cast("binary").alias("digest"),
                          F.array(*FACTS).alias("facts"))
    left = rows.select("conv", F.lit(1).alias("step"), "turn", "role", F.when(F.col("copies") > 0, F.col("text")).alias("text"), "copies",
                       _digest().alias("digest"), F.lit(None).cast("array<bigint>").alias("facts"))
    order = ["conv", "step", "turn", "role", "digest"]
    stream = head.unionByName(left).repartition("conv").sortWithinPartitions(*order).drop("step", "digest")
    small_batches(spark)
    kind = rows.schema["conv"].dataType.simpleString()
    numbers = ("gaps", *FACTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Repaired | None = None
        done: list[tuple] = []
        key_type = None

        def send():
            cols = list(zip(*done, strict=True))
            types = [key_type, *[pa.int64()] * len(numbers), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                              names=["conv", *numbers, "audit", "repaired_sha256"])

        for batch in batches:
            key_type = batch.schema.field(0).type
            for conv, turn, role, text, copies, facts_in in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.result())
                    now = Repaired(conv)
                if facts_in is not None:
                    now.facts, now.edits = facts_in, text
                    continue
                if copies:
                    now.see_turn(turn)
                for _ in range(copies):
                    now.row(role, text)
            if len(done) >= 256:
                yield send()
                done = []
        if now is not None:
            done.append(now.result())
            yield send()

    return stream.mapInArrow(run, f"conv {kind}, " + ", ".join(f"{c} long" for c in numbers) + ", audit string, repaired_sha256 string")
