"""Operators on whole corpora: conversations, lines, contamination, near-duplicates, vectors, the pipeline."""

import collections
import contextlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import corpus_pipeline
from tidewater.llm import chat, collisions, contamination, lines, minmax, packing, queries, quality, secrets, toxicity
from tidewater.llm.components import connected_components
from tools.check import TABLES, digest

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf)
    rel = con.execute(queries.ORACLES[name])
    cols = [c[0] for c in rel.description]
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, rel.fetchall())[0]


# --- components ---

def test_components_of_random_graphs(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(40)] + [(i, 2000) for i in range(2001, 2100)]
    edges += edges[:5] + [(7, 7), (None, 3), (3, None)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(parent)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- conversations ---

def test_chat_collapse_cases(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 2)
    monkeypatch.setattr(chat, "PART", 2)
    rows = []

    def conv(i, *texts, start=0, step=1):
        rows.extend((i, start + k * step, "user" if k % 2 == 0 else "bot", t, "x", 1) for k, t in enumerate(texts))
    conv(1, "a")
    conv(2, "a", "b", "c")
    conv(3, "a", "b", "c", "d", "e")
    conv(4, "a", "b", "c", "d", "e", start=10, step=7)      # equal to 3: other turn numbers
    conv(5, "a", "x")
    conv(6, "b", "a")
    conv(6, "b", "a")                                        # rows twice
    conv(7, None, "q")
    rows += [(None, 0, "user", "lost", "x", 1), (8, None, None, "first", "x", 1), (8, 5, "user", "tie2", "x", 1), (8, 5, "bot", "tie1", "x", 1)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos string, blk int")
    got = collections.defaultdict(str)
    meta = {}
    for r in sorted(chat.collapse(turns).collect(), key=lambda r: (r["conv_id"], r["part"])):
        got[r["conv_id"]] += r["rendered"]
        meta[r["conv_id"]] = (r["n_turns"], r["n_copies"])
    assert meta == {3: (5, 2), 5: (2, 1), 6: (2, 1), 7: (2, 1), 8: (3, 1)}
    assert got[5] == "<|user|>\na\n<|bot|>\nx\n"
    assert got[8] == "<||>\nfirst\n<|bot|>\ntie1\n<|user|>\ntie2\n"
    assert got[3].count("<|") == 5
    assert chat.collapse(turns.where("false")).collect() == []


# --- lines ---

LINES = [(1, "The same long line here\nunique one in doc 1"), (2, "the  SAME long line here\nanother unique line"), (3, None), (4, ""), (None, "The same long line here"),
         (5, "x y"), (6, "x y"), (7, "so he began with this. A sentence of at least six words here. And on"), (7, "dup id the same"), (7, "dup id the same"),
         (8, "other start entirely. A sentence of at least six words here. Different end"), (9, "a b c\na b c")]


def test_line_repeats_against_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "s", 1, "x", 2) for i, t in LINES], "doc_id long, text string, whole string, hi long, id string, at long")
    got = sorted((tuple(r) for r in lines.repeats(docs).collect()), key=repr)
    key = lambda p: (p[0] is not None, p[0] or 0, p[1])
    places = collections.defaultdict(list)
    for i, t in LINES:
        for m in re.finditer("[^\n]+", t or ""):
            if len(m[0].split()) >= lines.MIN_LINE_WORDS:
                places[tuple(m[0].casefold().split())].append((i, m.start(), m.end()))
    want = []
    for ps in places.values():
        first = min(ps, key=key)
        want += [(p[0], p[1], p[2], False, *first[:2], len(ps)) for p in ps if p[:2] != first[:2]]
    assert got == sorted(want, key=repr) and len(got) == 3
    clean = {r["doc_id"]: r["text"] for r in lines.remove(docs, lines.repeats(docs)).where("doc_id <> 7").collect()}
    assert clean[2] == "\nanother unique line" and clean[9] == "a b c\n" and clean[3] is None and clean[5] == clean[6] == "x y"
    # A sentence that two lines share is a phrase, not a passage.
    assert "A sentence of at least six words here." in clean[8]
    assert lines.repeats(docs.where("false")).collect() == []
    assert lines.remove(docs, lines.repeats(docs.where("false"))).count() == len(LINES)


def _words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9))) for _ in range(n)]


@pytest.mark.parametrize("length", [51, 60, 200])
def test_passages_are_found_whole(spark, length):
    """Without punctuation, in mid line, over lines, or as a line of its own."""
    rng = random.Random(length)
    rows, want = [], set()
    for k in range(80):
        passage = _words(rng, length)
        for c, gap in enumerate((" ", "\n", "  ")):
            head, tail = " ".join(_words(rng, rng.randint(1, 40))), " ".join(_words(rng, rng.randint(1, 40)))
            body = gap.join(passage).upper() if c == 1 else gap.join(passage)
            cut = "\n" if c == 2 else " "
            rows.append((10 * k + c, head + cut + body + cut + tail))
            first = len(head) + 1 if c == 0 else first
            if c:
                want.add((10 * k + c, len(head) + 1, len(head) + 1 + len(body), True, 10 * k, first, 3))
        rows.append((10 * k + 5, " ".join(_words(rng, 100) + passage[:20] + _words(rng, 3) + passage[22:44])))
    got = {tuple(r) for r in lines.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {g[:4] for g in got} == {w[:4] for w in want}
    assert got == want


def test_passages_against_brute_force(spark):
    """Every run of 51 words that stands earlier is met; every word that goes is in a passage that stands earlier.

    The passages' parts overlap in many ways, so most have earlier, shorter matches to choose from."""
    rng = random.Random(5)
    pool = [_words(rng, rng.choice([15, 30, 51, 70, 130])) for _ in range(25)]
    texts = [[w for _ in range(rng.randint(0, 5)) for w in rng.choice(pool)[rng.randint(0, 8):][:rng.randint(20, 130)] + _words(rng, rng.randint(0, 6))]
             for _ in range(120)]
    texts += [["x"] * 400, ["x"] * 70, ["x", "y"] * 60, _words(rng, 30_000)]
    texts[-1] += texts[-1][:5000]
    n, short = lines.MIN_PASSAGE, lines.REACH
    seen, small = set(), set()
    must, may, whole = {}, {}, collections.defaultdict(list)
    for i, t in enumerate(texts):
        must[i], may[i] = set(), set()
        for at in range(len(t)):
            w, s = tuple(t[at:at + n]), tuple(t[at:at + short])
            if len(w) == n and w in seen:
                must[i].update(range(at, at + n))
                whole[i].append(set(range(at, at + n)))
            if len(s) == short and s in small:
                may[i].update(range(at, at + short))
            seen.add(w)
            small.add(s)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    gone = collections.defaultdict(set)
    for r in lines.repeats(docs).collect():
        t = " ".join(texts[r["doc_id"]])
        lo = len(t[:r["start"]].split())
        took = set(range(lo, lo + len(t[r["start"]:r["end"]].split())))
        assert not took & gone[r["doc_id"]]
        gone[r["doc_id"]] |= took
    assert sum(map(len, must.values())) > 5000
    for i in must:
        assert gone[i] <= may[i] | must[i], i
        assert all(w & gone[i] for w in whole[i]), i
    left = sum(len(must[i] - gone[i]) for i in must)
    assert left <= 0.01 * sum(map(len, must.values())), left


def test_a_passage_in_very_many_documents(spark):
    rng = random.Random(3)
    passage = " ".join(_words(rng, 55))
    rows = [(i, " ".join([*_words(rng, 9), f"head{i}", passage, f"tail{i}", *_words(rng, 9)])) for i in range(600)]
    found = lines.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == 599 and all(rows[r["doc_id"]][1][r["start"]:r["end"]] == passage and r["kept_doc_id"] == 0 for r in found)
    with pytest.raises(ValueError):
        lines.repeats(spark.createDataFrame(rows[:1], "doc_id long, text string"), min_passage=20)


def test_only_units_that_can_repeat_are_grouped(spark, monkeypatch):
    """units that occur once are counted by half a digest and left out before their places are shuffled."""
    rng = random.Random(9)
    passage = " ".join(_words(rng, 80))
    rows = [(f"d{i}", " ".join([*_words(rng, 200), *([passage] if i % 50 == 0 else []), *_words(rng, 9)])) for i in range(200)]
    rows.append((None, "head " + passage))
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(4)
    units = lines.unit_digests(docs, "doc_id", "text", "line", 3, 51)
    repeated = units.groupBy("hi", "lo").count().where("count > 1").agg(F.sum("count")).first()[0]
    grouped, firsts = [], lines.firsts
    monkeypatch.setattr(lines, "firsts", lambda u: grouped.append(u.count()) or firsts(u))
    found = {r["doc_id"]: r for r in lines.repeats(docs).collect()}
    assert set(found) == {f"d{i}" for i in range(0, 200, 50)}
    texts = dict(rows)
    assert all(texts[i][r["start"]:r["end"]] == passage and (r["kept_doc_id"], r["kept_start"], r["copies"]) == (None, 5, 5)
               for i, r in found.items())
    assert repeated <= grouped[0] < 1.1 * repeated < 0.1 * units.count()


ODD = [None, "", "\n \n", "one two", " tail　wide\x85next\nÀÉ ß ſ İ x", "a b c\n\na b c\n"]


def _python_step(monkeypatch, docs, make):
    """The function that ``make`` hands to ``mapInArrow``."""
    steps = []
    with monkeypatch.context() as m:
        m.setattr(type(docs), "mapInArrow", lambda df, fn, schema: steps.append(fn) or docs)
        make()
    return steps[-1]


def _rows(step, rows, schema, size):
    """Output rows of ``step`` over ``rows``, ``size`` in a batch."""
    batches = [pa.RecordBatch.from_pylist(rows[k:k + size], schema=schema) for k in range(0, len(rows), size)]
    return sorted(((tuple(r.values()) for b in step(iter(batches)) for r in b.to_pylist())), key=repr)


@pytest.mark.parametrize("unit", ["line", "paragraph"])
def test_short_texts_share_their_numpy_calls(spark, monkeypatch, unit):
    """A batch of texts is hashed at once, to the units that each text has by itself."""
    rng = random.Random(13)
    texts = [*ODD, *(rng.choice(" \n").join(_words(rng, rng.randint(0, 120))) for _ in range(300)), *ODD]
    rows = [{"id": i if i % 9 else None, "text": t} for i, t in enumerate(texts)]
    schema = pa.schema([("id", pa.int64()), ("text", pa.string())])
    docs = spark.createDataFrame([], "doc_id long, text string")
    step = _python_step(monkeypatch, docs, lambda: lines.unit_digests(docs, "doc_id", "text", unit, 3, 51))
    calls, digests = [], lines._digests
    monkeypatch.setattr(lines, "_digests", lambda *a: calls.append(1) or digests(*a))
    got = _rows(step, rows, schema, len(rows))
    assert len(calls) < 10
    assert got == _rows(step, rows, schema, 1) and len(calls) > len(texts) / 2
    monkeypatch.setattr(lines, "JOINED", 2000)
    monkeypatch.setattr(lines, "OUT_ROWS", 7)
    assert got == _rows(step, rows, schema, 50)
    whole = {(r[0], texts[r[0]][r[2]:r[3]]) for r in got if r[0] is not None and not r[1]}
    find = lines.UNITS[unit].finditer
    assert whole == {(r["id"], m[0]) for r in rows if r["id"] is not None for m in find(r["text"] or "") if len(m[0].split()) >= 3}
    for i, piece, start, end, at, n, _, _ in got:
        if i is not None:
            assert texts[i][:start].split() == texts[i].split()[:at] and texts[i][start:end].split() == texts[i].split()[at:at + n]
            assert not piece or n >= lines.REACH


def test_contexts_and_windows_of_joined_texts(spark, monkeypatch):
    """Words about places and windows about units, against the words of each text by itself."""
    rng = random.Random(17)
    texts = [*ODD, *("  ".join(_words(rng, rng.randint(1, 150))) for _ in range(60)), *ODD]
    docs = spark.createDataFrame([], "doc_id long, text string")
    found = [[(m.start(), m.end()) for m in re.finditer(r"\S+", t or "")] for t in texts]
    rows, want = [], []
    for i, (t, w) in enumerate(zip(texts, found, strict=True)):
        # Some places are beyond the text: rows of one id may have several texts.
        places = sorted({rng.randint(0, len(w) + 3) for _ in range(5)})
        rows.append({"id": i, "text": t, "left": places, "right": [p for p in places if p]})
        for p in places:
            if p < len(w):
                ws = w[max(0, p - lines.CONTEXT):p]
                want.append((i, p, False, [t[a:b] for a, b in ws][::-1], w[p][0], ws[0][0] if ws else w[p][0]))
            if 0 < p <= len(w):
                ws = w[p:p + lines.CONTEXT]
                want.append((i, p, True, [t[a:b] for a, b in ws], w[p - 1][1], ws[-1][1] if ws else w[p - 1][1]))
    ints = pa.list_(pa.int32())
    schema = pa.schema([("id", pa.int64()), ("text", pa.string()), ("left", ints), ("right", ints)])
    asked = spark.createDataFrame([], "id long, at int, after boolean")
    monkeypatch.setattr(lines, "within", lambda df, key, members: df)
    step = _python_step(monkeypatch, docs, lambda: _ignored(lines.contexts, docs, asked, "doc_id", "text"))
    monkeypatch.setattr(lines, "OUT_ROWS", 7)
    for size in (1, len(rows)):
        got = {r[:3]: r[3:] for r in _rows(step, rows, schema, size)}
        assert set(got) == {w[:3] for w in want} and len(got) > 200
        hashes = {}
        for i, at, after, words, here, end in want:
            h, edges, place = got[i, at, after]
            assert place == here and len(h) == len(edges) == len(words) and here + sum(edges) * (1 if after else -1) == end
            for x, word in zip(h, words, strict=True):
                assert hashes.setdefault(word.casefold(), x) == x
        assert len(set(hashes.values())) == len(hashes)

    size, rows, want = 51, [], set()
    for i, (t, w) in enumerate(zip(texts, found, strict=True)):
        units = [(a, a + rng.randint(25, 60)) for a in (rng.randint(0, 120) for _ in range(4))]
        units = [(a, b) for a, b in units if b <= len(w)]
        rows.append({"id": i, "text": t, "ats": [a for a, _ in units], "tos": [b for _, b in units]})
        for a, b in units:
            for p in range(max(0, b - size), min(a, len(w) - size) + 1):
                want.add((i, p, p + size, w[p][0], w[p + size - 1][1]))
    schema = pa.schema([("id", pa.int64()), ("text", pa.string()), ("ats", ints), ("tos", ints)])
    asked = spark.createDataFrame([], "id long, at int, to int")
    step = _python_step(monkeypatch, docs, lambda: lines.windows(docs, asked, "doc_id", "text", size))
    got = _rows(step, rows, schema, len(rows))
    assert got == _rows(step, rows, schema, 1)
    assert {r[:5] for r in got} == want and len(got) == len(want) == len({r[5:] for r in got}) > 100


def _ignored(fn, *args):
    """Calls ``fn``, whose later steps miss columns that the caught one would have made."""
    with contextlib.suppress(AnalysisException):
        fn(*args)


# --- contamination ---

def brute_contamination(docs, items, window=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    wins = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if w and i is not None else 0):
            wins.setdefault(tuple(w[s:s + n]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in wins:
                    hit.update(range(s, s + n))
                    found |= wins[tuple(w[s:s + n])]
        out.append((i, len(w), len(hit), len(found), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def test_contamination_cases(spark):
    rng = random.Random(4)
    vocab = ["the", "of", "and", "to"] * 6 + [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice([5, 12, 13, 14, 30]))) for i in range(30)]
    items += [(31, "the the the the the the the the the the the the the"), (32, None), (33, ""), (None, text(20)), (34, "zz9"), (3, items[3][1]), (35, items[5][1])]
    docs = [(i, text(rng.randint(0, 200))) for i in range(80)]
    for i in range(60):
        w = items[i % 30][1].split()
        cut = rng.randint(0, max(0, len(w) - 13))
        docs.append((100 + i, f"{text(rng.randint(0, 300))} {' '.join(w[cut:cut + rng.choice([12, 13, 20])]).upper()}! {text(rng.randint(0, 30))}"))
    docs += [(200, None), (201, ""), (None, items[0][1]), (100, docs[80][1]), (202, "the " * 40), (203, "x ZZ9"), (204, "é" * 70_000 + " zz9")]
    frame = spark.createDataFrame([(i, t, 1, "p") for i, t in docs], "doc_id long, text string, k int, term string")
    bench = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, words int")
    got = sorted((tuple(r) for r in contamination.contamination(frame, bench).collect()), key=repr)
    assert got == brute_contamination(docs, items)
    assert contamination.contamination(frame.where("false"), bench).collect() == []
    assert {r["n_hit"] for r in contamination.contamination(frame, bench.where("false")).collect()} == {0}


def test_phrases_and_proximity_of_a_whole_index(spark):
    docs = [(1, "a rose is a rose is a rose"), (2, "Rose, a is"), (3, None), (4, "deep blue sea and the blue deep"), (None, "is a rose")]
    index = contamination.build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    phrases = spark.createDataFrame([(1, "a rose is"), (2, "rose"), (3, "IS A"), (4, "missing rose"), (5, ""), (6, "rose is a rose")], "phrase_id long, text string")
    got = sorted((tuple(r) for r in contamination.phrase_matches(index, phrases).collect()), key=repr)
    want = []
    for d, t in docs:
        w = re.findall("[a-z]+", (t or "").lower())
        for p, q in ((1, "a rose is"), (2, "rose"), (3, "is a"), (6, "rose is a rose")):
            want += [(d, p, i) for i in range(len(w)) if w[i:i + len(q.split())] == q.split()]
    assert got == sorted(want, key=repr)
    pairs = spark.createDataFrame([(1, "deep", "blue"), (2, "a", "a")], "pair_id long, a string, b string")
    near = sorted(tuple(r) for r in contamination.proximity_matches(index, pairs, 2).where("pair_id = 1").collect())
    assert near == [(4, 1, 0, 1), (4, 1, 6, 5)]


# --- near-duplicates ---

def brute_components(docs):
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        s = {tuple(w[j:j + 3]) for j in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set()
        sets.setdefault(i, []).append(s)
    ids = [i for i in sets if i is not None]
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in ids:
        for b in ids:
            if a < b and any(s and t and 100 * len(s & t) >= 85 * len(s | t) for s in sets[a] for t in sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: ([len(s) for s in sets[i]], find(i)) for i in ids}


def near_copies(rng, n, words=60, edits=4):
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_min_max_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(minmax, "CHUNK_CLASSES", 16)
    rng = random.Random(9)
    texts = near_copies(rng, 90) + near_copies(rng, 30, 200, 12) + near_copies(rng, 10, 5, 1) + ["same text here now"] * 20
    rng.shuffle(texts)
    docs = list(enumerate(texts)) + [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two"), (906, "x " * 30_000), (None, "same text here now"), (907, texts[0]), (907, texts[0])]
    frame = spark.createDataFrame([(i, t, "a", 3) for i, t in docs], "doc_id long, text string, bands string, n int")
    got = minmax.components(frame).collect()
    want = brute_components(docs)
    assert len(got) == len(docs)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            sizes, component = want[r["doc_id"]]
            assert r["n_shingles"] in sizes and r["component_id"] == component and r["kept"] == (component == r["doc_id"])
    assert minmax.components(frame.where("false")).collect() == []


def test_rows_of_one_id_share_a_component(spark):
    a, b = near_copies(random.Random(1), 1)[0], near_copies(random.Random(2), 1)[0]
    docs = spark.createDataFrame([(1, a), (5, a), (5, b), (9, b), (20, "else")], "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"]) for r in minmax.components(docs).collect()} == {(1, 1), (5, 1), (9, 1), (20, 20)}


# --- vectors ---

def test_vectors_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(collisions, "CHUNK", 32)
    rng = np.random.default_rng(6)
    rows = []
    for label in (0, 1, 2):
        for c in range(25):
            base = rng.standard_normal(48)
            for _ in range(int(rng.integers(1, 12))):
                rows.append((base + rng.standard_normal(48) * rng.choice([0, 0.05, 0.14, 0.2])).tolist() + [label])
    rows = [(i, [float(x) for x in np.float32(r[:-1])], r[-1]) for i, r in enumerate(rows)]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [], 0), (n + 2, [0.0] * 48, 0), (n + 3, [float("nan")] * 48, 0), (n + 4, [None] * 48, 1), (n + 5, rows[0][1], None),
             (n + 6, rows[0][1], 0), (n + 7, [3 * x for x in rows[0][1]], 0), (n + 8, rows[0][1][:5], 0), (n + 9, [-x for x in rows[0][1]], 0)]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows] + [(None, rows[0][1], 0, 1, 2)], "vec_id long, embedding array<float>, label int, n int, cell int")
    good = {i: np.array(np.float32(v), dtype=float) for i, v, lab in rows if v and lab is not None and None not in v and np.isfinite(v).all() and any(v)}
    label = {i: lab for i, _, lab in rows}
    links, parent = collections.Counter(), {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in good:
        for b in good:
            if a < b and label[a] == label[b] and len(good[a]) == len(good[b]):
                if good[a] @ good[b] / (np.linalg.norm(good[a]) * np.linalg.norm(good[b])) >= 0.98:
                    links[a] += 1
                    links[b] += 1
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    got = collisions.near_duplicates(frame).collect()
    assert len(got) == len(rows) + 1
    extra = [r for r in got if r["vec_id"] is None]
    assert extra[0]["n_links"] == 0 and extra[0]["component_id"] is None and extra[0]["kept"]
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] is not None} == {
        i: (links[i], find(i), find(i) == i) for i, _, _ in rows}
    assert collisions.near_duplicates(frame.where("false")).collect() == []


def test_needed_count_keeps_recall():
    need = collisions.needed_count()
    rng = np.random.default_rng(0)
    hits = (np.abs(rng.standard_normal((200_000, collisions.PROJECTIONS))) <= collisions.WIDTH).sum(axis=1)
    assert (hits >= need).mean() > 0.9999 and need > collisions.PROJECTIONS // 2


# --- pipeline ---

def test_pipeline_stages_one_by_one(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash_dedup", "decontamination", "secrets", "packing"]
    rows = {r["doc_id"]: r for r in docs.collect()}
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"), train=lambda i: ~quality.held_out(i, 3, 1))
    reader = model.reader()
    kept = {i: r["text"] for i, r in rows.items() if model.probability(reader.features(r["text"])) < corpus_pipeline.TOXIC}
    want = brute_components(kept.items())
    kept = {i: t for i, t in kept.items() if want[i][1] == i}
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = {r[0]: kept[r[0]] for r in brute_contamination(kept.items(), bench) if not r[5]}
    stage = docs
    for name, fn in corpus_pipeline.STAGES[:-1]:
        stage = fn(spark, stage, sf)
        assert stage.columns == docs.columns, name
    got = {r["doc_id"]: r for r in stage.collect()}
    assert set(got) == set(kept)
    for i, r in got.items():
        spans, text = secrets.base_spans(kept[i]), kept[i]
        assert not secrets.base_spans(r["text"]) and r["n_chars"] == len(r["text"])
        assert spans or r["text"] == text or "[SECRET]" in r["text"]
    pieces = corpus_pipeline.run(spark, sf).collect()
    assert {p["doc_id"] for p in pieces} == set(kept)
    assert all(sorted((p["start"], p["length"]) for p in pieces if p["doc_id"] == i) == packing.binary_pieces(n)
               for i, n in {(p["doc_id"], p["doc_tokens"]) for p in pieces})


def test_pipeline_stages_take_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "no id at all"), (3, "twice over"), (3, "twice over"), (4, "w " * 40_000)]
    docs = spark.createDataFrame([(i, t, None, None, None, "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, _gone string")
    for _, fn in corpus_pipeline.STAGES[:-1]:
        out = fn(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == {1, 2, 3, 4, None}
        assert fn(spark, docs.where("false"), "/root/testdata/sf0.001").collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").select(F.countDistinct("doc_id")).first()[0] == 4
