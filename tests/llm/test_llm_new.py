"""URL filter, source divergence and conversation repair against brute force and on odd input."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import divergence, repair, urls
from tidewater.llm.queries import URL_RULES

# --- URL filter ---

ODD_URLS = [None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/1", "http://example.com/en/", "http://example.com/EN/",
            "http://sub.example.com/en/x?y", "http://notexample.com/en/x", "http://example.com", "http://example.com?/en/", "http://com/",
            "http://a.net/es/1#f", "http://a.net/fr/", "http://a.net/de/", "a://b://c.com/d", "http://ÄB.Com/é?x=1&y=2&&z", "http://x.org/" + "a/1?" * 5000,
            "http://a.com/\n/x", "http://user@h.com:80/p;q?r=1;s=2#t", "http:///path", "http://.com/"]


def split_url(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path, rules):
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.name)) if fit else None


def test_url_rules_and_odd_urls(spark):
    df = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(ODD_URLS + ODD_URLS[:6])] + [(None, "http://a.org/", "x", 1)],
                               "page_id long, url string, host string, score int")
    got = urls.judge(df, URL_RULES).collect()
    assert len(got) == df.count()
    for r in got:
        url = "http://a.org/" if r["page_id"] is None else (ODD_URLS + ODD_URLS[:6])[r["page_id"]]
        host, path = split_url(url)
        rule = rule_of(host, path, URL_RULES)
        assert (r["host"], r["path"]) == (host, path)
        assert r["rule"] == (rule.name if rule else None)
        assert r["verdict"] in ("allow", "block") and (rule is None or r["verdict"] == rule.verdict)
    assert urls.judge(df.limit(0), URL_RULES).collect() == []
    # labels of one kind, or none: no trees, nothing more is blocked
    for rules in ((), (urls.Rule("block", "com"),), (urls.Rule("allow", "com"),)):
        assert {r["verdict"] for r in urls.judge(df, rules).collect() if r["rule"] is None} == {"allow"}


def made_urls(n, seed):
    """Good URLs, and bad ones that tend to be deep, with digits and many parameters; a third of either on other.io."""
    rng, out = random.Random(seed), []

    def word(letters="abcdefghij"):
        return "".join(rng.choice(letters) for _ in range(rng.randrange(3, 10)))
    for i in range(n):
        bad = i % 2
        host = f"{word()}{rng.randrange(10**5) if rng.random() < (.8 if bad else .1) else ''}.{('good', 'bad')[bad] if i % 3 else 'other'}.io"
        path = "/".join(word("0123456789a" if rng.random() < (.8 if bad else .1) else "abcdefghij") for _ in range(rng.randrange(1 + bad, 4 + bad)))
        query = "&".join(f"{word()}={rng.randrange(9)}" for _ in range(rng.randrange(2 * bad, 2 + 2 * bad)))
        out.append((i, f"http://{host}/{path}" + ("?" + query if query else ""), bad))
    return out


def test_url_trees_learn_what_rules_do_not_say(spark):
    rows = made_urls(3000, 3)
    judged = urls.judge(spark.createDataFrame(rows, "page_id long, url string, bad int"), [urls.Rule("block", "bad.io"), urls.Rule("allow", "good.io")])
    got = {r["page_id"]: r for r in judged.collect()}
    unseen = [(got[i]["verdict"] == "block") == bool(bad) for i, _, bad in rows if got[i]["rule"] is None]
    assert len(unseen) > 900 and sum(unseen) / len(unseen) > 0.95


def test_url_features_and_trees_against_brute_force(spark):
    rows = made_urls(600, 5) + [(1000 + i, u, None) for i, u in enumerate(ODD_URLS)]
    df = spark.createDataFrame(rows, "page_id long, url string, bad int")
    parts = urls.parts(df, ["page_id", "bad"]).withColumn("verdict", F.when(F.col("bad") == 1, "block").when(F.col("bad") == 0, "allow"))
    lexical = {r["page_id"]: r for r in urls.lexical(parts).collect()}
    for i, url, _ in rows:
        url, r = url or "", lexical[i]
        host, path = split_url(url)
        at = url.find("://")
        tail = url if at < 0 else url[at + 3 + len(host) + len(path):]
        query = tail.split("#")[0] if tail.startswith("?") else ""
        plain = re.sub(r"[^\x00-\x7F]+", "¤", url)
        want = {"url_length": len(url), "host_length": len(host), "path_length": len(path), "depth": sum(p != "" for p in path.split("/")),
                "host_labels": sum(p != "" for p in host.split(".")), "host_digits": sum(c in "0123456789" for c in host),
                "digit_share": 1000 * sum(c in "0123456789" for c in url) // len(url) if url else 0,
                "parameters": sum(p != "" for p in re.split("[&;]", query[1:])), "query_length": len(query),
                "hyphens": host.count("-"), "fragment": int("#" in tail)}
        assert {k: r[k] for k in want} == {k: min(v, urls.TOP) for k, v in want.items()}
        bits = -sum(k / len(plain) * math.log2(k / len(plain)) for k in collections.Counter(plain).values())
        assert abs(r["entropy"] - 100 * bits) <= 0.51

    # the trees, grown again in plain Python from the same features
    model = urls.fit(parts)
    full = urls.with_suffixes(urls.lexical(parts.withColumn("first", urls._half(F.col("url"), "statistics"))), model.suffixes, model.share,
                              urls._half(F.col("url"), "hide")).collect()
    train = [(tuple(r[f] for f in urls.FEATURES), r["bad"]) for r in full if not r["first"] and r["bad"] is not None]
    n = [sum(y == k for _, y in train) for k in (0, 1)]
    weight = [max(1, round(urls.WEIGHT * sum(n) / (2 * k))) for k in n]
    thresholds = [urls.cuts(list(collections.Counter(x[f] for x, _ in train).items())) for f in range(len(urls.FEATURES))]
    bins = [tuple(sum(t < v for t in thresholds[f]) for f, v in enumerate(x)) for x, _ in train]
    margins, unit = [0] * len(train), urls.UNIT * urls.WEIGHT
    for tree in model.trees:
        g, h = [], []
        for (_, y), m in zip(train, margins, strict=True):
            p = 1 / (1 + math.exp(-m / urls.UNIT))
            g.append(weight[y] * (math.floor(p * urls.UNIT + 0.5) - y * urls.UNIT))
            h.append(weight[y] * max(1, math.floor(p * (1 - p) * urls.UNIT + 0.5)))

        def gain(rows, f, b):
            left = [i for i in rows if bins[i][f] <= b]
            sides = [(sum(g[i] for i in s), sum(h[i] for i in s)) for s in (left, set(rows) - set(left), rows)]
            if min(sides[0][1], sides[1][1]) < urls.MIN_HESSIAN * unit:
                return 0
            return sum(k * a * a / (c + urls.RIDGE * unit) for k, (a, c) in zip((1, 1, -1), sides, strict=True)) / unit

        def walk(node, rows, depth):
            options = [(gain(rows, f, b), f, b) for f in range(len(urls.FEATURES)) for b in range(len(thresholds[f]))] if depth < urls.DEPTH else []
            best = max((o[0] for o in options), default=0)
            if node.feature is None:
                assert best <= 1e-9 + 1e-6 * abs(best) or depth == urls.DEPTH
                a, c = sum(g[i] for i in rows), sum(h[i] for i in rows)
                assert abs(node.value + urls.RATE * a / (c + urls.RIDGE * unit) * urls.UNIT) <= 1
                for i in rows:
                    margins[i] += node.value
                return
            f = urls.FEATURES.index(node.feature)
            assert gain(rows, f, thresholds[f].index(node.at)) == pytest.approx(best, rel=1e-9)
            walk(node.left, [i for i in rows if train[i][0][f] <= node.at], depth + 1)
            walk(node.right, [i for i in rows if train[i][0][f] > node.at], depth + 1)
        walk(tree, list(range(len(train))), 0)


def test_url_plan_is_native(spark, sf):
    plan = urls.judge(spark.read.parquet(f"{sf}/pages.parquet"), URL_RULES)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|ScalaUDF", plan) and "html" not in plan.split("== Physical Plan ==")[1]


# --- source divergence ---

def brute_audit(rows, min_docs, top):
    n, docs, groups = collections.Counter(), collections.Counter(), set()
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        groups.add((lang, source))
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        n.update((lang, source, w) for w in words)
        docs.update((lang, w) for w in set(words))
    kept = collections.defaultdict(set)
    for (lang, w), k in docs.items():
        if k >= min_docs:
            kept[lang].add(w)
    out = []
    for lang, source in groups:
        terms = kept[lang]
        others = [s for lg, s in groups if lg == lang]
        total = {s: sum(n[lang, s, w] for w in terms) for s in others}

        def price(k, size):
            return 1 + 10**9 * (k + 5) // (size + 5 * len(terms))
        lang_n = {w: sum(n[lang, s, w] for s in others) for w in terms}
        pairs = [(s, sum(abs(price(n[lang, source, w], total[source]) - price(n[lang, s, w], total[s])) for w in terms)) for s in others if s != source]
        above = [(w, price(n[lang, source, w], total[source]) - price(lang_n[w], sum(total.values()))) for w in terms if n[lang, source, w]]
        for part, found in (("pair", pairs), ("term", [x for x in above if x[1] > 0])):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(found) if part == "pair" or k < top]
    return set(out)


@pytest.mark.parametrize("groups,block,columns", [(64, 512, 1024), (2, 3, 4)])
def test_divergence_against_brute_force(spark, monkeypatch, groups, block, columns):
    monkeypatch.setattr(divergence, "BLOCK_GROUPS", groups)
    monkeypatch.setattr(divergence, "BLOCK_TERMS", block)
    monkeypatch.setattr(divergence, "COLUMNS", columns)
    rng = random.Random(groups)
    words = ["Alpha", "beta", "GAMMA", "délta", "Ünit", "ünit", "x", "日本", "eps", "zeta", "eta", "theta"]
    rows = [(" ".join(rng.choices(words, range(1, 13), k=rng.randrange(30))) + "1,!", lang, f"s{rng.randrange(7 if rng.random() < .6 else 1)}")
            for lang in ("en", "fr") for _ in range(60)]
    rows += [(None, "en", "empty"), ("", None, None), ("alone", None, "b"), ("beta beta " * 400_000, "en", "long"), rows[0], rows[0], ("q", "one", "only")]
    df = spark.createDataFrame([(*r, "clash", 3) for r in rows], "text string, lang string, source string, term string, n int")
    got = divergence.audit(df, min_docs=4, top_terms=5)
    assert {tuple(r) for r in got.collect()} == brute_audit(rows, 4, 5)
    assert divergence.audit(df.limit(0)).collect() == []
    kept = divergence.kept_terms(df, 4)
    tables = divergence.joint_tables(kept, divergence.group_totals(kept)).collect()
    n = collections.Counter((r["lang"], r["source"], r["term"]) for r in kept.where("term IS NOT NULL").collect())
    terms = collections.defaultdict(set)
    for lang, _, w in n:
        terms[lang].add(w)
    size = collections.Counter()
    for r in tables:
        size[r["lang"], r["a"], r["b"]] += r["terms"]
    assert {k: v for k, v in size.items() if k[0] == "en"} == {k: len(terms["en"]) for k in size if k[0] == "en"}


def test_divergence_flushes_and_cuts_long_texts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "FLUSH", 3)
    monkeypatch.setattr(divergence, "CHUNK", 5)
    rows = [("aa bb cc dd ee ff " * 3 + "g" * 40, "en", "a"), ("aa bb gg", "en", "b")]
    got = divergence.term_counts(spark.createDataFrame(rows, "text string, lang string, source string")).groupBy("term").agg(F.sum("n"), F.sum("docs"))
    assert {tuple(r) for r in got.where("term IS NOT NULL").collect()} == {
        ("aa", 4, 2), ("bb", 4, 2), ("cc", 3, 1), ("dd", 3, 1), ("ee", 3, 1), ("ff", 3, 1), ("g" * 40, 1, 1), ("gg", 1, 1)}


# --- conversation repair ---

def brute_repair(rows):
    """``rows``: (role, text) in order -> (blank, duplicate, truncated, illegal, cost, audit, sha)."""
    faults, seen = [], set()
    for role, text in rows:
        body = text.rstrip(repair.SPACE)
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "k")
        seen.add((role, text))
    best = {0: (0, "", ())}

    def insert(states):
        out = dict(states)
        for _ in range(2):
            for s, (c, a, done) in list(out.items()):
                to = 3 if s == 2 else 2
                one = (c + 5, a + "I", (*done, ("assistant" if to == 3 else "user", "")))
                if to not in out or one[:2] < out[to][:2]:
                    out[to] = one
        return out
    for (role, text), f in zip(rows, faults, strict=True):
        step = {}
        for s, (c, a, done) in insert(best).items():
            moves = [(s, c + 2, "D", done)]
            if f in "kt":
                add = 5 if f == "t" else 0
                to, name = (3, "assistant") if s == 2 else (2, "user")
                moves.append((to, c + add + 1, "R", (*done, (name, text))))
                kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((s, role[:1]))
                if kept is not None:
                    moves.append((kept, c + add, "K", (*done, (role, text))))
            for to, c2, e, done2 in moves:
                if to not in step or (c2, a + e) < step[to][:2]:
                    step[to] = (c2, a + e, done2)
        best = step
    cost, audit, done = min(v for s, v in insert(best).items() if s in (0, 3))
    pairs = list(itertools.pairwise(r[:1] for r, _ in rows))
    return (faults.count("b"), faults.count("d"), faults.count("t"), sum(a + b not in ("su", "ua", "au") for a, b in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest())


def brute_conversations(table, hurt):
    convs = collections.defaultdict(list)
    for conv, turn, role, text in table:
        convs[conv]  # noqa: B018 - every id counts
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if hurt else 19
        role, text = " " if role is None else role, " " if text is None else text
        if h:
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            row = (turn, "user" if h == 4 else role, text)
            convs[conv] += [row] * (2 if h == 3 else 1)
    out = set()
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).hexdigest()))
        turns = {r[0] for r in rows} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.add((conv, gaps, *brute_repair([r[1:] for r in rows])))
    return out


def odd_conversations(seed, n=120):
    rng, rows = random.Random(seed), []
    roles, texts = ["user", "assistant", "system", "tool", "", "u", None], ["Hi.", "yes!", "no", " \n", "", "ok? ", None, "Ja…", "done.\x0b"]
    for conv in range(n):
        for turn in range(rng.randrange(1, 12)):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 5, None, 3]), rng.choice(roles), rng.choice(texts)))
    rows += [(500, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(3000)]  # one long conversation
    rows += [(501, None, "user", "same.")] * 900 + [(None, 0, "user", "a."), (None, 1, "assistant", "b.")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hurt", [True, False])
def test_repair_against_brute_force(spark, monkeypatch, hurt):
    monkeypatch.setattr(repair, "STRETCH", 100)
    rows = odd_conversations(7)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, conv string, audit int")
    prepared = repair.damage(df) if hurt else repair.undamaged(df)
    assert {tuple(r) for r in repair.repair(prepared).collect()} == brute_conversations(rows, hurt)
    assert repair.repair(repair.damage(df.limit(0))).collect() == []


def test_repair_of_dropped_conversations(spark):
    drop = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    got = repair.repair(repair.damage(spark.createDataFrame([(7, drop, "user", "x")], "conv_id long, turn long, role string, text string"))).collect()
    assert [tuple(r) for r in got] == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_grammar_is_exact_and_shortens(spark):
    rng = random.Random(3)
    strings = ["".join(rng.choice(["ua", "ua", "ua", "s", "U", "3", "uu"]) for _ in range(rng.randrange(1, 60))) for _ in range(200)]
    distinct = spark.createDataFrame([(s,) for s in strings], "symbols string").distinct()
    rules = repair.grammar(distinct)
    known = repair.plain_texts(repair.matrices(rules))
    assert any(len(repair.expand(symbol, rules)) >= 8 for symbol, _, _ in rules)  # rules of rules
    short = distinct.select("symbols", repair._compressed(rules).alias("short")).collect()
    assert sum(len(r["short"]) for r in short) < 0.5 * sum(len(r["symbols"]) for r in short)
    for r in short:
        assert repair.expand(r["short"], rules) == r["symbols"]
        assert repair.evaluate(r["short"], known) == repair.evaluate(r["symbols"], known)


def test_dense_products_are_the_joint_tables():
    rng = np.random.default_rng(1)
    levels = [np.array([0, 1, 4]), np.array([0, 2])]
    at = [rng.integers(0, 3, 50), rng.integers(0, 2, 50)]
    x, starts = divergence._one_hot(levels, at, range(2))
    joint = x.T @ x
    assert list(starts) == [0, 3]
    assert joint[1, 4] == sum((a, b) == (1, 1) for a, b in zip(*at, strict=True)) and joint.sum() == 50 * 4
