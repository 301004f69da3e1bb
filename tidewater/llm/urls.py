"""URL filters: a rule list, and gradient-boosted trees on lexical features for the rest.

Everything that touches rows is a DataFrame expression: the features, the suffix statistics,
the histograms that choose the splits, and the trees themselves (one ``CASE`` each). The
driver sees histograms of at most nodes x features x ``BINS`` rows and never a URL.

URLs that a rule fits are the labelled ones. Half of them (by a hash of the URL) give the
suffix statistics, the other half grows the trees, so no URL's own label is among its
features; half of those again are shown to the trees as if their suffixes were unknown, or
the trees would learn nothing but suffixes. The rules say little about the shares of good and bad URLs elsewhere, so both
verdicts weigh the same in the trees. Gradients, leaves and scores are whole numbers (units
of 1 / ``UNIT``), so sums don't depend on the order of rows and a lost executor's rerun
grows the same trees.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ascii_lower_col, materialise

TREES = 8
DEPTH = 3
BINS = 32
RATE = 0.3
RIDGE = 1.0
#: A child with less weight than this (sum of p * (1 - p)) is not split off.
MIN_HESSIAN = 1.0
UNIT = 1 << 16
#: Weights of rows are whole multiples of 1 / ``WEIGHT``.
WEIGHT = 1 << 8
#: Feature values from here on are one value to the trees.
TOP = 4095
#: Weight of the overall share of blocked URLs in a suffix's own share.
PRIOR = 10

FEATURES = ("url_length", "host_length", "path_length", "depth", "host_labels", "digit_share", "host_digits", "entropy",
            "parameters", "query_length", "hyphens", "fragment", "suffix_labelled", "suffix_blocked", "domain_labelled", "domain_blocked")


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, where the path starts with ``path``; ``verdict`` allow or block."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Node:
    """A leaf with ``value`` (in units), or a split: rows with ``feature <= at`` go left."""

    value: int = 0
    feature: str | None = None
    at: int = 0
    left: Node | None = None
    right: Node | None = None

    def sql(self) -> str:
        if self.feature is None:
            return f"{self.value}L"
        return f"CASE WHEN {self.feature} <= {self.at} THEN {self.left.sql()} ELSE {self.right.sql()} END"


@dataclass(frozen=True)
class Model:
    """``suffixes`` (key, n, n_block) is a written table, ``share`` blocked ones per mille.
    Without trees (labels of one kind, or none) nothing is blocked."""

    suffixes: DataFrame | None
    share: int
    trees: tuple[Node, ...]

    def margin(self) -> str:
        """SQL of the log-odds of being blocked, in units, over the feature columns."""
        return " + ".join(["0L", *(t.sql() for t in self.trees)])


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def _until(text: Column, marks: str) -> Column:
    for m in marks:
        text = F.substring_index(text, m, 1)
    return text


def parts(pages: DataFrame, keep: Sequence[str], url_col: str = "url") -> DataFrame:
    """``keep`` columns, ``url`` (null: empty), ``host`` (A-Z lower-cased), ``path``, ``tail``
    (what follows the path). No ``://``: host and path empty, the whole url is tail."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    rows = pages.select(*[F.col(c) for c in keep], url.alias("url"), _after_scheme(url).alias("_rest"))
    host = _until(F.col("_rest"), "/?#")
    rows = rows.select(*keep, "url", "_rest", host.alias("_host"))
    rows = rows.select(*keep, "url", "_host", F.col("_rest").substr(F.length("_host") + 1, F.length("_rest")).alias("_rest"))
    path = _until(F.col("_rest"), "?#")
    rows = rows.select(*keep, "url", ascii_lower_col(F.col("_host")).alias("host"), "_rest", path.alias("path"))
    tail = F.when(F.instr("url", "://") > 0, F.col("_rest").substr(F.length("path") + 1, F.length("_rest"))).otherwise(F.col("url"))
    return rows.select(*keep, "url", "host", "path", tail.alias("tail"))


def rule_columns(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, else null. Among equals the smaller
    name wins, and of one name block."""
    order = sorted(rules, key=lambda r: (-len(r.name), r.name, r.verdict != "block"))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(order):
        host = F.lit(r.host)
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + r.host))) & F.startswith("path", F.lit(r.path))
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def _count(col: str, others: str) -> Column:
    """Characters of ``col`` outside the class ``others``."""
    return F.length(F.regexp_replace(col, f"[{others}]+", ""))


def _entropy(text: Column) -> Column:
    """Entropy of the characters in hundredths of a bit; all non-ASCII ones count as one."""
    plain = F.regexp_replace(text, r"[^\x00-\x7F]+", "¤")
    n = F.length(plain)

    def add(acc, c):
        k = n - F.length(F.replace(plain, c, F.lit("")))
        return acc - k / n * F.log2(k / n)
    bits = F.aggregate(F.array_distinct(F.split(plain, "")), F.lit(0.0), add)
    return F.when(n > 0, F.round(F.lit(100) * bits)).otherwise(0)


def _last_labels(n: int) -> Column:
    return F.substring_index("host", ".", -n)


def lexical(rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`parts` with the features that need no statistics, as whole numbers."""
    def whole(c: Column, name: str) -> Column:
        return F.least(c.cast("long"), F.lit(TOP)).cast("int").alias(name)
    query = F.when(F.startswith("tail", F.lit("?")), _until(F.col("tail"), "#")).otherwise(F.lit(""))
    parameters = F.size(F.filter(F.split(F.substring(query, 2, 1 << 30), "[&;]"), lambda p: p != ""))
    n = F.length("url")
    return rows.select(
        "*", whole(n, "url_length"), whole(F.length("host"), "host_length"), whole(F.length("path"), "path_length"),
        whole(F.size(F.filter(F.split("path", "/"), lambda p: p != "")), "depth"),
        whole(F.size(F.filter(F.split("host", r"\."), lambda p: p != "")), "host_labels"),
        whole(F.when(n > 0, F.floor(1000 * _count("url", "^0-9") / n)).otherwise(0), "digit_share"),
        whole(_count("host", "^0-9"), "host_digits"),
        whole(_entropy(F.col("url")), "entropy"),
        whole(F.when(query == "", 0).otherwise(parameters), "parameters"),
        whole(F.length(query), "query_length"),
        whole(_count("host", "^-"), "hyphens"),
        whole(F.instr("tail", "#") > 0, "fragment"),
        _last_labels(1).alias("_suffix"), _last_labels(2).alias("_domain"))


def suffix_statistics(rows: DataFrame) -> DataFrame:
    """For every last label and last two labels of the hosts of ``rows`` (``host``, ``label`` 1
    block or 0 allow): how many URLs, and how many of them are blocked."""
    keys = F.array_distinct(F.array(_last_labels(1), _last_labels(2)))
    by_host = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("n_block"))
    return by_host.select(F.explode(keys).alias("key"), "n", "n_block").groupBy("key").agg(F.sum("n").alias("n"), F.sum("n_block").alias("n_block"))


def with_suffixes(rows: DataFrame, suffixes: DataFrame, share: int, hide: Column | None = None) -> DataFrame:
    """Adds the suffix features; suffixes without a label, and all of rows where ``hide``
    holds, have 0 URLs and the overall share. Plain left joins: Spark broadcasts the written
    table while it is small by its size on disk, and else joins by key with hot keys split."""
    for kind in ("suffix", "domain"):
        stats = suffixes.select(F.col("key").alias(f"_{kind}"), "n", "n_block")
        rows = rows.join(stats, f"_{kind}", "left")
        n, n_block = (F.coalesce(c if hide is None else F.when(~hide, F.col(c)), F.lit(0)) for c in ("n", "n_block"))
        rows = rows.withColumns({f"{kind}_labelled": F.floor(F.log2(n + 1)).cast("int"),
                                 f"{kind}_blocked": F.floor((1000 * n_block + share * PRIOR) / (n + PRIOR)).cast("int")}).drop("n", "n_block")
    return rows


def _half(url: Column, of: str) -> Column:
    return F.pmod(F.xxhash64(url, F.lit(of)), F.lit(2)) == 0


def cuts(histogram: Sequence[tuple[int, int]], bins: int = BINS) -> list[int]:
    """At most ``bins - 1`` thresholds that part (value, count) rows about evenly, each half
    way between two values that occur."""
    rows = sorted(histogram)
    total, seen, out = sum(n for _, n in rows), 0, []
    for (value, n), (above, _) in pairwise(rows):
        seen += n
        if seen * bins >= total * (len(out) + 1) and len(out) < bins - 1:
            out.append((value + above) // 2)
    return out


def best_split(cells: dict[tuple[int, int], tuple[int, int]], n_cuts: Sequence[int]) -> tuple[int, int] | None:
    """(feature, bin) whose split gains most; the first among equals, None if none gains.
    ``cells``: (feature, bin) -> (sum of gradients, sum of hessians), times ``UNIT * WEIGHT``."""
    best, gain = None, 1e-9
    unit = UNIT * WEIGHT
    ridge = RIDGE * unit
    for f, cut_count in enumerate(n_cuts):
        column = [cells.get((f, b), (0, 0)) for b in range(cut_count + 1)]
        g, h = sum(x for x, _ in column), sum(x for _, x in column)
        gl = hl = 0
        for b in range(cut_count):
            gl, hl = gl + column[b][0], hl + column[b][1]
            if min(hl, h - hl) < MIN_HESSIAN * unit:
                continue
            up = gl * gl / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g * g / (h + ridge)
            if up / unit > gain:
                best, gain = (f, b), up / unit
    return best


def _grow(train: DataFrame, margin: str, thresholds: list[list[int]]) -> Node | None:
    """One tree over ``train`` (a bin for each feature, weights w0 and w1): a job for each level."""
    score = f"({margin}) / {UNIT}.0D"
    p = F.lit(1.0) / (1 + F.exp(-F.expr(score)))
    up = F.round(p * UNIT).cast("long")
    rows = train.withColumns({"_g": F.col("w0") * up - F.col("w1") * (UNIT - up),
                              "_h": (F.col("w0") + F.col("w1")) * F.greatest(F.round(p * (1 - p) * UNIT).cast("long"), F.lit(1))})
    splits: dict[int, tuple[int, int]] = {}  # node -> (feature, bin); children of i are 2i and 2i + 1
    totals: dict[int, tuple[int, int]] = {}
    for level in range(DEPTH):
        frontier = [i for i in range(1 << level, 2 << level) if level == 0 or i // 2 in splits]
        if not frontier:
            break
        node = "1"
        for d in range(level):
            at = f"({node})"
            arms = " ".join(f"WHEN {i} THEN IF({FEATURES[f]} <= {b}, {2 * i}, {2 * i + 1})"
                            for i, (f, b) in sorted(splits.items()) if 1 << d <= i < 2 << d)
            node = f"CASE {at} {arms} ELSE 0 END" if arms else "0"
        bins = F.posexplode(F.array(*[F.col(f) for f in FEATURES])).alias("f", "b")
        sums = (rows.select(F.expr(node).alias("node"), "_g", "_h", bins).where("node > 0")
                .groupBy("node", "f", "b").agg(F.sum("_g").alias("g"), F.sum("_h").alias("h")).collect())
        cells: dict[int, dict] = {i: {} for i in frontier}
        for r in sums:
            cells[r["node"]][(r["f"], r["b"])] = (r["g"], r["h"])
        for i in frontier:
            of_first = [v for (f, _), v in cells[i].items() if f == 0]
            totals[i] = (sum(g for g, _ in of_first), sum(h for _, h in of_first))
            split = best_split(cells[i], [len(t) for t in thresholds])
            if split is not None:
                splits[i] = split
                left = [v for (f, b), v in cells[i].items() if f == split[0] and b <= split[1]]
                gl, hl = sum(g for g, _ in left), sum(h for _, h in left)
                totals[2 * i], totals[2 * i + 1] = (gl, hl), (totals[i][0] - gl, totals[i][1] - hl)

    def build(i: int) -> Node:
        if i in splits:
            f, b = splits[i]
            return Node(feature=FEATURES[f], at=b, left=build(2 * i), right=build(2 * i + 1))
        g, h = totals[i]
        return Node(value=round(-RATE * g / (h + RIDGE * UNIT * WEIGHT) * UNIT))
    return build(1) if splits else None


def _unbin(node: Node, thresholds: dict[str, list[int]]) -> Node:
    if node.feature is None:
        return node
    return Node(feature=node.feature, at=thresholds[node.feature][node.at],
                left=_unbin(node.left, thresholds), right=_unbin(node.right, thresholds))


def fit(rows: DataFrame) -> Model:
    """Fit on ``rows`` of :func:`parts` with ``verdict`` (allow, block or null).

    All labelled rows count, not a sample. They are reduced to one row for each distinct
    vector of bins before the levels read them. Without both verdicts in both halves there is
    nothing to learn: the model has no trees.
    """
    spark = rows.sparkSession
    y = F.when(F.col("verdict") == "block", 1).when(F.col("verdict") == "allow", 0)
    marked = rows.select("url", "host", "path", "tail", y.alias("label"), _half(F.col("url"), "statistics").alias("first")).where("label IS NOT NULL")
    suffixes = materialise(spark, suffix_statistics(marked.where("first")), "url-suffixes")
    n, n_block = marked.where("first").agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    share = (1000 * n_block + 500) // (n + 1)
    grown = with_suffixes(lexical(marked.where("NOT first")), suffixes, share, _half(F.col("url"), "hide"))
    values = materialise(spark, grown.groupBy(*FEATURES).agg(F.sum(1 - F.col("label")).alias("n0"), F.sum("label").alias("n1")), "url-train")
    pair = F.posexplode(F.array(*[F.col(f) for f in FEATURES])).alias("f", "v")
    histogram = values.select((F.col("n0") + F.col("n1")).alias("n"), "n0", "n1", pair).groupBy("f", "v").agg(
        F.sum("n").alias("n"), F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect()  # at most TOP + 1 values of a feature
    n0, n1 = (sum(r[k] for r in histogram if r["f"] == 0) for k in ("n0", "n1"))
    if not n0 or not n1 or not n_block or n_block == n:
        return Model(suffixes, share, ())
    thresholds = [cuts([(r["v"], r["n"]) for r in histogram if r["f"] == i]) for i in range(len(FEATURES))]

    def bin_of(f: str, t: list[int]) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, t)), lambda c: c < F.col(f))).alias(f) if t else F.lit(0).alias(f)
    binned = values.select(*[bin_of(f, t) for f, t in zip(FEATURES, thresholds, strict=True)], "n0", "n1")
    weights = [max(1, round(WEIGHT * (n0 + n1) / (2 * k))) for k in (n0, n1)]
    train = materialise(spark, binned.groupBy(*FEATURES).agg(*[
        (F.sum(f"n{k}") * weights[k]).alias(f"w{k}") for k in (0, 1)]), "url-bins")
    trees: list[Node] = []
    for _ in range(TREES):
        tree = _grow(train, " + ".join(["0L", *(t.sql() for t in trees)]), thresholds)
        if tree is None:
            break
        trees.append(tree)
    by_name = dict(zip(FEATURES, thresholds, strict=True))
    return Model(suffixes, share, tuple(_unbin(t, by_name) for t in trees))


def score(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` of :func:`parts` (any columns beside) with ``score``, the probability of
    being blocked; 0.0 from a model without trees."""
    if not model.trees:
        return rows.withColumn("score", F.lit(0.0))
    kept = rows.columns
    full = with_suffixes(lexical(rows), model.suffixes, model.share)
    return full.withColumn("score", F.lit(1.0) / (1 + F.exp(-F.expr(model.margin()) / F.lit(float(UNIT))))).select(*kept, "score")


def judge(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id, host, path, rule, verdict, score`` for every row of ``pages``.

    The longest rule that fits decides; elsewhere the trees, trained on the URLs that rules
    decide: block from a score above 0.5. Null and empty URLs, and those without ``://``,
    have empty host and path and are judged by their features. Null or repeated ids and
    repeated rows keep their own results; an empty table gives no rows; other columns of any name are ignored.
    """
    name, verdict = rule_columns(rules)
    rows = parts(pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url")), ["_id"], "_url")
    rows = rows.withColumns({"rule": name, "verdict": verdict})
    judged = score(rows, fit(rows))
    final = F.coalesce("verdict", F.when(F.col("score") > 0.5, "block").otherwise("allow"))
    return judged.select(F.col("_id").alias(id_col), "host", "path", "rule", final.alias("verdict"), "score")
