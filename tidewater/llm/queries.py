"""The registered queries of this package and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import (chat, collisions, contamination, divergence, licenses, lines, minmax, packing, quality, repair, secrets,
                           toxicity, urls)
from tidewater.plans.registry import table

VOCAB, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def op1_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.digest_columns(secrets.scan(table(spark, sf, "documents")))


def op2_chat_collapse(spark: SparkSession, sf: str) -> DataFrame:
    return chat.collapse(table(spark, sf, "conversations"))


def op3_compression_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = quality.fit(docs, table(spark, sf, "labels"), train=lambda i: ~quality.held_out(i, 5, 0))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"), "difference")


def op4_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return lines.repeats(table(spark, sf, "documents"))


def op5_pow2_packing(spark: SparkSession, sf: str) -> DataFrame:
    packed = packing.pack(table(spark, sf, "documents"), public_tokenizers.path(VOCAB), public_tokenizers.path(RANKS))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = contamination.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), "contaminated")


def op7_minmax_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return minmax.components(table(spark, sf, "documents"))


def op8_license_diagonals(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.digest_columns(licenses.scan(table(spark, sf, "documents")))


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity.fit(docs, table(spark, sf, "labels"), train=lambda i: ~quality.held_out(i, 3, 1))
    return toxicity.score(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"), F.array_join("terms", ",").alias("terms"))


def op10_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return collisions.near_duplicates(table(spark, sf, "embeddings"))


URL_RULES = (urls.Rule("allow", "com"), urls.Rule("block", "example.com", "/en/"), urls.Rule("allow", "www.example.com", "/en/"),
             urls.Rule("block", "net", "/es/"), urls.Rule("block", "net", "/fr/"))


def op11_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge(table(spark, sf, "pages"), URL_RULES)


def op12_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(table(spark, sf, "documents"))


def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    return repair.repair(repair.damage(table(spark, sf, "conversations"))).withColumnRenamed("conv", "conv_id")


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_chat_collapse, op3_compression_quality, op4_line_dedup, op5_pow2_packing, op6_decontamination,
    op7_minmax_dedup, op8_license_diagonals, op9_toxicity, op10_embedding_dedup, op11_url_filter, op12_source_divergence,
    op13_conversation_repair)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACE = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

ORACLES = {
    "op2_chat_collapse": """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT conv_id, row_number() OVER w - 1 AS pos, '<|' || role || '|>' || chr(10) || text || chr(10) AS line
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
r AS (SELECT conv_id, pos, md5(string_agg(md5(line), ',') OVER (PARTITION BY conv_id ORDER BY pos)) AS h,
             pos = max(pos) OVER (PARTITION BY conv_id) AS last FROM p),
e AS (SELECT h, min(conv_id) AS conv_id, max(pos) + 1 AS n_turns, count(*) AS n_copies FROM r WHERE last GROUP BY h),
k AS (SELECT conv_id, n_turns, n_copies FROM e WHERE h NOT IN (SELECT h FROM r WHERE NOT last))
SELECT conv_id, CAST(pos // 1024 AS BIGINT) AS part, CAST(n_turns AS BIGINT) AS n_turns, n_copies,
       string_agg(line, '' ORDER BY pos) AS rendered
FROM p JOIN k USING (conv_id) GROUP BY conv_id, pos // 1024, n_turns, n_copies""",
    "op6_decontamination": f"""
WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
b AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, list_slice(w, i, i + least(len(w), 13) - 1) AS g
        FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
g AS (SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS g
      FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, i, g.n AS n FROM g JOIN win ON g.n = win.n AND g.g = win.g),
h AS (SELECT doc_id, count(DISTINCT hit) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS hit FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op7_minmax_dedup": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACE} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM d),
x AS (SELECT doc_id, unnest(g) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN s p ON p.doc_id = a JOIN s q ON q.doc_id = b WHERE 100 * i >= 85 * (len(p.g) + len(q.g) - i)),
r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, m.c AS component_id, m.c = doc_id AS kept
FROM s JOIN (SELECT a, min(b) AS c FROM r GROUP BY a) m ON m.a = doc_id""",
    "op10_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
       AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT vec_id, coalesce(n, 0) AS n_links, c AS component_id, c = vec_id AS kept
FROM v JOIN (SELECT a, min(b) AS c FROM r GROUP BY a) m ON m.a = vec_id
LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) k ON k.a = vec_id""",
    "op12_source_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT id, lang, source, term, count(*) AS n FROM (SELECT id, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
k AS (SELECT lang, term, CAST(sum(n) AS BIGINT) AS ln FROM t GROUP BY lang, term HAVING count(*) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, CAST(sum(n) AS BIGINT) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
lt AS (SELECT lang, count(*) AS v, CAST(sum(ln) AS BIGINT) AS ln FROM k GROUP BY lang),
gt AS (SELECT lang, source, CAST(coalesce(sum(n), 0) AS BIGINT) AS gn FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
x AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (gn + 5 * v) AS p,
             1 + (1000000000::HUGEINT * (k.ln + 5)) // (lt.ln + 5 * v) AS q
      FROM g JOIN k ON g.lang = k.lang JOIN lt ON lt.lang = g.lang JOIN gt ON gt.lang = g.lang AND gt.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pv AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
       FROM x a JOIN x b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pr AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
       FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
       LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
tm AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM x WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
      FROM (SELECT * FROM pr UNION ALL SELECT * FROM tm))
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50""",
    "op13_conversation_repair": """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
x AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (SELECT x.*, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda c: CAST(ord(c) AS BIGINT))),
             lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 20 AS h FROM x, crc),
r0 AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
              CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
              unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy FROM h WHERE h <> 0),
r1 AS (SELECT conv_id, turn, role, text, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS e,
              row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || ':' || text)) AS pos FROM r0),
r AS (SELECT *, CASE WHEN e = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
                     WHEN right(e, 1) NOT IN ('.', '!', '?') THEN 't' ELSE 'k' END AS f, left(role, 1) AS i,
             left(role, 1) || '>' || lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS two FROM r1),
ins(a, b, c, s) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 5, 'I'), (0, 3, 10, 'II'),
                    (1, 2, 5, 'I'), (1, 3, 10, 'II'), (2, 3, 5, 'I'), (3, 2, 5, 'I')),
ed(a, b, i, c, s) AS (VALUES (0, 0, '', 2, 'D'), (1, 1, '', 2, 'D'), (2, 2, '', 2, 'D'), (3, 3, '', 2, 'D'),
                      (0, 2, '', 1, 'R'), (1, 2, '', 1, 'R'), (3, 2, '', 1, 'R'), (2, 3, '', 1, 'R'),
                      (0, 1, 's', 0, 'K'), (0, 2, 'u', 0, 'K'), (1, 2, 'u', 0, 'K'), (3, 2, 'u', 0, 'K'), (2, 3, 'a', 0, 'K')),
mv AS (SELECT ins.a, ed.b, ed.i, ins.c + ed.c AS c, ed.s AS op, ins.s || ed.s AS s FROM ins JOIN ed ON ins.b = ed.a),
dp(conv_id, pos, st, best) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 0, {'c': 0, 's': ''} FROM (SELECT DISTINCT conv_id FROM r)
  UNION ALL
  SELECT dp.conv_id, r.pos, mv.b, min({'c': dp.best.c + mv.c + CASE WHEN r.f = 't' AND mv.op <> 'D' THEN 5 ELSE 0 END, 's': dp.best.s || mv.s})
  FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.pos = dp.pos + 1
  JOIN mv ON mv.a = dp.st AND (mv.i = '' OR mv.i = r.i) AND (r.f NOT IN ('b', 'd') OR mv.op = 'D')
  GROUP BY dp.conv_id, r.pos, mv.b),
n AS (SELECT conv_id, max(pos) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
             count(*) FILTER (f = 'b') AS blank, count(*) FILTER (f = 'd') AS duplicate, count(*) FILTER (f = 't') AS truncated,
             count(*) FILTER (two NOT IN ('s>u', 'u>a', 'a>u')) AS illegal FROM r GROUP BY conv_id),
fin AS (SELECT dp.conv_id, min({'c': best.c + e.c, 's': best.s || e.s}) AS best
        FROM dp JOIN n ON n.conv_id IS NOT DISTINCT FROM dp.conv_id AND n.n = dp.pos
        JOIN (VALUES (0, 0, ''), (1, 10, 'II'), (2, 5, 'I'), (3, 0, '')) e(st, c, s) ON e.st = dp.st GROUP BY dp.conv_id),
ops AS (SELECT conv_id, k, op, count(*) FILTER (op <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS pos,
               count(*) FILTER (op <> 'D') OVER (PARTITION BY conv_id ORDER BY k) AS line
        FROM (SELECT conv_id, unnest(generate_series(1, length(best.s))) AS k, unnest(string_split(best.s, '')) AS op FROM fin WHERE best.s <> '')),
roles AS (SELECT o.*, r.role, CASE WHEN op = 'I' THEN '' ELSE r.text END AS text,
                 max(CASE WHEN op = 'K' AND r.i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY o.conv_id) AS has_system
          FROM ops o LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM o.conv_id AND r.pos = o.pos AND o.op <> 'I' WHERE op <> 'D'),
sha AS (SELECT conv_id, sha256(string_agg((CASE WHEN op = 'K' THEN role WHEN (line - has_system) % 2 = 1 THEN 'user' ELSE 'assistant' END)
                                          || ':' || text, chr(10) ORDER BY k)) AS h FROM roles GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
       coalesce(best.s, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN fin ON fin.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN sha ON sha.conv_id IS NOT DISTINCT FROM o.conv_id""",
}
