"""The ``opN_*`` queries: each operator over its whole table, with production parameters."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loanlab.llm.text import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public vocabulary files lie; a parameter of the operators."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loanlab.llm import bpe
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())



OP9_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS t FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, COUNT(*) AS c
      FROM e a JOIN e b ON a.t = b.t AND a.doc_id < b.doc_id AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n) GROUP BY 1, 2),
l AS (SELECT x, y FROM p WHERE 100 * c >= 80 * (nx + ny - c)),
d AS (SELECT x AS u, y AS v FROM l UNION SELECT y, x FROM l),
r(node, seen) AS (SELECT u, u FROM d UNION SELECT r.node, d.v FROM r JOIN d ON r.seen = d.u),
m AS (SELECT node, MIN(seen) AS root FROM r GROUP BY 1)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, coalesce(root, s.doc_id) AS component_id FROM s LEFT JOIN m ON s.doc_id = m.node
"""


@query("op9_jaccard_join", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loanlab.llm import jaccard
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
a AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50),
g AS (SELECT a.doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h FROM a JOIN w ON a.doc_id = w.doc_id),
f AS (SELECT h, MIN(doc_id) AS first FROM g GROUP BY 1),
c AS (SELECT DISTINCT g.doc_id, unnest(range(i, i + 50)) AS p FROM g JOIN f ON g.h = f.h WHERE f.first < g.doc_id),
d AS (SELECT doc_id, list(p) AS ps FROM c GROUP BY 1),
k AS (SELECT w.doc_id, len(ws) AS n, list_transform(CASE WHEN ps IS NULL THEN range(1, len(ws) + 1)
        ELSE list_filter(range(1, len(ws) + 1), lambda p: NOT list_contains(ps, p)) END, lambda p: ws[p]) AS kept FROM w LEFT JOIN d ON w.doc_id = d.doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n - len(kept) AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""


@query("op8_substring_dedup", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loanlab.llm import substr
    return substr.substring_dedup(table(spark, sf_dir, "documents"), digest=True)


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loanlab.llm import langid
    return langid.fit_and_predict(table(spark, sf_dir, "documents"))


@query("op7_decontamination")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loanlab.llm import decontam
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP3_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings WHERE embedding IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op3_topk_search", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loanlab.llm import topk
    v = table(spark, sf_dir, "embeddings")
    return topk.top_k(v, v.where("vec_id % 100 = 0"))


def _op2_sql() -> str:
    from loanlab.llm.license_scan import BASE, TEMPLATES
    rows = ", ".join(f"({i}, '{label}', '{notice}', '{key}')" for i, (label, notice, key) in enumerate(TEMPLATES))
    base = ", ".join(f"('{label}', '{phrase}')" for label, phrase in BASE)
    return rf"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
t AS (SELECT tid, label, string_split(notice, ' ') AS nw, string_split(k, ' ') AS kw, len(string_split(split_part(notice, k, 1), ' ')) - 1 AS start FROM (VALUES {rows}) AS v(tid, label, notice, k)),
d AS (SELECT x AS word, ln((1.0 + (SELECT COUNT(*) FROM w)) / (1 + (SELECT COUNT(*) FROM w WHERE list_contains(ws, x)))) + 1e-6 AS idf FROM (SELECT DISTINCT unnest(nw) AS x FROM t)),
p AS (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
h AS (SELECT p.r, p.ws, p.i, tid, label, nw, start FROM p JOIN t ON p.ws[p.i] = t.kw[1] AND p.ws[p.i:p.i + len(kw) - 1] = kw),
u AS (SELECT r, i, tid, label, ws[i - start + j - 1] = nw[j] AS eq, nw[j] AS word FROM (SELECT *, unnest(range(1, len(nw) + 1)) AS j FROM h)),
s AS (SELECT r, i, tid, label, SUM(CASE WHEN eq THEN idf ELSE 0 END) / SUM(idf) AS share FROM u JOIN d ON u.word = d.word GROUP BY ALL),
b AS (SELECT p.r, p.i, label FROM p JOIN (SELECT label, string_split(phrase, ' ') AS kw FROM (VALUES {base}) AS v(label, phrase)) ON p.ws[p.i] = kw[1] AND p.ws[p.i:p.i + len(kw) - 1] = kw),
bb AS (SELECT r, COUNT(*) AS n, MIN(i) - 1 AS lo, MAX(i) - 1 AS hi FROM b GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
  coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM b WHERE b.r = w.r), '') AS base_labels,
  coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM (SELECT r, label FROM b UNION SELECT r, label FROM s) x WHERE x.r = w.r), '') AS labels,
  round(coalesce((SELECT MAX(share) FROM s WHERE s.r = w.r), 0), 6) AS score
FROM w LEFT JOIN bb ON w.r = bb.r
"""


@query("op2_license_scan", _op2_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loanlab.llm import license_scan
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


@query("op6_url_filter")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loanlab.llm import urls
    return urls.judge(table(spark, sf_dir, "pages"))


@query("op5_pii")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loanlab.llm import pii
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pii.pseudonymise(docs)
    return out.withColumnsRenamed({"_entities": "n_entities", "_kinds": "kinds"})


@query("op10_html_text")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loanlab.llm import html
    return html.train_and_extract(table(spark, sf_dir, "pages"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, MAX(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING COUNT(DISTINCT doc_id) >= 3),
j AS (SELECT k.r, k.i, k.line, coalesce(k.doc_id < f.keeper, false) AS gone FROM k LEFT JOIN f ON k.key = f.key),
c AS (SELECT *, lead(gone) OVER (PARTITION BY r ORDER BY i) AS next, i = 1 AND gone AS at_once FROM j),
s AS (SELECT r, COUNT(*) AS n, COUNT(*) FILTER (WHERE gone) AS g, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS kept,
    (CASE WHEN bool_or(at_once) THEN '0,' ELSE '' END) || string_agg(i, ',' ORDER BY i) FILTER (WHERE next IS DISTINCT FROM gone) AS keep FROM c GROUP BY r)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_lines, CAST(g AS BIGINT) AS n_dropped, sha256(kept) AS kept_sha256, keep FROM d JOIN s ON d.r = s.r
"""


@query("op11_line_dedup", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from loanlab.llm import linededup
    out = linededup.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"), F.array_join("keep", ",").alias("keep"))


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loanlab.llm import periodic
    return periodic.run_digests(table(spark, sf_dir, "documents"), prepare=periodic.made_periodic)


OP13_SQL = r"""
WITH RECURSIVE bits(b, c, n) AS (SELECT b, CAST(b AS BIGINT), 0 FROM range(256) t(b) UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n + 1 FROM bits WHERE n < 8),
steps AS (SELECT b, c FROM bits WHERE n = 8),
sums(id, s, v) AS (SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR), CAST(4294967295 AS BIGINT) FROM documents
  UNION ALL SELECT id, s[2:], xor(v >> 8, steps.c) FROM sums JOIN steps ON steps.b = xor(v & 255, ascii(s[1])) WHERE length(s) > 0),
crc AS (SELECT id, xor(v, 4294967295) AS c FROM sums WHERE s IS NULL OR s = ''),
e AS (SELECT row_number() OVER () AS r, doc_id, lang, crc.c,
    [CASE WHEN x IS NULL THEN '-' ELSE strlen(x) || ':' || x END FOR x IN [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text]] AS p,
    CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || CAST(n_chars + 1 AS VARCHAR) END AS q
  FROM documents JOIN crc ON documents.doc_id IS NOT DISTINCT FROM crc.id),
l AS (SELECT r, doc_id, lang, CASE WHEN lang IS NULL THEN '' ELSE '.' || lang END AS g, sha256(array_to_string(p, '')) AS leaf,
    CASE WHEN c % 7 = 0 THEN sha256(p[1] || p[2] || p[3] || q || p[5]) ELSE sha256(array_to_string(p, '')) END AS offered FROM e),
o AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, COUNT(*) OVER (PARTITION BY g) AS n FROM l),
t(g, k, i, n, h) AS (SELECT g, 0, i, n, leaf FROM o UNION ALL
  SELECT g, k + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE n > 1 GROUP BY g, k, i // 2, n),
sr AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS i, COUNT(*) OVER () AS n FROM t WHERE n = 1),
u(k, i, n, h) AS (SELECT 0, i, n, h FROM sr UNION ALL SELECT k + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY k, i // 2, n),
sib AS (SELECT o.r, t.k AS k, t.h, t.i & 1 AS side FROM o JOIN t ON o.g = t.g AND t.i = xor(o.i >> t.k, 1)
  UNION ALL SELECT o.r, 1000 + u.k, u.h, u.i & 1 FROM o JOIN sr ON o.g = sr.g JOIN u ON u.i = xor(sr.i >> u.k, 1)),
way AS (SELECT o.r, t.k FROM o JOIN (SELECT DISTINCT g, k FROM t WHERE n > 1) t ON o.g = t.g UNION ALL SELECT o.r, 1000 + u.k FROM o, (SELECT DISTINCT k FROM u WHERE n > 1) u),
steps_up AS (SELECT way.r, row_number() OVER (PARTITION BY way.r ORDER BY way.k) AS s, sib.h, sib.side FROM way LEFT JOIN sib ON way.r = sib.r AND way.k = sib.k),
f(r, s, h) AS (SELECT r, 0, offered FROM o UNION ALL
  SELECT f.r, f.s + 1, sha256(CASE WHEN p.h IS NULL THEN f.h WHEN p.side = 0 THEN p.h || f.h ELSE f.h || p.h END) FROM f JOIN steps_up p ON f.r = p.r AND p.s = f.s + 1),
proof AS (SELECT r, string_agg(h, '' ORDER BY k) AS path FROM sib GROUP BY r),
root AS (SELECT h FROM u WHERE n = 1),
ends AS (SELECT r, arg_max(h, s) AS h FROM f GROUP BY r)
SELECT o.doc_id, o.leaf, sr.h AS subroot, root.h AS root, sha256(coalesce(proof.path, '')) AS proof_sha256, ends.h AS folded_root, ends.h = root.h AS verified
FROM o JOIN sr ON o.g = sr.g CROSS JOIN root JOIN ends ON o.r = ends.r LEFT JOIN proof ON o.r = proof.r
"""


@query("op13_merkle_manifest", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loanlab.llm import merkle
    return merkle.document_manifest(table(spark, sf_dir, "documents"))
