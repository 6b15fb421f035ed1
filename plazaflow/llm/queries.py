"""The corpus operators as queries over the supplied tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from plazaflow.llm import (curriculum, decontaminate, exact_dedup, html_text, line_dedup, merkle, quality_rules, secrets, shingle_join, token_counts, toxicity,
                           url_filter, vector_codes)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLE[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query("op1_line_dedup", f"""
WITH lines AS (
    SELECT doc_id, i, x[i] AS line FROM (SELECT doc_id, x, unnest(range(1, len(x) + 1)) AS i
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents))),
keyed AS (SELECT *, {lower(f"trim(line, {SPACES})")} AS k FROM lines),
often AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT keyed.*, often.k IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN often USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""")
def op1(spark, sf_dir):
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", "kept_sha256")


@query("op2_toxicity")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.grade_texts(docs, model).select(F.col("row.doc_id").alias("doc_id"), "severity", "grade", "toxic")


@query("op3_shingle_join", f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all({lower("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
    SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
linked AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked),
reach(x, y) AS (SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x)
SELECT d.doc_id, coalesce(max(n), 0) AS n_shingles, least(d.doc_id, coalesce(min(r.y), d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN reach r ON r.x = d.doc_id GROUP BY d.doc_id""")
def op3(spark, sf_dir):
    return shingle_join.near_components(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


@query("op4_curriculum_mix")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = curriculum.with_places(curriculum.mix(docs, carry=["doc_id"]))
    return mixed.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken", "position", "place")


@query("op5_exact_dedup", """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
    sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""")
def op5(spark, sf_dir):
    return exact_dedup.equal_texts(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op6_html_text")
def op6(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def _secret_sql() -> str:
    """Spans from the lengths of what stands between matches, for each rule."""
    letters = {"password": "[pP][aA][sS][sS][wW][oO][rR][dD]", "passwd": "[pP][aA][sS][sS][wW][dD]", "secret": "[sS][eE][cC][rR][eE][tT]",
               "token": "[tT][oO][kK][eE][nN]", "api_?key": "[aA][pP][iI]_?[kK][eE][yY]"}
    parts = []
    for i, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("(?i:password|passwd|secret|token|api_?key)", "|".join(letters.values())).replace("'", "''")
        parts.append(f"""SELECT doc_id, {i} AS o, '{rule.kind}' AS kind, unnest(list_transform(range(1, len(m) + 1), lambda j: {{
            's': list_sum(list_transform(g[1:j], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:j - 1], lambda x: length(x))), 0),
            'n': length(m[j]), 'k': length(v[j])}})) AS f
        FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS v,
            string_split_regex(t, '{pattern}') AS g FROM texts) WHERE len(m) > 0""")
    found = " UNION ALL ".join(f"SELECT * FROM ({p}) WHERE f.k >= {r.least}" for p, r in zip(parts, secrets.RULES))
    span, order = "kind || ':' || CAST(f.s AS BIGINT) || ':' || CAST(f.s + f.n AS BIGINT)", "ORDER BY f.s, o"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE)
    return f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), found AS ({found})
        SELECT doc_id, {counts}, sha256(coalesce(string_agg({span}, ',' {order}) FILTER (WHERE o < {len(secrets.BASE)}), '')) AS base_sha256,
            coalesce(string_agg({span}, ',' {order}) FILTER (WHERE o IS NOT NULL), '') AS spans
        FROM documents LEFT JOIN found USING (doc_id) GROUP BY doc_id"""


@query("op7_secret_ledger", _secret_sql())
def op7(spark, sf_dir):
    return secrets.secret_digest(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("blob")


@query("op8_token_counts")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source").withColumn("edits", token_counts.revision_edits())
    counted = token_counts.count_with_edits(docs)
    return counted.select(F.col("row.doc_id").alias("doc_id"), "n_pieces", "n_tokens", "n_edits", "n_tokens_edited", "n_reencoded")


def _url_sql(limit: float = 0.25, z: float = 1.645) -> str:
    known = "|".join(s.replace(".", r"\.") for s in url_filter.SUFFIXES)
    cases = []
    for rule, verdict in sorted(url_filter.RULES, key=lambda r: -len(r[0])):
        host, slash, tail = rule.partition("/")
        cases.append((f"(host = '{host}' OR suffix_of(host, '.{host}')) AND prefix_of(path, '{slash + tail}')", rule, verdict))
    text = lambda i: " ".join(f"WHEN {c[0]} THEN '{c[i]}'" for c in cases)
    fix = lambda s: s.replace("suffix_of(", "ends_with(").replace("prefix_of(", "starts_with(")
    strength = """SELECT least(greatest(1 / greatest(coalesce(sum(pow(bad - n * m, 2) - n * m * (1 - m)) / nullif(sum(n * m * (1 - m) * (n - 1)), 0), 0), 1e-9) - 1, 1), 1000) AS s FROM """
    return fix(f"""
WITH split AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
named AS (
    SELECT page_id, {lower("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split),
leveled AS (SELECT *, regexp_extract(host, '(?:^|\\.)({known}|[^.]+)$', 1) AS suffix,
    regexp_extract(path, '/([0-9]{{1,18}})(?:[./][^0-9]*)?$', 1) AS number FROM named),
rows_ AS (SELECT *, CASE WHEN length(host) <= length(suffix) THEN host
    ELSE string_split(left(host, length(host) - length(suffix) - 1), '.')[-1] || '.' || suffix END AS domain,
    CASE {text(1)} END AS rule, CASE {text(2)} END AS said FROM leveled),
outcome AS (SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
h0 AS (SELECT host, domain, suffix, CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS bad
    FROM rows_ LEFT JOIN outcome ON number <> '' AND doc_id = TRY_CAST(number AS BIGINT) GROUP BY 1, 2, 3),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h0 GROUP BY 1, 2),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d0 GROUP BY 1),
s1 AS (SELECT *, (SELECT (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1) FROM s0) AS m FROM s0),
s2 AS (SELECT suffix, (bad + s * m) / (n + s) AS m FROM s1, ({strength} s1)),
d1 AS (SELECT d0.*, m FROM d0 JOIN s2 USING (suffix)),
d2 AS (SELECT domain, suffix, (bad + s * m) / (n + s) AS m FROM d1, ({strength} d1)),
h1 AS (SELECT h0.*, m FROM h0 JOIN d2 USING (domain, suffix)),
h2 AS (SELECT host, bad + s * m AS a, n - bad + s * (1 - m) AS b FROM h1, ({strength} h1)),
h3 AS (SELECT host, a / (a + b) - {z} * sqrt(a * b / (pow(a + b, 2) * (a + b + 1))) AS low FROM h2)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN low > {limit} THEN 'block' ELSE 'allow' END) AS verdict
FROM rows_ JOIN h3 USING (host)""")


@query("op9_host_reputation", _url_sql())
def op9(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, table(spark, sf_dir, "labels")).select("page_id", "host", "path", "rule", "verdict")


WORDS = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"


@query("op10_fm_decontamination", f"""
WITH words AS (SELECT doc_id, regexp_extract_all({lower("coalesce(text, '')")}, {WORDS}) AS w FROM documents),
items AS (SELECT item_id, w, least(len(w), 10) AS k FROM (
    SELECT item_id, regexp_extract_all({lower("coalesce(text, '')")}, {WORDS}) AS w FROM benchmark) WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, s FROM (
    SELECT item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s FROM items)),
places AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s FROM (
    SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT DISTINCT k FROM items) WHERE len(w) >= k)),
found AS (SELECT doc_id, i, k, item_id FROM places JOIN windows USING (k, s)),
hits AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM found) GROUP BY 1),
names AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(names.n, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
    hits.n IS NOT NULL AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN names USING (doc_id)""")
def op10(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_merkle_manifest")
def op11(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    return merkle.manifest(docs).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query("op12_vector_codes")
def op12(spark, sf_dir):
    coded, _ = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


@query("op13_quality_rules")
def op13(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = quality_rules.judge(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by")


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
