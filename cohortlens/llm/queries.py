"""Registered queries of the training-data operators (whole tables, full
results) and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import (bpe, cover_tree, html_extract, kn_quality, license_scan, line_dedup, minhash_dedup,
                             neighbour_graph, packing, secret_scan, source_audit, topk_search, vector_codes)
from cohortlens.llm.tables import table

VOCAB = public_tokenizers.path("byte_bpe_50k.json")

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(f):
        _QUERIES[name] = f
        if sql:
            _SQL[name] = sql
        return f
    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@register("op5_best_fit_packing")
def op5(spark, sf_dir):
    p = packing.pack(table(spark, sf_dir, "documents"), VOCAB)
    return p.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@register("op8_bpe_transducer")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, VOCAB, bpe.build_lexicon(docs, VOCAB))


@register("op3_exact_topk", """
WITH v AS (
  SELECT vec_id, list_transform(min(embedding), lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20""")
def op3(spark, sf_dir):
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


@register("op7_cover_tree_dedup", """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(min(embedding), lambda x: CAST(x AS DOUBLE)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL GROUP BY vec_id),
u AS (
  SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
      ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a)
SELECT c.vec_id, (SELECT count(*) FROM l WHERE l.a = c.vec_id) AS n_links, component_id,
       c.vec_id = component_id AS kept FROM c""")
def op7(spark, sf_dir):
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"), 0.95)


@register("op6_bottom_k_dedup")
def op6(spark, sf_dir):
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85, width=5)


@register("op10_winnowed_line_dedup")
def op10(spark, sf_dir):
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_deleted", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


@register("op4_credential_linking", secret_scan.duckdb_sql())
def op4(spark, sf_dir):
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


@register("op1_license_sentences", license_scan.duckdb_sql())
def op1(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


@register("op2_kneser_ney_quality")
def op2(spark, sf_dir):
    return kn_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op9_template_extraction")
def op9(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Product codes in SQL: one assignment and one update a round, unrolled."""
    def assigned(r: int) -> str:
        return f"""
a{r} AS MATERIALIZED (
  SELECT part, key, min(struct_pack(d := d, e := e)) AS best FROM (
    SELECT k.part, k.key, b.e, CAST(list_sum(list_transform(list_zip(k.key, b.v), lambda z: CAST((z[1] - z[2]) * (z[1] - z[2]) AS HUGEINT))) AS BIGINT) AS d
    FROM (SELECT DISTINCT part, key FROM p) k JOIN b{r} b USING (part)) GROUP BY part, key)"""

    def updated(r: int) -> str:
        return f"""
b{r + 1} AS MATERIALIZED (
  SELECT b.part, b.e, coalesce(u.v, b.v) AS v FROM b{r} b LEFT JOIN (
    SELECT part, e, list(CAST(CASE WHEN s >= 0 THEN s // c ELSE -((-s + c - 1) // c) END AS BIGINT) ORDER BY i) AS v FROM (
      SELECT p.part, a.best.e AS e, i, CAST(sum(p.key[i]) AS BIGINT) AS s, count(*) AS c
      FROM p JOIN a{r} a ON p.part = a.part AND p.key = a.key, (SELECT unnest(range(1, (SELECT w FROM dims) + 1)) AS i)
      GROUP BY ALL) GROUP BY part, e) u USING (part, e))"""

    steps = ",".join(assigned(r) + "," + updated(r) for r in range(rounds)) + "," + assigned(rounds)
    return f"""
WITH g AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
dims AS (SELECT max(len(x)) // {parts} AS w FROM g),
p AS MATERIALIZED (
  SELECT r, vec_id, label, part, x[part * w + 1:part * w + w] AS key FROM g, dims, (SELECT unnest(range({parts})) AS part)),
b0 AS (
  SELECT part, key AS v, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e
  FROM p WHERE r IN (SELECT r FROM g WHERE vec_id IS NOT NULL ORDER BY vec_id LIMIT {entries})),
{steps},
c AS (
  SELECT p.vec_id, p.label, string_agg(lower(printf('%02x', CAST(a.best.e AS INT))), '' ORDER BY p.part) AS code, CAST(sum(a.best.d) AS BIGINT) AS error
  FROM p JOIN a{rounds} a ON p.part = a.part AND p.key = a.key GROUP BY p.r, p.vec_id, p.label)
SELECT vec_id, code, error, label, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, e)) FROM b{rounds}) AS codebooks_sha256 FROM c"""


@register("op11_trie_vector_codes", _codes_sql())
def op11(spark, sf_dir):
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


@register("op12_nn_descent")
def op12(spark, sf_dir):
    return neighbour_graph.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


@register("op13_source_divergence", r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS MATERIALIZED (SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
s AS (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
gn AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source),
p AS MATERIALIZED (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS count,
    CAST(1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(gn.n, 0) + 2 * v.v) AS BIGINT) AS p,
    CAST(1 + 1000000000::HUGEINT * (k.n + 2) // (v.n + 2 * v.v) AS BIGINT) AS q
  FROM s JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN gn USING (lang, source) LEFT JOIN c USING (lang, source, term)),
x AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  UNION ALL
  SELECT a.lang, a.source, 'pair', b.source, 0 FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source
  WHERE a.lang NOT IN (SELECT lang FROM v)
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE count > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM x)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 10""")
def op13(spark, sf_dir):
    return source_audit.audit(table(spark, sf_dir, "documents"))
