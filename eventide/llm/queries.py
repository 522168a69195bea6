"""The registered queries of this subpackage and the SQL that some are checked with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from eventide.llm import bitplanes, contamination, exact, language, negatives, pages, pieces, ppm, sharding, simhash, tokens, toxicity, warc
from eventide.llm.common import shared_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_centroid_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


@query
def op2_warc_segments(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.archive_and_read(table(spark, folder, "pages"), shared_folder(spark, "warc"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


CHECKS["op2_warc_segments"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d, coalesce(html, '') AS h FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to FROM g"""


@query
def op3_pivot_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(table(spark, folder, "documents")).drop("fp")


@query
def op4_content_sort(spark: SparkSession, folder: str) -> DataFrame:
    return exact.content_sort(table(spark, folder, "documents"))


CHECKS["op4_content_sort"] = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)"""


@query
def op5_phrase_index(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("n_near")


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
CHECKS["op5_phrase_index"] = f"""
WITH a AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT item_id, w, least(13, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, n, unnest([array_to_string(w[i:i + n - 1], ' ') FOR i IN range(1, len(w) - n + 2)]) AS g FROM s),
t AS (SELECT doc_id, n, unnest([array_to_string(w[i:i + n - 1], ' ') FOR i IN range(1, len(w) - n + 2)]) AS g,
             unnest(range(1, len(w) - n + 2)) AS i FROM a, (SELECT DISTINCT n FROM q) WHERE len(w) >= n),
m AS (SELECT doc_id, i, n, item_id FROM t JOIN q USING (n, g)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
k AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT a.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM a LEFT JOIN h ON h.doc_id = a.doc_id LEFT JOIN k ON k.doc_id = a.doc_id"""


@query
def op6_pieces_scan(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode(table(spark, folder, "documents"))


@query
def op7_page_differencing(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages"))


@query
def op8_ppm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return ppm.scores(table(spark, folder, "documents"))


@query
def op9_string_kernel_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op10_feistel_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.feistel_shards(table(spark, folder, "documents"))


@query
def op11_patched_frames(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_spans(table(spark, folder, "documents"))


@query
def op12_one_bit_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mine(table(spark, folder, "embeddings"))


CHECKS["op12_one_bit_negatives"] = """
WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS c FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, v.vec_id, v.label = a.label AS same, CAST(list_inner_product(a.c, v.c) AS BIGINT) AS score
  FROM v a JOIN v ON v.vec_id <> a.vec_id AND len(v.c) = len(a.c) WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 3"""


@query
def op13_bit_plane_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return bitplanes.cluster(table(spark, folder, "embeddings"))


def _clusters_sql(rounds: int = 3) -> str:
    """Assignment and means, written out round by round."""
    steps = [r"""WITH v AS MATERIALIZED (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS c FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), c) - 1 AS k, c FROM v QUALIFY k < 16)"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT vec_id, c, arg_min(k, struct_pack(d := d, k := k)) AS k, min(d) AS d FROM (
  SELECT vec_id, v.c, k, list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(v.c, m.c)]) AS d FROM v, c{i} m) GROUP BY vec_id, c)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT o.k, coalesce(n.c, o.c) AS c FROM c{i} o LEFT JOIN (
  SELECT k, list(m ORDER BY j) AS c FROM (SELECT k, j, CAST(floor(sum(x)::DOUBLE / count(*)) AS BIGINT) AS m
    FROM (SELECT k, unnest(c) AS x, unnest(range(64)) AS j FROM a{i}) GROUP BY k, j) GROUP BY k) n ON n.k = o.k)""")
    return ",\n".join(steps) + f"""
SELECT vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} m ON m.k = a.k"""


CHECKS["op13_bit_plane_clusters"] = _clusters_sql()


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
