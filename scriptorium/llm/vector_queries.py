"""The registered queries over ``embeddings`` and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import vector_codes, vector_dedup, whitening
from .base import read_table


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.classes_of(read_table(spark, sf_dir, "embeddings"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.coded(read_table(spark, sf_dir, "embeddings")).drop("label")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(read_table(spark, sf_dir, "embeddings"))


OP11_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda c: c::DOUBLE) AS e,
         embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
         AND len(list_filter(embedding, lambda c: c <> 0)) > 0 AS ok
  FROM embeddings),
p AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.ok AND b.ok AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT reach.x, p.y FROM reach JOIN p ON reach.y = p.x),
c AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
n AS (SELECT x AS vec_id, count(*) AS n_links FROM p GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""

_DISTANCE = " + ".join(f"(part[{k}] - entry[{k}]) * (part[{k}] - entry[{k}])" for k in range(1, 5))


def _round(k: int) -> str:
    """An assignment of the distinct parts and the entries it leads to, for vectors of 64 components."""
    means = ", ".join(f"floor(sum(n * part[{j}])::DOUBLE / sum(n))::BIGINT" for j in range(1, 5))
    return f"""
a{k} AS (SELECT pos, part, n, min(({_DISTANCE}) * 256 + e) AS best FROM parts JOIN c{k} USING (pos) GROUP BY ALL),
m{k} AS (SELECT pos, best % 256 AS e, [{means}] AS moved FROM a{k} GROUP BY ALL),
c{k + 1} AS (SELECT pos, e, coalesce(moved, entry) AS entry FROM c{k} LEFT JOIN m{k} USING (pos, e)),"""


OP12_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
cut AS (SELECT vec_id, label, pos, x[4 * pos + 1 : 4 * pos + 4] AS part FROM (SELECT *, unnest(range(16)) AS pos FROM kept)),
parts AS (SELECT pos, part, count(*) AS n FROM cut GROUP BY ALL),
seed AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS e, x FROM kept ORDER BY vec_id LIMIT 64),
c0 AS (SELECT pos, e, x[4 * pos + 1 : 4 * pos + 4] AS entry FROM (SELECT *, unnest(range(16)) AS pos FROM seed)),
{_round(0)}{_round(1)}
last AS (SELECT pos, part, min(({_DISTANCE}) * 256 + e) AS best FROM parts JOIN c2 USING (pos) GROUP BY ALL),
book AS (
  SELECT sha256(string_agg(v, ',' ORDER BY pos, e, d)) AS codebooks_sha256
  FROM (SELECT pos, e, unnest(range(1, 5)) AS d, unnest(entry)::VARCHAR AS v FROM c2)),
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', best % 256), '' ORDER BY pos) AS code, sum(best // 256)::BIGINT AS error
  FROM cut JOIN last USING (pos, part) GROUP BY vec_id, label),
totals AS (SELECT label, sum(error)::BIGINT AS label_error FROM coded GROUP BY label)
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM coded JOIN totals ON coded.label IS NOT DISTINCT FROM totals.label CROSS JOIN book
"""

QUERIES = {"op11_embedding_dedup": op11_embedding_dedup, "op12_vector_codes": op12_vector_codes, "op13_whitening": op13_whitening}
ORACLES = {"op11_embedding_dedup": OP11_SQL, "op12_vector_codes": OP12_SQL}
