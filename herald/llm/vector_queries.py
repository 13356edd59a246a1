"""The registered queries over ``embeddings``, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herald.llm import caps, centroids, whitening

CLUSTERS, ROUNDS = 8, 10


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = centroids.cluster(_embeddings(spark, sf_dir), CLUSTERS, ROUNDS)
    return rows.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                       F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
                       .alias("centroid_sha256"))


def _clustering_sql() -> str:
    """Every round as two tables: the nearest centroid of each vector, and the means."""
    nearest = """a{i} AS MATERIALIZED (
    SELECT rid, arg_min(c, (dist, c)) AS c, min(dist) AS dist
    FROM (SELECT rid, c, sum((x - v) * (x - v))::BIGINT AS dist FROM parts JOIN c{i} USING (dim) GROUP BY rid, c)
    GROUP BY rid)"""
    means = """c{j} AS MATERIALIZED (
    SELECT o.c, o.dim, coalesce(m.v, o.v) AS v FROM c{i} o LEFT JOIN (
        SELECT c, dim, ((s - ((s % n) + n) % n) // n)::BIGINT AS v
        FROM (SELECT c, dim, sum(x) AS s, count(*) AS n FROM parts JOIN a{i} USING (rid) GROUP BY c, dim)) m
    ON m.c = o.c AND m.dim = o.dim)"""
    steps = [nearest.format(i=i) + ",\n" + means.format(i=i, j=i + 1) for i in range(ROUNDS)]
    return f"""WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id,
           list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS xs
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: isfinite(e::DOUBLE))) = 64),
parts AS MATERIALIZED (SELECT rid, unnest(xs) AS x, generate_subscripts(xs, 1) AS dim FROM kept),
first AS MATERIALIZED (SELECT xs, row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), xs) - 1 AS c FROM kept
    QUALIFY c < {CLUSTERS}),
c0 AS MATERIALIZED (SELECT c, unnest(xs) AS v, generate_subscripts(xs, 1) AS dim FROM first),
{",".join(steps)},
{nearest.format(i=ROUNDS)},
digests AS (SELECT c, sha256(string_agg(v::VARCHAR, ',' ORDER BY dim)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY c)
SELECT vec_id, c::INT AS cluster, dist AS distance, sum(dist) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
       sum(dist) OVER ()::BIGINT AS inertia, centroid_sha256
FROM a{ROUNDS} JOIN kept USING (rid) JOIN digests USING (c)
"""


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_vectors(_embeddings(spark, sf_dir))


NEAR_SQL = """
WITH RECURSIVE v AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm,
           len(e) AS width
    FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)
    WHERE len(e) > 0 AND len(list_filter(e, lambda x: isfinite(x))) = len(e)
      AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS MATERIALIZED (
    SELECT a.rid AS a, b.rid AS b FROM v a JOIN v b ON a.width = b.width AND a.rid <> b.rid
    WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
reach AS (SELECT rid AS a, rid AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
low AS (SELECT a AS rid, min(v.vec_id) AS low FROM reach JOIN v ON v.rid = reach.b GROUP BY a),
counts AS (SELECT a AS rid, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, coalesce(n, 0) AS n_links, low AS component_id, vec_id IS NOT DISTINCT FROM low AS kept
FROM v JOIN low USING (rid) LEFT JOIN counts USING (rid)
UNION ALL
SELECT vec_id, 0, vec_id, true FROM embeddings
WHERE embedding IS NULL OR len(embedding) = 0
   OR len(list_filter(embedding, lambda x: isfinite(x::DOUBLE))) < len(embedding)
   OR len(list_filter(embedding, lambda x: x <> 0)) = 0
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact deviation as a long, as far as it fits one, and whole in ``deviation_exact``."""
    rows = whitening.whiten(_embeddings(spark, sf_dir))
    fits = F.col("deviation") <= F.lit((1 << 63) - 1).cast("decimal(38,0)")
    return rows.select(
        "vec_id", "component", "n", F.when(fits, F.col("deviation").cast("bigint")).alias("deviation"),
        "whitened", "explained", "identity_error", F.col("deviation").alias("deviation_exact"))


QUERIES = {f.__name__: f for f in (op11_centroid_clustering, op12_embedding_near_dedup, op13_whitening)}
ORACLES = {"op11_centroid_clustering": _clustering_sql(), "op12_embedding_near_dedup": NEAR_SQL}
