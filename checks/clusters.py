from pyspark.sql import functions as F

from checks import check
from checks.features import wide
from tillwise.operators import clusters as c, features


def products(s):
    return features.product_wide(s.dim_product, s.sales_lines, s.fact_product_review, s.fact_refund, s.fact_inventory_movement)


@check("j01_user_clusters")
def _(s, spark):
    return c.user_profiles(c.cluster_users(wide(s)))


@check("j02_elbow")
def _(s, spark):
    f = c.vectors(wide(s), c.USER_FEATURES, ("user_id",)).select("user_id", "features").persist()
    try:
        return c.elbow(f)
    finally:
        f.unpersist()


@check("j03_silhouettes")
def _(s, spark):
    f = c.vectors(wide(s), c.USER_FEATURES, ("user_id",)).select("user_id", "features").persist()
    try:
        return c.silhouettes(f)
    finally:
        f.unpersist()


@check("j03_euclidean_silhouette", """
    WITH e AS (SELECT vec_id AS id, label AS c, embedding::DOUBLE[] AS x FROM embeddings WHERE label >= 0), n AS (SELECT c, count(*) AS size FROM e GROUP BY 1),
         t AS (SELECT q.id, q.c AS own, a.c, sum(list_distance(q.x, a.x)) AS total FROM e q, e a WHERE q.id % 50 = 0 GROUP BY 1, 2, 3),
         m AS (SELECT id, sum(CASE WHEN own = t.c THEN total / nullif(size - 1, 0) END) AS a, min(CASE WHEN own <> t.c THEN total / size END) AS b
               FROM t JOIN n ON t.c = n.c GROUP BY 1)
    SELECT round(avg(coalesce((b - a) / nullif(greatest(a, b), 0), 0)), 4) AS silhouette FROM m""")
def _(s, spark):
    e = s._source.raw("embeddings")
    return c.silhouette(e.select("vec_id", F.col("label").alias("cluster"), F.col("embedding").alias("x")), "vec_id", every=50)


@check("j04_calinski_harabasz", """
    WITH e AS (SELECT label, unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS d FROM embeddings),
         g AS (SELECT label, d, count(*) AS n, sum(v) AS s, sum(v * v) AS q FROM e GROUP BY 1, 2), m AS (SELECT d, sum(s) / sum(n) AS mu FROM g GROUP BY 1)
    SELECT round((sum(n * pow(s / n - mu, 2)) / (count(DISTINCT label) - 1)) / (sum(q - s * s / n) / ((SELECT count(*) FROM embeddings) - count(DISTINCT label))), 2) AS calinski_harabasz
    FROM g JOIN m ON g.d = m.d""")
def _(s, spark):
    e = s._source.raw("embeddings")
    return c.calinski_harabasz(e.select(F.col("label").alias("cluster"), F.col("embedding").cast("array<double>").alias("x")))


@check("j05_product_clusters")
def _(s, spark):
    return c.product_profiles(c.cluster_products(products(s)))


@check("j06_hierarchical")
def _(s, spark):
    return c.hierarchical(c.vectors(wide(s), c.COMPARED_FEATURES, ("user_id",)).select("user_id", "features")).select("user_id", "cluster")


@check("j07_density_clusters")
def _(s, spark):
    from pyspark.ml.functions import vector_to_array
    f = c.vectors(wide(s), c.COMPARED_FEATURES, ("user_id",)).select("user_id", vector_to_array("features").alias("x"))
    return c.density(f, "user_id")


@check("j08_method_comparison")
def _(s, spark):
    return c.compare(wide(s))
