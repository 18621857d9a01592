"""Catalog entries for nearest-neighbour joins and the row filters built on them, on the ``latent`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.operators import neighbours as NB
from strataflow.plans.catalog import register
from strataflow.sources.tables import tables

ROWS = "x AS (SELECT row_id, label, CAST(z AS DOUBLE[]) AS zd FROM latent)"
NEAR = """near AS (SELECT query_id, CAST(rank AS INTEGER) AS rank, id, distance FROM (
  SELECT a.row_id AS query_id, b.row_id AS id, list_distance(a.zd, b.zd) AS distance,
         row_number() OVER (PARTITION BY a.row_id ORDER BY list_distance(a.zd, b.zd), b.row_id) AS rank
  FROM {a} a JOIN x b ON {on}) WHERE rank <= {k})"""
# stand-in for generated minority rows: each minority row drawn halfway to the origin
SYNTHETIC = "syn AS (SELECT row_id, list_transform(zd, lambda v: 0.5 * v) AS zd FROM x WHERE label = 2)"


def latent(spark, sf_dir):
    return tables(spark, sf_dir).latent()


@register("knn_join", f"""WITH {ROWS}, {NEAR.format(a="x", on="a.row_id <> b.row_id", k=5)}
SELECT query_id, rank, id, round(distance, 6) AS distance FROM near""")
def q_knn_join(spark, sf_dir):
    lat = latent(spark, sf_dir)
    near = NB.knn_join(lat, lat, "z", "row_id", 5, exclude_self=True)
    return near.select("query_id", "rank", "id", F.round("distance", 6).alias("distance"))


@register("knn_filter", f"""WITH {ROWS}, {SYNTHETIC}, {NEAR.format(a="syn", on="true", k=5)}
SELECT query_id AS row_id, count(*) AS n_neighbours, CAST(sum(CAST(label <> 2 AS INTEGER)) AS BIGINT) AS n_other,
       2 * sum(CAST(label <> 2 AS INTEGER)) > count(*) AS dropped
FROM near JOIN x ON near.id = x.row_id GROUP BY 1""")
def q_knn_filter(spark, sf_dir):
    lat = latent(spark, sf_dir)
    half = F.transform(F.col("z").cast("array<double>"), lambda v: 0.5 * v)
    synthetic = lat.where("label = 2").select("row_id", half.alias("z"))
    return NB.neighbourhood(synthetic, lat, "z", "row_id", "label", 2, 5)


LINKS = f"""{NEAR.format(a="x", on="a.row_id <> b.row_id", k=1)},
links AS (SELECT l.query_id AS a, l.id AS b, p.label AS label_a, q.label AS label_b, l.distance
          FROM near l JOIN near r ON l.query_id = r.id AND l.id = r.query_id
          JOIN x p ON p.row_id = l.query_id JOIN x q ON q.row_id = l.id WHERE l.query_id < l.id AND p.label <> q.label)"""


@register("tomek_links", f"""WITH {ROWS}, {LINKS}
SELECT a, b, label_a, label_b, round(distance, 6) AS distance FROM links""")
def q_tomek_links(spark, sf_dir):
    links = NB.tomek_links(latent(spark, sf_dir), "z", "row_id", "label")
    return links.select("a", "b", "label_a", "label_b", F.round("distance", 6).alias("distance"))


@register("remove_tomek", f"""WITH {ROWS}, {LINKS},
big AS (SELECT label FROM x GROUP BY 1 ORDER BY count(*) DESC, label LIMIT 1)
SELECT row_id, label FROM x WHERE row_id NOT IN (
  SELECT a FROM links, big WHERE label_a = label UNION ALL SELECT b FROM links, big WHERE label_b = label)""")
def q_remove_tomek(spark, sf_dir):
    return NB.remove_tomek(latent(spark, sf_dir), "z", "row_id", "label").select("row_id", "label")
