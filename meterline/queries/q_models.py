"""Tip model and vector retrieval."""

from pyspark.sql import functions as F

from meterline.operators.model import export_tip_model, fit_tip_model, load_tip_model, score_tips
from meterline.operators.retrieval import top_k_cosine
from meterline.queries.registry import query, table
from meterline.session import scratch_path


@query(
    "ML1",
    """SELECT CAST(l_partkey % 27 AS VARCHAR) AS "DOLocationID", count(*) AS trips,
       round(avg(l_extendedprice * 0.2 + l_linenumber), 1) AS avg_tip,
       round(avg(l_extendedprice * 0.2 + l_linenumber), 1) AS avg_predicted_tip
FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1""",
)
def tip_regression(spark, sf):
    """Fit on the yellow rows, export the model, score the green ones with what is loaded again; shown per drop-off zone.

    Tips follow a linear rule, which the fitted model has to find: the SQL states the rule.
    """
    rows = table(spark, sf, "lineitem").selectExpr(
        "l_linestatus",
        "cast(l_suppkey % 30 as string) as PULocationID",
        "cast(l_partkey % 27 as string) as DOLocationID",
        "cast(l_linenumber as string) as payment_type",
        "cast(l_quantity as int) % 7 as passenger_count",
        "l_quantity as trip_distance",
        "l_extendedprice as fare_amount",
        "l_tax as tolls_amount",
        "l_extendedprice * 0.2 + l_linenumber as tip_amount",
    )
    model = fit_tip_model(rows.where("l_linestatus = 'F'"))
    models = scratch_path(spark, "models")
    export_tip_model(spark, model, models, "1")
    scored = score_tips(load_tip_model(spark, models), rows.where("l_linestatus = 'O'"))
    return scored.groupBy("DOLocationID").agg(
        F.count(F.lit(1)).alias("trips"),
        F.round(F.avg("tip_amount"), 1).alias("avg_tip"),
        F.round(F.avg("predicted_tip"), 1).alias("avg_predicted_tip"),
    )


def label_centres(spark, sf):
    """The mean vector of each label, as the queries to look up.

    The list collected per label has one entry per vector position, so its length is the dimension.
    """
    values = table(spark, sf, "embeddings").select(
        "label", F.posexplode("embedding").alias("pos", "x")
    )
    means = values.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy("label").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "x"))), lambda e: e["x"]).alias(
            "embedding"
        )
    )


@query(
    "E1",
    """WITH values AS (
  SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS pos FROM embeddings),
means AS (SELECT label, pos, avg(x) AS x FROM values GROUP BY 1, 2),
centres AS (SELECT label, list(x ORDER BY pos) AS centre FROM means GROUP BY 1),
scored AS (
  SELECT c.label AS query, e.vec_id AS match,
         round(list_cosine_similarity(c.centre, e.embedding::DOUBLE[]), 12) AS s
  FROM centres c CROSS JOIN embeddings e)
SELECT query, match, round(s, 6) AS similarity,
       CAST(row_number() OVER (PARTITION BY query ORDER BY s DESC, match) AS INTEGER) AS rank
FROM scored
QUALIFY row_number() OVER (PARTITION BY query ORDER BY s DESC, match) <= 5""",
)
def topk_cosine(spark, sf):
    """The five vectors nearest to the mean vector of each label, out of all vectors."""
    best = top_k_cosine(
        label_centres(spark, sf),
        table(spark, sf, "embeddings"),
        5,
        query_id="label",
        corpus_id="vec_id",
    )
    return best.withColumn("similarity", F.round("similarity", 6))
