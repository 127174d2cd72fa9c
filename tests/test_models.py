import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.operators.model import export_tip_model, fit_tip_model, load_tip_model, score_tips
from meterline.operators.retrieval import top_k_cosine
from meterline.schemas import struct
from meterline.streaming.loader import load_new_files
from meterline.operators.materialize import rebuild
from meterline.session import scratch_path


def brute_force(queries, corpus, k):
    out = set()
    for q, x in queries:
        scored = []
        for c, y in corpus:
            length = np.linalg.norm(x) * np.linalg.norm(y)
            score = float(np.dot(x, y) / length) if length else 0.0
            scored.append((-round(score, 9), c))
        for rank, (score, c) in enumerate(sorted(scored)[:k], 1):
            out.add((q, c, rank))
    return out


@pytest.mark.parametrize("block", [3, 1024])
def test_retrieval_against_brute_force(spark, block):
    random = np.random.default_rng(5)
    corpus = [(i, random.normal(size=8).tolist()) for i in range(200)]
    corpus += [(200 + i, corpus[i][1]) for i in range(20)] + [(300, [0.0] * 8)]
    queries = [(f"q{i}", random.normal(size=8).tolist()) for i in range(7)]
    c = spark.createDataFrame(corpus, "id int, v array<float>").repartition(5)
    q = spark.createDataFrame(queries, "name string, v array<float>")
    got = top_k_cosine(
        q, c, 6, query_id="name", corpus_id="id", query_vector="v", corpus_vector="v", block=block
    )
    assert {(r["query"], r["match"], r["rank"]) for r in got.collect()} == brute_force(
        queries, corpus, 6
    )


def test_retrieval_with_text_ids_and_few_rows(spark):
    c = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("z", None)], "id string, v array<double>")
    q = spark.createDataFrame([(1, [2.0, 0.0])], "n bigint, v array<double>")
    got = top_k_cosine(q, c, 5, query_id="n", corpus_id="id", query_vector="v", corpus_vector="v")
    assert [(r["match"], r["similarity"], r["rank"]) for r in got.orderBy("rank").collect()] == [
        ("a", 1.0, 1),
        ("b", 1.0, 2),
    ]


def test_retrieval_refuses_vectors_of_other_lengths(spark):
    c = spark.createDataFrame([(1, [1.0]), (2, [0.0, 1.0, 0.0])], "id bigint, v array<double>").coalesce(1)
    q = spark.createDataFrame([(1, [2.0, 0.0])], "n bigint, v array<double>")
    got = top_k_cosine(q, c, 1, query_id="n", corpus_id="id", query_vector="v", corpus_vector="v")
    with pytest.raises(Exception, match="vectors of length"):
        got.collect()


def test_retrieval_scans_the_corpus_once(spark, capsys):
    corpus = scratch_path(spark, "vectors")
    spark.range(50).selectExpr("id", "array(cast(id as double), 1.0) as v").write.parquet(corpus)
    vectors = spark.read.parquet(corpus)
    asked = spark.range(7).selectExpr("id as n", "array(1.0d, cast(id as double)) as v")
    got = top_k_cosine(asked, vectors, 2, query_id="n", corpus_id="id", query_vector="v", corpus_vector="v", block=2)
    got.explain()
    assert capsys.readouterr().out.count("FileScan") == 1
    assert got.count() == 14


def test_retrieval_of_odd_vectors(spark):
    c = spark.createDataFrame(
        [(1, [0.0, 0.0]), (2, [1.0, None]), (3, [float("inf"), 1.0]), (4, [1.0, 1.0])], "id bigint, v array<double>"
    )
    q = spark.createDataFrame([(1, [2.0, 2.0])], "n bigint, v array<double>")
    got = top_k_cosine(q, c, 9, query_id="n", corpus_id="id", query_vector="v", corpus_vector="v")
    assert [(r["match"], r["similarity"]) for r in got.orderBy("rank").collect()] == [(4, 1.0), (1, 0.0), (2, 0.0), (3, 0.0)]
    assert top_k_cosine(
        q.limit(0), c, 9, query_id="n", corpus_id="id", query_vector="v", corpus_vector="v"
    ).count() == 0


def test_tip_model_recovers_a_linear_rule(spark):
    trips = spark.range(2000).select(
        (F.col("id") % 5).cast("string").alias("PULocationID"),
        (F.col("id") % 3).cast("string").alias("DOLocationID"),
        (F.col("id") % 2).cast("string").alias("payment_type"),
        (F.col("id") % 7).cast("int").alias("passenger_count"),
        (F.col("id") % 11).cast("double").alias("trip_distance"),
        (F.col("id") % 13 + 3).cast("double").alias("fare_amount"),
        F.lit(0.5).alias("tolls_amount"),
    )
    rule = F.col("fare_amount") * 0.2 + F.col("trip_distance") * 0.1 + F.when(
        F.col("PULocationID") == "3", 2.0
    ).otherwise(0.0)
    labelled = trips.withColumn("tip_amount", rule)
    scored = score_tips(fit_tip_model(labelled), labelled)
    worst = scored.agg(F.max(F.abs(F.col("predicted_tip") - F.col("tip_amount")))).first()[0]
    assert worst < 0.01
    unseen = score_tips(fit_tip_model(labelled), trips.limit(1).withColumn("PULocationID", F.lit("99")))
    assert unseen.count() == 1


def test_stream_takes_each_file_once(spark, database):
    folder, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "progress")
    name = f"{database}.streamed"
    schema = struct("key string, v int")
    rebuild(spark.createDataFrame([], schema), name)

    def land(*data):
        spark.createDataFrame(list(data), schema).write.mode("append").json(folder)

    def load():
        load_new_files(spark, folder, schema, name, ["key"], checkpoint, file_format="json")
        return sorted(tuple(r) for r in spark.table(name).collect())

    land(("a", 1), ("b", 1), ("b", 1))
    assert load() == [("a", 1), ("b", 1), ("b", 1)]
    assert load() == [("a", 1), ("b", 1), ("b", 1)]
    land(("a", 9), ("c", 2))
    assert load() == [("a", 1), ("b", 1), ("b", 1), ("c", 2)]


def _remembering(spark, database, remember):
    """Functions that land rows and load them, the latter with the rows that the merge got."""
    folder, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "progress")
    name, schema = f"{database}.remembered", struct("key string, v int, taken_at string")
    rebuild(spark.createDataFrame([], schema), name)
    merged = []

    def note(batch):
        merged.extend(tuple(r)[:2] for r in batch.collect())
        return batch

    def load(*data):
        rows = [(*r, None) for r in data]
        spark.createDataFrame(rows, schema).write.mode("append").json(folder)
        merged.clear()
        load_new_files(
            spark, folder, schema, name, ["key"], checkpoint, file_format="json", prepare=note, remember=remember
        )
        return sorted(merged), sorted(tuple(r)[:2] for r in spark.table(name).collect())

    return load


def test_stream_remembers_rows_of_files_sent_again(spark, database):
    load = _remembering(spark, database, "1 day")
    assert load(("a", 1), ("b", 1), ("b", 1)) == ([("a", 1), ("b", 1)], [("a", 1), ("b", 1)])
    # Another row with a known key reaches the merge, which settles it; what came before does not.
    merged, rows = load(("a", 1), ("a", 9), ("b", 1), ("c", 2))
    assert merged == [("a", 9), ("c", 2)]
    assert rows == [("a", 1), ("b", 1), ("c", 2)]
    assert load(("a", 9), ("c", 2), ("b", 1))[0] == []


def test_rows_behind_the_span_pass_the_merge_again(spark, database):
    load = _remembering(spark, database, "1 second")
    assert load(("a", 1))[0] == [("a", 1)]
    for n in range(3):  # a batch forgets what the batch before it has put behind the span
        time.sleep(1.2)
        load((f"x{n}", n))
    merged, rows = load(("a", 1))
    assert merged == [("a", 1)]
    assert rows == [("a", 1), ("x0", 0), ("x1", 1), ("x2", 2)]


def test_an_exported_model_scores_in_another_session(spark):
    rows = spark.range(300).selectExpr(
        "cast(id % 5 as string) as PULocationID", "cast(id % 4 as string) as DOLocationID", "cast(id % 2 as string) as payment_type",
        "cast(id % 3 as int) as passenger_count", "cast(id % 11 as double) as trip_distance", "cast(id % 17 as double) as fare_amount",
        "0.0D as tolls_amount", "0.25 * (id % 17) + id % 4 as tip_amount",
    )
    folder = scratch_path(spark, "models")
    model = fit_tip_model(rows)
    export_tip_model(spark, model, folder, "2024-01")
    export_tip_model(spark, fit_tip_model(rows.withColumn("tip_amount", F.lit(1.0))), folder, "2023-12")
    with pytest.raises(Exception, match="exists"):
        export_tip_model(spark, model, folder, "2024-01")
    other = spark.newSession()
    again = load_tip_model(other, folder)
    given = other.createDataFrame([r.asDict() for r in rows.limit(40).collect()], rows.schema)
    want = [r["predicted_tip"] for r in score_tips(model, rows.limit(40)).collect()]
    assert [r["predicted_tip"] for r in score_tips(again, given).collect()] == pytest.approx(want)
    older = score_tips(load_tip_model(spark, folder, "2023-12"), rows.limit(5)).collect()
    assert [r["predicted_tip"] for r in older] == pytest.approx([1.0] * 5, abs=1e-4)
    with pytest.raises(FileNotFoundError):
        load_tip_model(spark, folder, "2022-01")
