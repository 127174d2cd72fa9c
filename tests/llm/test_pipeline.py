"""The pipeline's stages against their operators, on given and on odd documents; and every query's SQL."""

import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterline.llm import byte_cnn, minmax, queries, tree_rules
from meterline.llm.arrow import prepare

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    text = docs.filter("n_chars > 1500").first().text
    rows = [(None, text, "en", None, 1, "x"), (None, None, None, None, None, None), (7, text, "en", "a", 1, "y")]
    rows += [(7, text, "en", "a", 1, "y"), (9001, "", "en", "a", 0, "z"), (9002, text * 40, "en", "b", 9, "z")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    return docs.selectExpr("*", "'c' AS kept").unionByName(spark.createDataFrame(rows, schema))


def test_stages_keep_the_columns(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == odd.columns and out.count() > 0
        assert [f.dataType for f in out.schema.fields] == [f.dataType for f in odd.schema.fields]
    pieces = corpus_pipeline.pack_sequences(spark, docs, SF_DIR)
    assert pieces.groupBy().sum("length").first()[0] > 0


def test_filters_agree_with_the_operators(spark, odd):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rules = tree_rules.apply_rules(odd, tree_rules.fit(documents, labels))
    want = sorted(str(r.doc_id) for r in rules.filter("kept").collect())
    assert sorted(str(r.doc_id) for r in corpus_pipeline.quality_rules(spark, odd, SF_DIR).collect()) == want
    scored = byte_cnn.classify(odd, byte_cnn.fit(documents, labels))
    want = sorted(str(r.doc_id) for r in scored.filter("predicted = 1").collect())
    assert sorted(str(r.doc_id) for r in corpus_pipeline.quality_classifier(spark, odd, SF_DIR).collect()) == want


def test_one_of_each_group_stays(spark, odd):
    found = minmax.near_duplicates(odd, minmax.MinMax(width=5), ids_link=False).filter("doc_id IS NOT NULL")
    want = sorted({(r.doc_id, r.text_hash) for r in found.filter("kept_text").collect()})
    rows = corpus_pipeline.near_duplicates(spark, odd, SF_DIR)
    got = rows.filter("doc_id IS NOT NULL").selectExpr("doc_id", "xxhash64(text) AS h").collect()
    assert sorted(tuple(r) for r in got) == want
    assert {i for i, _ in want} >= {r.component_id for r in minmax.near_duplicates(odd, minmax.MinMax(width=5)).collect()} - {None}
    assert rows.filter("doc_id IS NULL").count() == 2


def test_texts_that_share_an_id_are_judged_each(spark):
    one, two = (" ".join(f"{p}{i}" for i in range(200)) for p in "ab")
    rows = [(1, one), (1, two), (1, one), (5, one + " end"), (6, two + " end"), (7, "other words stand here alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs.repartition(3), SF_DIR).collect()
    assert sorted(tuple(r) for r in kept) == sorted([(1, one), (1, two), rows[-1]])


INTERNAL = (
    "id hash row nth kept_id of_rows count text_hash own least component of_hash of_bucket of_slot of_index of_source "
    "of_begin of_row of_text of_key of_rank of_place of_length of_slots of_first of_before of_round".split()
)


@pytest.mark.parametrize("stage", ["near_duplicates", "mix_sources"])
def test_columns_with_internal_names_come_out_as_they_were(spark, odd, stage):
    docs = odd.drop("kept").withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in INTERNAL})
    plain = dict(corpus_pipeline.STAGES)[stage](spark, odd.drop("kept"), SF_DIR)
    rows = dict(corpus_pipeline.STAGES)[stage](spark, docs, SF_DIR)
    assert rows.columns == docs.columns
    rows = rows.collect()
    assert {str(r.doc_id) for r in rows} == {str(r.doc_id) for r in plain.collect()}
    for r in rows:
        assert all(r[c] == (None if r.doc_id is None else f"{c}{r.doc_id}") for c in INTERNAL)


def test_mixed_documents_are_whole(spark, odd):
    rows = corpus_pipeline.mix_sources(spark, odd, SF_DIR).collect()
    assert {tuple(r) for r in rows} == {tuple(r) for r in odd.collect()}


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_stages_take_an_empty_table(spark, odd, stage):
    assert dict(corpus_pipeline.STAGES)[stage](spark, odd.limit(0), SF_DIR).collect() == []


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    used = sum(r.length for r in rows)
    assert used and sum(p[0].padded for p in sequences.values()) < 1.05 * used + 4096


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    want = con.sql(queries.SQL[name]).df()
    got = queries.QUERIES[name](spark, SF_DIR).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    want, got = (f[columns].sort_values(columns).reset_index(drop=True) for f in (want, got))
    assert len(want) == len(got) and np.array_equal(want.values, got.values)
