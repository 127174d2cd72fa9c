"""Nested documents into linked tables.

`documents` is given a nested form: a struct of language and source, a list of lines, and the list
of words inside each line. All of the text takes part.
"""

from pyspark.sql import functions as F

from meterline.operators import nested as N
from meterline.queries.registry import query, table
from meterline.session import scratch_database, scratch_path


def nested_documents(spark, sf):
    return table(spark, sf, "documents").selectExpr(
        "doc_id",
        "named_struct('lang', lang, 'origin', named_struct('name', source)) as meta",
        "split(lang, '') as letters",
        "transform(split(text, '\n'), x -> named_struct('chars', length(x), "
        "'words', split(x, ' '))) as lines",
    )


def _tables(spark, sf):
    return N.flatten(nested_documents(spark, sf), "docs", ["doc_id"], "load-1")


LINES_SQL = """lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS idx
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"""
DOC_ID = "sha256(length(CAST(doc_id AS VARCHAR)) || ':' || doc_id)"
LINE_ID = f"sha256('64:' || {DOC_ID} || '5:lines' || length(CAST(idx AS VARCHAR)) || ':' || idx)"


@query(
    "N1",
    """SELECT sha256(length(CAST(p_partkey AS VARCHAR)) || ':' || p_partkey) AS _parent_id,
       CAST(unnest(range(len(w))) AS INTEGER) AS _list_idx, unnest(w) AS value
FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)""",
)
def child_table(spark, sf):
    parts = table(spark, sf, "part").selectExpr("p_partkey", "split(p_name, ' ') as words")
    keyed = parts.withColumn("id", N.row_identity(F.col("p_partkey")))
    return N.child_values(keyed, "id", "words")


@query(
    "N3 N4",
    f"""SELECT {DOC_ID} AS _row_id, doc_id, lang AS meta__lang,
       source AS meta__origin__name, 'load-1' AS _load_id FROM documents""",
)
def nested_root(spark, sf):
    return _tables(spark, sf)["docs"]


@query(
    "N2 N4",
    f"""WITH {LINES_SQL}
SELECT {LINE_ID} AS _row_id, {DOC_ID} AS _parent_id,
       CAST(idx AS INTEGER) AS _list_idx, CAST(length(line) AS INTEGER) AS chars,
       'load-1' AS _load_id
FROM lines""",
)
def nested_child(spark, sf):
    return _tables(spark, sf)["docs__lines"]


@query(
    "N2",
    f"""WITH {LINES_SQL},
words AS (
  SELECT {LINE_ID} AS _parent_id, unnest(w) AS word, unnest(range(len(w))) AS pos
  FROM (SELECT doc_id, idx, string_split(line, ' ') AS w FROM lines))
SELECT _parent_id, count(*) AS n, CAST(max(pos) AS INTEGER) AS last, min(word) AS low,
       max(word) AS high,
       CAST(sum(length(word)) AS BIGINT) AS chars
FROM words GROUP BY 1""",
)
def nested_grandchild(spark, sf):
    return N.text_summary(_tables(spark, sf)["docs__lines__words"])


@query(
    "N5 N6",
    f"""WITH {LINES_SQL}
SELECT 'docs' AS table_name, count(*) AS row_count FROM documents
UNION ALL SELECT 'docs__letters', CAST(sum(length(lang)) AS BIGINT) FROM documents
UNION ALL SELECT 'docs__lines', count(*) FROM lines
UNION ALL SELECT 'docs__lines__words', CAST(sum(len(string_split(line, ' '))) AS BIGINT) FROM lines""",
)
def nested_load_audit(spark, sf):
    """Loaded twice with replacement, the second time without one list; the tables left and their audit are shown."""
    database = scratch_database(spark, "nested")
    docs = nested_documents(spark, sf)
    for load, given in (("load-1", docs.withColumn("old", F.split("meta.origin.name", ""))), ("load-2", docs)):
        N.load_tables(spark, N.flatten(given, "docs", ["doc_id"], load), database, load)
    audit = spark.table(f"{database}._loads").where("load_id = 'load-2'")
    left = [t.name for t in spark.catalog.listTables(database) if t.name.startswith("docs")]
    names = F.explode(F.array(*[F.lit(name) for name in left])).alias("table_name")
    return spark.range(1).select(names).join(audit, "table_name", "full").select("table_name", "row_count")


@query(
    "N4 N2",
    """SELECT count(*) AS roots, count(*) AS distinct_roots,
       (SELECT CAST(sum(len(string_split(text, ' '))) AS BIGINT) FROM documents) * 2 AS children
FROM (SELECT text FROM documents UNION ALL SELECT text FROM documents)""",
)
def nested_without_key(spark, sf):
    """Every document twice and no key at all: identity comes from the place in the landed file."""
    docs = table(spark, sf, "documents").selectExpr("split(text, ' ') as words", "lang")
    landed = N.land(docs.unionAll(docs), scratch_path(spark, "landed_docs"))
    tables = N.flatten(landed, "docs", ["_file", "_position"], "load-1", ["_file", "_position"])
    children = tables["docs__words"].agg(F.count(F.lit(1))).scalar()
    return (
        tables["docs"]
        .agg(F.count(F.lit(1)).alias("roots"), F.countDistinct("_row_id").alias("distinct_roots"))
        .withColumn("children", children)
    )
