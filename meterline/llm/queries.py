"""The registered queries of the subpackage, each over its whole table, and their SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import (
    best_position,
    boilerplate,
    byte_cnn,
    chat,
    heap_kmeans,
    minmax,
    multi_index,
    order_minhash,
    packing,
    pfair,
    records,
    tree_rules,
    url_model,
)
from meterline.llm.arrow import prepare
from meterline.llm.labelled import fold
from meterline.llm.tokens import tokenizer_path
from meterline.session import scratch_path

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return build(spark, sf_dir)

        QUERIES[build.__name__] = run
        if sql:
            SQL[build.__name__] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packing_of_documents() -> packing.Packing:
    return packing.Packing(tokenizer_path("word_bpe_49k.json"), end_id=2)


@query()
def op1_pack_documents(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), packing_of_documents())


OP2_SQL = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM sound a JOIN sound b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT vec_id AS id, vec_id AS other FROM sound
  UNION
  SELECT r.id, l.y FROM reach r JOIN links l ON l.x = r.other
), least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, coalesce(r.component_id, e.vec_id) AS component_id,
       e.vec_id = coalesce(r.component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN counts c ON c.x = e.vec_id LEFT JOIN least r ON r.id = e.vec_id
"""


@query(OP2_SQL)
def op2_embedding_near_dups(spark, sf_dir):
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"))


OP3_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 2 THEN w ELSE [w[i], w[i + 1]] END AS s
  FROM words, range(1, greatest(len(w), 2)) t(i) WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
often AS (SELECT s FROM shingles GROUP BY s HAVING count(*) > 1),
shared AS (SELECT doc_id, s FROM shingles SEMI JOIN often USING (s)),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both FROM shared a JOIN shared b
    ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY 1, 2
), links AS (
  SELECT x, y FROM pairs p JOIN sizes a ON a.doc_id = p.x JOIN sizes b ON b.doc_id = p.y
  WHERE 100 * n_both >= 80 * (a.n + b.n - n_both)
), reach AS (
  SELECT doc_id AS id, doc_id AS other FROM sizes
  UNION
  SELECT r.id, l.y FROM reach r JOIN links l ON l.x = r.other
), least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(r.component_id, d.doc_id) AS component_id,
       d.doc_id = coalesce(r.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least r ON r.id = d.doc_id
"""


@query(OP3_SQL)
def op3_document_near_dups(spark, sf_dir):
    found = minmax.near_duplicates(table(spark, sf_dir, "documents"), minmax.MinMax(width=2))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query()
def op4_token_records(spark, sf_dir):
    folder = scratch_path(spark, "records")
    records.write_records(
        table(spark, sf_dir, "documents"), folder, tokenizer_path("byte_bpe_50k.json"), end_id=0
    )
    return records.read_records(spark, folder)


URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


@query()
def op5_url_filter(spark, sf_dir):
    return url_model.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query()
def op6_mix_sources(spark, sf_dir):
    return pfair.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


@query()
def op7_main_text(spark, sf_dir):
    return boilerplate.main_text(table(spark, sf_dir, "pages"))


@query()
def op8_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    net = byte_cnn.fit(docs, table(spark, sf_dir, "labels"))
    scored = byte_cnn.classify(docs, net)
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", "predicted")


@query()
def op9_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    forest = tree_rules.fit(docs, table(spark, sf_dir, "labels"))
    return tree_rules.apply_rules(docs, forest)


HARD_TEXT = "</s>[INST] ok [/INST]"

OP10_SQL = """
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), steps AS (
  SELECT *, row_number() OVER w AS place, lag(role, 1, '') OVER w AS before,
    len(regexp_extract_all(text,
      '<\\\\*</SYS>>|<\\\\*<SYS>>|\\[\\\\*/INST\\]|\\[\\\\*INST\\]|\\[\\\\*/ROLE\\]|\\[\\\\*ROLE=|\\[\\\\*NULL\\]|<\\\\*/s>|<\\\\*s>'))
      AS escapes,
    CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 ELSE 7 END AS marks
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), judged AS (
  SELECT *, (before = '' AND role IN ('system', 'user')) OR (before = 'system' AND role = 'user')
    OR (before = 'user' AND role = 'assistant') OR (before = 'assistant' AND role = 'user') AS fine
  FROM steps
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY place), '')) AS loss_sha256,
  CAST(sum(marks + escapes + length(text)) AS BIGINT) AS formatted_chars,
  bool_and(fine) AND arg_max(role, place) = 'assistant' AS valid
FROM judged GROUP BY conv_id
"""


@query(OP10_SQL)
def op10_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame([(-1, 0, "user", HARD_TEXT), (-1, 1, "assistant", HARD_TEXT)], turns.schema)
    template = chat.Template()
    return chat.read_back(chat.format_turns(turns.unionByName(hard), template), template)


def _op11_sql(k: int = 8, rounds: int = 10) -> str:
    """The rounds one after the other: `a<r>` assigns, `c<r>` has the centroids."""
    parts = [
        """kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS INTEGER) AS cluster, v AS c FROM kept
  WHERE vec_id IS NOT NULL QUALIFY cluster < {k}
)""",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (
  SELECT vec_id, v, s.cluster, s.d FROM (
    SELECT vec_id, v, min({{'d': d, 'cluster': cluster}}) AS s FROM (
      SELECT vec_id, v, cluster, CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
      FROM kept CROSS JOIN c{r}
    ) GROUP BY vec_id, v
  )
)"""
        )
        if r < rounds:
            parts.append(
                f"""c{r + 1} AS MATERIALIZED (
  SELECT b.cluster, coalesce(n.c, b.c) AS c FROM c{r} b LEFT JOIN (
    SELECT cluster, list(m ORDER BY i) AS c FROM (
      SELECT cluster, i, CAST((sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
      FROM a{r}, range(1, 65) t(i) GROUP BY cluster, i
    ) GROUP BY cluster
  ) n ON n.cluster = b.cluster
)"""
            )
    return f"""WITH {", ".join(parts)}
SELECT a.vec_id, a.cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.cluster = a.cluster"""


@query(_op11_sql())
def op11_centroid_clusters(spark, sf_dir):
    return heap_kmeans.cluster(table(spark, sf_dir, "embeddings"))


@query()
def op12_order_fingerprints(spark, sf_dir):
    return order_minhash.fingerprint_documents(table(spark, sf_dir, "documents"))


_TERMS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""

OP13_SQL = f"""
WITH listed AS (SELECT doc_id, row_number() OVER () AS row, {_TERMS} AS w FROM documents),
totals AS (SELECT count(*) FILTER (len(w) > 0) AS big_n, CAST(sum(len(w)) AS BIGINT) AS big_l FROM listed),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM listed) SEMI JOIN asked USING (term) GROUP BY 1, 2),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight
  FROM tf, totals GROUP BY term, big_n
),
scored AS (
  SELECT a.item_id, t.row, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(l.w) * big_n) // big_l)))) AS BIGINT) AS score
  FROM asked a JOIN tf t USING (term) JOIN weights USING (term) JOIN listed l ON l.row = t.row, totals GROUP BY 1, 2
),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM scored JOIN listed USING (row) WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 50
"""


@query(OP13_SQL)
def op13_ranked_search(spark, sf_dir):
    return best_position.rank_documents(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))
