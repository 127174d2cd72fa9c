"""Readers and writers: a given table is written out in some form and read back."""

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from meterline.operators import layout as L
from meterline.queries.registry import query, table
from meterline.schemas import struct
from meterline.session import scratch_database, scratch_path
from meterline.sources import files as S

ORDERS = struct(
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string"
)
ORDERS_SQL = """SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate)
FROM orders"""


def _orders_csv(spark, sf, **options):
    path = scratch_path(spark, "orders_csv")
    table(spark, sf, "orders").write.options(header=True, **options).csv(path)
    return path


@query("S1", ORDERS_SQL)
def csv_fixed_schema(spark, sf):
    return S.read_csv(spark, _orders_csv(spark, sf), ORDERS)


@query("S2 X6", ORDERS_SQL)
def csv_parsed_dates(spark, sf):
    fmt = "MM/dd/yyyy HH:mm:ss"
    path = _orders_csv(spark, sf, timestampNTZFormat=fmt)
    return S.read_csv(spark, path, ORDERS, timestamp_format=fmt)


@query(
    "S3",
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
       CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part""",
)
def csv_all_text(spark, sf):
    path = scratch_path(spark, "part_csv")
    table(spark, sf, "part").write.csv(path, header=True)
    return S.read_csv(spark, path)


@query("S4", "SELECT * FROM supplier")
def csv_inferred(spark, sf):
    path = scratch_path(spark, "supplier_csv")
    table(spark, sf, "supplier").write.csv(path, header=True)
    rows = S.read_csv(spark, path, infer=True)
    return rows.withColumn("s_suppkey", F.col("s_suppkey").cast("bigint"))


@query("S5 S14", ORDERS_SQL)
def csv_gzip(spark, sf):
    path = _orders_csv(spark, sf, compression="gzip")
    return S.read_csv(spark, path, ORDERS, spread=8)


LENIENT = struct("p_partkey bigint, p_name string, p_size int")


@query(
    "S6",
    """SELECT p_partkey, p_name,
       CASE WHEN p_type NOT IN ('ECONOMY', 'SMALL') THEN CAST(p_size AS VARCHAR) END AS p_size
FROM part""",
)
def csv_lenient(spark, sf):
    """Short rows, rows with surplus values and cells that are no numbers."""
    path = scratch_path(spark, "lenient_csv")
    line = F.expr(
        "concat_ws(',', p_partkey, p_name, case p_type when 'ECONOMY' then null "
        "when 'SMALL' then 'x' when 'PROMO' then concat(p_size, ',surplus,1') else cast(p_size as string) end)"
    )
    lines = table(spark, sf, "part").select(line.alias("p_partkey,p_name,p_size"))
    lines.write.options(header=True, sep="\u0001").csv(path)
    return S.read_csv(spark, path, LENIENT).withColumn("p_size", F.col("p_size").cast("string"))


@query(
    "S7",
    """SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O')""",
)
def parquet_glob(spark, sf):
    path = scratch_path(spark, "orders_by_status")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    orders.write.partitionBy("o_orderstatus").parquet(path)
    return S.read_parquet(spark, f"{path}/o_orderstatus=[FO]", base=path)


BY_NAME_SQL = """SELECT o_orderkey AS key, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS price,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS priority
FROM orders"""


@query("S8", BY_NAME_SQL)
def parquet_by_name(spark, sf):
    path = scratch_path(spark, "by_name")
    orders = table(spark, sf, "orders")
    orders.where("o_orderstatus = 'F'").selectExpr(
        "o_orderkey as key", "o_totalprice as price"
    ).write.parquet(f"{path}/a")
    orders.where("o_orderstatus <> 'F'").selectExpr(
        "o_orderpriority as priority", "o_orderkey as key"
    ).write.parquet(f"{path}/b")
    return S.read_parquet(spark, f"{path}/a", f"{path}/b", by_name=True)


@query("S8 U2", BY_NAME_SQL)
def parquet_by_name_types(spark, sf):
    """As above, with the shared column in two types."""
    path = scratch_path(spark, "by_name_types")
    orders = table(spark, sf, "orders")
    orders.where("o_orderstatus = 'F'").selectExpr(
        "cast(o_orderkey as int) as key", "o_totalprice as price"
    ).write.parquet(f"{path}/a")
    orders.where("o_orderstatus <> 'F'").selectExpr(
        "o_orderpriority as priority", "o_orderkey as key"
    ).write.parquet(f"{path}/b")
    schema = struct("key bigint, price double, priority string")
    return S.read_by_name(spark, [f"{path}/a", f"{path}/b"], schema)


def document_lines(spark, sf):
    """Documents with their lines as a list of structs."""
    return table(spark, sf, "documents").selectExpr(
        "doc_id",
        "lang",
        "transform(split(text, '\n'), (x, i) -> named_struct('doc_id', doc_id, 'line_no', i, "
        "'line', x)) as lines",
    )


LINES_SQL = """lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS line_no
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"""


@query(
    "S9",
    f"""WITH {LINES_SQL}
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, md5(line) AS line_md5, length(line) AS n FROM lines""",
)
def json_selected_list(spark, sf):
    path = scratch_path(spark, "documents_json")
    docs = document_lines(spark, sf)
    docs.write.json(path)
    rows = S.read_documents(spark, path, "lines", docs.schema)
    return rows.select(
        "doc_id",
        "line_no",
        F.md5(F.encode("line", "UTF-8")).alias("line_md5"),
        F.length("line").cast("bigint").alias("n"),
    )


def _landed(spark, sf):
    """Each document's lines landed as one page, then an empty page, then pages that come after it."""
    path = scratch_path(spark, "pages_json")
    lines = document_lines(spark, sf).withColumn("lines", F.coalesce("lines", F.array()))
    last = lines.agg(F.max("doc_id")).scalar()
    pages = lines.selectExpr("doc_id as page", "lines as docs")
    total = pages.agg(F.sum(F.size("docs"))).scalar()
    end = lines.agg((F.max("doc_id") + 1).alias("page")).select(
        "page", F.slice(F.array().cast(pages.schema["docs"].dataType), 1, 1).alias("docs")
    )
    behind = pages.select((F.col("page") + last + 2).alias("page"), "docs")
    pages = pages.unionByName(end).unionByName(behind).withColumn("num_found", total)
    pages.write.json(path)
    return S.read_documents(spark, path, schema=pages.schema)


@query(
    "S10",
    f"""WITH {LINES_SQL}
SELECT (SELECT 2 * count(*) + 1 FROM documents) AS pages, CAST(1 AS BIGINT) AS empty_pages,
       2 * count(*) AS rows_read, count(*) AS rows_reported
FROM lines""",
)
def landed_pages(spark, sf):
    """All landed pages counted, with the empty one and those behind it."""
    return S.page_coverage(_landed(spark, sf), "docs", "num_found")


@query(
    "S10",
    f"""WITH {LINES_SQL}
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, md5(line) AS line_md5 FROM lines""",
)
def pages_until_empty(spark, sf):
    """The entries of the pages ahead of the empty one; of those behind it, none."""
    entries = S.entries_until_empty(_landed(spark, sf), "docs", "page")
    return entries.select("doc_id", "line_no", F.md5(F.encode("line", "UTF-8")).alias("line_md5"))


def _orders_by_month(spark, sf, file_format="parquet", condition="true", path=None):
    path = path or scratch_path(spark, "orders_by_month")
    rows = table(spark, sf, "orders").where(condition).select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("ordered"),
        F.col("o_orderstatus").alias("service"),
        F.date_format("o_orderdate", "yyyy-MM").alias("ym"),
    )
    writer = rows.hint("rebalance", "service", "ym").write.partitionBy("service", "ym")
    writer.format(file_format).option("header", True).mode("append").save(path)
    return path


@query(
    "S11 S7",
    """SELECT o_orderstatus AS service, strftime(o_orderdate, '%Y-%m') AS ym, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders
WHERE o_orderstatus IN ('F', 'P') AND o_orderdate >= TIMESTAMP '1996-03-01'
  AND o_orderdate < TIMESTAMP '1996-07-01'
GROUP BY 1, 2""",
)
def month_window_files(spark, sf):
    base = _orders_by_month(spark, sf)
    paths = S.month_paths(
        ["F", "P"],
        date(1996, 3, 15),
        date(1996, 6, 10),
        base + "/service={type}/ym={year}-{month}",
    )
    rows = S.read_parquet(spark, *paths, base=base)
    return rows.groupBy("service", "ym").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
    )


@query(
    "S12",
    """SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderstatus = 'O' AND o_orderdate >= TIMESTAMP '2001-01-01'""",
)
def missing_files_skipped(spark, sf):
    """Months that are missing and a file that is no Parquet file are passed over."""
    base, paths = _damaged_months(spark, sf)
    return S.read_available(spark, paths, base=base).select("o_orderkey", "o_totalprice")


def _damaged_months(spark, sf):
    base = _orders_by_month(spark, sf)
    note = spark.range(1).selectExpr("'no parquet file' as value")
    note.write.mode("append").text(f"{base}/service=O/ym=2001-02")
    note.write.text(f"{base}/service=X/ym=2001-03")
    template = base + "/service={type}/ym={year}-{month}"
    return base, S.month_paths(["O", "X"], date(2001, 1, 1), date(2004, 12, 31), template)


@query(
    "S12",
    """WITH months AS (
  SELECT service, strftime(DATE '2001-01-01' + to_months(CAST(i AS INTEGER)), '%Y-%m') AS ym
  FROM (VALUES ('O'), ('X')) AS v(service), range(48) AS r(i)),
held AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS ym, count(*) AS n FROM orders
  WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT service, m.ym, 'read' AS state, n AS rows FROM months m JOIN held USING (ym) WHERE service = 'O'
UNION ALL SELECT service, m.ym, 'missing', CAST(NULL AS BIGINT) FROM months m LEFT JOIN held USING (ym)
WHERE (service = 'X' AND m.ym <> '2001-03') OR (service = 'O' AND n IS NULL AND m.ym <> '2001-02')
UNION ALL SELECT * FROM (VALUES ('O', '2001-02', 'unreadable', NULL), ('X', '2001-03', 'unreadable', NULL))""",
)
def listed_file_states(spark, sf):
    """What became of each month of a list: read, missing or unreadable."""
    states = S.file_states(spark, _damaged_months(spark, sf)[1])
    service = F.regexp_extract("listed", "service=([^/]+)", 1).alias("service")
    ym = F.regexp_extract("listed", "ym=([^/]+)", 1).alias("ym")
    return states.groupBy(service, ym, "state").agg(F.sum("rows").alias("rows"))


@query("S14 S16 S28", "SELECT CAST(4 AS BIGINT) AS files, count(*) AS n FROM orders")
def files_per_write(spark, sf):
    path = scratch_path(spark, "four_files")
    L.write_parquet(table(spark, sf, "orders"), path, files=4)
    L.write_parquet(table(spark, sf, "orders"), path, files=4)
    rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))
    files = L.file_report(spark, path).agg(F.count(F.lit(1))).scalar()
    return rows.select(files.alias("files"), "n")


@query(
    "S28",
    "SELECT CAST(8 AS BIGINT) AS files, TRUE AS avg_is_sum_by_count, TRUE AS above_zero, count(*) AS n FROM lineitem",
)
def file_sizes(spark, sf):
    """Number of files and their average size, which is the sum of the sizes by their number."""
    path = scratch_path(spark, "file_sizes")
    L.write_parquet(table(spark, sf, "lineitem"), path, files=8)
    total = L.file_report(spark, path).agg(F.sum("bytes") / F.lit(1024.0 * 1024.0)).scalar()
    rows = spark.read.parquet(path).agg(F.count(F.lit(1))).scalar()
    return L.average_file_mb(spark, path).select(
        "files",
        (F.abs(F.col("avg_mb") * F.col("files") - total) < 1e-6).alias("avg_is_sum_by_count"),
        (F.col("avg_mb") > 0).alias("above_zero"),
        rows.alias("n"),
    )


@query("S15", "SELECT CAST(1 AS BIGINT) AS files, count(DISTINCT l_suppkey) AS n FROM lineitem")
def single_file_report(spark, sf):
    path = scratch_path(spark, "single_report")
    report = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    L.write_report(report, path)
    rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))
    files = L.file_report(spark, path).agg(F.count(F.lit(1))).scalar()
    return rows.select(files.alias("files"), "n")


@query("S17", "SELECT count(*) AS n, TRUE AS second_refused FROM customer")
def write_once(spark, sf):
    path = scratch_path(spark, "once")
    customers = table(spark, sf, "customer")
    L.write_parquet(customers, path, overwrite=False)
    try:
        L.write_parquet(customers, path, overwrite=False)
        refused = False
    except AnalysisException:
        refused = True
    return spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("n"), F.lit(refused).alias("second_refused")
    )


ARCHIVED = struct("o_orderkey bigint, o_custkey bigint, o_totalprice double, ordered string")


@query(
    "S18 S5",
    """SELECT o_orderstatus AS service, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY 1, 2, 3""",
)
def month_archive(spark, sf):
    """CSV by month into the archive in three runs: half of the months, all of them, and those that files came late for."""
    base = _orders_by_month(spark, sf, "csv", "o_orderkey % 10 <> 0 or year(o_orderdate) <> 1995")
    target = scratch_path(spark, "archive")
    source = base + "/service={service}/ym={year}-{month}"
    days = table(spark, sf, "orders").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")).first()
    services = {"F": ARCHIVED, "O": ARCHIVED, "P": ARCHIVED}
    every = S.months_touched(days.lo.date(), days.hi.date())
    first = every[: len(every) // 2]
    L.archive_months(spark, services, first, source, target, files_per_month=2)
    L.archive_months(spark, services, every, source, target, files_per_month=2)
    _orders_by_month(spark, sf, "csv", "o_orderkey % 10 = 0 and year(o_orderdate) = 1995", base)
    late = L.archive_months(spark, services, every, source, target, files_per_month=2)
    if not all("ym=1995-" in path for path in late):
        raise AssertionError("a month was archived again without need")
    return (
        spark.read.parquet(target)
        .groupBy("service", "year", "month")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
        )
    )


@query("S19", "SELECT count(*) AS n, TRUE AS within_chunk FROM lineitem")
def chunked_table(spark, sf):
    name = f"{scratch_database(spark, 'chunked')}.lineitem"
    L.create_then_append(table(spark, sf, "lineitem"), name)
    per_file = (
        spark.table(name).groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("rows"))
    )
    return per_file.agg(
        F.sum("rows").alias("n"), (F.max("rows") <= 100_000).alias("within_chunk")
    )


@query("S20 M2", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0")
def replaced_table(spark, sf):
    name = f"{scratch_database(spark, 'replaced')}.customer"
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    customers.write.mode("overwrite").saveAsTable(name)
    customers.where("c_acctbal > 0").write.mode("overwrite").saveAsTable(name)
    return spark.table(name)


@query("S21 M3", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def described_table(spark, sf):
    name = f"{scratch_database(spark, 'described')}.customer"
    schema = struct("c_custkey bigint, c_name string, c_mktsegment string")
    notes = {"c_custkey": "The customer's key", "c_mktsegment": "Line of business"}
    for _ in range(2):
        L.create_if_absent(spark, name, schema, notes)
    table(spark, sf, "customer").select(*schema.names).write.insertInto(name)
    return spark.table(name)


@query(
    "S22 F3",
    """SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS pickup_date FROM events
WHERE ts >= TIMESTAMP '2024-01-04 12:00:00' AND ts < TIMESTAMP '2024-01-09 06:00:00'""",
)
def date_partitioned(spark, sf):
    from meterline.operators.filters import in_window, partition_window

    name = f"{scratch_database(spark, 'dated')}.events"
    L.write_by_date(table(spark, sf, "events"), name, "ts")
    span = ("2024-01-04 12:00:00", "2024-01-09 06:00:00")
    rows = spark.table(name).where(partition_window("pickup_date", *span) & in_window("ts", *span))
    return rows.select("event_id", "pickup_date")


@query("S23", ORDERS_SQL)
def csv_external_table(spark, sf):
    name = f"{scratch_database(spark, 'external')}.orders"
    return L.external_csv_table(spark, name, _orders_csv(spark, sf), ORDERS)


@query("S24 M9", "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal >= 0")
def truncated_table(spark, sf):
    name = f"{scratch_database(spark, 'truncated')}.supplier"
    rows = table(spark, sf, "supplier")
    rows.select("s_suppkey", "s_name").write.saveAsTable(name)
    L.truncate(spark, name)
    rows.where("s_acctbal >= 0").select("s_suppkey", "s_name").write.insertInto(name)
    return spark.table(name)


@query(
    "S25",
    """SELECT CAST(NULL AS VARCHAR) AS unique_row_id, CAST(c_custkey AS VARCHAR) AS c_custkey,
       c_acctbal FROM customer""",
)
def staged_copy(spark, sf):
    name = f"{scratch_database(spark, 'staging')}.customer"
    schema = struct("unique_row_id string, c_custkey string, c_acctbal double")
    L.create_if_absent(spark, name, schema)
    L.copy_into(table(spark, sf, "customer"), name, ["c_custkey", "c_acctbal"])
    return spark.table(name)


@query("S26 Q1 Q2", "SELECT * FROM nation")
def seed_table(spark, sf):
    path = scratch_path(spark, "nation_csv")
    nation = table(spark, sf, "nation")
    nation.write.csv(path, header=True)
    name = f"{scratch_database(spark, 'seeds')}.nation"
    return S.load_seed(spark, path, name, nation.schema, ["n_nationkey"])
