from pyspark.sql import functions as F

from meterline.operators import nested as N

SCHEMA = (
    "key string, year int, "
    "editions struct<num: int, docs: array<struct<title: string, language: array<string>>>>, "
    "author_name array<string>, grid array<array<int>>"
)
DATA = [
    ("a", 1997, (2, [("t1", ["eng", "ger"]), ("t2", None)]), ["x", "y"], [[1, 2], [3]]),
    ("b", 2001, (1, [("t3", [])]), [], None),
    ("c", None, None, None, [[]]),
]


def tables(spark, load="l1"):
    return N.flatten(spark.createDataFrame(DATA, SCHEMA), "books", ["key"], load)


def test_tables_and_columns(spark):
    got = tables(spark)
    assert set(got) == {
        "books",
        "books__editions__docs",
        "books__editions__docs__language",
        "books__author_name",
        "books__grid",
        "books__grid__list",
    }
    assert got["books"].columns == ["_row_id", "key", "year", "editions__num", "_load_id"]
    assert got["books__author_name"].columns == [
        "_row_id",
        "_parent_id",
        "_list_idx",
        "value",
        "_load_id",
    ]


def test_rows_link_up(spark):
    got = tables(spark)
    linked = (
        got["books__editions__docs__language"]
        .alias("g")
        .join(got["books__editions__docs"].alias("d"), F.expr("g._parent_id = d._row_id"))
        .join(got["books"].alias("b"), F.expr("d._parent_id = b._row_id"))
        .select("b.key", "d.title", "g._list_idx", "g.value")
    )
    assert sorted(tuple(r) for r in linked.collect()) == [
        ("a", "t1", 0, "eng"),
        ("a", "t1", 1, "ger"),
    ]
    assert got["books__author_name"].count() == 2
    assert got["books__editions__docs"].count() == 3
    cells = got["books__grid__list"].select("value").collect()
    assert sorted(r[0] for r in cells) == [1, 2, 3]


def test_ids_repeat_on_a_second_run(spark):
    first, second = tables(spark), tables(spark, "l2")
    for name in first:
        ids = lambda t: sorted(r[0] for r in t.select("_row_id").collect())
        assert ids(first[name]) == ids(second[name])
        assert len(set(ids(first[name]))) == len(ids(first[name]))


def test_identical_documents_stay_apart(spark, tmp_path):
    docs = spark.createDataFrame([(["a", "b"],)] * 5, "tags array<string>")
    landed = N.land(docs, str(tmp_path / "landed"))
    got = N.flatten(landed, "d", ["_file", "_position"], "l1", drop=["_file", "_position"])
    assert got["d"].select("_row_id").distinct().count() == 5
    parents = got["d__tags"].groupBy("_parent_id").count().collect()
    assert [r["count"] for r in parents] == [2] * 5


def test_load_replaces_and_audits(spark, database):
    for load in ("l1", "l2"):
        result = N.load_tables(spark, tables(spark, load), database, load)
    assert result.rows["books"] == 3
    assert spark.table(f"{database}.books").select("_load_id").distinct().collect()[0][0] == "l2"
    audit = spark.table(f"{database}._loads")
    assert audit.count() == 12
    assert audit.where("loaded_at is null").count() == 0


def test_load_drops_tables_of_lists_that_are_gone(spark, database):
    before = spark.createDataFrame([(1, ["a"], [["b"]])], "k int, tags array<string>, deep array<array<string>>")
    N.load_tables(spark, N.flatten(before, "Docs", ["k"], "l1"), database, "l1")
    spark.range(1).write.saveAsTable(f"{database}.docs_other")
    N.load_tables(spark, N.flatten(before.drop("deep"), "Docs", ["k"], "l2"), database, "l2")
    left = {t.name for t in spark.catalog.listTables(database) if not t.isTemporary}
    assert left == {"docs", "docs__tags", "docs_other", "_loads"}


def test_plain_values_are_stored_small(spark, database):
    docs = spark.createDataFrame([(k, [[f"v{j % 9}" for j in range(50)]] * 40) for k in range(10)], "k int, deep array<array<string>>")
    result = N.load_tables(spark, N.flatten(docs, "docs", ["k"], "l1"), database, "l1")
    values = spark.table(f"{database}.docs__deep__list")
    assert result.rows["docs__deep__list"] == values.select("_row_id").distinct().count() == 20_000
    parents = spark.table(f"{database}.docs__deep").select("_row_id")
    assert values.join(parents, values["_parent_id"] == parents["_row_id"]).count() == 20_000
    files = spark.read.format("binaryFile").load(values.inputFiles()).agg(F.sum("length")).first()[0]
    assert files < 20 * 20_000


def test_text_summary_sorts_no_texts_ahead_of_the_shuffle(spark):
    lists = [["b", "é", "", None], [], None, [None], [f"w{j}" for j in range(25_000)], ["x"]]
    rows = [(k % 5, texts) for k, texts in enumerate(lists)]  # the key of the first list comes again
    child = N.flatten(spark.createDataFrame(rows, "k int, v array<string>"), "d", ["k"], "l")["d__v"]
    got = {tuple(r)[1:] for r in N.text_summary(child).collect()}
    assert got == {(5, 3, "", "é", 3), (1, 0, None, None, None), (25_000, 24_999, "w0", "w9999", 138_890)}
    plan = N.text_summary(child)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" in plan and "Sort" not in plan[plan.index("MapInArrow") :]


def test_child_values_of_null_and_empty_lists(spark):
    df = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None)], "id int, v array<string>")
    got = [tuple(r) for r in N.child_values(df, "id", "v").collect()]
    assert got == [(1, 0, "a"), (1, 1, None)]
