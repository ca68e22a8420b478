import pytest
from conftest import rows

from ebbtide.plans import quality, reports
from ebbtide.session import work_dir
from ebbtide.sources import copying
from ebbtide.specs import GOODS_INFO, ORDER_GOODS, ORDER_INFO


@pytest.fixture
def child(spark):
    return spark.createDataFrame([(1, 10), (2, 10), (3, 99), (4, None), (4, 11)], "id INT, p INT")


@pytest.fixture
def parent(spark):
    return spark.createDataFrame([(10, "x"), (11, "y"), (12, None)], "p INT, v STRING")


def test_key_check(child, spark):
    check = quality.key_check(child, "child", ["id"])
    assert rows(check) == [("child", "id", 5, 4, 0, 1)]
    assert rows(quality.key_check(child, "child", ["p"])) == [("child", "p", 5, 3, 1, 1)]
    good = quality.key_check(child, "good", ["id", "p"]).where("null_keys = 0")
    assert rows(quality.tables_without_key(check.unionByName(good))) == [("child",)]
    assert rows(quality.key_check(child.limit(0), "none", ["id"])) == [("none", "id", 0, 0, 0, 0)]


def test_missing_constraints(spark):
    tables = spark.createDataFrame([("s", "a"), ("s", "b"), ("t", "a")], "table_schema STRING, table_name STRING")
    constraints = spark.createDataFrame(
        [("s", "a", "PRIMARY KEY"), ("s", "b", "UNIQUE")], "table_schema STRING, table_name STRING, constraint_type STRING"
    )
    missing = quality.missing_constraints(tables, constraints, ["table_schema", "table_name"])
    assert rows(missing) == [("s", "b"), ("t", "a")]


def test_references(child, parent):
    assert rows(quality.orphans(child, parent, "p")) == [(99, 3)]
    report = quality.reference_report(
        {"child": child, "parent": parent}, [quality.Reference("child", "p", "parent", "p")]
    )
    assert rows(report) == [("child", "p", "parent", "p", 5, 1, 1, 0.6)]


def test_references_follow_from_declared_keys():
    found = quality.references_between([ORDER_INFO, ORDER_GOODS, GOODS_INFO])
    assert [(r.child, r.column, r.parent) for r in found] == [
        ("order_goods", "goods_id", "goods_info"),
        ("order_goods", "order_id", "order_info"),
    ]


def test_reconcile_counts_duplicates_and_nulls(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k INT, v STRING")
    right = spark.createDataFrame([(1, "a"), (2, None), (3, "d"), (4, "e")], "k INT, v STRING")
    assert rows(quality.reconcile(left, right, ["k"], "t")) == [("t", 4, 4, 2, 2, 1, False)]
    assert rows(quality.reconcile(left, left, ["k"], "t")) == [("t", 4, 4, 0, 0, 0, True)]
    assert rows(quality.differences(left, right)) == sorted(
        [(1, "a", "left", 1), (3, "c", "left", 1), (3, "d", "right", 1), (4, "e", "right", 1)], key=repr
    )


def test_copy_selects_replaces_and_verifies(spark, parent, child, tmp_path):
    source = {"order_info": parent, "order_goods": child, "im_skipped": parent}
    for _ in range(2):
        paths = copying.copy_tables(source.get, source, ["order_.*"], str(tmp_path))
    assert sorted(paths) == ["order_goods", "order_info"]
    copy = spark.read.parquet(paths["order_goods"])
    assert quality.reconcile(child, copy, ["id"], "order_goods").first()["identical"]
    assert rows(copying.merged_counts(child, copy, "order_goods")) == [("order_goods", 5, 5, True)]


def test_jdbc_slices(spark):
    source = copying.JdbcSource(spark, "jdbc:x://h/db", {"user": "u"})
    assert source.slices("order_goods", "rec_id", 1, 9, 4) == {
        "url": "jdbc:x://h/db",
        "dbtable": "order_goods",
        "partitionColumn": "rec_id",
        "lowerBound": "1",
        "upperBound": "9",
        "numPartitions": "4",
        "user": "u",
    }
    assert source.bounds_query("t", "k") == "SELECT MIN(k) AS low, MAX(k) AS high FROM t"


def test_sizes_lists_and_server(spark, child, parent, tmp_path):
    for name, df in (("child", child), ("parent", parent)):
        df.coalesce(1).write.parquet(str(tmp_path / name))
    paths = {n: str(tmp_path / n) for n in ("child", "parent")}
    report = quality.size_report(spark, {"child": child, "parent": parent}, paths)
    assert rows(report, "table_name", "rows", "files") == [("child", 5, 1), ("parent", 3, 1)]
    child.createOrReplaceTempView("a_child_view")
    assert ("a_child_view",) in rows(quality.table_list(spark), "table_name")
    assert rows(quality.schema_list(spark, ["ignored"])) == [("default",)]
    assert rows(quality.schema_list(spark, ["default"])) == []
    served = quality.server(reports.row_counts({"child": child})).first()
    assert served["engine_version"].startswith("4.") and served["current_schema"] == "default"


def test_date_columns(spark):
    df = spark.sql("SELECT 1 AS i, DATE'2024-01-01' AS d, CAST(NULL AS TIMESTAMP) AS t UNION ALL SELECT 2, DATE'2024-02-01', NULL")
    assert rows(quality.date_columns({"t": df}), "column_name", "ordinal_position", "nulls", "earliest", "latest") == [
        ("d", 2, 0, "2024-01-01", "2024-02-01"),
        ("t", 3, 2, None, None),
    ]
    with pytest.raises(ValueError):
        quality.date_columns({"t": df.select("i")})


def test_report_helpers(spark):
    df = spark.createDataFrame([(5,), (7,), (6,)], "id INT")
    assert rows(reports.next_id(df, "id", 1)) == [(8,)]
    assert rows(reports.next_id(df, "id", 100)) == [(100,)]
    assert rows(reports.sample_ids(df, "id", 2)) == [(5,), (6,)]
    assert reports.section(df, "s").first()["section"] == "s"


class _Session:
    """Just enough of a session without a shared folder."""

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master})()
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})()


def test_work_dir_prefers_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is not None:
        assert work_dir(spark, "x").startswith(f"{shared}/ebbtide/x-")
    assert "ebbtide-x-" in work_dir(_Session("local[2]"), "x")
    with pytest.raises(ValueError, match="shared by all executors"):
        work_dir(_Session("spark://host:7077"), "x")
