"""Keys, references, profiles, copies and freshness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.functions import megabytes
from ebbtide.plans import quality, reports, views
from ebbtide.plans.quality import Reference
from ebbtide.session import work_dir
from ebbtide.sources import changelog, copying
from ebbtide.streaming import health
from ebbtide.suite import retail as R
from ebbtide.suite.registry import query

KEYS = {
    "benchmark": ["item_id"],
    "conversations": ["conv_id", "turn"],
    "customer": ["c_custkey"],
    "documents": ["doc_id"],
    "embeddings": ["vec_id"],
    "events": ["event_id"],
    "labels": ["doc_id"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "nation": ["n_nationkey"],
    "orders": ["o_orderkey"],
    "pages": ["page_id"],
    "part": ["p_partkey"],
    "region": ["r_regionkey"],
    "supplier": ["s_suppkey"],
}

REFERENCES = [
    Reference("customer", "c_nationkey", "nation", "n_nationkey"),
    Reference("lineitem", "l_orderkey", "orders", "o_orderkey"),
    Reference("lineitem", "l_partkey", "part", "p_partkey"),
    Reference("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    Reference("nation", "n_regionkey", "region", "r_regionkey"),
    Reference("orders", "o_custkey", "customer", "c_custkey"),
    # Not every document has a label: the second one shows orphans.
    Reference("labels", "doc_id", "documents", "doc_id"),
    Reference("documents", "doc_id", "labels", "doc_id"),
]

ALL_TABLES = sorted(KEYS)


def _key_sql(table: str, key: list[str]) -> str:
    null = " OR ".join(f"{k} IS NULL" for k in key)
    cols = ", ".join(key)
    return f"""SELECT '{table}' AS table_name, '{",".join(key)}' AS key_columns,
  CAST(COALESCE(SUM(n), 0) AS BIGINT) AS rows, COUNT(*) FILTER (WHERE NOT bad) AS distinct_keys,
  CAST(COALESCE(SUM(n) FILTER (WHERE bad), 0) AS BIGINT) AS null_keys,
  CAST(COALESCE(SUM(n - 1) FILTER (WHERE NOT bad), 0) AS BIGINT) AS duplicates
FROM (SELECT {null} AS bad, COUNT(*) AS n FROM {table} GROUP BY {cols})"""


KEY_SQL = "\nUNION ALL ".join(_key_sql(t, k) for t, k in KEYS.items())


def _key_checks(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for name, key in KEYS.items():
        part = quality.key_check(R.table(spark, d, name), name, key)
        out = part if out is None else out.unionByName(part)
    return out


@query("key_checks", KEY_SQL)
def key_checks(spark: SparkSession, d: str) -> DataFrame:
    return _key_checks(spark, d)


@query(
    "tables_without_key",
    f"SELECT table_name FROM ({KEY_SQL}) WHERE null_keys > 0 OR duplicates > 0 ORDER BY table_name",
)
def tables_without_key(spark: SparkSession, d: str) -> DataFrame:
    return quality.tables_without_key(_key_checks(spark, d))


def _reference_sql(r: Reference) -> str:
    return f"""SELECT '{r.child}' AS child_table, '{r.column}' AS fk_column, '{r.parent}' AS parent_table,
  '{r.parent_column}' AS parent_column, COUNT(*) AS child_rows,
  COUNT(*) FILTER (WHERE c.{r.column} IS NULL) AS null_references,
  COUNT(*) FILTER (WHERE c.{r.column} IS NOT NULL AND p.k IS NULL) AS orphans,
  ROUND(COUNT(p.k) / COUNT(*), 4) AS coverage
FROM {r.child} c LEFT JOIN (SELECT DISTINCT {r.parent_column} AS k FROM {r.parent}) p ON c.{r.column} = p.k"""


@query("reference_report", "\nUNION ALL ".join(_reference_sql(r) for r in REFERENCES))
def reference_report(spark: SparkSession, d: str) -> DataFrame:
    names = {n for r in REFERENCES for n in (r.child, r.parent)}
    return quality.reference_report({n: R.table(spark, d, n) for n in names}, REFERENCES)


@query(
    "unlabelled_documents",
    "SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
)
def unlabelled_documents(spark: SparkSession, d: str) -> DataFrame:
    """Rows without a counterpart: LEFT JOIN ... IS NULL."""
    docs = R.table(spark, d, "documents").select("doc_id", "lang")
    return quality.orphans(docs, R.table(spark, d, "labels"), "doc_id")


@query("table_row_counts", "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in ALL_TABLES))
def table_row_counts(spark: SparkSession, d: str) -> DataFrame:
    return reports.row_counts({t: R.table(spark, d, t) for t in ALL_TABLES}, "table_name")


_RANKED_SQL = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in ALL_TABLES)


@query(
    "tables_largest_first",
    f"SELECT 'row counts' AS section, table_name, rows, CAST(row_number() OVER (ORDER BY rows DESC, table_name) AS INTEGER) AS place FROM ({_RANKED_SQL})",
)
def tables_largest_first(spark: SparkSession, d: str) -> DataFrame:
    """A report section ordered by an expression: what of ``table_sizes`` the tables themselves tell."""
    counts = reports.row_counts({t: R.table(spark, d, t) for t in ALL_TABLES}, "table_name")
    place = F.row_number().over(Window.orderBy(F.col("rows").desc(), "table_name"))  # one row for each table
    return reports.section(reports.largest_first(counts, F.col("rows"), "table_name").withColumn("place", place), "row counts")


@query(
    "lines_without_reversal",
    """SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem a WHERE l_returnflag <> 'R' AND NOT EXISTS (
  SELECT 1 FROM lineitem b WHERE b.l_returnflag = 'R' AND b.l_orderkey = a.l_orderkey AND b.l_partkey = a.l_partkey
    AND b.l_suppkey = a.l_suppkey)""",
)
def lines_without_reversal(spark: SparkSession, d: str) -> DataFrame:
    """The anti-join on three keys, as catalogs match constraints by schema, table and name."""
    lines = R.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
    kinds = lines.withColumn("constraint_type", F.when(F.col("l_returnflag") == "R", "REVERSAL").otherwise("SALE"))
    wanted = ["l_orderkey", "l_partkey", "l_suppkey"]
    sales = kinds.where("constraint_type = 'SALE'").select(*wanted)
    return quality.missing_constraints(sales, kinds.select(*wanted, "constraint_type"), wanted, "REVERSAL")


@query(
    "megabytes_per_source",
    "SELECT source, ROUND(SUM(strlen(text)) / 1048576.0, 2) AS total_mb FROM documents GROUP BY source",
)
def megabytes_per_source(spark: SparkSession, d: str) -> DataFrame:
    """Bytes as megabytes, over what both engines can measure."""
    sized = R.table(spark, d, "documents").groupBy("source").agg(F.sum(F.octet_length("text")).alias("bytes"))
    return sized.select("source", megabytes(F.col("bytes")).alias("total_mb"))


@query(
    "windows_to_the_millisecond",
    """SELECT CAST(time_bucket(INTERVAL '10 seconds', l_shipdate, TIMESTAMP '1970-01-01') AS TIMESTAMP) AS window_start,
  CAST(time_bucket(INTERVAL '10 seconds', l_shipdate, TIMESTAMP '1970-01-01') + INTERVAL '10 seconds' AS TIMESTAMP) AS window_end,
  COUNT(*) AS line_items FROM lineitem GROUP BY 1, 2""",
)
def windows_to_the_millisecond(spark: SparkSession, d: str) -> DataFrame:
    """Window bounds cut to TIMESTAMP(3)."""
    windows = views.revenue_by_window(R.lines(spark, d), "ts", "10 seconds")
    return views.millisecond_windows(windows).select(
        *(F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")), "line_items"
    )


@query("table_sizes")
def table_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Rows and megabytes on disk, largest first.  SQL over the tables cannot see file sizes."""
    paths = {t: f"{d.rstrip('/')}/{t}.parquet" for t in ALL_TABLES}
    report = quality.size_report(spark, {t: R.table(spark, d, t) for t in ALL_TABLES}, paths)
    return reports.section(report, "row counts and sizes")


@query("tables_and_server")
def tables_and_server(spark: SparkSession, d: str) -> DataFrame:
    """Row counts with the engine version and current schema, which differ between engines."""
    counts = reports.row_counts({t: R.table(spark, d, t) for t in ALL_TABLES}, "table_name")
    return reports.section(quality.server(counts), "tables and server")


@query("registered_tables")
def registered_tables(spark: SparkSession, d: str) -> DataFrame:
    """The given tables in the session catalog, with their rows counted through it."""
    for name in ALL_TABLES:
        R.table(spark, d, name).createOrReplaceTempView(name)
    listed = quality.table_list(spark).where(F.col("table_name").isin(ALL_TABLES))
    counts = reports.row_counts({t: spark.table(t) for t in ALL_TABLES}, "table_name")
    return listed.join(counts, "table_name").orderBy("table_name")


DATE_TABLES = {"events": [("ts", 2)], "lineitem": [("l_shipdate", 11)], "orders": [("o_orderdate", 5)]}


def _date_sql(table: str, column: str, place: int) -> str:
    return f"""SELECT '{table}' AS table_name, {place} AS ordinal_position, '{column}' AS column_name,
  'timestamp_ntz' AS data_type, 'YES' AS is_nullable, COUNT(*) FILTER (WHERE {column} IS NULL) AS nulls,
  CAST(MIN({column}) AS VARCHAR) AS earliest, CAST(MAX({column}) AS VARCHAR) AS latest FROM {table}"""


@query("date_columns", "\nUNION ALL ".join(_date_sql(t, c, p) for t, cs in DATE_TABLES.items() for c, p in cs))
def date_columns(spark: SparkSession, d: str) -> DataFrame:
    return quality.date_columns({t: R.table(spark, d, t) for t in ALL_TABLES})


# -- freshness

FRESH_SQL = """SELECT COALESCE(CAST(MAX(window_end) AS VARCHAR), 'none') AS newest_window,
  COALESCE(CAST(CAST(ROUND(date_diff('second', MAX(window_end), TIMESTAMP '2002-01-01')) AS BIGINT) AS VARCHAR), 'n/a') AS age_seconds
FROM (SELECT time_bucket(INTERVAL '10 seconds', l_shipdate, TIMESTAMP '1970-01-01') + INTERVAL '10 seconds' AS window_end
      FROM lineitem {where})"""


@query("freshness", FRESH_SQL.format(where=""))
def freshness(spark: SparkSession, d: str) -> DataFrame:
    windows = views.revenue_by_window(R.lines(spark, d), "ts", "10 seconds")
    return health.freshness(windows, F.expr("TIMESTAMP_NTZ'2002-01-01 00:00:00'"))


@query(
    "staleness_verdict",
    "SELECT *, CASE WHEN age_seconds = 'n/a' THEN 'empty' WHEN CAST(age_seconds AS BIGINT) > 3600 THEN 'stale' ELSE 'current' END AS verdict FROM ("
    + FRESH_SQL.format(where="")
    + ")",
)
def staleness_verdict(spark: SparkSession, d: str) -> DataFrame:
    windows = views.revenue_by_window(R.lines(spark, d), "ts", "10 seconds")
    return health.verdict(windows, 3600, F.expr("TIMESTAMP_NTZ'2002-01-01 00:00:00'"))


# -- copies

COPIED = ["customer", "nation", "orders", "part", "region", "supplier"]
COPY_SQL = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS left_rows, count(*) AS right_rows, CAST(0 AS BIGINT) AS only_left, "
    f"CAST(0 AS BIGINT) AS only_right, CAST(0 AS BIGINT) AS changed_keys, true AS identical FROM {t}"
    for t in COPIED
)


@query("copied_tables", COPY_SQL)
def copied_tables(spark: SparkSession, d: str) -> DataFrame:
    """Copy the included tables and verify the copy row for row."""
    including = ["customer", "nation|region", "orders", "part", "suppl.*"]
    paths = copying.copy_tables(
        lambda t: R.table(spark, d, t), ALL_TABLES, including, work_dir(spark, "copy")
    )
    out = None
    for name, path in paths.items():
        part = quality.reconcile(R.table(spark, d, name), spark.read.parquet(path), KEYS[name], name)
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "reconciled_line_items",
    R.SQL + """SELECT 'order_goods' AS table_name, (SELECT COUNT(*) FROM li) AS left_rows, (SELECT COUNT(*) FROM li2) AS right_rows,
  COUNT(*) FILTER (WHERE flag = 'R' OR status = 'O') AS only_left,
  COUNT(*) FILTER (WHERE flag <> 'R' AND status = 'O') AS only_right,
  COUNT(*) FILTER (WHERE flag <> 'R' AND status = 'O') AS changed_keys, false AS identical FROM li""",
)
def reconciled_line_items(spark: SparkSession, d: str) -> DataFrame:
    """The first against the last state of the line-items."""
    old, new = R.LINES.conform(R.lines(spark, d)), changelog.replay(R.decoded(spark, d, R.LINES), R.LINES)
    return quality.reconcile(old, new, R.LINES.key, R.LINES.name)


@query(
    "line_item_differences",
    R.SQL + """SELECT rec_id, deal_price, 'left' AS side, CAST(1 AS BIGINT) AS surplus FROM li WHERE flag = 'R' OR status = 'O'
UNION ALL SELECT rec_id, deal_price * 0.9, 'right', 1 FROM li WHERE flag <> 'R' AND status = 'O'""",
)
def line_item_differences(spark: SparkSession, d: str) -> DataFrame:
    """Both sides lie by key, so the rows themselves are compared without another exchange."""
    old = R.LINES.conform(R.lines(spark, d)).repartition(*R.LINES.key)
    new = changelog.replay_by_key(R.decoded(spark, d, R.LINES), R.LINES)
    return quality.differences(old, new).select("rec_id", "deal_price", "side", "surplus")
