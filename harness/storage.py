"""Registered queries: loading files into tables and merging tables.

They write below the session's shared scratch folder and return what the
tables hold.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.operators.merge import Unmatched
from cairn.operators.quality import Rule
from cairn.plans.incremental import change_daily, create_daily, read_daily
from cairn.plans.warehouse import GOLD_INPUTS, Warehouse
from cairn.session import scratch_dir
from cairn.sources.clustered import read_clustered, write_clustered
from cairn.sources.files import (
    FILE_COLUMN,
    LINEAGE_COLUMN,
    LOAD_COLUMN,
    PlannedLoad,
    active_loads,
    discover,
    ingest_all,
    ingest_file,
    ingest_new,
    load_plan,
    read_checked,
    read_delimited,
    read_delimited_lines,
    read_files,
    with_lineage,
)
from cairn.sources.tables import create_layers, read_table, replace_rows, table_exists, upsert_table, write_table
from cairn.sources.validated import validated, write_validated
from cairn.plans.silver import SILVER, silver_transform
from harness.layers import LOAD_TIME, gold_model, gold_sql, silver_sql
from harness.operators import CHANGES_SQL, MERGE_KEY, TARGET_SQL, merge_sides, merge_sql
from harness.registry import query
from harness.retail import raw, source

_LOADED = ("customer", "orders", "lineitem")


def _database(spark: SparkSession, label: str) -> str:
    """A new database below the scratch folder."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    create_layers(spark, {name: scratch_dir(spark, label)})
    return name


def _counts_sql(tables, columns: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count {columns} FROM {t}" for t in tables
    )


# -- raw load --------------------------------------------------------------


@query(
    "bronze_ingest",
    _counts_sql(_LOADED, ", 'loaded' AS status, count(*) AS stamped_rows, TRUE AS one_load_time"),
)
def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load files into tables; the status report next to what the tables hold."""
    database = _database(spark, "bronze")
    plan = [PlannedLoad(t, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in _LOADED]
    report = ingest_all(spark, plan, database)
    held = None
    for table in _LOADED:
        stamped = read_table(spark, f"{database}.{table}").agg(
            F.lit(table).alias("held_table"),
            F.count(LINEAGE_COLUMN).alias("stamped_rows"),
            (F.min(LINEAGE_COLUMN) == F.max(LINEAGE_COLUMN)).alias("one_load_time"),
        )
        held = stamped if held is None else held.unionByName(stamped)
    return report.join(held, F.col("table_name") == F.col("held_table")).select(
        "table_name", "row_count", "status", "stamped_rows", "one_load_time"
    )


def _landing_zone(spark: SparkSession, sf_dir: str) -> str:
    """Files as an extraction leaves them: one folder per subject area."""
    root = scratch_dir(spark, "landing")
    for folder, tables in _LANDING.items():
        for table in tables:
            source(spark, sf_dir, table).write.parquet(f"{root}/{folder}/{table}.parquet")
    return root


# Two folders hold a file of the same name: both are loaded, under longer names.
_LANDING = {"sales": ("orders", "customer"), "places": ("nation", "region"), "archive": ("nation",)}
_LANDED_SQL = " UNION ALL ".join(
    f"SELECT '{f'{folder}_{t}' if t == 'nation' else t}' AS table_name, count(*) AS row_count, "
    f"'{folder}' AS folder FROM {t}"
    for folder, tables in _LANDING.items()
    for t in tables
)


@query("bronze_load_plan", f"SELECT *, TRUE AS table_created FROM ({_LANDED_SQL})")
def bronze_load_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discover the landing folders and load all that was found."""
    database = _database(spark, "discovered")
    found = discover(spark, _landing_zone(spark, sf_dir))
    report = ingest_all(spark, found.values(), database)
    created = spark.createDataFrame(
        [(name, table_exists(spark, f"{database}.{name}")) for name in found],
        "table_name string, table_created boolean",
    )
    folder = F.element_at(F.split("file_path", "/"), -2).alias("folder")
    return (
        load_plan(spark, found)
        .join(report, "table_name")
        .join(created, "table_name")
        .select("table_name", "row_count", folder, "table_created")
    )


@query("active_tables", f"SELECT table_name, row_count FROM ({_LANDED_SQL}) WHERE row_count > 20")
def active_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only tables that a control table switches on are loaded. Here it
    switches on those with more than 20 rows."""
    database = _database(spark, "active")
    found = discover(spark, _landing_zone(spark, sf_dir))
    control = None
    for load in found.values():
        switch = read_files(spark, load.file_path).agg(
            F.lit(load.table_name).alias("table_name"), (F.count(F.lit(1)) > 20).cast("int").alias("active")
        )
        control = switch if control is None else control.unionByName(switch)
    chosen = {row.table_name for row in active_loads(load_plan(spark, found), control).toLocalIterator()}
    report = ingest_all(spark, [found[name] for name in sorted(chosen)], database)
    return report.select("table_name", "row_count")


@query(
    "bronze_ingest_json",
    "SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier",
)
def bronze_ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON documents that span lines, each an array of up to 10,000 records."""
    folder = f"{scratch_dir(spark, 'json')}/docs"
    suppliers = source(spark, sf_dir, "supplier")
    documents = suppliers.groupBy(F.floor(F.col("s_suppkey") / 10000).alias("chunk")).agg(
        F.to_json(F.collect_list(F.struct(*suppliers.columns)), {"pretty": "true"}).alias("value")
    )
    documents.select("value").write.option("maxRecordsPerFile", 1).text(folder)
    database = _database(spark, "documents")
    ingest_file(spark, folder, f"{database}.supplier", fmt="json")
    return read_table(spark, f"{database}.supplier").select(*suppliers.columns)


def _half(df: DataFrame, first: bool) -> DataFrame:
    return df.where("o_orderkey % 2 = 0" if first else "o_orderkey % 2 = 1")


@query(
    "bronze_ingest_new",
    """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 1 AND o_custkey % 5 <> 0 THEN 2 ELSE 1 END AS loads,
              3 AS first_files, 2 AS second_files, 0 AS third_files
       FROM orders WHERE o_custkey % 5 <> 0 OR o_orderkey % 2 = 0
       UNION ALL SELECT -n_nationkey, 0, 2, 3, 2, 0 FROM nation""",
)
def bronze_ingest_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rounds of one landing folder: all files are new; one is new, one has changed and one is equal; all are equal."""
    root, database = scratch_dir(spark, "growing"), _database(spark, "growing")
    table = f"{database}.orders"
    orders = source(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    none = orders.where("o_orderkey < 0")

    def land(df: DataFrame, name: str) -> None:
        df.coalesce(1).write.mode("overwrite").parquet(f"{root}/{name}")

    for name, frame in (("even", _half(orders, True)), ("odd", _half(orders, False)), ("none", none)):
        land(frame, name)
    first, _ = ingest_new(spark, root, table)
    known = read_table(spark, table).select(LOAD_COLUMN).first()[0]
    nations = source(spark, sf_dir, "nation").selectExpr(
        "-CAST(n_nationkey AS BIGINT) AS o_orderkey", "0D AS o_totalprice", "CAST(1 AS BIGINT) AS o_custkey"
    )
    # A writer gives a changed file another name: the old one is dropped with its rows by hand.
    changed = read_table(spark, table).where("o_orderkey % 2 = 1").select(FILE_COLUMN).first()[0]
    land(_half(orders, False).where("o_custkey % 5 <> 0"), "odd")
    land(nations, "nations")
    replace_rows(read_table(spark, table).where("false"), table, F.col(FILE_COLUMN) == changed)
    second, _ = ingest_new(spark, root, table)
    third, _ = ingest_new(spark, root, table)
    loads = F.when(F.col(LOAD_COLUMN) == known, 1).otherwise(2).alias("loads")
    counts = [F.lit(n).alias(f"{name}_files") for name, n in (("first", first), ("second", second), ("third", third))]
    return read_table(spark, table).select("o_orderkey", "o_totalprice", loads, *counts)


# -- delimited text --------------------------------------------------------


def _orders_as_text(spark: SparkSession, sf_dir: str) -> str:
    folder = f"{scratch_dir(spark, 'csv')}/orders"
    customer = F.when(F.col("o_orderkey") % 10 == 0, F.lit("NULL")).otherwise(F.col("o_custkey").cast("string"))
    orders = source(spark, sf_dir, "orders").withColumn("o_custkey", customer)
    orders.write.option("sep", "|").option("header", True).csv(folder)
    return folder


_TEXT_COLUMNS = "o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@query(
    "csv_inferred",
    f"""SELECT {_TEXT_COLUMNS}, CASE WHEN o_orderkey % 10 = 0 THEN 'NULL' ELSE CAST(o_custkey AS VARCHAR) END
        AS o_custkey FROM orders""",
)
def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text ``NULL`` makes the customer column text."""
    orders = read_delimited(spark, _orders_as_text(spark, sf_dir), sep="|")
    return orders.withColumn("o_orderkey", F.col("o_orderkey").cast("long"))


@query(
    "csv_typed",
    f"""SELECT {_TEXT_COLUMNS}, CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS o_custkey FROM orders""",
)
def csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text ``NULL`` becomes NULL in a number column."""
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType(), False),
            T.StructField("o_custkey", T.LongType(), False),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("o_orderdate", T.TimestampType()),
            T.StructField("o_orderpriority", T.StringType()),
        ]
    )
    return read_delimited(spark, _orders_as_text(spark, sf_dir), sep="|", schema=schema)


_BROKEN = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
                    CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey,
                    CASE WHEN o_orderkey % 13 = 0 THEN '1995-02-30' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END
                        AS o_orderdate,
                    o_orderpriority FROM orders"""


@query(
    "csv_rejects",
    f"""SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey,
               CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority, '' AS failed
        FROM ({_BROKEN}) WHERE o_custkey <> 'n/a' AND o_orderdate <> '1995-02-30'
        UNION ALL
        SELECT CAST(o_orderkey AS BIGINT), NULL, NULL, NULL,
               concat_ws(',', CASE WHEN o_custkey = 'n/a' THEN 'o_custkey' END,
                              CASE WHEN o_orderdate = '1995-02-30' THEN 'o_orderdate' END)
        FROM ({_BROKEN}) WHERE o_custkey = 'n/a' OR o_orderdate = '1995-02-30'""",
)
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited text with bad numbers and dates: typed rows, and rejects with the columns that failed."""
    folder = f"{scratch_dir(spark, 'csv')}/orders"
    sql = _BROKEN.replace("VARCHAR", "STRING").replace("FROM orders", "FROM {orders}")
    spark.sql(sql, orders=source(spark, sf_dir, "orders")).write.csv(folder, sep="|", header=True)
    schema = "o_orderkey long, o_custkey long, o_orderdate date, o_orderpriority string"
    typed, rejects = read_checked(spark, folder, T.StructType.fromDDL(schema), sep="|")
    key = F.substring_index("line", "|", 1).cast("long").alias("o_orderkey")
    nothing = [F.lit(None).cast(kind).alias(n) for n, kind in (("c", "long"), ("d", "date"), ("p", "string"))]
    return typed.withColumn("failed", F.lit("")).union(
        rejects.select(key, *nothing, F.array_join("failed_columns", ",").alias("failed"))
    )


_RULES = [Rule("cheap", "l_extendedprice < 50000"), Rule("returned", "l_returnflag <> 'N'"), Rule("few", "l_quantity <= 40")]


@query(
    "validate_once",
    """SELECT l_orderkey, l_linenumber, failed_rules, (SELECT count(*) FROM lineitem WHERE l_extendedprice < 50000
              AND l_returnflag <> 'N' AND l_quantity <= 40) AS valid_rows
       FROM (SELECT *, concat_ws(',', CASE WHEN NOT l_extendedprice < 50000 THEN 'cheap' END,
                                      CASE WHEN NOT l_returnflag <> 'N' THEN 'returned' END,
                                      CASE WHEN NOT l_quantity <= 40 THEN 'few' END) AS failed_rules FROM lineitem)
       WHERE failed_rules <> ''""",
)
def validate_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules as bits of one number; valid and rejected rows are written by one job."""
    table = f"{_database(spark, 'validated')}.lines"
    write_validated(source(spark, sf_dir, "lineitem"), _RULES, table)
    valid, rejected = validated(spark, table, _RULES)
    names = F.array_join("failed_rules", ",").alias("failed_rules")
    return rejected.select("l_orderkey", "l_linenumber", names, F.lit(valid.count()).alias("valid_rows"))


_AMOUNTS = ("SubTotal", "TaxAmt", "Freight", "TotalDue")
# An order with amounts of 19 digits, numbers written in other ways, and text that is no number.
_FEW_ORDERS = [
    {"SalesOrderID": "-1", "SubTotal": "123456789012345.6789", "TaxAmt": "0.0001", "Freight": "2e1", "Status": "5.0"},
    {"SalesOrderID": "-2.0", "SubTotal": "1", "TaxAmt": "NULL", "Freight": "1", "Status": "5"},
    {"SalesOrderID": "-3", "SubTotal": "9", "TaxAmt": "8", "Freight": "7", "Status": "five"},
]


@query(
    "silver_from_text",
    f"""SELECT SalesOrderID, {", ".join(_AMOUNTS)} FROM ({silver_sql("sales_salesorderheader")})
        UNION ALL SELECT -1, 123456789012345.6789, 0.0001, 20, 123456789012365.679000
        UNION ALL
        SELECT SalesOrderDetailID, UnitPrice, UnitPriceDiscount, OrderQty, LineTotal
        FROM ({silver_sql("sales_salesorderdetail")})""",
)
def silver_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and lines whose raw tables are delimited text, and a few lines in memory."""
    load_time = F.lit(LOAD_TIME).cast("timestamp")

    def cleaned(df: DataFrame, table: str) -> DataFrame:
        return silver_transform(df, SILVER[table], load_time=load_time, stable_row_ids=True)

    def from_text(table: str) -> DataFrame:
        given = raw(spark, sf_dir, table)
        folder = scratch_dir(spark, "text")
        texts = given.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in given.columns])
        texts.write.csv(folder, sep="|", header=True)
        return cleaned(read_delimited(spark, folder, sep="|", schema=texts.schema), table)

    names = [c for c in SILVER["sales_salesorderheader"].schema.names if c != "TotalDue"]
    usual = {"OrderDate": "2020-01-01", "DueDate": "2020-01-02", "ShipDate": "2020-01-03", "ModifiedDate": "2020-01-01"}
    lines = ["|".join(names)]
    for order in _FEW_ORDERS:
        values = {"OnlineOrderFlag": "1"} | usual | order
        lines.append("|".join(values.get(n, "0") for n in names))
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    few = cleaned(read_delimited_lines(spark, lines, sep="|", schema=text), "sales_salesorderheader")
    headers = from_text("sales_salesorderheader").unionByName(few).select("SalesOrderID", *_AMOUNTS)
    money, total = "decimal(19,4)", "decimal(38,6)"
    details = from_text("sales_salesorderdetail").select(
        "SalesOrderDetailID",
        "UnitPrice",
        "UnitPriceDiscount",
        F.col("OrderQty").cast(money),
        F.col("LineTotal").cast(total),
    )
    return headers.union(details)


# -- the layers as tables --------------------------------------------------


@query("warehouse_tables", gold_sql("ft_agg_product_day"))
def warehouse_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tables, silver tables, fact, dimension and aggregate, each written
    and read back."""
    suffix = uuid.uuid4().hex[:12]
    lake = Warehouse(f"bronze_{suffix}", f"silver_{suffix}", f"gold_{suffix}")
    lake.create(spark, scratch_dir(spark, "warehouse"))
    inputs = ("FactInternetSales", "DimProduct")
    tables = sorted({table for model in inputs for table in GOLD_INPUTS[model].values()})
    for table in tables:
        write_table(with_lineage(raw(spark, sf_dir, table)), f"{lake.bronze}.{table}")
    load_time = F.lit(LOAD_TIME).cast("timestamp")
    lake.refresh_silver(spark, tables, load_time=load_time, stable_row_ids=True, wide_ids=True)
    lake.refresh_gold(spark, [*inputs, "ft_agg_product_day"], wide_ids=True, silver_unique=True)
    return read_table(spark, f"{lake.gold}.ft_agg_product_day")


_CLUSTERED = """OrderDateKey BETWEEN TIMESTAMP '1995-01-01 00:00:00' AND TIMESTAMP '1995-12-31 00:00:00'
                AND ProductKey BETWEEN 20 AND 150"""


@query("fact_clustered", f"SELECT * FROM ({gold_sql('FactInternetSales')}) WHERE {_CLUSTERED}")
def fact_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales fact, written in Z-order of date and product, and read by both."""
    table = f"{_database(spark, 'clustered')}.fact"
    write_clustered(gold_model(spark, sf_dir, "FactInternetSales"), table, ["OrderDateKey", "ProductKey"], files=16)
    return read_clustered(spark, table, {"OrderDateKey": (datetime(1995, 1, 1), datetime(1995, 12, 31)), "ProductKey": (20, 150)})


_KEPT = "SalesOrderDetailID % 10 <> 7"
_CHANGED_FACT = """SELECT ProductKey, CASE WHEN SalesOrderDetailID % 10 = 5 THEN OrderDateKey + INTERVAL 3 DAY ELSE OrderDateKey END
                          AS OrderDateKey, SalesOrderDetailID,
                          CASE WHEN SalesOrderDetailID % 10 = 5 THEN OrderQty + 1 ELSE OrderQty END AS OrderQty,
                          CASE WHEN SalesOrderDetailID % 10 = 5 THEN LineTotal * 2 ELSE LineTotal END AS LineTotal
                   FROM fact"""


@query(
    "ft_agg_incremental",
    f"""WITH fact AS ({gold_sql('FactInternetSales')}), changed AS ({_CHANGED_FACT})
        SELECT f.ProductKey, CAST(f.OrderDateKey AS DATE) AS OrderDate, p.ProductName, p.CategoryName AS ProductCategoryName,
               p.SubcategoryName AS ProductSubcategoryName, CAST(sum(f.OrderQty) AS BIGINT) AS TotalOrderQty,
               CAST(sum(f.LineTotal) AS DECIMAL(38,6)) AS TotalLineTotal
        FROM changed f LEFT JOIN ({gold_sql('DimProduct')}) p ON f.ProductKey = p.ProductKey
        WHERE f.{_KEPT} GROUP BY ALL""",
)
def ft_agg_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily aggregate after inserts, updates that move to another day, and deletes; not computed again."""
    table = f"{_database(spark, 'daily')}.state"
    columns = ["ProductKey", "OrderDateKey", "SalesOrderDetailID", "OrderQty", "LineTotal"]
    write_table(gold_model(spark, sf_dir, "FactInternetSales").select(*columns), f"{table}_fact")
    fact = read_table(spark, f"{table}_fact")
    changed = spark.sql(_CHANGED_FACT.replace("FROM fact", "FROM {fact}"), fact=fact)
    digit = F.col("SalesOrderDetailID") % 10
    create_daily(fact.where(digit != 3), table)
    change_daily(spark, table, fact.where(digit == 7), changed.where(digit == 3))
    change_daily(spark, table, fact.where(digit == 5), changed.where(digit == 5))
    return read_daily(spark, table, gold_model(spark, sf_dir, "DimProduct"))


# -- tables ----------------------------------------------------------------


@query("merge_create", TARGET_SQL)
def merge_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert into a table that does not exist creates it."""
    target, _ = merge_sides(spark, sf_dir)
    table = f"{_database(spark, 'created')}.orders"
    upsert_table(target, table, ["id"])
    return read_table(spark, table)


@query("merge_table", merge_sql("t.id IS NULL OR NOT coalesce(t.state = 'F', FALSE)"))
def merge_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge on a table: written, merged into and read back."""
    target, changes = merge_sides(spark, sf_dir)
    table = f"{_database(spark, 'merged')}.orders"
    upsert_table(target, table, ["id"])
    upsert_table(changes, table, ["id"], Unmatched.DELETE, "state = 'F'")
    return read_table(spark, table)


_MOVED = "CASE WHEN id % 7 = 0 THEN NULL WHEN id % 5 = 0 THEN 'moved' ELSE state END"


@query(
    "merge_table_partitioned",
    f"""WITH t AS ({TARGET_SQL}),
             s AS (SELECT id, customer, amount, {_MOVED} AS state FROM ({CHANGES_SQL}) WHERE id IS NULL OR id % 4 = 0)
        SELECT * FROM s UNION ALL
        SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.id = t.id)
                          AND (t.id IS NULL OR NOT coalesce(t.amount > 400000, FALSE))""",
)
def merge_table_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge into a table partitioned by order state; some rows move to another partition, NULL included."""
    target, changes = merge_sides(spark, sf_dir)
    changes = changes.where("id IS NULL OR id % 4 = 0").withColumn("state", F.expr(_MOVED))
    table = f"{_database(spark, 'parted')}.orders"
    upsert_table(target, table, ["id"], partition_by=["state"])
    upsert_table(changes, table, ["id"], Unmatched.DELETE, "amount > 400000")
    return read_table(spark, table)


@query("merge_bucketed", merge_sql("t.id IS NULL OR NOT coalesce(t.state = 'F', FALSE)"))
def merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge of merge_table on a table bucketed by the key: both sides stay in their buckets."""
    target, changes = merge_sides(spark, sf_dir)
    table = f"{_database(spark, 'bucketed')}.orders"
    write_table(target, table, bucket_by=["id"], buckets=8)
    upsert_table(changes, table, ["id"], Unmatched.DELETE, "state = 'F'")
    return read_table(spark, table)


@query(
    "overwrite_new_schema",
    f"""SELECT CAST(floor(amount / 1000) AS BIGINT) AS id, count(*) AS copies,
               string_agg(DISTINCT state, '' ORDER BY state) AS states, 3 AS schemas
        FROM ({TARGET_SQL}) GROUP BY 1""",
)
def overwrite_new_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced from itself twice, each time with other columns and types."""
    target, _ = merge_sides(spark, sf_dir)
    table = f"{_database(spark, 'reshaped')}.orders"
    seen = set()
    write_table(target, table)
    seen.add(read_table(spark, table).schema.simpleString())
    write_table(read_table(spark, table).selectExpr("state", "CAST(floor(amount / 1000) AS STRING) AS id"), table)
    seen.add(read_table(spark, table).schema.simpleString())
    states = F.concat_ws("", F.array_sort(F.collect_set("state"))).alias("states")
    counted = read_table(spark, table).groupBy(F.col("id").cast("long").alias("id"))
    write_table(counted.agg(F.count(F.lit(1)).alias("copies"), states), table)
    held = read_table(spark, table)
    seen.add(held.schema.simpleString())
    return held.withColumn("schemas", F.lit(len(seen)))


@query(
    "overwrite_table",
    f"SELECT {MERGE_KEY} AS id, count(*) AS copies, max(o_totalprice) AS amount FROM orders GROUP BY ALL",
)
def overwrite_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by a summary of itself, with another schema."""
    target, _ = merge_sides(spark, sf_dir)
    table = f"{_database(spark, 'replaced')}.orders"
    orders = source(spark, sf_dir, "orders")
    write_table(orders.selectExpr(f"{MERGE_KEY} AS id", "o_totalprice AS amount"), table)
    summary = read_table(spark, table).groupBy("id").agg(
        F.count(F.lit(1)).alias("copies"), F.max("amount").alias("amount")
    )
    write_table(summary, table)
    return read_table(spark, table)
