"""Registered queries: the operators one by one, on the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import columns as C
from cairn.operators.compare import comparison, except_all, large_row_differences, row_differences
from cairn.operators.dedup import current_rows, keep_latest
from cairn.operators.hot_keys import salted_join
from cairn.operators.joins import anti_join, lookup_join
from cairn.operators.merge import Unmatched, merge_frames
from cairn.operators.preview import preview
from cairn.operators.quality import Rule, rejected_rows, validate
from cairn.operators.schema import require_columns, require_layout
from cairn.plans.gold import ft_agg_product_day
from cairn.plans.silver import DORMANT_PRODUCT_RULES, SILVER, silver_transform
from cairn.plans.types import DATE_TIME, DAY, INT, LONG, MONEY, SHORT, WEIGHT, columns
from harness.layers import LOAD_TIME, silver
from harness.registry import query
from harness.retail import raw, raw_for_duckdb, source

# -- dedup -----------------------------------------------------------------


@query(
    "dedup_latest_single",
    """SELECT * FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST,
           o_orderkey, o_orderstatus, o_totalprice, o_orderpriority) = 1""",
)
def dedup_latest_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest(source(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")


@query(
    "dedup_latest_composite",
    """SELECT * FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
           l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
           l_linestatus) = 1""",
)
def dedup_latest_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest(source(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


@query(
    "dedup_hot_keys",
    """SELECT * FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate DESC NULLS LAST,
           l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
           l_linestatus) = 1""",
)
def dedup_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three keys share all rows: one third each."""
    return keep_latest(source(spark, sf_dir, "lineitem"), "l_returnflag", "l_shipdate")


@query(
    "dedup_join_result",
    """SELECT o_custkey, l_partkey, l_quantity
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       QUALIFY row_number() OVER (PARTITION BY o_custkey, l_partkey
                                  ORDER BY o_orderdate DESC NULLS LAST, l_quantity) = 1""",
)
def dedup_join_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = source(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = source(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    bought = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    return current_rows(bought, ["o_custkey", "l_partkey"], ["l_quantity"], "o_orderdate")


@query(
    "latest_per_entity",
    """SELECT l_partkey, l_extendedprice AS latest_price FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_partkey
                                  ORDER BY l_shipdate DESC NULLS LAST, l_extendedprice) = 1""",
)
def latest_per_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = source(spark, sf_dir, "lineitem")
    latest = current_rows(history, ["l_partkey"], ["l_extendedprice"], "l_shipdate")
    return latest.withColumnRenamed("l_extendedprice", "latest_price")


# -- projections and expressions -------------------------------------------


@query(
    "cast_projection",
    """SELECT l_orderkey, CAST(l_quantity AS SMALLINT) AS l_quantity,
              CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_linenumber END AS line_text,
              CAST(l_extendedprice AS DECIMAL(19,4)) AS l_extendedprice,
              CAST(l_discount AS DECIMAL(8,2)) AS l_discount,
              CAST(l_shipdate AS TIMESTAMP) AS l_shipdate, CAST(l_shipdate AS DATE) AS ship_day
       FROM lineitem""",
)
def cast_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that is no number becomes NULL and does not fail the job."""
    schema = columns(
        l_orderkey=LONG,
        l_quantity=SHORT,
        line_text=INT,
        l_extendedprice=MONEY,
        l_discount=WEIGHT,
        l_shipdate=DATE_TIME,
        ship_day=DAY,
    )
    text = F.when(F.col("l_returnflag") == "A", F.lit("NULL")).otherwise(F.col("l_linenumber").cast("string"))
    lines = source(spark, sf_dir, "lineitem")
    return C.cast_projection(lines.withColumns({"line_text": text, "ship_day": F.col("l_shipdate")}), schema)


@query(
    "alias_projection",
    """SELECT p_partkey AS ProductKey, p_partkey AS ProductAlternateKey, p_name AS ProductName,
              p_type AS CategoryName FROM part""",
)
def alias_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.project(
        source(spark, sf_dir, "part"),
        {
            "ProductKey": "p_partkey",
            "ProductAlternateKey": "p_partkey",
            "ProductName": "p_name",
            "CategoryName": "p_type",
        },
    )


_KEY_ID_SQL = "md5('orders|' || length(CAST(SalesOrderID AS VARCHAR)) || ':' || CAST(SalesOrderID AS VARCHAR))"


@query(
    "null_defaults",
    f"""SELECT SalesOrderID, TRUE AS random_id_filled, rowguid IS NOT NULL AS random_id_kept,
               coalesce(rowguid, substr({_KEY_ID_SQL}, 1, 8) || '-' || substr({_KEY_ID_SQL}, 9, 4) || '-'
                   || substr({_KEY_ID_SQL}, 13, 4) || '-' || substr({_KEY_ID_SQL}, 17, 4) || '-'
                   || substr({_KEY_ID_SQL}, 21, 12)) AS key_id,
               coalesce(ModifiedDate, TIMESTAMP '{LOAD_TIME}') AS change_date,
               TRUE AS now_filled
        FROM ({raw_for_duckdb('sales_salesorderheader')})""",
)
def null_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random ids and the current time differ per run, so only their presence
    is shown; the key hash and the fixed load time are shown as they are."""
    orders = raw(spark, sf_dir, "sales_salesorderheader")
    random_id = C.default_random_id("rowguid")
    return orders.select(
        "SalesOrderID",
        random_id.isNotNull().alias("random_id_filled"),
        F.col("rowguid").eqNullSafe(random_id).alias("random_id_kept"),
        C.default_key_id("rowguid", "orders", ["SalesOrderID"]).alias("key_id"),
        C.default_load_time("ModifiedDate", F.lit(LOAD_TIME).cast("timestamp")).alias("change_date"),
        C.default_load_time("ModifiedDate").isNotNull().alias("now_filled"),
    )


@query(
    "derived_account_number",
    f"""SELECT CustomerID, coalesce(AccountNumber, 'AW' || printf('%09d', CustomerID)) AS AccountNumber
        FROM ({raw_for_duckdb('sales_customer')})""",
)
def derived_account_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = raw(spark, sf_dir, "sales_customer")
    number = C.default_account_number("AccountNumber", "CustomerID")
    return customers.select("CustomerID", number.alias("AccountNumber"))


@query(
    "null_out_bad_interval",
    f"""SELECT ProductID, StartDate, CASE WHEN EndDate < StartDate THEN NULL ELSE EndDate END AS EndDate
        FROM ({raw_for_duckdb('production_productcosthistory')})""",
)
def null_out_bad_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = raw(spark, sf_dir, "production_productcosthistory")
    return history.select("ProductID", "StartDate", C.null_if_before("EndDate", "StartDate").alias("EndDate"))


@query(
    "guarded_total",
    f"""SELECT SalesOrderID,
               CAST(CASE WHEN SubTotal IS NOT NULL AND TaxAmt IS NOT NULL AND Freight IS NOT NULL
                         THEN SubTotal + TaxAmt + Freight ELSE 0 END AS DECIMAL(38,6)) AS TotalDue
        FROM ({raw_for_duckdb('sales_salesorderheader')})""",
)
def guarded_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = raw(spark, sf_dir, "sales_salesorderheader")
    total = C.guarded_total("SubTotal", "TaxAmt", "Freight").cast("decimal(38,6)")
    return orders.select("SalesOrderID", total.alias("TotalDue"))


@query(
    "line_total",
    f"""SELECT SalesOrderDetailID, CAST(UnitPrice * (1 - UnitPriceDiscount) * OrderQty AS DECIMAL(38,6)) AS LineTotal
        FROM ({raw_for_duckdb('sales_salesorderdetail')})""",
)
def line_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = raw(spark, sf_dir, "sales_salesorderdetail")
    total = C.line_total("UnitPrice", "UnitPriceDiscount", "OrderQty")
    return lines.select("SalesOrderDetailID", total.alias("LineTotal"))


@query(
    "fact_measures",
    f"""SELECT SalesOrderDetailID, CAST(OrderQty * UnitPrice AS DECIMAL(38,6)) AS ExtendedAmount,
               CAST(UnitPrice * UnitPriceDiscount AS DECIMAL(38,6)) AS DiscountAmount,
               CAST(OrderQty * StandardCost AS DECIMAL(38,6)) AS TotalProductCost,
               CAST(OrderQty * UnitPrice - UnitPrice * UnitPriceDiscount AS DECIMAL(38,6)) AS LineTotal
        FROM (SELECT *, CAST(0.5 AS DECIMAL(18,4)) * UnitPrice AS StandardCost
              FROM ({raw_for_duckdb('sales_salesorderdetail')}))""",
)
def fact_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = raw(spark, sf_dir, "sales_salesorderdetail")
    cost = F.col("UnitPrice") * F.lit(0.5).cast("decimal(2,1)")
    measures = C.fact_measures("OrderQty", "UnitPrice", "UnitPriceDiscount", cost)
    wide = {name: value.cast("decimal(38,6)") for name, value in measures.items()}
    return C.project(lines, {"SalesOrderDetailID": "SalesOrderDetailID", **wide})


@query(
    "full_name",
    f"""SELECT BusinessEntityID, FirstName || ' ' || LastName AS CustomerName
        FROM ({raw_for_duckdb('person_person')})""",
)
def full_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = raw(spark, sf_dir, "person_person")
    return people.select("BusinessEntityID", C.full_name("FirstName", "LastName").alias("CustomerName"))


@query(
    "date_parts",
    """SELECT o_orderkey, CAST(isodow(o_orderdate) AS INTEGER) AS DayNumberOfWeek,
              dayname(o_orderdate) AS EnglishDayNameOfWeek,
              CAST(day(o_orderdate) AS INTEGER) AS DayNumberOfMonth,
              CAST(dayofyear(o_orderdate) AS INTEGER) AS DayNumberOfYear,
              CAST(week(o_orderdate) AS INTEGER) AS WeekNumberOfYear,
              monthname(o_orderdate) AS EnglishMonthName,
              CAST(month(o_orderdate) AS INTEGER) AS MonthNumberOfYear,
              CAST(quarter(o_orderdate) AS INTEGER) AS CalendarQuarter,
              CAST(year(o_orderdate) AS INTEGER) AS CalendarYear,
              CAST(CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS INTEGER) AS CalendarSemester,
              CAST(o_orderdate AS DATE) AS OrderDay
       FROM orders""",
)
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = source(spark, sf_dir, "orders")
    parts = C.calendar("o_orderdate")
    return C.project(orders, {"o_orderkey": "o_orderkey", **parts, "OrderDay": F.to_date("o_orderdate")})


# -- rules -----------------------------------------------------------------

_CUSTOMER_RULES = (
    Rule("balance", "c_acctbal >= 0"),
    Rule("nation", "c_nationkey BETWEEN 0 AND 20"),
    Rule("segment", "c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')"),
    Rule("key above nation", "c_custkey >= c_nationkey"),
    Rule("credit", "credit >= 0 OR credit IS NULL"),
    Rule("not frozen", "c_name = 'Customer#000000007' OR c_custkey > 7"),
)
_CREDIT_SQL = "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey AS INTEGER) - 100 END"


def _customers_with_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    credit = F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey").cast("int") - 100)
    return source(spark, sf_dir, "customer").withColumn("credit", credit)


@query(
    "integrity_filters",
    f"""SELECT * FROM (SELECT *, {_CREDIT_SQL} AS credit FROM customer)
        WHERE c_acctbal >= 0 AND c_nationkey BETWEEN 0 AND 20
          AND c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') AND c_custkey >= c_nationkey
          AND (credit >= 0 OR credit IS NULL) AND (c_name = 'Customer#000000007' OR c_custkey > 7)""",
)
def integrity_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = validate(_customers_with_credit(spark, sf_dir), _CUSTOMER_RULES)
    return valid


@query(
    "rejected_rows",
    f"""SELECT c_custkey, concat_ws(',', CASE WHEN NOT c_acctbal >= 0 THEN 'balance' END,
               CASE WHEN NOT c_nationkey BETWEEN 0 AND 20 THEN 'nation' END,
               CASE WHEN NOT c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN 'segment' END,
               CASE WHEN NOT c_custkey >= c_nationkey THEN 'key above nation' END,
               CASE WHEN NOT (credit >= 0 OR credit IS NULL) THEN 'credit' END,
               CASE WHEN NOT (c_name = 'Customer#000000007' OR c_custkey > 7) THEN 'not frozen' END)
               AS failed_rules
        FROM (SELECT *, {_CREDIT_SQL} AS credit FROM customer)
        WHERE NOT (c_acctbal >= 0 AND c_nationkey BETWEEN 0 AND 20
          AND c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') AND c_custkey >= c_nationkey
          AND (credit >= 0 OR credit IS NULL) AND (c_name = 'Customer#000000007' OR c_custkey > 7))""",
)
def rejected_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = rejected_rows(_customers_with_credit(spark, sf_dir), _CUSTOMER_RULES)
    return rejected.select("c_custkey", F.concat_ws(",", "failed_rules").alias("failed_rules"))


@query(
    "dormant_product_rules",
    f"""SELECT ProductID FROM ({raw_for_duckdb('production_product')})
        WHERE SafetyStockLevel > 0 AND ReorderPoint > 0 AND StandardCost >= 0 AND ListPrice >= 0
          AND DaysToManufacture >= 0 AND (upper(Class) IN ('H', 'M', 'L') OR Class IS NULL)
          AND (upper(ProductLine) IN ('R', 'M', 'T', 'S') OR ProductLine IS NULL)
          AND (upper(Style) IN ('U', 'M', 'W') OR Style IS NULL) AND (Weight > 0 OR Weight IS NULL)
          AND (SellEndDate >= SellStartDate OR SellEndDate IS NULL)""",
)
def dormant_product_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = silver_transform(
        raw(spark, sf_dir, "production_product"),
        SILVER["production_product"],
        load_time=F.lit(LOAD_TIME).cast("timestamp"),
        wide_ids=True,
        extra_rules=DORMANT_PRODUCT_RULES,
    )
    return products.select("ProductID")


# -- joins -----------------------------------------------------------------


@query(
    "join_inner",
    """SELECT o_orderkey, l_linenumber, o_custkey, l_quantity
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = source(spark, sf_dir, "lineitem")
    orders = source(spark, sf_dir, "orders")
    return lookup_join(lines, orders, {"l_orderkey": "o_orderkey"}, "inner").select(
        "o_orderkey", "l_linenumber", "o_custkey", "l_quantity"
    )


@query(
    "join_left_lookup",
    """SELECT o_orderkey, c_custkey AS CustomerKey FROM orders
       LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey""",
)
def join_left_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer's own key, NULL when the customer was not accepted."""
    orders = source(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = source(spark, sf_dir, "customer").where("c_acctbal >= 0").select(
        F.col("c_custkey").alias("CustomerKey")
    )
    return lookup_join(orders, customers, {"o_custkey": "CustomerKey"}).select("o_orderkey", "CustomerKey")


@query(
    "join_anti",
    """SELECT c_custkey, c_name FROM customer
       WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O')""",
)
def join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = source(spark, sf_dir, "customer").select("c_custkey", "c_name")
    open_orders = source(spark, sf_dir, "orders").where("o_orderstatus = 'O'")
    return anti_join(customers, open_orders.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query(
    "join_bridge",
    """SELECT o_orderkey, l_linenumber, event_type
       FROM orders JOIN lineitem ON l_orderkey = o_orderkey
       JOIN (SELECT DISTINCT CAST(floor(event_id / 3) AS BIGINT) AS order_id, event_type FROM events)
         ON order_id = o_orderkey""",
)
def join_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = source(spark, sf_dir, "orders").select("o_orderkey")
    lines = source(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    events = source(spark, sf_dir, "events")
    links = events.select(F.floor(F.col("event_id") / 3).cast("long").alias("order_id"), "event_type").distinct()
    linked = orders.join(links, F.col("o_orderkey") == F.col("order_id"), "inner")
    return lookup_join(lines, linked, {"l_orderkey": "o_orderkey"}, "inner").select(
        "o_orderkey", "l_linenumber", "event_type"
    )


@query(
    "join_snowflake",
    """SELECT c_custkey, n_name, r_name FROM customer
       LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 3) ON c_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def join_snowflake(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = source(spark, sf_dir, "nation").where("n_nationkey <> 3")
    places = nations.join(source(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    customers = source(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return lookup_join(customers, places, {"c_nationkey": "n_nationkey"}).select("c_custkey", "n_name", "r_name")


# -- aggregation, counts, top rows -----------------------------------------


@query(
    "agg_product_day",
    """SELECT l_partkey AS ProductKey, CAST(l_shipdate AS DATE) AS OrderDate, p_name AS ProductName,
              p_type AS ProductCategoryName, p_brand AS ProductSubcategoryName,
              CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS TotalOrderQty,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,6)) AS TotalLineTotal
       FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
)
def agg_product_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = C.project(
        source(spark, sf_dir, "lineitem"),
        {
            "ProductKey": "l_partkey",
            "OrderDateKey": "l_shipdate",
            "OrderQty": F.col("l_quantity").cast("int"),
            "LineTotal": F.col("l_extendedprice").cast("decimal(18,2)"),
        },
    )
    products = C.project(
        source(spark, sf_dir, "part"),
        {"ProductKey": "p_partkey", "ProductName": "p_name", "CategoryName": "p_type", "SubcategoryName": "p_brand"},
    )
    return ft_agg_product_day(sales, products)


@query("distinct_dates", "SELECT DISTINCT o_orderdate AS DateKey FROM orders")
def distinct_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("DateKey")).distinct()


@query("row_count", "SELECT count(*) AS total_count FROM lineitem")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("total_count"))


@query("preview_top_n", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def preview_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = source(spark, sf_dir, "orders")
    return preview(orders, [F.col("o_totalprice").desc(), "o_orderkey"])


# -- comparison and schema checks ------------------------------------------

_KEY_PAIR = ("l_orderkey", "l_linenumber")


@query(
    "except_all_diff",
    """SELECT l_orderkey, l_linenumber FROM lineitem
       EXCEPT ALL SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem""",
)
def except_all_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = source(spark, sf_dir, "lineitem").select(*_KEY_PAIR)
    return except_all(lines, lines.distinct())


@query(
    "row_differences",
    """SELECT l_orderkey, l_linenumber, count(*) AS left_rows, CAST(1 AS BIGINT) AS right_rows
       FROM lineitem GROUP BY ALL HAVING count(*) <> 1""",
)
def differing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = source(spark, sf_dir, "lineitem").select(*_KEY_PAIR)
    return row_differences(lines, lines.distinct())


_CHANGED_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_comment_ FROM
    (SELECT *, CASE WHEN l_orderkey % 997 = 5 THEN 'changed' ELSE l_returnflag END AS l_comment_ FROM lineitem)
    WHERE l_orderkey % 1999 <> 3"""
_GIVEN_SQL = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag AS l_comment_ FROM lineitem"


@query(
    "compare_large",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_comment_,
               CAST(sum(l) AS BIGINT) AS left_rows, CAST(sum(r) AS BIGINT) AS right_rows
        FROM (SELECT *, 1 AS l, 0 AS r FROM ({_GIVEN_SQL}) UNION ALL SELECT *, 0, 1 FROM ({_CHANGED_SQL}))
        GROUP BY ALL HAVING sum(l) <> sum(r)""",
)
def compare_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two nearly equal tables: only ranges of rows whose fingerprints differ are compared row by row."""
    lines = source(spark, sf_dir, "lineitem")
    given, changed = (
        spark.sql(sql.replace("FROM lineitem", "FROM {lines}"), lines=lines) for sql in (_GIVEN_SQL, _CHANGED_SQL)
    )
    return large_row_differences(given, changed)


@query(
    "compare_frames",
    """SELECT TRUE AS same_frame_equal, FALSE AS distinct_frame_equal, count(*) AS differing_keys
       FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) <> 1)""",
)
def compare_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = source(spark, sf_dir, "lineitem").select(*_KEY_PAIR)
    same = comparison(lines, source(spark, sf_dir, "lineitem").select(*_KEY_PAIR))
    other = comparison(lines, lines.distinct())
    differing = row_differences(lines, lines.distinct()).agg(F.count(F.lit(1)).alias("n"))
    equal, no_flag, no_count = "same_schema AND same_rows", "CAST(NULL AS BOOLEAN)", "CAST(NULL AS BIGINT)"
    results = (
        same.selectExpr(f"{equal} AS same_frame_equal", f"{no_flag} AS distinct_frame_equal", f"{no_count} AS differing_keys")
        .union(other.selectExpr(no_flag, equal, no_count))
        .union(differing.selectExpr(no_flag, no_flag, "n"))
    )
    return results.agg(*[F.max(c).alias(c) for c in results.columns])


@query(
    "schema_check",
    f"""SELECT TRUE AS layout_ok, FALSE AS raw_layout_ok, count(*) AS total_count
        FROM (SELECT DISTINCT BusinessEntityID, EmailAddressID FROM ({raw_for_duckdb('person_emailaddress')}))""",
)
def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table passes the check by position, the raw table does not."""
    return _checked(spark, sf_dir, "person_emailaddress", require_layout)


@query(
    "schema_check_by_name",
    f"""SELECT TRUE AS layout_ok, FALSE AS raw_layout_ok, count(DISTINCT AddressID) AS total_count
        FROM ({raw_for_duckdb('person_address')})""",
)
def schema_check_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table passes the check by name and exact type, the raw table
    does not: its dates have another type."""
    return _checked(spark, sf_dir, "person_address", require_columns)


def _checked(spark: SparkSession, sf_dir: str, table: str, require) -> DataFrame:
    clean, untyped = silver(spark, sf_dir, table), raw(spark, sf_dir, table)
    results = {}
    for name, frame in (("layout_ok", clean), ("raw_layout_ok", untyped)):
        try:
            require(frame, clean.schema)
            results[name] = True
        except ValueError:
            results[name] = False
    flags = [F.lit(ok).alias(name) for name, ok in results.items()]
    return clean.agg(*flags, F.count(F.lit(1)).alias("total_count"))


# -- merge -----------------------------------------------------------------
# The target holds the orders up to 1999, the source those from 1998 on with a
# changed price: both overlap for two years. Some keys are NULL on both sides.

MERGE_KEY = "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderkey END"
TARGET_SQL = f"""SELECT {MERGE_KEY} AS id, o_custkey AS customer, o_totalprice AS amount, o_orderstatus AS state
                  FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'"""
CHANGES_SQL = f"""SELECT {MERGE_KEY} AS id, o_custkey AS customer, o_totalprice + 1 AS amount, o_orderstatus AS state
                  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'"""
_UNMATCHED_SQL = "NOT EXISTS (SELECT 1 FROM s WHERE s.id = t.id)"


def merge_sql(kept: str) -> str:
    return f"""WITH t AS ({TARGET_SQL}), s AS ({CHANGES_SQL})
               SELECT * FROM s UNION ALL SELECT * FROM t WHERE {_UNMATCHED_SQL} AND ({kept})"""


def merge_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = source(spark, sf_dir, "orders")
    target, changes = (
        spark.sql(side.replace("FROM orders", "FROM {orders}"), orders=orders) for side in (TARGET_SQL, CHANGES_SQL)
    )
    return target, changes


@query("merge_upsert", merge_sql("TRUE"))
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, changes = merge_sides(spark, sf_dir)
    return merge_frames(target, changes, ["id"])


_HOT_SQL = """SELECT l_orderkey, l_linenumber, l_extendedprice,
                     CAST(CASE WHEN l_orderkey % 3 = 0 THEN 1 WHEN l_orderkey % 50 = 1 THEN NULL ELSE l_partkey END
                          AS DECIMAL(14, 2)) AS code
              FROM lineitem"""
_CODES_SQL = "SELECT CAST(p_partkey AS DECIMAL(14, 2)) AS part_code, p_name, p_brand FROM part"


@query(
    "join_hot_decimal_key",
    f"""SELECT l_orderkey, l_linenumber, l_extendedprice, code, p_name, p_brand
        FROM ({_HOT_SQL}) LEFT JOIN ({_CODES_SQL}) ON code = part_code""",
)
def join_hot_decimal_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the lines have one decimal key: its rows are salted."""
    lines = spark.sql(_HOT_SQL.replace("FROM lineitem", "FROM {t}"), t=source(spark, sf_dir, "lineitem"))
    codes = spark.sql(_CODES_SQL.replace("FROM part", "FROM {t}"), t=source(spark, sf_dir, "part"))
    return salted_join(lines, codes, {"code": "part_code"}).drop("part_code")


_FEW = "id IS NULL OR id % 100 = 7 OR id < 0"


@query(
    "merge_small_change",
    f"""WITH t AS ({TARGET_SQL}), s AS (SELECT * FROM ({CHANGES_SQL}) WHERE {_FEW})
        SELECT * FROM s UNION ALL SELECT * FROM t WHERE {_UNMATCHED_SQL}""",
)
def merge_small_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert of few rows: a bitmap of their keys keeps most of the target out of the join."""
    target, changes = merge_sides(spark, sf_dir)
    changes = changes.where(_FEW)
    return merge_frames(target, changes, ["id"], source_rows=changes.count(), key_filter=True)


@query("merge_upsert_delete", merge_sql("t.id IS NULL"))
def merge_upsert_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, changes = merge_sides(spark, sf_dir)
    return merge_frames(target, changes, ["id"], Unmatched.DELETE)


@query("merge_conditional_delete", merge_sql("t.id IS NULL OR NOT coalesce(t.state = 'F' AND t.amount > 1000, FALSE)"))
def merge_conditional_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, changes = merge_sides(spark, sf_dir)
    return merge_frames(target, changes, ["id"], Unmatched.DELETE, "state = 'F' AND amount > 1000")


@query(
    "merge_schema_evolution",
    f"""WITH t AS ({TARGET_SQL}),
             s AS (SELECT id, customer, amount, amount * 2 AS doubled FROM ({CHANGES_SQL}))
        SELECT s.id, s.customer, s.amount, t.state, s.doubled FROM s LEFT JOIN t ON s.id = t.id
        UNION ALL
        SELECT id, customer, amount, state, NULL FROM t WHERE {_UNMATCHED_SQL}""",
)
def merge_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source adds ``doubled`` and lacks ``state``."""
    target, changes = merge_sides(spark, sf_dir)
    changes = changes.withColumn("doubled", F.col("amount") * 2).drop("state")
    return merge_frames(target, changes, ["id"])
