import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cairn.plans import gold
from cairn.plans.silver import SILVER
from cairn.plans.warehouse import GOLD_INPUTS, GOLD_MODELS, Warehouse, check_gold
from cairn.session import scratch_dir
from cairn.sources.tables import read_table, write_table
from tests.conftest import rows
from tests.test_silver import T1, T2, frame

DATE = dt.datetime(2024, 3, 5, 10)


def silver_frame(spark, table, *records):
    """Rows in a silver layout, computed columns included."""
    schema = SILVER[table].schema
    for f in schema.fields:
        f.nullable = True
    data = [tuple(r.get(f.name) for f in schema.fields) for r in records]
    return spark.createDataFrame(data, schema)


@pytest.fixture
def sales(spark):
    """Inputs of the fact: one online order with two lines, and traps."""
    order = {
        "OrderDate": DATE,
        "DueDate": DATE,
        "ShipDate": DATE,
        "RevisionNumber": 1,
        "OnlineOrderFlag": 1,
        "ModifiedDate": T1,
    }
    line = {"SpecialOfferID": 1, "UnitPriceDiscount": Decimal("0.1"), "ModifiedDate": T1}
    return {
        "header": silver_frame(
            spark,
            "sales_salesorderheader",
            {"SalesOrderID": 1, "CustomerID": 10, "TerritoryID": 6, "SalesOrderNumber": "SO1", **order},
            # An offline version is newer than the online one.
            {"SalesOrderID": 2, "CustomerID": 10, "TerritoryID": 6, "SalesOrderNumber": "SO2", **order},
            {
                "SalesOrderID": 2,
                "SalesOrderNumber": "SO2",
                **order,
                "OnlineOrderFlag": 0,
                "ModifiedDate": T2,
            },
            {"SalesOrderID": 3, "CustomerID": 99, "TerritoryID": 99, "SalesOrderNumber": "SO3", **order},
        ),
        "detail": silver_frame(
            spark,
            "sales_salesorderdetail",
            {"SalesOrderID": 1, "SalesOrderDetailID": 1, "ProductID": 7, "OrderQty": 3, "UnitPrice": Decimal(10), **line},
            {
                "SalesOrderID": 1,
                "SalesOrderDetailID": 1,
                "ProductID": 7,
                "OrderQty": 1,
                "UnitPrice": Decimal(99),
                **line,
                "ModifiedDate": dt.datetime(2019, 1, 1),
            },
            {"SalesOrderID": 1, "SalesOrderDetailID": 2, "ProductID": 77, "OrderQty": 1, "UnitPrice": Decimal(5), **line},
            {"SalesOrderID": 2, "SalesOrderDetailID": 3, "ProductID": 7, "OrderQty": 1, "UnitPrice": Decimal(5), **line},
            # The newest version of this line has no price.
            {"SalesOrderID": 3, "SalesOrderDetailID": 4, "ProductID": 7, "OrderQty": 1, "UnitPrice": Decimal(5), **line},
            {
                "SalesOrderID": 3,
                "SalesOrderDetailID": 4,
                "ProductID": 7,
                "OrderQty": 1,
                "UnitPrice": Decimal(0),
                **line,
                "ModifiedDate": T2,
            },
            {
                "SalesOrderID": 3,
                "SalesOrderDetailID": 5,
                "ProductID": 7,
                "OrderQty": 2,
                "UnitPrice": Decimal(4),
                **line,
                "SpecialOfferID": 55,
            },
        ),
        "product": silver_frame(
            spark, "production_product", *[{"ProductID": 7, "Name": n, "ModifiedDate": T1} for n in "ab"]
        ),
        # The customer's own territory is not the order's.
        "customer": silver_frame(
            spark, "sales_customer", {"CustomerID": 10, "TerritoryID": 3, "ModifiedDate": T1}
        ),
        "special_offer": silver_frame(spark, "sales_specialoffer", {"SpecialOfferID": 1, "ModifiedDate": T1}),
        "territory": silver_frame(
            spark, "sales_salesterritory", *[{"TerritoryID": t, "Name": f"T{t}", "ModifiedDate": T1} for t in (3, 6)]
        ),
    }


FACT_COLUMNS = (
    "SalesOrderDetailID",
    "ProductKey",
    "CustomerKey",
    "PromotionKey",
    "SalesTerritoryKey",
    "SalesOrderID",
    "OrderQty",
    "LineTotal",
)
FACT_ROWS = [
    (1, 7, 10, 1, 6, "1", 3, Decimal("29.000000")),
    (2, None, 10, 1, 6, "1", 1, Decimal("4.500000")),
    (5, 7, None, None, None, "3", 2, Decimal("7.600000")),
]


@pytest.mark.parametrize("limit", ["10485760", "-1"])
def test_fact_resolves_keys_and_keeps_unresolved_lines(sales, conf, limit):
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    fact = check_gold("FactInternetSales", gold.fact_internet_sales(**sales))
    assert rows(fact.select(*FACT_COLUMNS)) == FACT_ROWS
    assert fact.columns == gold.GOLD_SCHEMAS["FactInternetSales"].names


def test_fact_with_cost_amounts(spark, sales):
    costs = silver_frame(
        spark,
        "production_productcosthistory",
        {"ProductID": 7, "StartDate": T1, "StandardCost": Decimal(2), "ModifiedDate": T1},
        {"ProductID": 7, "StartDate": T2, "StandardCost": Decimal(3), "ModifiedDate": T2},
    )
    fact = gold.fact_internet_sales(**sales, cost_history=costs)
    amounts = fact.select("SalesOrderDetailID", "ExtendedAmount", "DiscountAmount", "TotalProductCost")
    assert rows(amounts) == [
        (1, Decimal(30), Decimal(1), Decimal(9)),
        (2, Decimal(5), Decimal("0.5"), None),
        (5, Decimal(8), Decimal("0.4"), Decimal(6)),
    ]
    assert rows(fact.select(*FACT_COLUMNS)) == FACT_ROWS


def test_daily_aggregate_with_a_repeated_product(spark, sales):
    fact = gold.fact_internet_sales(**sales)
    names = "ProductKey int, ProductName string, CategoryName string, SubcategoryName string"
    once = spark.createDataFrame([(7, "n", "c", "s")], names)
    day = dt.date(2024, 3, 5)
    unknown = (None, day, None, None, None, 1, Decimal("4.500000"))
    known = (7, day, "n", "c", "s", 5, Decimal("36.600000"))
    assert rows(check_gold("ft_agg_product_day", gold.ft_agg_product_day(fact, once))) == [known, unknown]
    # As with a join before the sum: a product listed twice counts twice.
    twice = gold.ft_agg_product_day(fact, once.union(once))
    assert rows(twice) == [(*known[:5], 10, Decimal("73.200000")), unknown]


def test_wide_table(spark, sales):
    person = silver_frame(
        spark,
        "person_person",
        {"BusinessEntityID": 10, "FirstName": "Ada", "LastName": "Byron", "ModifiedDate": T1},
        {"BusinessEntityID": 99, "FirstName": "Solo", "ModifiedDate": T1},
    )
    category = silver_frame(spark, "production_productcategory", {"ProductCategoryID": 1, "Name": "cat"})
    subcategory = silver_frame(
        spark, "production_productsubcategory", {"ProductSubcategoryID": 2, "ProductCategoryID": 1, "Name": "sub"}
    )
    product = silver_frame(
        spark, "production_product", {"ProductID": 7, "Name": "p", "ProductNumber": "P7", "ProductSubcategoryID": 2}
    )
    wide = gold.one_big_table(
        sales["header"], sales["detail"], product, subcategory, category, sales["territory"], person
    )
    assert check_gold("OneBigTable", wide, wide_ids=False).columns == gold.GOLD_SCHEMAS["OneBigTable"].names
    picked = wide.select(
        "SalesOrderDetailID", "ProductName", "ProductCategoryName", "ProductSubcategoryName", "TerritoryName", "CustomerName"
    )
    assert rows(picked) == [
        (1, "p", "cat", "sub", "T6", "Ada Byron"),
        (2, None, None, None, "T6", "Ada Byron"),
        # Zero prices stay here, and a missing last name makes the name NULL.
        (4, "p", "cat", "sub", None, None),
        (5, "p", "cat", "sub", None, None),
    ]


def test_reasons_are_joined_per_order_and_listed_once(spark, sales):
    reasons = silver_frame(spark, "sales_salesreason", {"SalesReasonID": 1}, {"SalesReasonID": 1}, {"SalesReasonID": 2})
    links = silver_frame(
        spark,
        "sales_salesorderheadersalesreason",
        *[{"SalesOrderID": o, "SalesReasonID": r} for o, r in [(1, 1), (1, 2), (1, 1), (2, 1), (3, 8)]],
    )
    out = gold.fact_internet_sales_reason(sales["header"], sales["detail"], reasons, links)
    # Order 2 is offline and counts all the same.
    assert rows(check_gold("FactInternetSalesReason", out, wide_ids=False)) == [
        ("SO1", 1, 1),
        ("SO1", 1, 2),
        ("SO1", 2, 1),
        ("SO1", 2, 2),
        ("SO2", 3, 1),
    ]


def test_customer_joins_by_customer_id_or_by_person(spark):
    customer = silver_frame(
        spark,
        "sales_customer",
        {"CustomerID": 1, "PersonID": 2, "AccountNumber": "A1"},
        {"CustomerID": 2, "PersonID": 1, "AccountNumber": "A2"},
        {"CustomerID": 3, "PersonID": 9, "AccountNumber": "A3"},
    )
    person = silver_frame(spark, "person_person", *[{"BusinessEntityID": i, "FirstName": f"F{i}"} for i in (1, 2)])
    address = silver_frame(spark, "person_address", {"AddressID": 1}, {"AddressID": 1})
    email = silver_frame(
        spark,
        "person_emailaddress",
        {"BusinessEntityID": 1, "EmailAddressID": 1, "EmailAddress": "old", "ModifiedDate": T1},
        {"BusinessEntityID": 1, "EmailAddressID": 2, "EmailAddress": "new", "ModifiedDate": T2},
    )
    phone = silver_frame(spark, "person_personphone", {"BusinessEntityID": 2, "PhoneNumber": "555"})
    tables = (customer, person, address, email, phone)
    picked = ("CustomerKey", "GeographyKey", "CustomerAlternateKey", "FirstName", "EmailAddress", "Phone")
    by_customer = check_gold("DimCustomer", gold.dim_customer(*tables), wide_ids=False).select(*picked)
    assert rows(by_customer) == [(1, 1, "A1", "F1", "new", None), (2, None, "A2", "F2", None, "555")]
    by_person = gold.dim_customer(*tables, person_key="PersonID").select(*picked)
    assert rows(by_person) == [(1, 1, "A1", "F2", None, "555"), (2, None, "A2", "F1", "new", None)]


def test_products_keep_unmatched_names_null_and_repeat_with_the_category(spark):
    product = silver_frame(
        spark,
        "production_product",
        {"ProductID": 1, "ProductSubcategoryID": 5, "ProductModelID": 6, "ModifiedDate": T1, "Name": "old"},
        {"ProductID": 1, "ProductSubcategoryID": 5, "ProductModelID": 6, "ModifiedDate": T2, "Name": "new"},
        {"ProductID": 2, "ModifiedDate": T1, "Name": "bare"},
    )
    subcategory = silver_frame(
        spark, "production_productsubcategory", {"ProductSubcategoryID": 5, "ProductCategoryID": 8, "Name": "sub"}
    )
    category = silver_frame(
        spark, "production_productcategory", *[{"ProductCategoryID": 8, "Name": n} for n in ("c1", "c2")]
    )
    model = silver_frame(spark, "production_productmodel", {"ProductModelID": 6, "Name": "mod"})
    out = check_gold("DimProduct", gold.dim_product(product, subcategory, category, model), wide_ids=False)
    assert rows(out.drop("ProductAlternateKey")) == [
        (1, "new", "mod", "sub", "c1", 5, 8),
        (1, "new", "mod", "sub", "c2", 5, 8),
        (2, "bare", None, None, None, None, None),
    ]


def test_dates_come_from_orders_once_each(spark, sales):
    out = check_gold("DimDate", gold.dim_date(sales["header"]))
    assert rows(out) == [(DATE, DATE, 2, "Tuesday", 5, 65, 10, "March", 3, 1, 2024, 1)]


def test_trusting_silver_keys_skips_only_implied_dedups(spark, sales):
    detail = sales["detail"]
    repeated = gold._current(detail, "sales_salesorderdetail", "SalesOrderDetailID", ["OrderQty"], True)
    assert repeated.count() == 5
    header = gold._current(sales["header"], "sales_salesorderheader", "SalesOrderID", ["OrderDate"], True)
    assert header.count() == sales["header"].count()


def test_the_warehouse_from_raw_tables_to_gold(spark, sales):
    layers = Warehouse("wh_bronze", "wh_silver", "wh_gold")
    layers.create(spark, scratch_dir(spark, "warehouse"))
    for table in SILVER:
        write_table(frame(spark, table), f"wh_bronze.{table}")
    for arg, table in GOLD_INPUTS["FactInternetSales"].items():
        usable = sales[arg].fillna(0)
        if table == "sales_specialoffer":
            usable = usable.withColumns({"StartDate": F.col("ModifiedDate"), "EndDate": F.col("ModifiedDate")})
        write_table(usable, f"wh_bronze.{table}")
    written = layers.refresh_silver(spark)
    assert set(written) == set(SILVER)
    # Loading the same input again changes nothing.
    assert layers.refresh_silver(spark) == written
    built = layers.refresh_gold(spark, silver_unique=True)
    assert set(built) == set(GOLD_MODELS)
    fact = read_table(spark, "wh_gold.FactInternetSales")
    assert built["FactInternetSales"] == fact.count() > 0
    daily = read_table(spark, "wh_gold.ft_agg_product_day")
    assert daily.selectExpr("sum(TotalOrderQty)").first() == fact.selectExpr("sum(OrderQty)").first()


def test_daily_sums_are_not_grouped_again_after_the_join(spark, sales):
    names = "ProductKey int, ProductName string, CategoryName string, SubcategoryName string"
    daily = gold.ft_agg_product_day(gold.fact_internet_sales(**sales), spark.createDataFrame([(7, "n", "c", None)], names))
    plan = daily._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan.split("Join")[0]
