"""The gold layer: eight dimensions, two facts, a daily aggregate, a wide table.

Each model is a function from DataFrames to a DataFrame and does no I/O.

Inputs are reduced to their latest row per key first. Where they come straight
from :mod:`cairn.plans.silver`, that has been done already;
``silver_unique=True`` then skips it, but only where the silver key implies
the key used here (details, e-mails and phones, for example, are always
reduced again). Leave it off for tables from elsewhere, or whose keys may be
NULL.

Lookups whose only output is the key itself need no latest row, only the set of
known keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions import columns as C
from cairn.operators.dedup import current_rows
from cairn.operators.joins import lookup_join
from cairn.operators.quality import Rule, apply_rules
from cairn.plans.silver import SILVER
from cairn.plans.types import (
    DATE_TIME,
    DAY,
    INT,
    LONG,
    MONEY,
    SHORT,
    SMALL_MONEY,
    TEXT,
    TOTAL,
    Optional,
    columns,
    widen_ids,
)

# Table names, column names and types of the gold layer.

GOLD_SCHEMAS = {
    "DimCurrency": columns(CurrencyKey=TEXT, CurrencyAlternateKey=TEXT, CurrencyName=TEXT),
    "DimCustomer": columns(
        CustomerKey=INT,
        GeographyKey=INT,
        CustomerAlternateKey=TEXT,
        Title=Optional(TEXT),
        FirstName=TEXT,
        MiddleName=Optional(TEXT),
        LastName=TEXT,
        NameStyle=INT,
        EmailAddress=Optional(TEXT),
        Phone=Optional(TEXT),
    ),
    "DimDate": columns(
        DateKey=DATE_TIME,
        FullDateAlternateKey=DATE_TIME,
        DayNumberOfWeek=INT,
        EnglishDayNameOfWeek=TEXT,
        DayNumberOfMonth=INT,
        DayNumberOfYear=INT,
        WeekNumberOfYear=INT,
        EnglishMonthName=TEXT,
        MonthNumberOfYear=INT,
        CalendarQuarter=INT,
        CalendarYear=INT,
        CalendarSemester=INT,
    ),
    "DimGeography": columns(GeographyKey=INT, City=TEXT, StateProvince=TEXT, CountryRegion=TEXT, PostalCode=TEXT),
    "DimProduct": columns(
        ProductKey=INT,
        ProductAlternateKey=TEXT,
        ProductName=TEXT,
        ModelName=TEXT,
        SubcategoryName=TEXT,
        CategoryName=TEXT,
        ProductSubcategoryKey=INT,
        ProductCategoryKey=INT,
    ),
    "DimPromotion": columns(
        PromotionKey=INT,
        PromotionAlternateKey=INT,
        EnglishPromotionName=TEXT,
        DiscountPct=SMALL_MONEY,
        EnglishPromotionType=TEXT,
        StartDate=DATE_TIME,
        EndDate=DATE_TIME,
        MinQty=INT,
    ),
    "DimSalesReason": columns(SalesReasonKey=INT, SalesReasonName=TEXT, SalesReasonType=TEXT),
    "DimSalesTerritory": columns(
        SalesTerritoryKey=INT,
        SalesTerritoryAlternateKey=INT,
        SalesTerritoryRegion=TEXT,
        SalesTerritoryCountry=TEXT,
        SalesTerritoryGroup=TEXT,
    ),
    "FactInternetSales": columns(
        ProductKey=INT,
        OrderDateKey=DATE_TIME,
        DueDateKey=DATE_TIME,
        ShipDateKey=DATE_TIME,
        CustomerKey=INT,
        PromotionKey=INT,
        SalesTerritoryKey=INT,
        SalesOrderID=TEXT,
        SalesOrderDetailID=INT,
        RevisionNumber=SHORT,
        OrderQty=INT,
        UnitPrice=MONEY,
        UnitPriceDiscount=MONEY,
        LineTotal=TOTAL,
    ),
    "FactInternetSalesReason": columns(SalesOrderNumber=TEXT, SalesOrderLineNumber=INT, SalesReasonKey=INT),
    "ft_agg_product_day": columns(
        ProductKey=INT,
        OrderDate=DAY,
        ProductName=TEXT,
        ProductCategoryName=TEXT,
        ProductSubcategoryName=TEXT,
        TotalOrderQty=LONG,
        TotalLineTotal=TOTAL,
    ),
    "OneBigTable": columns(
        SalesOrderID=INT,
        SalesOrderDetailID=INT,
        OrderDate=DATE_TIME,
        DueDate=DATE_TIME,
        SubTotal=MONEY,
        TaxAmt=MONEY,
        Freight=MONEY,
        TotalDue=MONEY,
        LineTotal=MONEY,
        OrderQty=INT,
        UnitPrice=MONEY,
        UnitPriceDiscount=MONEY,
        ProductName=TEXT,
        ProductNumber=TEXT,
        ProductCategoryName=TEXT,
        ProductSubcategoryName=TEXT,
        TerritoryName=TEXT,
        CustomerName=TEXT,
    ),
}

POSITIVE_SALE = (Rule("positive quantity", "OrderQty > 0"), Rule("positive price", "UnitPrice > 0"))


def _current(df: DataFrame, table: str, keys: str | Sequence[str], carry: Sequence[str], silver_unique: bool):
    """Latest rows per key, unless the silver key of ``table`` implies that
    there is one row per key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    implied = set(SILVER[table].keys) <= set(keys)
    return current_rows(df, keys, carry, unique=silver_unique and implied)


# -- dimensions ------------------------------------------------------------


def dim_currency(currency: DataFrame, silver_unique: bool = False) -> DataFrame:
    latest = _current(currency, "sales_currency", "CurrencyCode", ["Name"], silver_unique)
    return C.project(
        latest, {"CurrencyKey": "CurrencyCode", "CurrencyAlternateKey": "CurrencyCode", "CurrencyName": "Name"}
    )


def dim_customer(
    customer: DataFrame,
    person: DataFrame,
    address: DataFrame,
    email: DataFrame,
    phone: DataFrame,
    silver_unique: bool = False,
    person_key: str = "CustomerID",
) -> DataFrame:
    """Customers with their person, address, e-mail and phone.

    Persons, e-mails and phones are found by ``person_key``, by default the
    customer id itself (pass ``PersonID`` to follow the customer's person);
    the address is the one whose id equals the customer id. Customers without
    a person are left out. The customer table is taken as it is.
    """
    names = ["Title", "FirstName", "MiddleName", "LastName", "NameStyle"]
    persons = C.project(
        _current(person, "person_person", "BusinessEntityID", names, silver_unique),
        {"PersonKey": "BusinessEntityID", **{n: n for n in names}},
    )
    addresses = C.project(_current(address, "person_address", "AddressID", [], silver_unique), {"GeographyKey": "AddressID"})
    emails = C.project(
        _current(email, "person_emailaddress", "BusinessEntityID", ["EmailAddress"], silver_unique),
        {"EmailKey": "BusinessEntityID", "EmailAddress": "EmailAddress"},
    )
    phones = C.project(
        _current(phone, "person_personphone", "BusinessEntityID", ["PhoneNumber"], silver_unique),
        {"PhoneKey": "BusinessEntityID", "Phone": "PhoneNumber"},
    )
    wanted = {"CustomerKey": "CustomerID", "CustomerAlternateKey": "AccountNumber"}
    person_ref = "CustomerKey"
    if person_key != "CustomerID":
        person_ref = "PersonRef"
        wanted[person_ref] = person_key
    customers = C.project(customer, wanted)
    # By default all five inputs are partitioned by the same id: one shuffle each.
    return (
        customers.join(persons, F.col(person_ref) == F.col("PersonKey"), "inner")
        .join(addresses, F.col("CustomerKey") == F.col("GeographyKey"), "left")
        .join(emails, F.col(person_ref) == F.col("EmailKey"), "left")
        .join(phones, F.col(person_ref) == F.col("PhoneKey"), "left")
        .select(*GOLD_SCHEMAS["DimCustomer"].names)
    )


def dim_date(header: DataFrame) -> DataFrame:
    """Calendar attributes of the order dates that occur.

    The attributes depend on the date alone, so the dates are made distinct
    before the attributes are computed.
    """
    days = header.select(F.col("OrderDate").alias("DateKey")).distinct()
    return C.project(days, {"DateKey": "DateKey", "FullDateAlternateKey": "DateKey", **C.calendar("DateKey")})


def dim_geography(
    address: DataFrame, state: DataFrame, country: DataFrame, silver_unique: bool = False
) -> DataFrame:
    """Addresses with the names of their state and country."""
    places = C.project(
        _current(address, "person_address", "AddressID", ["City", "StateProvinceID", "PostalCode"], silver_unique),
        {"GeographyKey": "AddressID", "City": "City", "StateRef": "StateProvinceID", "PostalCode": "PostalCode"},
    )
    states = C.project(
        _current(state, "person_stateprovince", "StateProvinceID", ["Name", "CountryRegionCode"], silver_unique),
        {"StateKey": "StateProvinceID", "StateProvince": "Name", "CountryRef": "CountryRegionCode"},
    )
    countries = C.project(
        _current(country, "person_countryregion", "CountryRegionCode", ["Name"], silver_unique),
        {"CountryKey": "CountryRegionCode", "CountryRegion": "Name"},
    )
    regions = states.join(countries, F.col("CountryRef") == F.col("CountryKey"), "inner")
    return lookup_join(places, regions, {"StateRef": "StateKey"}, "inner").select(
        *GOLD_SCHEMAS["DimGeography"].names
    )


def _categorised(subcategory: DataFrame, category: DataFrame) -> DataFrame:
    """Subcategories with the name of their category, if any."""
    categories = C.project(category, {"CategoryKey": "ProductCategoryID", "CategoryName": "Name"})
    named = C.project(
        subcategory,
        {"SubcategoryKey": "ProductSubcategoryID", "CategoryRef": "ProductCategoryID", "SubcategoryName": "Name"},
    )
    return named.join(categories, F.col("CategoryRef") == F.col("CategoryKey"), "left")


def dim_product(
    product: DataFrame,
    subcategory: DataFrame,
    category: DataFrame,
    model: DataFrame,
    silver_unique: bool = False,
) -> DataFrame:
    """Products with model, subcategory and category; absent names are NULL.

    The category table is taken as it is.
    """
    products = _current(
        product,
        "production_product",
        "ProductID",
        ["Name", "ProductNumber", "ProductSubcategoryID", "ProductModelID"],
        silver_unique,
    )
    subcategories = _current(
        subcategory,
        "production_productsubcategory",
        "ProductSubcategoryID",
        ["Name", "ProductCategoryID"],
        silver_unique,
    )
    models = C.project(
        _current(model, "production_productmodel", "ProductModelID", ["Name"], silver_unique),
        {"ModelKey": "ProductModelID", "ModelName": "Name"},
    )
    described = lookup_join(
        products, _categorised(subcategories, category), {"ProductSubcategoryID": "SubcategoryKey"}
    )
    return C.project(
        lookup_join(described, models, {"ProductModelID": "ModelKey"}),
        {
            "ProductKey": "ProductID",
            "ProductAlternateKey": "ProductNumber",
            "ProductName": "Name",
            "ModelName": "ModelName",
            "SubcategoryName": "SubcategoryName",
            "CategoryName": "CategoryName",
            "ProductSubcategoryKey": "SubcategoryKey",
            "ProductCategoryKey": "CategoryRef",
        },
    )


def dim_promotion(special_offer: DataFrame, silver_unique: bool = False) -> DataFrame:
    kept = ["Description", "DiscountPct", "Type", "StartDate", "EndDate", "MinQty"]
    latest = _current(special_offer, "sales_specialoffer", "SpecialOfferID", kept, silver_unique)
    return C.project(
        latest,
        {
            "PromotionKey": "SpecialOfferID",
            "PromotionAlternateKey": "SpecialOfferID",
            "EnglishPromotionName": "Description",
            "DiscountPct": "DiscountPct",
            "EnglishPromotionType": "Type",
            "StartDate": "StartDate",
            "EndDate": "EndDate",
            "MinQty": "MinQty",
        },
    )


def dim_sales_reason(reason: DataFrame, silver_unique: bool = False) -> DataFrame:
    latest = _current(reason, "sales_salesreason", "SalesReasonID", ["Name", "ReasonType"], silver_unique)
    return C.project(
        latest,
        {"SalesReasonKey": "SalesReasonID", "SalesReasonName": "Name", "SalesReasonType": "ReasonType"},
    )


def dim_sales_territory(territory: DataFrame, silver_unique: bool = False) -> DataFrame:
    kept = ["Name", "CountryRegionCode", "Group"]
    latest = _current(territory, "sales_salesterritory", "TerritoryID", kept, silver_unique)
    return C.project(
        latest,
        {
            "SalesTerritoryKey": "TerritoryID",
            "SalesTerritoryAlternateKey": "TerritoryID",
            "SalesTerritoryRegion": "Name",
            "SalesTerritoryCountry": "CountryRegionCode",
            "SalesTerritoryGroup": "Group",
        },
    )


# -- facts -----------------------------------------------------------------


def _known_keys(df: DataFrame, table: str, key: str, name: str, silver_unique: bool) -> DataFrame:
    """The keys of a lookup table under the name they get in the fact."""
    return _current(df, table, key, [], silver_unique).select(F.col(key).alias(name))


def _online_orders(header: DataFrame, carry: Sequence[str], silver_unique: bool) -> DataFrame:
    """Orders whose latest version is an online order.

    The filter follows the dedup: an order whose newest version is not online
    is gone, even if an older version was.
    """
    latest = _current(header, "sales_salesorderheader", "SalesOrderID", [*carry, "OnlineOrderFlag"], silver_unique)
    return latest.where("OnlineOrderFlag = 1").drop("OnlineOrderFlag").withColumnRenamed("SalesOrderID", "OrderID")


def fact_internet_sales(
    header: DataFrame,
    detail: DataFrame,
    product: DataFrame,
    customer: DataFrame,
    special_offer: DataFrame,
    territory: DataFrame,
    cost_history: DataFrame | None = None,
    silver_unique: bool = False,
    wide_ids: bool = True,
) -> DataFrame:
    """Lines of online orders with the keys of their dimensions.

    A key is NULL when its dimension does not know it. Details are reduced by
    ``SalesOrderDetailID`` alone. Customer and territory are looked up per
    order, before orders meet their many lines.

    With ``cost_history`` the extended, discount and cost amounts are added at
    the end; the cost is that of the product's latest history row.
    Ids are 64-bit numbers unless ``wide_ids`` is off.
    """
    customers = _known_keys(customer, "sales_customer", "CustomerID", "CustomerKey", silver_unique)
    territories = _known_keys(territory, "sales_salesterritory", "TerritoryID", "SalesTerritoryKey", silver_unique)
    products = _known_keys(product, "production_product", "ProductID", "ProductKey", silver_unique)
    offers = _known_keys(special_offer, "sales_specialoffer", "SpecialOfferID", "PromotionKey", silver_unique)

    orders = _online_orders(
        header, ["OrderDate", "DueDate", "ShipDate", "RevisionNumber", "CustomerID", "TerritoryID"], silver_unique
    )
    orders = lookup_join(orders, customers, {"CustomerID": "CustomerKey"})
    orders = lookup_join(orders, territories, {"TerritoryID": "SalesTerritoryKey"})

    amounts = ("OrderQty", "UnitPrice", "UnitPriceDiscount")
    lines = _current(
        detail,
        "sales_salesorderdetail",
        "SalesOrderDetailID",
        ["SalesOrderID", "ProductID", "SpecialOfferID", *amounts],
        silver_unique,
    )
    sales = lookup_join(apply_rules(lines, POSITIVE_SALE), orders, {"SalesOrderID": "OrderID"}, "inner")
    sales = lookup_join(sales, products, {"ProductID": "ProductKey"})
    sales = lookup_join(sales, offers, {"SpecialOfferID": "PromotionKey"})
    cost = None
    if cost_history is not None:
        costs = _current(
            cost_history, "production_productcosthistory", "ProductID", ["StandardCost"], silver_unique
        ).withColumnRenamed("ProductID", "CostKey")
        sales = lookup_join(sales, costs, {"ProductID": "CostKey"})
        cost = "StandardCost"
    measures = C.fact_measures(*amounts, cost)
    sales = C.project(
        sales,
        {
            "ProductKey": "ProductKey",
            "OrderDateKey": "OrderDate",
            "DueDateKey": "DueDate",
            "ShipDateKey": "ShipDate",
            "CustomerKey": "CustomerKey",
            "PromotionKey": "PromotionKey",
            "SalesTerritoryKey": "SalesTerritoryKey",
            "SalesOrderID": "OrderID",
            **{name: name for name in ("SalesOrderDetailID", "RevisionNumber", *amounts)},
            **measures,
        },
    )
    schema = GOLD_SCHEMAS["FactInternetSales"]
    extra = [name for name in measures if name not in schema.names] if cost else []
    return sales.selectExpr(*C.cast_expressions(widen_ids(schema) if wide_ids else schema, sales.schema), *extra)


def fact_internet_sales_reason(
    header: DataFrame, detail: DataFrame, reason: DataFrame, order_reason: DataFrame, silver_unique: bool = False
) -> DataFrame:
    """Order lines and the reasons given for their order, online or not.

    Only keys reach the output, so each input is made distinct first (a
    repeated order cannot multiply its lines), and the final dedup is a
    hash-aggregated distinct. Orders meet their few reasons before their many
    lines, so only one join sees an order with a huge number of lines.
    """
    reasons = _known_keys(reason, "sales_salesreason", "SalesReasonID", "SalesReasonKey", silver_unique)
    links = _current(
        order_reason,
        "sales_salesorderheadersalesreason",
        ["SalesOrderID", "SalesReasonID"],
        [],
        silver_unique,
    )
    lines = _current(
        detail, "sales_salesorderdetail", ["SalesOrderID", "SalesOrderDetailID"], [], silver_unique
    )
    orders = header.select("SalesOrderID", "SalesOrderNumber")
    orders = orders if silver_unique else orders.distinct()
    known_links = lookup_join(links, reasons, {"SalesReasonID": "SalesReasonKey"}, "left_semi")
    order_reasons = orders.join(known_links, "SalesOrderID").withColumnRenamed("SalesOrderID", "OrderID")
    return C.project(
        lookup_join(lines, order_reasons, {"SalesOrderID": "OrderID"}, "inner"),
        {
            "SalesOrderNumber": "SalesOrderNumber",
            "SalesOrderLineNumber": "SalesOrderDetailID",
            "SalesReasonKey": "SalesReasonID",
        },
    ).distinct()


def ft_agg_product_day(fact: DataFrame, product: DataFrame) -> DataFrame:
    """Quantity and amount per product and day, from the fact and the product
    dimension.

    Sales are summed per product and day before the product's names are joined,
    so the join sees one row per product and day, and hot products are reduced
    before any shuffle.
    """
    daily = (
        fact.groupBy(F.col("ProductKey").alias("FactKey"), F.to_date("OrderDateKey").alias("OrderDate"))
        .agg(F.sum("OrderQty").alias("Qty"), F.sum("LineTotal").alias("Amount"))
    )
    return with_product_names(daily, product)


def with_product_names(daily: DataFrame, product: DataFrame) -> DataFrame:
    """Sums per ``FactKey`` and ``OrderDate`` with the names of the product dimension.

    Should the dimension repeat a product, its rows with equal names count as
    often as they come. They are counted before the join, so that the many sums
    need no grouping after it.
    """
    names = C.project(
        product,
        {
            "ProductKey": "ProductKey",
            "ProductName": "ProductName",
            "ProductCategoryName": "CategoryName",
            "ProductSubcategoryName": "SubcategoryName",
        },
    )
    copies = names.withColumnRenamed("ProductKey", "NameKey").groupBy("NameKey", *names.columns[1:]).agg(F.count(F.lit(1)).alias("Copies"))
    named = lookup_join(daily, copies, {"FactKey": "NameKey"})
    times = F.coalesce("Copies", F.lit(1))
    return named.select(
        F.col("FactKey").alias("ProductKey"),
        "OrderDate",
        "ProductName",
        "ProductCategoryName",
        "ProductSubcategoryName",
        (F.col("Qty") * times).alias("TotalOrderQty"),
        (F.col("Amount") * times).cast(TOTAL).alias("TotalLineTotal"),
    )


def one_big_table(
    header: DataFrame,
    detail: DataFrame,
    product: DataFrame,
    subcategory: DataFrame,
    category: DataFrame,
    territory: DataFrame,
    person: DataFrame,
    silver_unique: bool = False,
) -> DataFrame:
    """Lines of online orders with all descriptive names in one row.

    The customer's name is that of the person whose id equals the customer id.
    """
    persons = C.project(
        _current(person, "person_person", "BusinessEntityID", ["FirstName", "LastName"], silver_unique),
        {"PersonKey": "BusinessEntityID", "CustomerName": C.full_name("FirstName", "LastName")},
    )
    territories = C.project(
        _current(territory, "sales_salesterritory", "TerritoryID", ["Name"], silver_unique),
        {"TerritoryKey": "TerritoryID", "TerritoryName": "Name"},
    )
    categories = _current(category, "production_productcategory", "ProductCategoryID", ["Name"], silver_unique)
    subcategories = _current(
        subcategory,
        "production_productsubcategory",
        "ProductSubcategoryID",
        ["Name", "ProductCategoryID"],
        silver_unique,
    )
    products = C.project(
        lookup_join(
            _current(
                product,
                "production_product",
                "ProductID",
                ["Name", "ProductNumber", "ProductSubcategoryID"],
                silver_unique,
            ),
            _categorised(subcategories, categories),
            {"ProductSubcategoryID": "SubcategoryKey"},
        ),
        {
            "ProductKey": "ProductID",
            "ProductName": "Name",
            "ProductNumber": "ProductNumber",
            "ProductCategoryName": "CategoryName",
            "ProductSubcategoryName": "SubcategoryName",
        },
    )

    amounts = ["SubTotal", "TaxAmt", "Freight", "TotalDue"]
    orders = _online_orders(
        header, ["OrderDate", "DueDate", *amounts, "CustomerID", "TerritoryID"], silver_unique
    )
    orders = lookup_join(orders, territories, {"TerritoryID": "TerritoryKey"})
    orders = lookup_join(orders, persons, {"CustomerID": "PersonKey"})
    lines = _current(
        detail,
        "sales_salesorderdetail",
        "SalesOrderDetailID",
        ["SalesOrderID", "ProductID", "OrderQty", "UnitPrice", "UnitPriceDiscount", "LineTotal"],
        silver_unique,
    )
    sales = lookup_join(lines, orders, {"SalesOrderID": "OrderID"}, "inner")
    sales = lookup_join(sales, products, {"ProductID": "ProductKey"})
    wide = {name: name for name in GOLD_SCHEMAS["OneBigTable"].names}
    return C.project(sales, {**wide, "OrderQty": F.col("OrderQty").cast(INT)})
