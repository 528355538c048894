"""Registered queries: the 20 silver tables and the 12 gold models."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.plans import gold
from cairn.plans.silver import SILVER, silver_keys, silver_rejects, silver_transform
from cairn.plans.warehouse import GOLD_INPUTS, GOLD_MODELS, check_gold
from harness.registry import query
from harness.retail import raw, raw_for_duckdb

LOAD_TIME = "2030-01-01 00:00:00"


def silver(spark: SparkSession, sf_dir: str, table: str, **options) -> DataFrame:
    """One silver table from the supplied tables.

    Load time and row ids are fixed so that the result can be compared, and ids
    are 64-bit as in the supplied tables.
    """
    return silver_transform(
        raw(spark, sf_dir, table),
        SILVER[table],
        load_time=F.lit(LOAD_TIME).cast("timestamp"),
        stable_row_ids=True,
        **options,
    )


# Gold reduces order lines by their id alone: both dedups share one shuffle.
_DISTRIBUTED = {"sales_salesorderdetail": ("SalesOrderDetailID",)}


def _gold_input(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return silver(spark, sf_dir, table, distribute_by=_DISTRIBUTED.get(table, ()))


# Inputs of which a model uses nothing but the key.
_KEY_INPUTS = {
    "DimCustomer": ("address",),
    "FactInternetSales": ("product", "customer", "special_offer", "territory"),
    "FactInternetSalesReason": ("detail", "reason", "order_reason"),
}


def _silver_keys(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return silver_keys(raw(spark, sf_dir, table), SILVER[table], wide_ids=True)


def gold_model(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    """One gold model on top of the silver plans."""
    if model == "ft_agg_product_day":
        inputs = {arg: gold_model(spark, sf_dir, name) for arg, name in GOLD_INPUTS[model].items()}
        options = {}
    else:
        only_keys = _KEY_INPUTS.get(model, ())
        inputs = {
            arg: (_silver_keys if arg in only_keys else _gold_input)(spark, sf_dir, name)
            for arg, name in GOLD_INPUTS[model].items()
        }
        options = {} if model == "DimDate" else {"silver_unique": True}
        if model == "FactInternetSales":
            options["wide_ids"] = True
    return check_gold(model, GOLD_MODELS[model](**inputs, **options), wide_ids=True)


# -- silver in DuckDB ------------------------------------------------------


@dataclass(frozen=True)
class SilverSql:
    keys: str
    output: str
    where: str = "TRUE"
    derived: Mapping[str, str] = field(default_factory=dict)


_SILVER_SQL = {
    "person_address": SilverSql(
        "AddressID",
        "AddressID BIGINT|AddressLine1 VARCHAR|AddressLine2 VARCHAR|City VARCHAR|StateProvinceID BIGINT"
        "|PostalCode VARCHAR|rowguid VARCHAR",
    ),
    "person_countryregion": SilverSql("CountryRegionCode", "CountryRegionCode VARCHAR|Name VARCHAR"),
    "person_emailaddress": SilverSql(
        "BusinessEntityID, EmailAddressID",
        "BusinessEntityID BIGINT|EmailAddressID BIGINT|EmailAddress VARCHAR|rowguid VARCHAR",
    ),
    "person_person": SilverSql(
        "BusinessEntityID",
        "BusinessEntityID BIGINT|PersonType VARCHAR|NameStyle INTEGER|Title VARCHAR|FirstName VARCHAR"
        "|MiddleName VARCHAR|LastName VARCHAR|Suffix VARCHAR|EmailPromotion INTEGER"
        "|AdditionalContactInfo VARCHAR|Demographics VARCHAR|rowguid VARCHAR",
        "EmailPromotion BETWEEN 0 AND 2 AND PersonType IN ('GC', 'SP', 'EM', 'IN', 'VC', 'SC')",
    ),
    "person_personphone": SilverSql(
        "BusinessEntityID, PhoneNumber, PhoneNumberTypeID",
        "BusinessEntityID BIGINT|PhoneNumber VARCHAR|PhoneNumberTypeID BIGINT",
    ),
    "person_stateprovince": SilverSql(
        "StateProvinceID",
        "StateProvinceID BIGINT|StateProvinceCode VARCHAR|CountryRegionCode VARCHAR"
        "|IsOnlyStateProvinceFlag BOOLEAN|Name VARCHAR|TerritoryID BIGINT|rowguid VARCHAR",
    ),
    "production_product": SilverSql(
        "ProductID",
        "ProductID BIGINT|Name VARCHAR|ProductNumber VARCHAR|MakeFlag BOOLEAN|FinishedGoodsFlag BOOLEAN"
        "|Color VARCHAR|SafetyStockLevel SMALLINT|ReorderPoint SMALLINT|StandardCost DECIMAL(19,4)"
        "|ListPrice DECIMAL(19,4)|Size VARCHAR|SizeUnitMeasureCode VARCHAR|WeightUnitMeasureCode VARCHAR"
        "|Weight DECIMAL(8,2)|DaysToManufacture INTEGER|ProductLine VARCHAR|Class VARCHAR|Style VARCHAR"
        "|ProductSubcategoryID BIGINT|ProductModelID BIGINT|SellStartDate TIMESTAMP|SellEndDate TIMESTAMP"
        "|DiscontinuedDate TIMESTAMP|rowguid VARCHAR",
    ),
    "production_productcategory": SilverSql(
        "ProductCategoryID", "ProductCategoryID BIGINT|Name VARCHAR|rowguid VARCHAR"
    ),
    "production_productcosthistory": SilverSql(
        "ProductID, StartDate",
        "ProductID BIGINT|StartDate TIMESTAMP|EndDate TIMESTAMP|StandardCost DECIMAL(19,4)",
        "StandardCost >= 0",
        {"EndDate": "CASE WHEN EndDate < StartDate THEN NULL ELSE EndDate END"},
    ),
    "production_productdescription": SilverSql(
        "ProductDescriptionID", "ProductDescriptionID BIGINT|Description VARCHAR|rowguid VARCHAR"
    ),
    "production_productmodel": SilverSql(
        "ProductModelID",
        "ProductModelID BIGINT|Name VARCHAR|CatalogDescription VARCHAR|Instructions VARCHAR|rowguid VARCHAR",
    ),
    "production_productsubcategory": SilverSql(
        "ProductSubcategoryID",
        "ProductSubcategoryID BIGINT|ProductCategoryID BIGINT|Name VARCHAR|rowguid VARCHAR",
    ),
    "sales_currency": SilverSql("CurrencyCode", "CurrencyCode VARCHAR|Name VARCHAR"),
    "sales_customer": SilverSql(
        "CustomerID",
        "CustomerID BIGINT|PersonID BIGINT|StoreID BIGINT|TerritoryID BIGINT|AccountNumber VARCHAR"
        "|rowguid VARCHAR",
        derived={"AccountNumber": "coalesce(AccountNumber, 'AW' || printf('%09d', CustomerID))"},
    ),
    "sales_salesorderdetail": SilverSql(
        "SalesOrderID, SalesOrderDetailID",
        "SalesOrderID BIGINT|SalesOrderDetailID BIGINT|CarrierTrackingNumber VARCHAR|OrderQty SMALLINT"
        "|ProductID BIGINT|SpecialOfferID BIGINT|UnitPrice DECIMAL(19,4)|UnitPriceDiscount DECIMAL(19,4)"
        "|LineTotal DECIMAL(38,6)|rowguid VARCHAR",
        "OrderQty > 0 AND UnitPrice >= 0 AND UnitPriceDiscount >= 0",
        {"LineTotal": "UnitPrice * (1 - UnitPriceDiscount) * OrderQty"},
    ),
    "sales_salesorderheader": SilverSql(
        "SalesOrderID",
        "SalesOrderID BIGINT|RevisionNumber SMALLINT|OrderDate TIMESTAMP|DueDate TIMESTAMP"
        "|ShipDate TIMESTAMP|Status SMALLINT|OnlineOrderFlag INTEGER|SalesOrderNumber VARCHAR"
        "|PurchaseOrderNumber VARCHAR|AccountNumber VARCHAR|CustomerID BIGINT|SalesPersonID BIGINT"
        "|TerritoryID BIGINT|BillToAddressID BIGINT|ShipToAddressID BIGINT|ShipMethodID BIGINT"
        "|CreditCardID BIGINT|CreditCardApprovalCode VARCHAR|CurrencyRateID BIGINT|SubTotal DECIMAL(19,4)"
        "|TaxAmt DECIMAL(19,4)|Freight DECIMAL(19,4)|TotalDue DECIMAL(38,6)|Comment VARCHAR|rowguid VARCHAR",
        "SubTotal >= 0 AND TaxAmt >= 0 AND Freight >= 0 AND Status >= 0 AND Status <= 8",
        {
            "TotalDue": "CASE WHEN SubTotal IS NOT NULL AND TaxAmt IS NOT NULL AND Freight IS NOT NULL "
            "THEN SubTotal + TaxAmt + Freight ELSE 0 END"
        },
    ),
    "sales_salesorderheadersalesreason": SilverSql(
        "SalesOrderID, SalesReasonID", "SalesOrderID BIGINT|SalesReasonID BIGINT"
    ),
    "sales_salesreason": SilverSql("SalesReasonID", "SalesReasonID BIGINT|Name VARCHAR|ReasonType VARCHAR"),
    "sales_salesterritory": SilverSql(
        "TerritoryID",
        'TerritoryID BIGINT|Name VARCHAR|CountryRegionCode VARCHAR|"Group" VARCHAR|SalesYTD DECIMAL(19,4)'
        "|SalesLastYear DECIMAL(19,4)|CostYTD DECIMAL(19,4)|CostLastYear DECIMAL(19,4)|rowguid VARCHAR",
        "SalesYTD >= 0 AND SalesLastYear >= 0 AND CostYTD >= 0 AND CostLastYear >= 0",
    ),
    "sales_specialoffer": SilverSql(
        "SpecialOfferID",
        "SpecialOfferID BIGINT|Description VARCHAR|DiscountPct DECIMAL(10,4)|Type VARCHAR|Category VARCHAR"
        "|StartDate TIMESTAMP|EndDate TIMESTAMP|MinQty INTEGER|MaxQty INTEGER|rowguid VARCHAR",
        "DiscountPct >= 0 AND EndDate >= StartDate AND (MaxQty >= 0 OR MaxQty IS NULL) AND MinQty >= 0",
    ),
}

_ALWAYS_COMPUTED = ("LineTotal", "TotalDue")


def _key_row_id(table: str, keys: str) -> str:
    parts = [f"CAST({k.strip()} AS VARCHAR)" for k in keys.split(",")]
    text = " || '|' || ".join([f"'{table}'", *[f"length({part}) || ':' || {part}" for part in parts]])
    parts = [f"substr(md5({text}), {start}, {size})" for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return "coalesce(rowguid, " + " || '-' || ".join(parts) + ")"


def silver_sql(table: str) -> str:
    """One silver table as a DuckDB query."""
    spec = _SILVER_SQL[table]
    keys = [k.strip() for k in spec.keys.split(",")]
    declared = [column.rsplit(" ", 1) for column in spec.output.split("|")]
    derived = {"rowguid": _key_row_id(table, spec.keys), **spec.derived}
    ties = [n for n, _ in declared if n not in keys and n not in _ALWAYS_COMPUTED]
    newest = ", ".join(["ModifiedDate DESC NULLS LAST", *[f"{n} ASC NULLS FIRST" for n in ties]])
    output = ", ".join(f"CAST({derived.get(n, n)} AS {kind}) AS {n}" for n, kind in declared)
    return f"""
        SELECT {output}, CAST(ModifiedDate AS TIMESTAMP) AS ModifiedDate
        FROM (SELECT *, row_number() OVER (PARTITION BY {spec.keys} ORDER BY {newest}) AS version
              FROM (SELECT * REPLACE (coalesce(ModifiedDate, TIMESTAMP '{LOAD_TIME}') AS ModifiedDate)
                    FROM ({raw_for_duckdb(table)}))
              WHERE {spec.where})
        WHERE version = 1"""


# -- gold in DuckDB --------------------------------------------------------


def _latest(table: str, keys: str, ties: str = "") -> str:
    order = ", ".join(
        ["ModifiedDate DESC NULLS LAST", *[f"{t.strip()} ASC NULLS FIRST" for t in ties.split(",") if t.strip()]]
    )
    return (
        f"(SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1)"
    )


_FACT_SQL = f"""
    SELECT p.ProductID AS ProductKey, soh.OrderDate AS OrderDateKey, soh.DueDate AS DueDateKey,
           soh.ShipDate AS ShipDateKey, c.CustomerID AS CustomerKey, so.SpecialOfferID AS PromotionKey,
           st.TerritoryID AS SalesTerritoryKey, CAST(soh.SalesOrderID AS VARCHAR) AS SalesOrderID,
           sod.SalesOrderDetailID, soh.RevisionNumber, CAST(sod.OrderQty AS INTEGER) AS OrderQty,
           sod.UnitPrice, sod.UnitPriceDiscount,
           CAST(sod.OrderQty * CAST(sod.UnitPrice AS DECIMAL(18,4))
                - CAST(sod.UnitPrice AS DECIMAL(18,4)) * CAST(sod.UnitPriceDiscount AS DECIMAL(18,4))
                AS DECIMAL(38,6)) AS LineTotal
    FROM {_latest('sales_salesorderdetail', 'SalesOrderDetailID',
                  'SalesOrderID, ProductID, SpecialOfferID, OrderQty, UnitPrice, UnitPriceDiscount')} sod
    JOIN (SELECT * FROM {_latest('sales_salesorderheader', 'SalesOrderID')}
          WHERE OnlineOrderFlag = 1) soh ON sod.SalesOrderID = soh.SalesOrderID
    LEFT JOIN {_latest('production_product', 'ProductID')} p ON sod.ProductID = p.ProductID
    LEFT JOIN {_latest('sales_customer', 'CustomerID')} c ON soh.CustomerID = c.CustomerID
    LEFT JOIN {_latest('sales_specialoffer', 'SpecialOfferID')} so ON sod.SpecialOfferID = so.SpecialOfferID
    LEFT JOIN {_latest('sales_salesterritory', 'TerritoryID')} st ON soh.TerritoryID = st.TerritoryID
    WHERE sod.OrderQty > 0 AND sod.UnitPrice > 0"""

_PRODUCT_SQL = f"""
    SELECT p.ProductID AS ProductKey, p.ProductNumber AS ProductAlternateKey, p.Name AS ProductName,
           pm.Name AS ModelName, ps.Name AS SubcategoryName, pc.Name AS CategoryName,
           ps.ProductSubcategoryID AS ProductSubcategoryKey, ps.ProductCategoryID AS ProductCategoryKey
    FROM {_latest('production_product', 'ProductID')} p
    LEFT JOIN {_latest('production_productsubcategory', 'ProductSubcategoryID')} ps
           ON p.ProductSubcategoryID = ps.ProductSubcategoryID
    LEFT JOIN production_productcategory pc ON ps.ProductCategoryID = pc.ProductCategoryID
    LEFT JOIN {_latest('production_productmodel', 'ProductModelID')} pm ON p.ProductModelID = pm.ProductModelID"""

_GOLD_SQL = {
    "DimCurrency": f"""
        SELECT CurrencyCode AS CurrencyKey, CurrencyCode AS CurrencyAlternateKey, Name AS CurrencyName
        FROM {_latest('sales_currency', 'CurrencyCode')}""",
    "DimCustomer": f"""
        SELECT c.CustomerID AS CustomerKey, a.AddressID AS GeographyKey,
               c.AccountNumber AS CustomerAlternateKey, p.Title, p.FirstName, p.MiddleName, p.LastName,
               p.NameStyle, ea.EmailAddress, pp.PhoneNumber AS Phone
        FROM sales_customer c
        JOIN {_latest('person_person', 'BusinessEntityID')} p ON c.CustomerID = p.BusinessEntityID
        LEFT JOIN {_latest('person_address', 'AddressID')} a ON c.CustomerID = a.AddressID
        LEFT JOIN {_latest('person_emailaddress', 'BusinessEntityID', 'EmailAddress')} ea
               ON c.CustomerID = ea.BusinessEntityID
        LEFT JOIN {_latest('person_personphone', 'BusinessEntityID', 'PhoneNumber')} pp
               ON c.CustomerID = pp.BusinessEntityID""",
    "DimDate": """
        SELECT DISTINCT OrderDate AS DateKey, OrderDate AS FullDateAlternateKey,
               CAST(isodow(OrderDate) AS INTEGER) AS DayNumberOfWeek,
               dayname(OrderDate) AS EnglishDayNameOfWeek,
               CAST(day(OrderDate) AS INTEGER) AS DayNumberOfMonth,
               CAST(dayofyear(OrderDate) AS INTEGER) AS DayNumberOfYear,
               CAST(week(OrderDate) AS INTEGER) AS WeekNumberOfYear,
               monthname(OrderDate) AS EnglishMonthName,
               CAST(month(OrderDate) AS INTEGER) AS MonthNumberOfYear,
               CAST(quarter(OrderDate) AS INTEGER) AS CalendarQuarter,
               CAST(year(OrderDate) AS INTEGER) AS CalendarYear,
               CAST(CASE WHEN month(OrderDate) BETWEEN 1 AND 6 THEN 1 ELSE 2 END AS INTEGER) AS CalendarSemester
        FROM sales_salesorderheader""",
    "DimGeography": f"""
        SELECT a.AddressID AS GeographyKey, a.City, sp.Name AS StateProvince, cr.Name AS CountryRegion,
               a.PostalCode
        FROM {_latest('person_address', 'AddressID')} a
        JOIN {_latest('person_stateprovince', 'StateProvinceID')} sp ON a.StateProvinceID = sp.StateProvinceID
        JOIN {_latest('person_countryregion', 'CountryRegionCode')} cr
          ON sp.CountryRegionCode = cr.CountryRegionCode""",
    "DimProduct": _PRODUCT_SQL,
    "DimPromotion": f"""
        SELECT SpecialOfferID AS PromotionKey, SpecialOfferID AS PromotionAlternateKey,
               Description AS EnglishPromotionName, DiscountPct, Type AS EnglishPromotionType,
               StartDate, EndDate, MinQty
        FROM {_latest('sales_specialoffer', 'SpecialOfferID')}""",
    "DimSalesReason": f"""
        SELECT SalesReasonID AS SalesReasonKey, Name AS SalesReasonName, ReasonType AS SalesReasonType
        FROM {_latest('sales_salesreason', 'SalesReasonID')}""",
    "DimSalesTerritory": f"""
        SELECT TerritoryID AS SalesTerritoryKey, TerritoryID AS SalesTerritoryAlternateKey,
               Name AS SalesTerritoryRegion, CountryRegionCode AS SalesTerritoryCountry,
               "Group" AS SalesTerritoryGroup
        FROM {_latest('sales_salesterritory', 'TerritoryID')}""",
    "FactInternetSales": _FACT_SQL,
    "FactInternetSalesReason": f"""
        SELECT SalesOrderNumber, SalesOrderLineNumber, SalesReasonKey
        FROM (SELECT soh.SalesOrderNumber, sod.SalesOrderDetailID AS SalesOrderLineNumber,
                     sr.SalesReasonID AS SalesReasonKey, soh.ModifiedDate
              FROM sales_salesorderheader soh
              JOIN {_latest('sales_salesorderdetail', 'SalesOrderID, SalesOrderDetailID')} sod
                ON soh.SalesOrderID = sod.SalesOrderID
              JOIN sales_salesorderheadersalesreason link ON soh.SalesOrderID = link.SalesOrderID
              JOIN sales_salesreason sr ON link.SalesReasonID = sr.SalesReasonID)
        QUALIFY row_number() OVER (PARTITION BY SalesOrderNumber, SalesOrderLineNumber, SalesReasonKey
                                   ORDER BY ModifiedDate DESC) = 1""",
    "ft_agg_product_day": f"""
        SELECT fis.ProductKey, CAST(fis.OrderDateKey AS DATE) AS OrderDate, dp.ProductName,
               dp.CategoryName AS ProductCategoryName, dp.SubcategoryName AS ProductSubcategoryName,
               CAST(sum(fis.OrderQty) AS BIGINT) AS TotalOrderQty,
               CAST(sum(fis.LineTotal) AS DECIMAL(38,6)) AS TotalLineTotal
        FROM ({_FACT_SQL}) fis LEFT JOIN ({_PRODUCT_SQL}) dp ON fis.ProductKey = dp.ProductKey
        GROUP BY ALL""",
    "OneBigTable": f"""
        SELECT soh.SalesOrderID, sod.SalesOrderDetailID, soh.OrderDate, soh.DueDate, soh.SubTotal,
               soh.TaxAmt, soh.Freight, soh.TotalDue, sod.LineTotal,
               CAST(sod.OrderQty AS INTEGER) AS OrderQty, sod.UnitPrice, sod.UnitPriceDiscount,
               p.Name AS ProductName, p.ProductNumber, pc.Name AS ProductCategoryName,
               psc.Name AS ProductSubcategoryName, st.Name AS TerritoryName,
               c.FirstName || ' ' || c.LastName AS CustomerName
        FROM {_latest('sales_salesorderdetail', 'SalesOrderDetailID',
                      'SalesOrderID, ProductID, OrderQty, UnitPrice, UnitPriceDiscount, LineTotal')} sod
        JOIN (SELECT * FROM {_latest('sales_salesorderheader', 'SalesOrderID')}
              WHERE OnlineOrderFlag = 1) soh ON sod.SalesOrderID = soh.SalesOrderID
        LEFT JOIN {_latest('production_product', 'ProductID')} p ON sod.ProductID = p.ProductID
        LEFT JOIN {_latest('production_productsubcategory', 'ProductSubcategoryID')} psc
               ON p.ProductSubcategoryID = psc.ProductSubcategoryID
        LEFT JOIN {_latest('production_productcategory', 'ProductCategoryID')} pc
               ON psc.ProductCategoryID = pc.ProductCategoryID
        LEFT JOIN {_latest('sales_salesterritory', 'TerritoryID')} st ON soh.TerritoryID = st.TerritoryID
        LEFT JOIN {_latest('person_person', 'BusinessEntityID')} c ON soh.CustomerID = c.BusinessEntityID""",
}


def _silver_tables(model: str) -> list[str]:
    if model == "ft_agg_product_day":
        return sorted({t for m in GOLD_INPUTS[model].values() for t in _silver_tables(m)})
    return sorted(GOLD_INPUTS[model].values())


def gold_sql(model: str) -> str:
    """One gold model as a DuckDB query over the silver queries."""
    tables = ", ".join(f"{t} AS ({silver_sql(t)})" for t in _silver_tables(model))
    return f"WITH {tables} {_GOLD_SQL[model]}"


# -- variants --------------------------------------------------------------

_COST_TABLES = [*GOLD_INPUTS["FactInternetSales"].values(), "production_productcosthistory"]
_COST_SQL = f"""
    WITH {", ".join(f"{t} AS ({silver_sql(t)})" for t in _COST_TABLES)}
    SELECT fis.*, CAST(fis.OrderQty * CAST(fis.UnitPrice AS DECIMAL(18,4)) AS DECIMAL(38,6)) AS ExtendedAmount,
           CAST(CAST(fis.UnitPrice AS DECIMAL(18,4)) * CAST(fis.UnitPriceDiscount AS DECIMAL(18,4))
                AS DECIMAL(38,6)) AS DiscountAmount,
           CAST(fis.OrderQty * CAST(pch.StandardCost AS DECIMAL(18,4)) AS DECIMAL(38,6)) AS TotalProductCost
    FROM ({_FACT_SQL}) fis
    LEFT JOIN {_latest('production_productcosthistory', 'ProductID', 'StandardCost')} pch
           ON fis.ProductKey = pch.ProductID"""


@query("gold_FactInternetSales_costs", _COST_SQL)
def fact_with_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with its optional amounts, from the latest cost per product."""
    model = "FactInternetSales"
    inputs = {
        arg: (_silver_keys if arg in _KEY_INPUTS[model] else silver)(spark, sf_dir, table)
        for arg, table in GOLD_INPUTS[model].items()
    }
    costs = silver(spark, sf_dir, "production_productcosthistory")
    fact = gold.fact_internet_sales(**inputs, cost_history=costs, silver_unique=True, wide_ids=True)
    amounts = ("ExtendedAmount", "DiscountAmount", "TotalProductCost")
    return fact.withColumns({name: F.col(name).cast("decimal(38,6)") for name in amounts})


@query(
    "silver_rejects",
    f"""SELECT SalesOrderDetailID, CarrierTrackingNumber,
               concat_ws(' / ', CASE WHEN NOT OrderQty > 0 THEN 'OrderQty > 0' END,
                         CASE WHEN NOT UnitPrice >= 0 THEN 'UnitPrice >= 0' END,
                         CASE WHEN NOT UnitPriceDiscount >= 0 THEN 'UnitPriceDiscount >= 0' END) AS broken
        FROM ({raw_for_duckdb('sales_salesorderdetail')})
        WHERE NOT (OrderQty > 0 AND UnitPrice >= 0 AND UnitPriceDiscount >= 0)""",
)
def rejected_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines the silver rules drop, with the rules they break."""
    rejects = silver_rejects(raw(spark, sf_dir, "sales_salesorderdetail"), SILVER["sales_salesorderdetail"])
    broken = F.concat_ws(" / ", "failed_rules").alias("broken")
    return rejects.select("SalesOrderDetailID", "CarrierTrackingNumber", broken)


# Ids beyond 32 bits: every id of the fact's inputs is moved up by that much.
_LARGE = 5_000_000_000
_IDS = ("SalesOrderID", "SalesOrderDetailID", "CustomerID", "ProductID", "SpecialOfferID", "TerritoryID")
_MOVED = ("ProductKey", "CustomerKey", "PromotionKey", "SalesTerritoryKey", "SalesOrderDetailID")


@query(
    "wide_ids_kept",
    f"""SELECT * REPLACE ({", ".join(f"{c} + {_LARGE} AS {c}" for c in _MOVED)},
                          CAST(CAST(SalesOrderID AS BIGINT) + {_LARGE} AS VARCHAR) AS SalesOrderID)
        FROM ({gold_sql("FactInternetSales")})""",
)
def wide_ids_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids above 2^31 come through silver and fact unchanged, by default."""

    def moved(table: str) -> DataFrame:
        df = raw(spark, sf_dir, table)
        up = {c: F.col(c).cast("long") + F.lit(_LARGE) for c in _IDS if c in df.columns}
        return silver_transform(
            df.withColumns(up), SILVER[table], load_time=F.lit(LOAD_TIME).cast("timestamp"), stable_row_ids=True
        )

    inputs = {arg: moved(table) for arg, table in GOLD_INPUTS["FactInternetSales"].items()}
    return check_gold("FactInternetSales", gold.fact_internet_sales(**inputs, silver_unique=True))


# -- gold with its own dedup -----------------------------------------------

# Inputs that a model takes as they are, and the text that a join needs unchanged.
_AS_IT_IS = {"DimCustomer": ("customer",), "DimProduct": ("category",)}
_UNCHANGED = ("SalesOrderNumber", "CountryRegionCode")
_OLDER = "__days_older"


def _history(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The rows and, for each, two older versions with other texts and amounts, from one evaluation of the rows."""
    days = F.col(_OLDER)
    changes = {"ModifiedDate": F.col("ModifiedDate") - F.make_dt_interval(days)}
    for name, kind in df.dtypes:
        if name in keys or name in _UNCHANGED:
            continue
        if kind == "string":
            changes[name] = F.when(days == 0, F.col(name)).otherwise(F.concat(F.col(name), F.lit(" v"), days.cast("string")))
        elif kind.startswith("decimal"):
            changes[name] = F.when(days == 0, F.col(name)).otherwise((F.col(name) + days).cast(kind))
    versions = F.explode(F.array(*[F.lit(n) for n in (2, 0, 1)]))
    return df.withColumn(_OLDER, versions).withColumns(changes).drop(_OLDER)


def gold_from_history(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    """One gold model from inputs with several versions per key."""
    inputs = {}
    for arg, table in GOLD_INPUTS[model].items():
        df = _gold_input(spark, sf_dir, table)
        inputs[arg] = df if arg in _AS_IT_IS.get(model, ()) else _history(df, SILVER[table].keys)
    return check_gold(model, GOLD_MODELS[model](**inputs), wide_ids=True)


# -- registration ----------------------------------------------------------


def _register_silver(table: str) -> None:
    query(f"silver_{table}", silver_sql(table))(lambda spark, sf_dir: silver(spark, sf_dir, table))


def _register_gold(model: str) -> None:
    query(f"gold_{model}", gold_sql(model))(lambda spark, sf_dir: gold_model(spark, sf_dir, model))


for _table in SILVER:
    _register_silver(_table)
for _model in gold.GOLD_SCHEMAS:
    _register_gold(_model)


def _register_history(model: str) -> None:
    query(f"gold_{model}_from_history", gold_sql(model))(lambda spark, sf_dir: gold_from_history(spark, sf_dir, model))


for _model in gold.GOLD_SCHEMAS:
    if _model not in ("DimDate", "ft_agg_product_day"):  # these two dedup nothing
        _register_history(_model)
