"""The 20 silver tables: one transform, 20 declarations.

Order of the steps: the change date gets its default, rules drop rows, the
latest row per key stays, values are derived, and everything is cast to the
declared types. Rules precede the dedup, so an invalid newest row does not hide
an older valid one. The date default precedes it too, so an undated row wins.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from cairn.functions import columns as C
from cairn.operators.dedup import keep_latest
from cairn.operators.quality import Rule, apply_rules, rejected_rows
from cairn.operators.schema import require_layout
from cairn.plans.types import (
    BIT,
    DATE_TIME,
    INT,
    MONEY,
    SHORT,
    SMALL_MONEY,
    TEXT,
    TOTAL,
    WEIGHT,
    Optional,
    columns,
    widen_ids,
)

CHANGED = "ModifiedDate"
ROW_ID = "rowguid"

Derivations = Mapping[str, Column]


def _nothing() -> Derivations:
    return {}


@dataclass(frozen=True)
class SilverSpec:
    """Declaration of one silver table."""

    name: str
    keys: tuple[str, ...]
    schema: T.StructType
    rules: tuple[Rule, ...] = ()
    derive: Callable[[], Derivations] = field(default=_nothing)
    # Columns that are always computed, whatever the input holds.
    computed: tuple[str, ...] = ()


def rules(*conditions: str) -> tuple[Rule, ...]:
    """Rules named after their condition."""
    return tuple(Rule(c, c) for c in conditions)


def not_negative(*names: str) -> tuple[Rule, ...]:
    """A rule ``>= 0`` per column."""
    return rules(*[f"{name} >= 0" for name in names])


def silver_transform(
    df: DataFrame,
    spec: SilverSpec,
    load_time: Column | None = None,
    stable_row_ids: bool = False,
    wide_ids: bool = True,
    extra_rules: tuple[Rule, ...] = (),
    distribute_by: tuple[str, ...] = (),
) -> DataFrame:
    """Clean ``df`` into the table that ``spec`` declares.

    ``load_time`` replaces the current timestamp for undated rows.
    ``stable_row_ids`` derives missing row ids from the key instead of drawing
    random ones. Ids are 64-bit numbers; ``wide_ids=False`` declares them as 32-bit
    ones, and an id that does not fit then fails. ``extra_rules`` adds checks that
    are off by default. ``distribute_by`` names a part of the key by which rows are
    distributed before the dedup, so that a later dedup on that part needs no
    second shuffle; it fits keys that are nearly unique, since all versions of a
    row are then sent.
    """
    schema = widen_ids(spec.schema) if wide_ids else spec.schema
    derived = spec.derive()
    dated = _dated(df, spec, load_time)
    valid = apply_rules(dated, (*spec.rules, *extra_rules))
    # Only columns that reach the output take part in the dedup.
    inputs = [name for name in schema.names if name in df.columns and name not in spec.computed]
    valid = valid.select(*inputs)
    if distribute_by:
        if not set(distribute_by) <= set(spec.keys):
            raise ValueError(f"{distribute_by} is no part of the key {spec.keys}")
        valid = valid.repartition(*distribute_by)
    latest = keep_latest(valid, spec.keys, CHANGED)
    if ROW_ID in schema.names:
        missing_id = (
            C.default_key_id(ROW_ID, spec.name, spec.keys) if stable_row_ids else C.default_random_id(ROW_ID)
        )
        derived = {**derived, ROW_ID: missing_id}
    return require_layout(C.cast_projection(latest.withColumns(dict(derived)), schema), schema)


def silver_keys(df: DataFrame, spec: SilverSpec, wide_ids: bool = True) -> DataFrame:
    """The keys of :func:`silver_transform`, each once.

    Which row of a key wins does not matter here, so the sort and window give
    way to a hash aggregation over the key columns.
    """
    valid = apply_rules(C.numeric_text_as_numbers(df, spec.schema), spec.rules)
    schema = widen_ids(spec.schema) if wide_ids else spec.schema
    keys = T.StructType([schema[name] for name in spec.keys])
    return C.cast_projection(valid, keys).distinct()


def silver_rejects(df: DataFrame, spec: SilverSpec, load_time: Column | None = None) -> DataFrame:
    """Input rows that the rules of ``spec`` drop, with the rules' names."""
    return rejected_rows(_dated(df, spec, load_time), spec.rules)


def _dated(df: DataFrame, spec: SilverSpec, load_time: Column | None) -> DataFrame:
    numbers = C.numeric_text_as_numbers(df, spec.schema)
    return numbers.withColumn(CHANGED, C.default_load_time(CHANGED, load_time))


# Table names, keys, column names and types of the silver layer.

_SPECS = (
    SilverSpec(
        "person_address",
        ("AddressID",),
        columns(
            AddressID=INT,
            AddressLine1=TEXT,
            AddressLine2=Optional(TEXT),
            City=TEXT,
            StateProvinceID=INT,
            PostalCode=TEXT,
            rowguid=TEXT,
            ModifiedDate=DATE_TIME,
        ),
    ),
    SilverSpec(
        "person_countryregion",
        ("CountryRegionCode",),
        columns(CountryRegionCode=TEXT, Name=TEXT, ModifiedDate=DATE_TIME),
    ),
    SilverSpec(
        "person_emailaddress",
        ("BusinessEntityID", "EmailAddressID"),
        columns(
            BusinessEntityID=INT,
            EmailAddressID=INT,
            EmailAddress=Optional(TEXT),
            rowguid=TEXT,
            ModifiedDate=DATE_TIME,
        ),
    ),
    SilverSpec(
        "person_person",
        ("BusinessEntityID",),
        columns(
            BusinessEntityID=INT,
            PersonType=TEXT,
            NameStyle=INT,
            Title=Optional(TEXT),
            FirstName=TEXT,
            MiddleName=Optional(TEXT),
            LastName=TEXT,
            Suffix=Optional(TEXT),
            EmailPromotion=INT,
            AdditionalContactInfo=Optional(TEXT),
            Demographics=Optional(TEXT),
            rowguid=TEXT,
            ModifiedDate=DATE_TIME,
        ),
        rules=rules(
            "EmailPromotion BETWEEN 0 AND 2",
            "PersonType IN ('GC', 'SP', 'EM', 'IN', 'VC', 'SC')",
        ),
    ),
    SilverSpec(
        "person_personphone",
        ("BusinessEntityID", "PhoneNumber", "PhoneNumberTypeID"),
        columns(BusinessEntityID=INT, PhoneNumber=TEXT, PhoneNumberTypeID=INT, ModifiedDate=DATE_TIME),
    ),
    SilverSpec(
        "person_stateprovince",
        ("StateProvinceID",),
        columns(
            StateProvinceID=INT,
            StateProvinceCode=TEXT,
            CountryRegionCode=TEXT,
            IsOnlyStateProvinceFlag=BIT,
            Name=TEXT,
            TerritoryID=INT,
            rowguid=TEXT,
            ModifiedDate=DATE_TIME,
        ),
    ),
    SilverSpec(
        "production_product",
        ("ProductID",),
        columns(
            ProductID=INT,
            Name=TEXT,
            ProductNumber=TEXT,
            MakeFlag=BIT,
            FinishedGoodsFlag=BIT,
            Color=Optional(TEXT),
            SafetyStockLevel=SHORT,
            ReorderPoint=SHORT,
            StandardCost=MONEY,
            ListPrice=MONEY,
            Size=Optional(TEXT),
            SizeUnitMeasureCode=Optional(TEXT),
            WeightUnitMeasureCode=Optional(TEXT),
            Weight=Optional(WEIGHT),
            DaysToManufacture=INT,
            ProductLine=Optional(TEXT),
            Class=Optional(TEXT),
            Style=Optional(TEXT),
            ProductSubcategoryID=Optional(INT),
            ProductModelID=Optional(INT),
            SellStartDate=DATE_TIME,
            SellEndDate=Optional(DATE_TIME),
            DiscontinuedDate=Optional(DATE_TIME),
            rowguid=TEXT,
            ModifiedDate=DATE_TIME,
        ),
    ),
    SilverSpec(
        "production_productcategory",
        ("ProductCategoryID",),
        columns(ProductCategoryID=INT, Name=TEXT, rowguid=TEXT, ModifiedDate=DATE_TIME),
    ),
    SilverSpec(
        "production_productcosthistory",
        ("ProductID", "StartDate"),
        columns(
            ProductID=INT,
            StartDate=DATE_TIME,
            EndDate=Optional(DATE_TIME),
            StandardCost=MONEY,
            ModifiedDate=DATE_TIME,
        ),
        rules=not_negative("StandardCost"),
        derive=lambda: {"EndDate": C.null_if_before("EndDate", "StartDate")},
    ),
    SilverSpec(
        "production_productdescription",
        ("ProductDescriptionID",),
        columns(ProductDescriptionID=INT, Description=TEXT, rowguid=TEXT, ModifiedDate=DATE_TIME),
    ),
    SilverSpec(
        "production_productmodel",
        ("ProductModelID",),
        columns(
            ProductModelID=INT,
            Name=TEXT,
            CatalogDescription=Optional(TEXT),
            Instructions=Optional(TEXT),
            rowguid=TEXT,
            ModifiedDate=DATE_TIME,
        ),
    ),
    SilverSpec(
        "production_productsubcategory",
        ("ProductSubcategoryID",),
        columns(
            ProductSubcategoryID=INT, ProductCategoryID=INT, Name=TEXT, rowguid=TEXT, ModifiedDate=DATE_TIME
        ),
    ),
    SilverSpec(
        "sales_currency",
        ("CurrencyCode",),
        columns(CurrencyCode=TEXT, Name=TEXT, ModifiedDate=DATE_TIME),
    ),
    SilverSpec(
        "sales_customer",
        ("CustomerID",),
        columns(
            CustomerID=INT,
            PersonID=Optional(INT),
            StoreID=Optional(INT),
            TerritoryID=Optional(INT),
            AccountNumber=Optional(TEXT),
            rowguid=TEXT,
            ModifiedDate=DATE_TIME,
        ),
        derive=lambda: {"AccountNumber": C.default_account_number("AccountNumber", "CustomerID")},
    ),
    SilverSpec(
        "sales_salesorderdetail",
        ("SalesOrderID", "SalesOrderDetailID"),
        columns(
            SalesOrderID=INT,
            SalesOrderDetailID=INT,
            CarrierTrackingNumber=Optional(TEXT),
            OrderQty=SHORT,
            ProductID=INT,
            SpecialOfferID=INT,
            UnitPrice=MONEY,
            UnitPriceDiscount=MONEY,
            LineTotal=Optional(TOTAL),
            rowguid=TEXT,
            ModifiedDate=DATE_TIME,
        ),
        rules=rules("OrderQty > 0") + not_negative("UnitPrice", "UnitPriceDiscount"),
        derive=lambda: {"LineTotal": C.line_total("UnitPrice", "UnitPriceDiscount", "OrderQty")},
        computed=("LineTotal",),
    ),
    SilverSpec(
        "sales_salesorderheader",
        ("SalesOrderID",),
        columns(
            SalesOrderID=INT,
            RevisionNumber=SHORT,
            OrderDate=DATE_TIME,
            DueDate=DATE_TIME,
            ShipDate=Optional(DATE_TIME),
            Status=SHORT,
            OnlineOrderFlag=INT,
            SalesOrderNumber=Optional(TEXT),
            PurchaseOrderNumber=Optional(TEXT),
            AccountNumber=Optional(TEXT),
            CustomerID=INT,
            SalesPersonID=Optional(INT),
            TerritoryID=Optional(INT),
            BillToAddressID=INT,
            ShipToAddressID=INT,
            ShipMethodID=INT,
            CreditCardID=Optional(INT),
            CreditCardApprovalCode=Optional(TEXT),
            CurrencyRateID=Optional(INT),
            SubTotal=MONEY,
            TaxAmt=MONEY,
            Freight=MONEY,
            TotalDue=Optional(TOTAL),
            Comment=Optional(TEXT),
            rowguid=TEXT,
            ModifiedDate=DATE_TIME,
        ),
        rules=not_negative("SubTotal", "TaxAmt", "Freight") + rules("Status BETWEEN 0 AND 8"),
        derive=lambda: {"TotalDue": C.guarded_total("SubTotal", "TaxAmt", "Freight")},
        computed=("TotalDue",),
    ),
    SilverSpec(
        "sales_salesorderheadersalesreason",
        ("SalesOrderID", "SalesReasonID"),
        columns(SalesOrderID=INT, SalesReasonID=INT, ModifiedDate=DATE_TIME),
    ),
    SilverSpec(
        "sales_salesreason",
        ("SalesReasonID",),
        columns(SalesReasonID=INT, Name=TEXT, ReasonType=TEXT, ModifiedDate=DATE_TIME),
    ),
    SilverSpec(
        "sales_salesterritory",
        ("TerritoryID",),
        columns(
            TerritoryID=INT,
            Name=TEXT,
            CountryRegionCode=TEXT,
            Group=TEXT,
            SalesYTD=MONEY,
            SalesLastYear=MONEY,
            CostYTD=MONEY,
            CostLastYear=MONEY,
            rowguid=TEXT,
            ModifiedDate=DATE_TIME,
        ),
        rules=not_negative("SalesYTD", "SalesLastYear", "CostYTD", "CostLastYear"),
    ),
    SilverSpec(
        "sales_specialoffer",
        ("SpecialOfferID",),
        columns(
            SpecialOfferID=INT,
            Description=TEXT,
            DiscountPct=SMALL_MONEY,
            Type=TEXT,
            Category=TEXT,
            StartDate=DATE_TIME,
            EndDate=DATE_TIME,
            MinQty=INT,
            MaxQty=Optional(INT),
            rowguid=TEXT,
            ModifiedDate=DATE_TIME,
        ),
        rules=not_negative("DiscountPct", "MinQty")
        + rules("EndDate >= StartDate", "MaxQty >= 0 OR MaxQty IS NULL"),
    ),
)

SILVER: dict[str, SilverSpec] = {spec.name: spec for spec in _SPECS}

# Checks on products that exist but are not applied; pass as ``extra_rules``.
DORMANT_PRODUCT_RULES = (
    rules("SafetyStockLevel > 0", "ReorderPoint > 0")
    + not_negative("StandardCost", "ListPrice", "DaysToManufacture")
    + rules(
        "upper(Class) IN ('H', 'M', 'L') OR Class IS NULL",
        "upper(ProductLine) IN ('R', 'M', 'T', 'S') OR ProductLine IS NULL",
        "upper(Style) IN ('U', 'M', 'W') OR Style IS NULL",
        "Weight > 0 OR Weight IS NULL",
        "SellEndDate >= SellStartDate OR SellEndDate IS NULL",
    )
)
