import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.operators.compare import frames_equal
from cairn.operators.schema import has_layout
from cairn.plans.silver import (
    DORMANT_PRODUCT_RULES,
    SILVER,
    silver_keys,
    silver_rejects,
    silver_transform,
)
from cairn.sources.files import read_delimited_lines
from tests.conftest import rows

# Order headers as pipe-delimited text, with their columns; what is given and what comes out.
HEADER = (
    "SalesOrderID|RevisionNumber|OrderDate|DueDate|ShipDate|Status|OnlineOrderFlag|SalesOrderNumber"
    "|PurchaseOrderNumber|AccountNumber|CustomerID|SalesPersonID|TerritoryID|BillToAddressID|ShipToAddressID"
    "|ShipMethodID|CreditCardID|CreditCardApprovalCode|CurrencyRateID|SubTotal|TaxAmt|Freight|TotalDue|Comment"
    "|rowguid|ModifiedDate"
)
GIVEN_ORDERS = [
    "43659|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43659|PO522145787|10-4020-000676|29825|279|5|985|985|5|16281|105041Vi84182|NULL|20565.6206|1971.5149|616.0984|23153.2339|NULL|79b65321-39ca-4115-9cba-8fe0903e12e6|2011-06-07 00:00:00.000",
    "43660|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43660|PO18850127500|10-4020-000117|29672|279|5|921|921|5|5618|115213Vi29411|NULL|1294.2529|124.2483|38.8276|1457.3288|NULL|738dc42d-d03b-48a1-9822-f95a67ea7389|2011-06-07 00:00:00.000",
    "43661|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43661|PO18473189620|10-4020-000442|29734|282|6|517|517|5|1346|85274Vi6854|4|32726.4786|3153.7696|985.553|36865.8012|NULL|d91b9131-18a4-4a11-bc3a-90b6f53e9d74|2011-06-07 00:00:00.000",
    "43662|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43662|PO18444174044|10-4020-000227|29994|282|6|482|482|5|10456|125295Vi53935|4|28832.5289|2775.1646|867.2389|32474.9324|NULL|4a1ecfc0-cc3a-4740-b028-1c50bb48711c|2011-06-07 00:00:00.000",
    "43663|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43663|PO18009186470|10-4020-000510|29565|276|4|1073|1073|5|4322|45303Vi22691|NULL|419.4589|40.2681|12.5838|472.3108|NULL|9b1e7a40-6ae0-4ad3-811c-a64951857c4b|2011-06-07 00:00:00.000",
    "43664|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43664|PO16617121983|10-4020-000397|29898|280|1|876|876|5|806|95555Vi4081|NULL|24432.6088|2344.9921|732.81|27510.4109|NULL|22a8a5da-8c22-42ad-9241-839489b6ef0d|2011-06-07 00:00:00.000",
    "43665|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43665|PO16588191572|10-4020-000146|29580|283|1|849|849|5|15232|35568Vi78804|NULL|14352.7713|1375.9427|429.9821|16158.6961|NULL|5602c304-853c-43d7-9e79-76e320d476cf|2011-06-07 00:00:00.000",
    "43666|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43666|PO16008173883|10-4020-000511|30052|276|4|1074|1074|5|13349|105623Vi69217|NULL|5056.4896|486.3747|151.9921|5694.8564|NULL|e2a90057-1366-4487-8a7e-8085845ff770|2011-06-07 00:00:00.000",
    "43667|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43667|PO15428132599|10-4020-000646|29974|277|3|629|629|5|10370|55680Vi53503|NULL|6107.082|586.1203|183.1626|6876.3649|NULL|86d5237d-432d-4b21-8abc-671942f5789d|2011-06-07 00:00:00.000",
    "43668|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43668|PO14732180295|10-4020-000514|29614|282|6|529|529|5|1566|85817Vi8045|4|35944.1562|3461.7654|1081.8017|40487.7233|NULL|281cc355-d538-494e-9b44-461b36a826c6|2011-06-07 00:00:00.000",
    "43668|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43668|PO14732180295|10-4020-000514|29614|282|6|529|529|5|1566|85817Vi8045|4|35944.1562|3461.7654|1081.8017|40487.7233|NULL|281cc355-d538-494e-9b44-461b36a826c6|2011-06-07 00:00:00.000",
    "43668|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43668|PO14732180295|10-4020-000514|29614|282|6|529|529|5|1566|85817Vi8045|4|35944.1562|3461.7654|1081.8017|40487.7233|NULL|281cc355-d538-494e-9b44-461b36a826c6|2011-06-07 00:00:00.000",
    "43668|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43668|PO14732180295|10-4020-000514|29614|282|6|529|529|5|1566|85817Vi8045|4|35944.1562|3461.7654|1081.8017|40487.7233|NULL|281cc355-d538-494e-9b44-461b36a826c6|2011-06-07 00:00:00.000",
]
EXPECTED_ORDERS = [
    "43659|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43659|PO522145787|10-4020-000676|29825|279|5|985|985|5|16281|105041Vi84182|NULL|20565.6206|1971.5149|616.0984|23153.2339|NULL|79b65321-39ca-4115-9cba-8fe0903e12e6|2011-06-07 00:00:00.000",
    "43660|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43660|PO18850127500|10-4020-000117|29672|279|5|921|921|5|5618|115213Vi29411|NULL|1294.2529|124.2483|38.8276|1457.3288|NULL|738dc42d-d03b-48a1-9822-f95a67ea7389|2011-06-07 00:00:00.000",
    "43661|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43661|PO18473189620|10-4020-000442|29734|282|6|517|517|5|1346|85274Vi6854|4|32726.4786|3153.7696|985.553|36865.8012|NULL|d91b9131-18a4-4a11-bc3a-90b6f53e9d74|2011-06-07 00:00:00.000",
    "43662|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43662|PO18444174044|10-4020-000227|29994|282|6|482|482|5|10456|125295Vi53935|4|28832.5289|2775.1646|867.2389|32474.9324|NULL|4a1ecfc0-cc3a-4740-b028-1c50bb48711c|2011-06-07 00:00:00.000",
    "43663|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43663|PO18009186470|10-4020-000510|29565|276|4|1073|1073|5|4322|45303Vi22691|NULL|419.4589|40.2681|12.5838|472.3108|NULL|9b1e7a40-6ae0-4ad3-811c-a64951857c4b|2011-06-07 00:00:00.000",
    "43664|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43664|PO16617121983|10-4020-000397|29898|280|1|876|876|5|806|95555Vi4081|NULL|24432.6088|2344.9921|732.81|27510.4109|NULL|22a8a5da-8c22-42ad-9241-839489b6ef0d|2011-06-07 00:00:00.000",
    "43665|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43665|PO16588191572|10-4020-000146|29580|283|1|849|849|5|15232|35568Vi78804|NULL|14352.7713|1375.9427|429.9821|16158.6961|NULL|5602c304-853c-43d7-9e79-76e320d476cf|2011-06-07 00:00:00.000",
    "43666|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43666|PO16008173883|10-4020-000511|30052|276|4|1074|1074|5|13349|105623Vi69217|NULL|5056.4896|486.3747|151.9921|5694.8564|NULL|e2a90057-1366-4487-8a7e-8085845ff770|2011-06-07 00:00:00.000",
    "43667|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43667|PO15428132599|10-4020-000646|29974|277|3|629|629|5|10370|55680Vi53503|NULL|6107.082|586.1203|183.1626|6876.3649|NULL|86d5237d-432d-4b21-8abc-671942f5789d|2011-06-07 00:00:00.000",
    "43668|8|2011-05-31 00:00:00.000|2011-06-12 00:00:00.000|2011-06-07 00:00:00.000|5|0|SO43668|PO14732180295|10-4020-000514|29614|282|6|529|529|5|1566|85817Vi8045|4|35944.1562|3461.7654|1081.8017|40487.7233|NULL|281cc355-d538-494e-9b44-461b36a826c6|2011-06-07 ",
]

T1, T2 = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)
LOAD = dt.datetime(2030, 1, 1)


def frame(spark, table, *records):
    """Rows of a silver table's input; columns that are not given are NULL."""
    spec = SILVER[table]
    fields = [T.StructField(f.name, f.dataType) for f in spec.schema if f.name not in spec.computed]
    schema = T.StructType(fields)
    return spark.createDataFrame([tuple(r.get(f.name) for f in fields) for r in records], schema)


def run(spark, table, *records, **options):
    options.setdefault("load_time", F.lit(LOAD))
    out = silver_transform(frame(spark, table, *records), SILVER[table], **options)
    return [r.asDict() for r in out.orderBy(*SILVER[table].keys).collect()]


def test_thirteen_text_rows_become_ten_typed_orders(spark):
    given = read_delimited_lines(spark, [HEADER, *GIVEN_ORDERS], sep="|")
    assert given.count() == 13 and given.schema["CurrencyRateID"].dataType == T.StringType()
    spec = SILVER["sales_salesorderheader"]
    expected = read_delimited_lines(spark, [HEADER, *EXPECTED_ORDERS], sep="|", schema=spec.schema)
    assert expected.count() == 10
    assert frames_equal(silver_transform(given, spec, wide_ids=False), expected)


@pytest.mark.parametrize("table", SILVER)
def test_every_table_has_its_declared_layout(spark, table):
    given = frame(spark, table)
    assert has_layout(silver_transform(given, SILVER[table], wide_ids=False), SILVER[table].schema)
    assert set(SILVER[table].keys) <= set(SILVER[table].schema.names)
    extra = given.withColumn("bronze_ingestion_timestamp", F.current_timestamp())
    assert silver_transform(extra, SILVER[table]).columns == SILVER[table].schema.names


def header(key, **values):
    base = {"Status": 5, "SubTotal": Decimal(1), "TaxAmt": Decimal(2), "Freight": Decimal(3), "ModifiedDate": T1}
    return {"SalesOrderID": key, **base, **values}


def test_an_invalid_newest_row_does_not_hide_an_older_valid_one(spark):
    out = run(
        spark, "sales_salesorderheader", header(1, Comment="old"), header(1, ModifiedDate=T2, TaxAmt=Decimal(-1))
    )
    assert [(r["SalesOrderID"], r["Comment"], r["TotalDue"]) for r in out] == [(1, "old", Decimal("6.000000"))]


def test_an_undated_row_wins(spark):
    out = run(spark, "sales_salesorderheader", header(1, ModifiedDate=T2), header(1, Comment="u", ModifiedDate=None))
    assert [(r["Comment"], r["ModifiedDate"]) for r in out] == [("u", LOAD)]


def test_headers_with_a_null_amount_or_odd_status_are_dropped(spark):
    kept = run(
        spark,
        "sales_salesorderheader",
        header(1, SubTotal=None),
        header(2, Status=9),
        header(3, Status=None),
        header(4, Status=0),
        header(5, Status=8, Freight=Decimal(0)),
    )
    assert [r["SalesOrderID"] for r in kept] == [4, 5]


def detail(key, **values):
    base = {"OrderQty": 2, "UnitPrice": Decimal(10), "UnitPriceDiscount": Decimal("0.25"), "ModifiedDate": T1}
    return {"SalesOrderID": 1, "SalesOrderDetailID": key, **base, **values}


def test_detail_rules_and_total(spark):
    out = run(
        spark,
        "sales_salesorderdetail",
        detail(1),
        detail(2, OrderQty=0),
        detail(3, UnitPrice=Decimal(0)),
        detail(4, UnitPrice=Decimal(-1)),
        detail(5, UnitPriceDiscount=None),
        detail(6, UnitPriceDiscount=Decimal(-1)),
    )
    assert [(r["SalesOrderDetailID"], r["LineTotal"]) for r in out] == [
        (1, Decimal("15.000000")),
        (3, Decimal("0.000000")),
    ]


def test_cost_history_loses_a_bad_end_date_only(spark):
    base = {"ProductID": 1, "StandardCost": Decimal(5), "ModifiedDate": T1}
    out = run(
        spark,
        "production_productcosthistory",
        {**base, "StartDate": T2, "EndDate": T1},
        {**base, "StartDate": T1, "EndDate": T2},
        {**base, "ProductID": 2, "StartDate": T1, "StandardCost": Decimal(-1)},
    )
    assert [(r["ProductID"], r["StartDate"], r["EndDate"]) for r in out] == [(1, T1, T2), (1, T2, None)]


def offer(key, **values):
    base = {"DiscountPct": Decimal(0), "StartDate": T1, "EndDate": T1, "MinQty": 0, "ModifiedDate": T1}
    return {"SpecialOfferID": key, **base, **values}


def test_offer_rules(spark):
    out = run(
        spark,
        "sales_specialoffer",
        offer(1),
        offer(2, StartDate=T2),
        offer(3, MaxQty=-1),
        offer(4, MaxQty=0),
        offer(5, MinQty=-1),
        offer(6, DiscountPct=Decimal(-1)),
        offer(7, EndDate=None),
    )
    assert [r["SpecialOfferID"] for r in out] == [1, 4]


def test_person_and_territory_rules(spark):
    people = [
        {"BusinessEntityID": i, "PersonType": kind, "EmailPromotion": promotion}
        for i, (kind, promotion) in enumerate(
            [("GC", 0), ("VC", 2), ("XX", 1), ("SC", 3), ("IN", -1), (None, 1), ("EM", None), ("gc", 1)]
        )
    ]
    assert [r["BusinessEntityID"] for r in run(spark, "person_person", *people)] == [0, 1]
    money = dict.fromkeys(["SalesYTD", "SalesLastYear", "CostYTD", "CostLastYear"], Decimal(0))
    territories = [{"TerritoryID": 9, **money}] + [
        {"TerritoryID": i, **money, name: value}
        for i, (name, value) in enumerate([(n, v) for n in money for v in (Decimal(-1), None)])
    ]
    assert [r["TerritoryID"] for r in run(spark, "sales_salesterritory", *territories)] == [9]


def test_customer_defaults(spark):
    given = [
        {"CustomerID": 3, "ModifiedDate": T1},
        {"CustomerID": 4, "AccountNumber": "X", "rowguid": "kept", "ModifiedDate": T1},
    ]
    first, second = run(spark, "sales_customer", *given, stable_row_ids=True)
    assert first["AccountNumber"] == "AW000000003" and len(first["rowguid"]) == 36
    assert (second["AccountNumber"], second["rowguid"]) == ("X", "kept")
    again = run(spark, "sales_customer", *given, stable_row_ids=True)[0]
    random_one, random_two = (run(spark, "sales_customer", *given)[0] for _ in range(2))
    assert again == first and random_one["rowguid"] != random_two["rowguid"]


def test_composite_keys(spark):
    phones = [
        {"BusinessEntityID": 1, "PhoneNumber": p, "PhoneNumberTypeID": k, "ModifiedDate": d}
        for p, k, d in [("5", 1, T1), ("5", 1, T2), ("5", 2, T1), ("6", 1, T1)]
    ]
    out = run(spark, "person_personphone", *phones)
    assert [(r["PhoneNumber"], r["PhoneNumberTypeID"], r["ModifiedDate"]) for r in out] == [
        ("5", 1, T2),
        ("5", 2, T1),
        ("6", 1, T1),
    ]


def test_dormant_product_rules_apply_on_demand(spark):
    good = {
        "SafetyStockLevel": 1,
        "ReorderPoint": 1,
        "StandardCost": Decimal(0),
        "ListPrice": Decimal(0),
        "DaysToManufacture": 0,
        "SellStartDate": T1,
        "ModifiedDate": T1,
    }
    faults = [{}, {"Class": "h"}, {"Class": "Z"}, {"Weight": Decimal(0)}, {"SellEndDate": dt.datetime(2019, 1, 1)}]
    products = [{"ProductID": i, **good, **fault} for i, fault in enumerate(faults)]
    assert len(run(spark, "production_product", *products)) == 5
    checked = run(spark, "production_product", *products, extra_rules=DORMANT_PRODUCT_RULES)
    assert [r["ProductID"] for r in checked] == [0, 1]


def test_keys_equal_those_of_the_full_transform(spark):
    given = frame(
        spark,
        "sales_salesorderdetail",
        detail(1),
        detail(1, ModifiedDate=T2),
        detail(2, OrderQty=0),
        detail(2),
        detail(3, OrderQty=-1),
    )
    spec = SILVER["sales_salesorderdetail"]
    assert rows(silver_keys(given, spec)) == rows(silver_transform(given, spec).select(*spec.keys)) == [(1, 1), (1, 2)]


def test_rejects_name_the_broken_rules(spark):
    given = frame(spark, "sales_salesorderdetail", detail(1), detail(2, OrderQty=0, UnitPrice=Decimal(-1)))
    rejects = silver_rejects(given, SILVER["sales_salesorderdetail"])
    assert rows(rejects.select("SalesOrderDetailID", "failed_rules")) == [(2, ["OrderQty > 0", "UnitPrice >= 0"])]


def test_large_ids_are_kept_or_fail_but_never_vanish(spark):
    given = spark.createDataFrame([(3_000_000_001, T1), (3_000_000_002, T1)], "CustomerID long, ModifiedDate timestamp")
    spec = SILVER["sales_customer"]
    given = given.select(*[F.col(n) if n in given.columns else F.lit(None).cast("string").alias(n) for n in spec.schema.names])
    kept = silver_transform(given, spec)
    assert sorted(r.CustomerID for r in kept.collect()) == [3_000_000_001, 3_000_000_002]
    with pytest.raises(Exception, match="OVERFLOW"):
        silver_transform(given, spec, wide_ids=False).collect()
