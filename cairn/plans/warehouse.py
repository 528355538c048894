"""The layers as catalog tables: raw load, silver upserts, gold overwrites."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cairn.operators.merge import Unmatched
from cairn.operators.schema import require_columns, require_layout
from cairn.plans import gold
from cairn.plans.silver import SILVER, silver_transform
from cairn.plans.types import widen_ids
from cairn.sources.tables import create_layers, read_table, upsert_table, write_table


@dataclass(frozen=True)
class Warehouse:
    """Database names of the three layers."""

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"

    def create(self, spark: SparkSession, root: str) -> None:
        """Create the databases, each at its folder below ``root``."""
        names = (self.bronze, self.silver, self.gold)
        create_layers(spark, {name: f"{root.rstrip('/')}/{name}" for name in names})

    def refresh_silver(
        self,
        spark: SparkSession,
        tables: Iterable[str] = tuple(SILVER),
        **options,
    ) -> dict[str, int]:
        """Clean raw tables and merge them into silver; rows that are gone from
        the source are deleted. ``options`` go to :func:`silver_transform`.
        Returns the rows written per table."""
        written = {}
        for name in tables:
            spec = SILVER[name]
            clean = silver_transform(read_table(spark, f"{self.bronze}.{name}"), spec, **options)
            written[name] = upsert_table(clean, f"{self.silver}.{name}", spec.keys, Unmatched.DELETE)
        return written

    def refresh_gold(
        self, spark: SparkSession, models: Iterable[str] | None = None, wide_ids: bool = True, **options
    ) -> dict[str, int]:
        """Rebuild gold models from silver. Returns the rows per model.

        The daily aggregate reads the fact and the product dimension from gold,
        so they are built before it. ``options`` go to each model that reads
        silver, for example ``silver_unique=True``.
        """
        written = {}
        for model in GOLD_INPUTS if models is None else models:
            layer = self.gold if model == "ft_agg_product_day" else self.silver
            inputs = {arg: read_table(spark, f"{layer}.{table}") for arg, table in GOLD_INPUTS[model].items()}
            extra = {} if model in ("DimDate", "ft_agg_product_day") else dict(options)
            if model == "FactInternetSales":
                extra["wide_ids"] = wide_ids
            frame = GOLD_MODELS[model](**inputs, **extra)
            written[model] = write_table(check_gold(model, frame, wide_ids), f"{self.gold}.{model}")
        return written


def check_gold(model: str, frame: DataFrame, wide_ids: bool = True) -> DataFrame:
    """``frame`` itself if it has the declared schema of ``model``.

    The sales fact is checked by exact types, the others by layout.
    """
    schema = gold.GOLD_SCHEMAS[model]
    require = require_columns if model == "FactInternetSales" else require_layout
    return require(frame, widen_ids(schema) if wide_ids else schema)


GOLD_MODELS = {
    "DimCurrency": gold.dim_currency,
    "DimCustomer": gold.dim_customer,
    "DimDate": gold.dim_date,
    "DimGeography": gold.dim_geography,
    "DimProduct": gold.dim_product,
    "DimPromotion": gold.dim_promotion,
    "DimSalesReason": gold.dim_sales_reason,
    "DimSalesTerritory": gold.dim_sales_territory,
    "FactInternetSales": gold.fact_internet_sales,
    "FactInternetSalesReason": gold.fact_internet_sales_reason,
    "ft_agg_product_day": gold.ft_agg_product_day,
    "OneBigTable": gold.one_big_table,
}

# Which table feeds which argument of a model.
GOLD_INPUTS: Mapping[str, Mapping[str, str]] = {
    "DimCurrency": {"currency": "sales_currency"},
    "DimCustomer": {
        "customer": "sales_customer",
        "person": "person_person",
        "address": "person_address",
        "email": "person_emailaddress",
        "phone": "person_personphone",
    },
    "DimDate": {"header": "sales_salesorderheader"},
    "DimGeography": {
        "address": "person_address",
        "state": "person_stateprovince",
        "country": "person_countryregion",
    },
    "DimProduct": {
        "product": "production_product",
        "subcategory": "production_productsubcategory",
        "category": "production_productcategory",
        "model": "production_productmodel",
    },
    "DimPromotion": {"special_offer": "sales_specialoffer"},
    "DimSalesReason": {"reason": "sales_salesreason"},
    "DimSalesTerritory": {"territory": "sales_salesterritory"},
    "FactInternetSales": {
        "header": "sales_salesorderheader",
        "detail": "sales_salesorderdetail",
        "product": "production_product",
        "customer": "sales_customer",
        "special_offer": "sales_specialoffer",
        "territory": "sales_salesterritory",
    },
    "FactInternetSalesReason": {
        "header": "sales_salesorderheader",
        "detail": "sales_salesorderdetail",
        "reason": "sales_salesreason",
        "order_reason": "sales_salesorderheadersalesreason",
    },
    "ft_agg_product_day": {"fact": "FactInternetSales", "product": "DimProduct"},
    "OneBigTable": {
        "header": "sales_salesorderheader",
        "detail": "sales_salesorderdetail",
        "product": "production_product",
        "subcategory": "production_productsubcategory",
        "category": "production_productcategory",
        "territory": "sales_salesterritory",
        "person": "person_person",
    },
}
