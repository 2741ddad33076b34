"""What a delivery holds: datasets, fields, keys, references, and the reason and rule vocabulary."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StringType, StructField, StructType, TimestampType, IntegerType

CONTRACT_VERSION = "2.0"
PIPELINE_VERSION = "1.0"


@dataclass(frozen=True)
class Dataset:
    """fields: name to kind (country, currency, id, date, money, volume, distance, days, rate, places, kind or text).
    refs: field to (dataset, whether only trusted rows count, whether a missing value is unknown too)."""

    name: str
    fields: dict[str, str]
    key: tuple[str, ...]
    refs: dict[str, tuple[str, bool, bool]] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    date: str | None = None
    amount: str | None = None

    @property
    def is_fact(self) -> bool:
        return self.amount is not None


_COUNTRY, _CURRENCY = ("countries", False, True), ("currencies", False, True)
_CUSTOMER, _CENTER = ("customers", True, False), ("cost_centers", True, False)
_ROUTE, _SHIPMENT = ("routes", True, True), ("shipments", False, True)

# Dataset names and fields in their published order, keys, cost types, country aliases, reason codes,
# rules and thresholds. They define the data contract, and results depend on them.
DATASETS: dict[str, Dataset] = {
    d.name: d
    for d in (
        Dataset("countries", {"country_code": "country", "country_name": "text", "default_currency": "currency"}, ("country_code",), {"default_currency": _CURRENCY}),
        Dataset("currencies", {"currency_code": "currency", "currency_name": "text", "decimal_places": "places"}, ("currency_code",)),
        Dataset("exchange_rates", {"rate_date": "date", "currency_code": "currency", "rate_to_eur": "rate"}, ("rate_date", "currency_code"), {"currency_code": _CURRENCY}),
        Dataset("customers", {"customer_id": "id", "customer_name": "text", "country_code": "country"}, ("customer_id",), {"country_code": _COUNTRY}),
        Dataset("cost_centers", {"cost_center_id": "id", "cost_center_name": "text", "country_code": "country"}, ("cost_center_id",), {"country_code": _COUNTRY}),
        Dataset(
            "routes",
            {"route_id": "id", "origin_country_code": "country", "destination_country_code": "country", "transport_mode": "text", "distance_km": "distance", "standard_transit_days": "days"},
            ("route_id",),
            {"origin_country_code": _COUNTRY, "destination_country_code": _COUNTRY},
        ),
        Dataset(
            "shipments",
            {"shipment_id": "id", "shipment_date": "date", "route_id": "id", "volume_m3": "volume", "country_code": "country", "customer_id": "id", "cost_center_id": "id", "currency_code": "currency", "revenue_amount": "money"},
            ("shipment_id",),
            {"country_code": _COUNTRY, "currency_code": _CURRENCY, "customer_id": _CUSTOMER, "cost_center_id": _CENTER, "route_id": _ROUTE},
            ("customer_id", "cost_center_id", "route_id"),
            "shipment_date",
            "revenue_amount",
        ),
        Dataset(
            "invoices",
            {"invoice_id": "id", "shipment_id": "id", "invoice_date": "date", "country_code": "country", "customer_id": "id", "cost_center_id": "id", "currency_code": "currency", "revenue_amount": "money", "source_updated_at": "text"},
            ("invoice_id",),
            {"country_code": _COUNTRY, "currency_code": _CURRENCY, "customer_id": _CUSTOMER, "cost_center_id": _CENTER, "shipment_id": _SHIPMENT},
            ("customer_id", "cost_center_id"),
            "invoice_date",
            "revenue_amount",
        ),
        Dataset(
            "budgets",
            {"month_start": "date", "cost_center_id": "id", "currency_code": "currency", "budget_amount": "money"},
            ("month_start", "cost_center_id"),
            {"currency_code": _CURRENCY, "cost_center_id": _CENTER},
            ("cost_center_id",),
            "month_start",
            "budget_amount",
        ),
        Dataset(
            "operational_costs",
            {"cost_id": "id", "shipment_id": "id", "route_id": "id", "cost_center_id": "id", "country_code": "country", "posting_date": "date", "cost_type": "kind", "amount": "money", "currency_code": "currency"},
            ("cost_id",),
            {"country_code": _COUNTRY, "currency_code": _CURRENCY, "cost_center_id": _CENTER, "shipment_id": _SHIPMENT, "route_id": _ROUTE},
            ("cost_center_id", "route_id", "shipment_id"),
            "posting_date",
            "amount",
        ),
    )
}
COST_TYPES = ("FUEL", "LABOR", "WAREHOUSING", "TRANSPORT")
COUNTRY_ALIASES = {
    "DE": "DE", "DEU": "DE", "GERMANY": "DE",
    "NL": "NL", "NLD": "NL", "NETHERLANDS": "NL",
    "FR": "FR", "FRA": "FR", "FRANCE": "FR",
    "GB": "GB", "GBR": "GB", "UK": "GB", "UNITED KINGDOM": "GB",
    "TR": "TR", "TUR": "TR", "TÜRKIYE": "TR", "TURKIYE": "TR", "TURKEY": "TR",
}
RULES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {  # rule: reasons, datasets
    "DUPLICATE_INVOICE": (("DUPLICATE_INVOICE", "CROSS_BATCH_DUPLICATE_INVOICE", "CONFLICTING_DUPLICATE_INVOICE"), ("invoices",)),
    "CROSS_BATCH_RECORD_OWNERSHIP": (("CROSS_BATCH_DUPLICATE_RECORD",), ("shipments", "budgets", "operational_costs")),
    "REQUIRED_IDENTIFIERS": (("MISSING_CUSTOMER_ID", "MISSING_COST_CENTER_ID", "MISSING_ROUTE_ID", "MISSING_SHIPMENT_ID"), ("shipments", "invoices", "budgets", "operational_costs")),
    "FINITE_FINANCIAL_VALUES": (("INVALID_FINANCIAL_VALUE",), ("shipments", "invoices", "budgets", "operational_costs")),
    "VALID_SHIPMENT_VOLUME": (("INVALID_SHIPMENT_VOLUME",), ("shipments",)),
    "VALID_COST_TYPE": (("INVALID_COST_TYPE",), ("operational_costs",)),
    "VALID_EXCHANGE_RATES": (("INVALID_EXCHANGE_RATE", "INVALID_EXCHANGE_RATE_REFERENCE"), ("exchange_rates", "shipments", "invoices", "budgets", "operational_costs")),
    "EXCHANGE_RATE_UNIQUENESS": (("DUPLICATE_EXCHANGE_RATE", "CONFLICTING_EXCHANGE_RATE", "CONFLICTING_EXCHANGE_RATE_REFERENCE"), ("exchange_rates", "shipments", "invoices", "budgets", "operational_costs")),
    "EXCHANGE_RATE_EXISTS": (("MISSING_EXCHANGE_RATE",), ("shipments", "invoices", "budgets", "operational_costs")),
    "INVOICE_COUNTRY_VOLUME": (("COUNTRY_VOLUME_DROP",), ("invoices",)),
    "REFERENTIAL_INTEGRITY": (
        ("INVALID_ROUTE_DEFINITION", "UNKNOWN_COUNTRY_CODE", "UNKNOWN_CURRENCY_CODE", "UNKNOWN_CUSTOMER_ID", "UNKNOWN_COST_CENTER_ID", "UNKNOWN_SHIPMENT_ID", "UNKNOWN_ROUTE_ID"),
        ("countries", "customers", "cost_centers", "routes", "exchange_rates", "shipments", "invoices", "budgets", "operational_costs"),
    ),
}
NONCRITICAL = ("CROSS_BATCH_RECORD_OWNERSHIP",)
RECONCILIATION_RULES = ("SOURCE_TARGET_ROW_RECONCILIATION", "SOURCE_TARGET_FINANCIAL_RECONCILIATION")
READBACK_MISMATCH, FINANCIAL_MISMATCH = "COMMITTED_READBACK_MISMATCH", "COMMITTED_FINANCIAL_MISMATCH"
EXPECTED_INVOICES_PER_COUNTRY, MIN_VOLUME_RATIO = 144, "0.50"
# End of fixed values.

FACTS = tuple(d.name for d in DATASETS.values() if d.is_fact)
REASON_TO_RULE = {reason: rule for rule, (reasons, _) in RULES.items() for reason in reasons}
COVERAGE = [(rule, dataset) for rule, (_, datasets) in RULES.items() for dataset in datasets]
PROVENANCE = ("_batch_id", "_source_file", "_source_row_number", "_source_fingerprint", "_ingested_at")


def source_schema(dataset: str) -> StructType:
    """Every source column is a string, in the contract's order."""
    return StructType([StructField(f, StringType()) for f in DATASETS[dataset].fields])


def bronze_schema(dataset: str) -> StructType:
    kinds = {"_source_row_number": IntegerType(), "_ingested_at": TimestampType()}
    return StructType([*source_schema(dataset).fields, *(StructField(p, kinds.get(p, StringType())) for p in PROVENANCE)])
