"""Specifications of the order pipeline: which columns are masked, which are
identifiers, which are measures, and the star layout.

Everything is data; operators take these specs as parameters so a different
document layout only needs a different spec.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class DimSpec:
    """A dimension: distinct rows over ``attributes`` with surrogate ``key``.

    ``join_key`` is the single attribute the parity fact load joins on;
    ``not_null`` lists attributes that must be non-null for a staging row to
    enter the dimension.
    """

    name: str
    key: str
    attributes: tuple[str, ...]
    join_key: str
    not_null: tuple[str, ...] = ()


@dataclass(frozen=True)
class StarSpec:
    dims: tuple[DimSpec, ...]
    fact_text: tuple[str, ...]
    measures: tuple[str, ...]
    fact_key: str = "id_fact"

    def dim(self, name: str) -> DimSpec:
        for d in self.dims:
            if d.name == name:
                return d
        raise KeyError(name)


# ---------------------------------------------------------------------------
# Fixed values. These names and lists must equal the source pipeline's for
# results to line up; they are stated here once, in the source's order.
# ---------------------------------------------------------------------------

# Name columns replaced by pseudonyms (one shared mapping), in processing order.
NAME_COLUMNS = (
    "attributes.manufacturer",
    "buyer.nodes.name",
    "buyer.nodes.parentCompany.nodes.name",
    "point_of_contact.nodes.name",
    "attributes.sellingManufacturerFacilityName",
    "attributes.trader",
)

# Identifier columns replaced by sequential tokens, in processing order.
ID_COLUMNS = (
    "rowId",
    "produits.nodes.asset.attributes.gtin",
    "produits.nodes.asset.attributes.hsCode",
)

# Identifier type of a column: first rule that holds. A name as a whole, or a part of the lower-cased name.
ID_TYPE_BY_NAME = {"rowId": "PO"}
ID_TYPE_BY_PART = (("gtin", "GTIN"), ("hs", "HS"))
ID_TYPE_DEFAULT = "OTHER"
# Token prefixes per identifier type.
ID_PREFIX = {"PO": "PO_", "GTIN": "FAKE_GTIN_", "HS": "FAKE_HS_"}
# Identifier values treated as blank after stripping.
ID_BLANK_TOKENS = ("", "nan", "NaN", "null", "None")
# Rows the first-N sample keeps where a caller asks for the source's number.
SAMPLE_ROWS = 100_000

# Text read as null by the delimited-text reader (pandas' default NA list).
CSV_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Measures coerced to numbers when staging, in the source's order.
NUMERIC_COLUMNS = (
    "produits.nodes.value",
    "feedstock.nodes.quantity",
    "attributes.millsTracabilityPo",
    "attributes.millsTracabilityPko",
    "attributes.plantationsTracabilityPo",
    "attributes.plantationsTracabilityPko",
    "attributes.volumeContact",
)

# Star layout: seven dimensions, then the fact.
ORDER_STAR = StarSpec(
    dims=(
        DimSpec("dim_buyer", "id_buyer",
                ("buyer.nodes.name", "buyer.nodes.parentCompany.nodes.name",
                 "attributes.buyerNameContact"),
                join_key="buyer.nodes.name", not_null=("buyer.nodes.name",)),
        DimSpec("dim_product", "id_product",
                ("produits.nodes.asset.descriptionShort",
                 "produits.nodes.asset.attributes.gtin",
                 "produits.nodes.asset.attributes.hsCode",
                 "produits.nodes.asset.attributes.descriptionShort",
                 "produits.nodes.asset.attributes.regulatedProductName",
                 "produits.nodes.unit",
                 "produits.nodes.asset.attributes.category",
                 "produits.nodes.asset.attributes.isComponent",
                 "produits.nodes.asset.attributes.productLine",
                 "produits.nodes.asset.attributes.countryOfOrigin"),
                join_key="produits.nodes.asset.descriptionShort"),
        DimSpec("dim_feedstock", "id_feedstock",
                ("attributes.feedstock", "feedstock.nodes.asset.descriptionShort",
                 "feedstock.nodes.rawMaterial.name", "feedstock.nodes.unit"),
                join_key="attributes.feedstock"),
        DimSpec("dim_certification", "id_certification",
                ("transactionExpectedCertificateNomenclatures.nodes.tradeItem.descriptionShort",
                 "transactionExpectedCertificateNomenclatures.nodes.type",
                 "transactionExpectedCertificateNomenclatures.nodes.level"),
                join_key="transactionExpectedCertificateNomenclatures.nodes.tradeItem.descriptionShort"),
        DimSpec("dim_trader", "id_trader",
                ("attributes.trader", "attributes.traderContact"),
                join_key="attributes.trader"),
        DimSpec("dim_point_of_contact", "id_poc",
                ("point_of_contact.nodes.name",),
                join_key="point_of_contact.nodes.name"),
        DimSpec("dim_manufacturer", "id_manufacturer",
                ("attributes.sellingManufacturerFacilityName", "attributes.manufacturer",
                 "attributes.manufacturerContact"),
                join_key="attributes.manufacturer"),
    ),
    fact_text=("rowId", "type"),
    measures=NUMERIC_COLUMNS,
)

# Traceability measures (rates) and the volume used to weight them.
TRACEABILITY_MEASURES = (
    "attributes.millsTracabilityPo",
    "attributes.millsTracabilityPko",
    "attributes.plantationsTracabilityPo",
    "attributes.plantationsTracabilityPko",
)
VOLUME_MEASURE = "produits.nodes.value"

def safe_name(column: str) -> str:
    """Column name without dots, for outputs consumed by other engines."""
    return column.replace(".", "_")


# Declared shape of one purchase-order node (the documents' GraphQL layout):
# with it and a path list, flattening needs no discovery pass over the data.
ORDER_NODE_SCHEMA = (
    "rowId string, type string, "
    "attributes struct<buyerNameContact: string, feedstock: string, trader: string, traderContact: string, "
    "sellingManufacturerFacilityName: string, manufacturer: string, manufacturerContact: string, "
    "millsTracabilityPo: string, millsTracabilityPko: string, plantationsTracabilityPo: string, "
    "plantationsTracabilityPko: string, volumeContact: string>, "
    "buyer struct<nodes: array<struct<name: string, parentCompany: struct<nodes: array<struct<name: string>>>>>>, "
    "point_of_contact struct<nodes: array<struct<name: string>>>, "
    "produits struct<nodes: array<struct<value: double, unit: string, asset: struct<descriptionShort: string, "
    "attributes: struct<gtin: string, hsCode: string, descriptionShort: string, regulatedProductName: string, "
    "category: string, isComponent: string, productLine: string, countryOfOrigin: string>>>>>, "
    "feedstock struct<nodes: array<struct<quantity: double, unit: string, asset: struct<descriptionShort: string>, "
    "rawMaterial: struct<name: string>>>>, "
    "transactionExpectedCertificateNomenclatures struct<nodes: array<struct<type: string, level: string, "
    "tradeItem: struct<descriptionShort: string>>>>"
)

# The leaf paths the star consumes, in document order of the declared shape.
ORDER_PATHS = (
    "rowId", "type",
    "attributes.buyerNameContact", "attributes.feedstock", "attributes.trader", "attributes.traderContact",
    "attributes.sellingManufacturerFacilityName", "attributes.manufacturer", "attributes.manufacturerContact",
    "attributes.millsTracabilityPo", "attributes.millsTracabilityPko", "attributes.plantationsTracabilityPo",
    "attributes.plantationsTracabilityPko", "attributes.volumeContact",
    "buyer.nodes.name", "buyer.nodes.parentCompany.nodes.name", "point_of_contact.nodes.name",
    "produits.nodes.value", "produits.nodes.unit", "produits.nodes.asset.descriptionShort",
    "produits.nodes.asset.attributes.gtin", "produits.nodes.asset.attributes.hsCode",
    "produits.nodes.asset.attributes.descriptionShort", "produits.nodes.asset.attributes.regulatedProductName",
    "produits.nodes.asset.attributes.category", "produits.nodes.asset.attributes.isComponent",
    "produits.nodes.asset.attributes.productLine", "produits.nodes.asset.attributes.countryOfOrigin",
    "feedstock.nodes.quantity", "feedstock.nodes.unit", "feedstock.nodes.asset.descriptionShort",
    "feedstock.nodes.rawMaterial.name",
    "transactionExpectedCertificateNomenclatures.nodes.type",
    "transactionExpectedCertificateNomenclatures.nodes.level",
    "transactionExpectedCertificateNomenclatures.nodes.tradeItem.descriptionShort",
)
