"""Entity contracts: what each source table must look like and which rules its rows obey."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- fixed values, given by the source data contract -------------------------------------
UNKNOWN_KEY = "__UNKNOWN__"
UNKNOWN_TEXT = "Unknown"
MISSING_NAMES = ["", "Unknown", "nan"]
FIELD_SEPARATOR = ";"
# File name and encodings to try, in order, per table.
SOURCE_FILES = {
    "Region": ("Region.csv", ["utf-8", "cp1252"]),
    "Sector": ("Sector.csv", ["cp1252", "utf-8"]),
    "Customer": ("Customer.csv", ["utf-8", "cp1252"]),
    "Seller": ("Seller.csv", ["utf-8", "cp1252"]),
    "Product": ("Products.csv", ["utf-8", "cp1252"]),
    "SalesHeader": ("SalesHeader.csv", ["utf-8", "cp1252"]),
    "SalesLine": ("SalesLine.csv", ["cp1252", "utf-8"]),
    "Invoice": ("Invoice.csv", ["cp1252", "utf-8"]),
}
# ------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A row predicate ``column op value``; ``not_null`` takes no value."""

    column: str
    op: str
    value: object = None


@dataclass(frozen=True)
class EntitySpec:
    """Contract of one source table. ``text`` maps string columns to their longest length."""

    name: str
    keys: tuple[str, ...]
    required: tuple[str, ...]
    optional: tuple[str, ...]
    text: dict[str, int] = field(default_factory=dict)
    decimals: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    codes: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [*self.required, *self.optional]


# ---- fixed values: the contracts of the eight source tables ------------------------------
REGION = EntitySpec(
    "Region", ("regionid",), ("regionid",), ("description",), text={"regionid": 50, "description": 100}
)
SECTOR = EntitySpec(
    "Sector", ("sectorid",), ("sectorid",), ("description",), text={"sectorid": 50, "description": 100}
)
CUSTOMER = EntitySpec(
    "Customer",
    ("accountid",),
    ("accountid",),
    ("accountname", "regionid", "sectorid"),
    text={"accountid": 50, "accountname": 100, "regionid": 50, "sectorid": 50},
)
SELLER = EntitySpec(
    "Seller", ("sellerid",), ("sellerid",), ("sellername",), text={"sellerid": 50, "sellername": 100}
)
PRODUCT = EntitySpec(
    "Product",
    ("itemid",),
    ("itemid",),
    ("name", "namealias", "marque"),
    text={"itemid": 50, "name": 100, "namealias": 100, "marque": 50},
)
SALES_HEADER = EntitySpec(
    "SalesHeader",
    ("saleid",),
    ("saleid", "accountid", "sellerid", "orderdate"),
    ("delivdate", "bruteamount", "netamount", "taxamount", "totalamount"),
    text={"accountid": 50, "sellerid": 50},
    decimals=("bruteamount", "netamount", "taxamount", "totalamount"),
    dates=("orderdate", "delivdate"),
)
SALES_LINE = EntitySpec(
    "SalesLine",
    ("saleid", "itemid"),
    ("saleid", "itemid", "qty"),
    ("unitprice", "httotalamount", "ttctotalamount", "promotype", "promovalue"),
    text={"itemid": 50, "promotype": 50},
    decimals=("unitprice", "httotalamount", "ttctotalamount", "promovalue"),
    integers=("qty",),
    rules=(Rule("qty", ">", 0),),
)
INVOICE = EntitySpec(
    "Invoice",
    ("invoiceid",),
    ("invoiceid", "salesid"),
    ("paymentamount", "paymentmethod"),
    text={"invoiceid": 50, "paymentmethod": 10},
    decimals=("paymentamount",),
    codes=("paymentmethod",),
)
# ------------------------------------------------------------------------------------------

ENTITIES = {
    s.name: s for s in (REGION, SECTOR, CUSTOMER, SELLER, PRODUCT, SALES_HEADER, SALES_LINE, INVOICE)
}
