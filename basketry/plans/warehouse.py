"""The warehouse job: raw tables -> clean tables -> dimensions -> facts -> customer scores."""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections import defaultdict
from collections.abc import Collection, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.columns import date_from_key
from basketry.operators import cleaning as C
from basketry.operators import dimensions as D
from basketry.operators import facts as X
from basketry.operators import rfm as R
from basketry.session import materialise, scratch_root
from basketry.sources import fixtures
from basketry.sources.delimited import ORDINAL, stage
from basketry.sources.tables import Snapshot, TableStore
from basketry.specs import ENTITIES

STAR_TABLES = [
    "DimDate", "DimCustomer", "DimSeller", "DimProduct", "DimPromotion", "DimPaymentMethod",
    "FactSales", "FactInvoices",
]
# Dimension -> natural key, surrogate key.
KEYED = {
    "DimCustomer": ("AccountID", "CustomerKey"),
    "DimSeller": ("SellerID", "SellerKey"),
    "DimProduct": ("ItemID", "ProductKey"),
    "DimPromotion": ("PromoType", "PromotionKey"),
    "DimPaymentMethod": ("PaymentMethodCode", "PaymentMethodKey"),
}
PARTITIONED = {"FactSales": [X.MONTH], "FactInvoices": [X.MONTH]}


# Clean tables that are read from the marked rows of their entity; the others are small and stored.
_VIEWS = {f"clean_{e}": e for e in ("SalesHeader", "SalesLine", "Invoice")}


class _Landed(Mapping):
    """The raw entities of a warehouse, as stored text tables."""

    def __init__(self, warehouse: Warehouse):
        self._warehouse = warehouse

    def __getitem__(self, entity: str) -> DataFrame:
        return self._warehouse.table(f"raw_{entity}")

    def __iter__(self) -> Iterator[str]:
        return iter(self._warehouse.sources)

    def __len__(self) -> int:
        return len(self._warehouse.sources)


# Dimensions that facts may name members of before these arrive: raw entity and column, and the raw entity of members.
LATE = {
    "DimCustomer": ("SalesHeader", "accountid"),
    "DimSeller": ("SalesHeader", "sellerid"),
    "DimProduct": ("SalesLine", "itemid"),
}
HISTORY = {"DimCustomer": "HistCustomer", "DimSeller": "HistSeller", "DimProduct": "HistProduct"}


class Warehouse:
    """Stages of the load as stored tables, each built on first use from the ones before it.

    Sources land as tables before they are cleaned: cleaning looks at key columns several times,
    which is cheap in a columnar table and not in text, and the file order is fixed once. Entities named by
    ``in_place`` are columns of columnar tables that carry their order already; they are read where they are.
    A stage that is complete is read; after a failure the job continues at the first missing
    table. ``reload`` writes new versions, and surrogate keys survive it through the key maps.

    ``publish`` shows all tables of the star at once; ``append`` adds a batch of raw rows and publishes it. With
    ``late_members``, sales that name an unknown customer, seller or product make a member of it, and keep it;
    without, they go to the unknown member.
    """

    def __init__(self, store: TableStore, raw: Mapping[str, DataFrame], late_members: bool = False, in_place: Collection[str] = ()):
        self.store, self.sources, self.late_members, self.in_place = store, raw, late_members, in_place
        self.raw = _Landed(self)
        self.spark = store.spark
        self._open: dict[str, DataFrame] = {}
        self._reloading: set[str] = set()
        self._locks: defaultdict[str, threading.RLock] = defaultdict(threading.RLock)

    def table(self, name: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._open:
                if name.startswith("raw_") and name.removeprefix("raw_") in self.in_place:
                    self._open[name] = self._build(name)
                elif name in _VIEWS:
                    # The rows that stay are those of the marked ones, which are stored.
                    entity = _VIEWS[name]
                    self._open[name] = C.outline(entity).of_marked(self.table(f"marked_{entity}"))
                elif name in self._reloading or not self.store.exists(name):
                    self._open[name] = self._write(name)
                    self._reloading.discard(name)
                else:
                    self._open[name] = self.store.read(name)
            return self._open[name]

    def _write(self, name: str) -> DataFrame:
        # These come from scans and joins over the whole table, whose tasks are as even as a shuffle of the wide rows
        # would make them. A month of a fact has as many files as the join has tasks, at most.
        wide = name.startswith(("raw_", "marked_")) or name in (*PARTITIONED, "sale_keys")
        return self.store.write(name, self._build(name), PARTITIONED.get(name, ()), rebalance=not wide)

    def quality_counters(self) -> DataFrame:
        """The counters of all cleanings, as stored with the load. They are counted from the stored flags of the
        rows, so no row is cleaned for them, and a lost executor does not count twice."""
        return reduce(DataFrame.unionByName, self.tables(*map(_counts_name, ENTITIES)))

    def tables(self, *names: str) -> list[DataFrame]:
        """Several tables; those still to be built are built side by side, since jobs on small
        dimensions would leave most of a cluster idle."""
        with ThreadPoolExecutor(max_workers=len(names)) as pool:
            return list(pool.map(self.table, names))

    def clean(self, entity: str) -> DataFrame:
        return self.table(f"clean_{entity}")

    def build_star(self) -> dict[str, DataFrame]:
        """The whole star schema in load order, and the counters of its cleanings."""
        built = self.tables(*STAR_TABLES, *map(_counts_name, ENTITIES))
        return dict(zip(STAR_TABLES, built, strict=False))

    def publish(self) -> Snapshot:
        """Build what is missing of the star and show all of it at once."""
        base = self.store.snapshot()
        self.build_star()
        return self.store.publish([*STAR_TABLES, "sale_keys", *map(_map_name, KEYED)], base=base)

    def reload(self, raw: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
        """Rebuild everything as new versions. Readers of a snapshot keep the old tables until ``publish`` shows the
        new ones."""
        self.sources = raw or self.sources
        self._open.clear()
        self._reloading = {f"{s}_{e}" for e in ENTITIES for s in ("raw", "marked", "clean", "counts")} | set(STAR_TABLES) | {"sale_keys", "rfm", *map(_map_name, KEYED)}
        return self.build_star()

    def _build(self, name: str) -> DataFrame:
        if name.startswith("raw_"):
            return self.sources[name.removeprefix("raw_")]
        if name.startswith("marked_"):
            marked = self._cleaned(name.removeprefix("marked_")).marked
            # The place of a line in its file tells which of its copies stays, and nothing after that.
            return marked.drop(ORDINAL) if name == "marked_SalesLine" else marked
        if name.startswith("clean_"):
            entity = name.removeprefix("clean_")
            return C.outline(entity).of_marked(self.table(f"marked_{entity}"))
        if name.startswith("counts_"):
            entity = name.removeprefix("counts_")
            return C.outline(entity).counts_of_marked(self.table(f"marked_{entity}"))
        if name.startswith("keys_"):
            return self._build_keys(name.removeprefix("keys_"))
        if name in KEYED:
            natural, key = KEYED[name]
            return D.keyed(self._members(name), self.table(_map_name(name)), natural, key)
        if name == "DimDate":
            return D.dim_date(self.clean("SalesHeader"))
        if name == "FactSales":
            return X.fact_sales(*self.tables("sale_keys", "clean_SalesLine", "DimProduct", "DimPromotion"))
        if name == "FactInvoices":
            return X.fact_invoices(*self.tables("clean_Invoice", "sale_keys", "DimPaymentMethod"))
        if name == "sale_keys":
            return X.sale_keys(*self.tables("clean_SalesHeader", "DimCustomer", "DimSeller"))
        if name == "rfm":
            return R.rfm_segments(R.rfm_base(self.table("FactSales"))).withColumn("Monetary", R.money("Monetary"))
        raise KeyError(name)

    def _cleaned(self, entity: str) -> C.Cleaned:
        raw = f"raw_{entity}"
        if entity == "SalesHeader":
            customers, sellers = (self._parents(d) for d in ("DimCustomer", "DimSeller"))
            return C.clean_sales_header(self.table(raw), customers, sellers)
        if entity == "SalesLine":
            return C.clean_sales_line(*self.tables(raw, "clean_SalesHeader"), self._parents("DimProduct"))
        if entity == "Invoice":
            return C.clean_invoice(*self.tables(raw, "clean_SalesHeader"))
        return C.clean_dimension(self.table(raw), ENTITIES[entity])

    def _parents(self, dim: str) -> DataFrame:
        """The keys that facts may point at, under the name they have in the raw tables."""
        natural, column = KEYED[dim][0], LATE[dim][1]
        if self.late_members:
            return self._members(dim).select(F.col(natural).alias(column))
        return self.clean(dim.removeprefix("Dim"))

    def _members(self, dim: str) -> DataFrame:
        members = self._known_members(dim)
        if self.late_members and dim in LATE:
            entity, column = LATE[dim]
            return D.with_late(members, self.raw[entity], column, KEYED[dim][0])
        return members

    def _known_members(self, dim: str) -> DataFrame:
        if dim == "DimCustomer":
            return D.customer_members(*self.tables("clean_Customer", "clean_Region", "clean_Sector"))
        if dim == "DimSeller":
            return D.seller_members(self.clean("Seller"))
        if dim == "DimProduct":
            return D.product_members(self.clean("Product"))
        if dim == "DimPromotion":
            return D.promotion_members(self.clean("SalesLine"))
        return D.payment_members(self.clean("Invoice"))

    def _build_keys(self, dim: str) -> DataFrame:
        natural, key = KEYED[dim]
        members = self._members(dim)
        order = _key_order(members, natural)
        name = _map_name(dim)
        if self.store.exists(name):
            return D.extend_keys(self.store.read(name), members, natural, key, order)
        return D.assign_keys(members, natural, key, order)


    # ---- batches --------------------------------------------------------------------------

    def append(self, raw: Mapping[str, DataFrame], batch: str) -> Snapshot:
        """Add a batch of raw rows to the published star, and publish.

        New members get keys after the highest, new sales and their lines and invoices become facts, lines of
        earlier sales are found too. Rows whose key is there already are not added, so a repeated batch, or one
        that overlaps an earlier one, adds what is new only. Files of earlier loads are not touched, and only the
        months of the batch are looked at. Stand-ins whose real row has come are completed under their key. Nothing
        is visible before all of it is; a batch that failed half way can be repeated. Entities that the batch does
        not have are empty. ``raw_`` and ``clean_`` tables stay those of the last full load."""
        base = self.publish()
        if batch in base.batches:
            return base
        rows = {e: materialise(raw[e], f"batch-{e}") if e in raw else self.raw[e].limit(0) for e in ENTITIES}
        clean = {e: C.clean_dimension(rows[e], ENTITIES[e], add_unknown=False).rows for e in ("Region", "Sector", "Customer", "Seller", "Product")}
        added: dict[str, str | None] = {}
        rewritten: list[str] = []

        def now(name: str) -> DataFrame:
            """A table as it will be published."""
            if name in rewritten:
                return self.store.read(name)
            version, loads = base.tables[name]
            return self.store.read_folders(name, version, (*loads, added[name]) if added.get(name) else loads)

        def add(name: str, new: DataFrame) -> None:
            added[name] = self.store.append(name, new, batch, base, PARTITIONED.get(name, ()))

        def add_members(dim: str, members: DataFrame) -> None:
            natural, key = KEYED[dim]
            if dim in LATE:
                entity, column = LATE[dim]
                members = D.with_late(members, rows[entity] if self.late_members else rows[entity].limit(0), column, natural)
            members = materialise(members, "members")
            stored = base.read(dim)
            add(_map_name(dim), D.new_keys(base.read(_map_name(dim)), members, natural, key, _key_order(members, natural)))
            keys = now(_map_name(dim))
            fresh = D.keyed(members.join(stored.select(natural), natural, "left_anti"), keys, natural, key)
            known = D.keyed(members.filter(~F.col(D.LATE)) if dim in LATE else members, keys, natural, key)
            known = known.filter(~D.is_stand_in(known, natural, key)) if dim in LATE else known
            waiting = stored.filter(D.is_stand_in(stored, natural, key)).select(key) if dim in LATE else stored.limit(0).select(key)
            complete = materialise(known.join(waiting, key), "complete")
            if complete.isEmpty():
                add(dim, fresh.select(stored.columns))
            else:
                others = stored.join(complete.select(key), key, "left_anti")
                self.store.write(dim, others.unionByName(complete.select(stored.columns)).unionByName(fresh.select(stored.columns)))
                rewritten.append(dim)

        both = lambda e: _stacked(self.clean(e), clean[e])
        add_members("DimCustomer", D.customer_members(clean["Customer"], both("Region"), both("Sector")))
        add_members("DimSeller", D.seller_members(clean["Seller"]))
        add_members("DimProduct", D.product_members(clean["Product"]))
        parent = lambda dim: now(dim).select(F.col(KEYED[dim][0]).alias(LATE[dim][1]))

        headers = C.clean_sales_header(rows["SalesHeader"], parent("DimCustomer"), parent("DimSeller")).rows
        headers = headers.join(base.read("sale_keys").select("saleid"), "saleid", "left_anti")
        add("sale_keys", X.sale_keys(materialise(headers, "headers"), now("DimCustomer"), now("DimSeller")))
        lines = materialise(C.clean_sales_line(rows["SalesLine"], now("sale_keys"), parent("DimProduct")).rows, "lines")
        bills = materialise(C.clean_invoice(rows["Invoice"], now("sale_keys")).rows, "invoices")
        for dim, members in (("DimPromotion", D.promotion_members(lines)), ("DimPaymentMethod", D.payment_members(bills))):
            add_members(dim, members)
        sales = now("sale_keys")
        add("FactSales", self._unseen(X.fact_sales(sales, lines, now("DimProduct"), now("DimPromotion")), base.read("FactSales"), "SalesKey"))
        add("FactInvoices", self._unseen(X.fact_invoices(bills, sales, now("DimPaymentMethod")), base.read("FactInvoices"), "InvoiceKey"))
        days = sales.select(date_from_key("OrderDateKey").alias("orderdate"), date_from_key("DeliveryDateKey").alias("delivdate"))
        calendar = materialise(D.dim_date(days), "calendar")
        if not calendar.join(base.read("DimDate"), "DateKey", "left_anti").isEmpty():
            self.store.write("DimDate", calendar)
            rewritten.append("DimDate")
        done = self.store.publish(rewritten, {t: f for t, f in added.items() if f}, batch, base)
        self._open.clear()
        if self.store.exists("rfm"):
            self._reloading.add("rfm")
        return done

    @staticmethod
    def _unseen(facts: DataFrame, stored: DataFrame, key: str) -> DataFrame:
        """Facts whose key is not stored yet; only the months of the batch are read."""
        facts = materialise(facts, "facts")
        months = [r[0] for r in facts.select(X.MONTH).distinct().collect()]  # as many as there are months
        return facts.join(stored.filter(F.col(X.MONTH).isin(months)).select(key), key, "left_anti")

    # ---- history --------------------------------------------------------------------------

    def load_history(self, day: str) -> None:
        """Bring the histories of customers, sellers and products up to the dimensions as of ``day``, and store for
        each sale line the versions that are valid on its order date."""
        for dim, name in HISTORY.items():
            natural, key = KEYED[dim]
            members = self.table(dim)
            if self.store.exists(name):
                stored = self.store.read(name).drop("VersionKey")
                rows = D.merge_versions(stored, members, natural, F.lit(day))
            else:
                # Facts are older than the first load of the history: its versions hold from the beginning.
                rows = D.open_versions(members, F.lit("0001-01-01"))
            self.store.write(name, rows.withColumn("VersionKey", D.version_key(natural)))
        facts = self.table("FactSales").select("SalesKey", "OrderDateKey", *[KEYED[d][1] for d in HISTORY], X.MONTH)
        for dim, name in HISTORY.items():
            key, version = KEYED[dim][1], f"{dim.removeprefix('Dim')}Version"
            versions = self.store.read(name).withColumnRenamed("VersionKey", version)
            facts = D.valid_versions(facts, key, date_from_key("OrderDateKey"), versions, key, version)
        kept = [f"{d.removeprefix('Dim')}Version" for d in HISTORY]
        self.store.write("FactSalesVersions", facts.select("SalesKey", *kept, X.MONTH), [X.MONTH])


def _key_order(members: DataFrame, natural: str) -> list[str]:
    """Late members are numbered after the others, these in the order of their file."""
    return [c for c in (D.LATE, ORDINAL) if c in members.columns] + [natural]


def _stacked(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of an entity and of a batch; where both have a key the stored row is first."""
    parts = [df.drop(ORDINAL).withColumn(ORDINAL, F.lit(i)) for i, df in enumerate((stored, new))]
    return parts[0].unionByName(parts[1])


def _map_name(dim: str) -> str:
    return f"keys_{dim}"


def _counts_name(entity: str) -> str:
    return f"counts_{entity}"


class _Files(Mapping):
    """The eight entities from delimited files, each read when it is asked for: a load that resumes does not
    read what has landed."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getitem__(self, entity: str) -> DataFrame:
        return stage(self.spark, self.folder, entity)

    def __iter__(self) -> Iterator[str]:
        return iter(ENTITIES)

    def __len__(self) -> int:
        return len(ENTITIES)


def raw_from_files(spark: SparkSession, folder: str) -> Mapping[str, DataFrame]:
    """The eight entities from delimited files."""
    return _Files(spark, folder)


def open_files(spark: SparkSession, folder: str, target: str) -> Warehouse:
    """Warehouse at ``target`` over the delimited files in ``folder``."""
    return Warehouse(TableStore(spark, target), raw_from_files(spark, folder))


_opened: dict[tuple[str, str], Warehouse] = {}


def open_fixture(spark: SparkSession, folder: str) -> Warehouse:
    """Warehouse over the driver's tables in ``folder``, in this application's shared scratch.

    The reports read the stored star, as they would in production; it is built once per
    application and input folder.
    """
    where = (spark.sparkContext.applicationId, folder.rstrip("/"))
    if where not in _opened:
        digest = hashlib.sha256(where[1].encode()).hexdigest()[:12]
        store = TableStore(spark, f"{scratch_root(spark)}/warehouse-{digest}")
        _opened[where] = Warehouse(store, fixtures.raw_tables(spark, folder), in_place=fixtures.IN_PLACE)
    return _opened[where]
