"""The bronze → silver → gold → mart → report graph as lazy DataFrames.

``Lakehouse`` builds each table once per instance (the DataFrame, not its
data); Catalyst sees one plan per requested output and prunes the rest. The
bronze layer comes either from the star-schema snapshot (``from_driver``) or
from bronze tables already written by the ingest job (``from_bronze``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from retail_lakehouse.plans import marts as M
from retail_lakehouse.plans import reports as R
from retail_lakehouse.plans import warehouse as W
from retail_lakehouse.plans.silver import SILVER_BUILDERS
from retail_lakehouse.schemas import BY_TABLE
from retail_lakehouse.session import LARGE, drop_materialized, input_bytes, materialize, new_table_path, prepare, shuffles_dropped
from retail_lakehouse.sources import driver_tables as D
from retail_lakehouse.sources.stored import CODEC, bucket_count, drop_layer, layout_of, read_table, write_layer

# Tables that are stored in buckets of order_id: the rollups and joins of the facts
# and of the seller mart are by order.
BY_ORDER = {"silver": ("orders", "order_items", "order_payments", "order_reviews"), "gold": ("fct_orders", "fct_order_items")}


class Lakehouse:
    def __init__(self, bronze_source: Callable[[str], DataFrame], week_start: str = "sunday",
                 day_basis: str = "calendar", materialize: tuple[str, ...] = ()):
        """``materialize``: layers ("silver", "gold", "mart") or tables ("gold.fct_orders") that are
        written the first time they are used (parquet in the shared checkpoint
        folder), for outputs that read many tables many times (quality suite,
        report check) — each table is then computed once, its lineage is cut,
        and readers prune columns."""
        self._bronze_source = bronze_source
        self.week_start = week_start
        self.day_basis = day_basis
        self.materialize = materialize
        self._versions_source = bronze_source
        self._dealt_source: Callable[[str, int], DataFrame] | None = None  # bronze dealt by order_id into buckets
        self._memo: dict[str, DataFrame] = {}
        self._dealt: set[str] = set()  # stored tables in buckets of order_id
        self._paths: dict[str, str] = {}  # of stored tables
        self.large = False  # whether the tables of orders take turns

    # -- construction ---------------------------------------------------------
    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, **kw) -> "Lakehouse":
        tables = D.load_driver_tables(spark, sf_dir)
        lh = cls(lambda name: D.snapshot_bronze(tables, name), **kw)
        # The latest version of a review is one row, however often it landed.
        lh._versions_source = lambda name: D.snapshot_landing(tables, name)
        lh._dealt_source = lambda name, buckets: D.dealt_bronze(tables, name, buckets)
        lh.large = input_bytes(spark, [f"{sf_dir}/{t}.parquet" for t in D.DRIVER_TABLES]) > LARGE
        return lh

    @classmethod
    def from_bronze(cls, spark: SparkSession, bronze_tables: Mapping[str, DataFrame], **kw) -> "Lakehouse":
        prepare(spark)
        return cls(lambda name: bronze_tables[name], **kw)

    def by_order(self) -> bool:
        """Whether the silver tables of orders are stored in buckets of ``order_id``."""
        return all(f"silver.{n}" in self._dealt for n in BY_ORDER["silver"])

    def write(self, key: str, df: DataFrame, path: str) -> int:
        """Write the table ``df`` of this layer graph at ``path``; returns its rows."""
        layer, name = key.split(".")
        if name not in BY_ORDER.get(layer, ()):
            return write_layer(df, path)
        n = bucket_count(df.sparkSession)
        # The latest versions of the reviews are found by review, so these move with their hashes.
        dealt = layer == "silver" and name != "order_reviews" and self._dealt_source is not None
        if dealt:
            source, fn = SILVER_BUILDERS[name]
            df = fn(self._dealt_source(source, n))
        return write_layer(df, path, bucket_by="order_id", buckets=n, dealt=dealt)

    def _store(self, key: str, df: DataFrame) -> DataFrame:
        layer, name = key.split(".")
        spark, path = df.sparkSession, new_table_path(df.sparkSession, key.replace(".", "-"))
        self._paths[key] = path
        # Buckets pay where all that meets by order lies in them.
        if name not in BY_ORDER.get(layer, ()) or "silver" not in self.materialize:
            return materialize(df, compression=CODEC, path=path)
        self.write(key, df, path)
        if layout_of(spark, path):
            self._dealt.add(key)
        root, table = path.rsplit("/", 1)
        return read_table(spark, root, table)

    def _get(self, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        if key not in self._memo:
            df = build()
            if key in self.materialize or key.split(".")[0] in self.materialize:
                df = self._store(key, df)
            self._memo[key] = df
        return self._memo[key]

    def build_layers(self, tables: tuple[str, ...] = (), max_workers: int = 4) -> "Lakehouse":
        """Write the materialized layers, each tier's independent tables as
        concurrent Spark jobs (one driver thread per table), so small jobs share
        the cluster instead of running one by one (those of large tables of orders
        take turns). ``tables`` names those wanted; none named means all."""
        for layer in TIERS:
            self.build_tier(layer, tables, max_workers)
        return self

    def build_tier(self, layer: str, tables: tuple[str, ...] = (), max_workers: int = 4) -> "Lakehouse":
        stored = [n for n in TIERS[layer] if layer in self.materialize or f"{layer}.{n}" in self.materialize]
        wanted = [n for n in stored if not tables or n in tables]
        if wanted:
            self.run_tier(layer, wanted, getattr(self, layer), max_workers)
        return self

    def run_tier(self, layer: str, names: Iterable[str], run: Callable[[str], object], max_workers: int = 4) -> dict[str, object]:
        """``run`` for each table of a tier, as concurrent jobs; where the input is large, the tables of
        orders one after the other before the rest: each fills the cluster, and its shuffles go before the next."""
        names, done = tuple(names), {}
        with shuffles_dropped(SparkSession.active()):
            if self.large:
                done = {n: run(n) for n in BY_ORDER.get(layer, ()) if n in names}
            with ThreadPoolExecutor(max_workers=max_workers) as pool:
                rest = [n for n in names if n not in done]
                done |= dict(zip(rest, pool.map(run, rest)))
        return {n: done[n] for n in names}

    def drop(self, *layers: str) -> None:
        """Delete the stored tables of ``layers``, which nothing reads any more."""
        for key in [k for k in self._paths if k.split(".")[0] in layers]:
            drop_layer(self._memo.pop(key).sparkSession, path := self._paths.pop(key))
            self._dealt.discard(key)
            drop_materialized(SparkSession.active(), (path,))

    # -- layers ---------------------------------------------------------------
    def bronze(self, table_name: str) -> DataFrame:
        if table_name not in BY_TABLE:
            raise KeyError(table_name)
        return self._get(f"bronze.{table_name}", lambda: self._bronze_source(table_name))

    def silver(self, name: str) -> DataFrame:
        source, fn = SILVER_BUILDERS[name]
        if name == "order_reviews":
            return self._get(f"silver.{name}", lambda: fn(self._versions_source(source)))
        return self._get(f"silver.{name}", lambda: fn(self.bronze(source)))

    def gold(self, name: str) -> DataFrame:
        s = self.silver
        builders = {
            "dim_customers": lambda: W.dim_customers(s("customers")),
            "dim_products": lambda: W.dim_products(s("products"), s("product_category_translation")),
            "dim_sellers": lambda: W.dim_sellers(s("sellers")),
            "dim_geography": lambda: W.dim_geography(s("geolocation")),
            "dim_date": lambda: W.dim_date(s("orders"), self.week_start),
            "fct_orders": lambda: W.fct_orders(s("orders"), s("order_items"), s("order_payments"),
                                               s("order_reviews"), self.by_order(), "gold.fct_orders" in self.materialize),
            # The order fact has the rows of the orders, one by one: where it alone is stored, it is read instead.
            "fct_order_items": lambda: W.fct_order_items(
                s("order_items"), self.gold("fct_orders") if "gold.fct_orders" in self.materialize else s("orders")),
        }
        return self._get(f"gold.{name}", builders[name])

    def mart(self, name: str) -> DataFrame:
        g = self.gold
        builders = {
            "mart_daily_sales": lambda: M.mart_daily_sales(g("fct_orders")),
            "mart_delivery_performance": lambda: M.mart_delivery_performance(g("fct_orders"), self.day_basis),
            "mart_seller_performance": lambda: M.mart_seller_performance(
                g("dim_sellers"), g("fct_order_items"), g("fct_orders")),
            "mart_customer_rfm": lambda: M.mart_customer_rfm(g("fct_orders"), g("dim_customers")),
        }
        return self._get(f"mart.{name}", builders[name])

    def report(self, name: str) -> DataFrame:
        g, m = self.gold, self.mart
        builders = {
            "report_executive_kpis": lambda: R.report_executive_kpis(g("fct_orders")),
            "report_daily_sales": lambda: R.report_daily_sales(m("mart_daily_sales")),
            "report_delivery_performance": lambda: R.report_delivery_performance(m("mart_delivery_performance")),
            "report_top_sellers": lambda: R.report_top_sellers(m("mart_seller_performance")),
            "report_rfm_segments": lambda: R.report_rfm_segments(m("mart_customer_rfm")),
            "report_sales_by_state": lambda: R.report_sales_by_state(g("fct_orders"), g("dim_customers")),
        }
        return self._get(f"report.{name}", builders[name])


SILVER_NAMES = tuple(SILVER_BUILDERS)
GOLD_NAMES = ("dim_customers", "dim_products", "dim_sellers", "dim_geography", "dim_date",
              "fct_orders", "fct_order_items")
MART_NAMES = ("mart_daily_sales", "mart_delivery_performance", "mart_seller_performance", "mart_customer_rfm")
TIERS = {"silver": SILVER_NAMES, "gold": GOLD_NAMES, "mart": MART_NAMES}
# What the report check stores: what more than one mart or report reads, and the marts.
# The order lines have one reader, which takes five of their columns.
REPORT_TABLES = ("gold.dim_customers", "gold.fct_orders", "mart")
REPORT_NAMES = ("report_executive_kpis", "report_daily_sales", "report_delivery_performance",
                "report_top_sellers", "report_rfm_segments", "report_sales_by_state")
