"""Mart dependencies, and the run that builds all of them from the raw inputs."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession

from martloom.config import Config
from martloom.plans.marts import common, customers, leads, orders, products, reviews, sellers
from martloom.session import cut, run_folder, size_shuffles, tune
from martloom.sources.marts import export_marts, write_bucketed, write_mart
from martloom.sources.quality import load, passed
from martloom.sources.raw import finite_columns, read_all_typed

PROFILE = "mart_customer_payment_profile"
DETAIL = "mart_order_payment_detail"
ACQUISITION = "mart_seller_acquisition"

# marts of one step need only raw inputs, parts and marts of earlier steps
STEPS = (
    (PROFILE, DETAIL, ACQUISITION, "mart_seller_performance", "mart_product_price_range"),
    (
        "mart_geo_payment_summary",
        "mart_monthly_revenue",
        "mart_payment_leakage",
        "mart_hv_category_preference",
        "mart_repeat_customer",
        "mart_review_by_segment",
        "mart_mql_funnel",
        "mart_mql_monthly",
        "mart_lead_behaviour",
    ),
)
# order-level and product-level aggregates that several marts read
PARTS = ("payments_by_order", "reviews_by_order", "product_categories")
FACTS = "order_facts"


class Marts:
    """Marts by name. Each is written on first use and read back by everything that needs it.

    ``store`` writes a mart and returns it as a table, ``cut`` does so for intermediate
    results. Parts named in ``shared`` are also written once: their readers then skip the
    aggregation, and the planner knows their true size when it chooses join strategies.
    """

    def __init__(
        self,
        raw: dict[str, DataFrame],
        store: Callable[[DataFrame, str], DataFrame],
        cfg: Config = Config(),
        analysis_date: Column | None = None,
        cut: Callable[[DataFrame, str], DataFrame] | None = None,
        shared: tuple[str, ...] = ("product_categories", "customer_quantiles"),
    ):
        self.raw = {name: finite_columns(df) for name, df in raw.items()}
        self.cfg, self.analysis_date = cfg, analysis_date
        self.shared = set(shared)
        self._store, self._cut = store, cut
        self._ready: dict[str, DataFrame] = {}

    @property
    def spark(self) -> SparkSession:
        return next(iter(self.raw.values())).sparkSession

    def part(self, name: str) -> DataFrame:
        if name in self._ready:
            return self._ready[name]
        r = self.raw
        part = {
            "payments_by_order": lambda: common.payments_by_order(r["order_payments"]),
            "reviews_by_order": lambda: common.reviews_by_order(r["order_reviews"]),
            "product_categories": lambda: common.product_categories(r["products"], r["category_translation"]),
            FACTS: lambda: orders.order_facts(
                r["orders"],
                self.part("payments_by_order"),
                r["customers"].select("customer_id", "customer_unique_id", "customer_state", "customer_city"),
                r["order_items"],
            ),
            # one row, found once and read by every report over the customers
            "customer_quantiles": lambda: customers.customer_quantiles(self.mart(PROFILE), self.cfg),
        }[name]()
        if self._cut is not None and name in self.shared:
            part = self._ready[name] = self._cut(part, name)
        return part

    def define(self, name: str) -> DataFrame:
        """The mart as a plan; only what it reads from other marts is written."""
        r, mart, part = self.raw, self.mart, self.part

        def facts() -> DataFrame | None:
            return part(FACTS) if FACTS in self.shared else None

        def paid() -> DataFrame | None:
            return None if FACTS in self.shared else part("payments_by_order")

        builders = {
            PROFILE: lambda: customers.customer_payment_profile(
                r["orders"], paid(), r["customers"], part("reviews_by_order"), self.cfg, self._cut, facts()
            ),
            DETAIL: lambda: orders.detail_of(facts())
            if FACTS in self.shared
            else orders.order_payment_detail(r["orders"], paid(), r["customers"], r["order_items"]),
            ACQUISITION: lambda: leads.seller_acquisition(r["closed_deals"], r["mql"]),
            "mart_seller_performance": lambda: sellers.seller_performance(
                r["order_items"], r["orders"], r["sellers"], part("reviews_by_order"), part("product_categories"), self._cut,
                self.cfg.distinct_sketch,
            ),
            "mart_product_price_range": lambda: products.product_price_range(
                r["order_items"], r["orders"], part("product_categories")
            ),
            "mart_geo_payment_summary": lambda: customers.geo_payment_summary(mart(PROFILE)),
            "mart_monthly_revenue": lambda: orders.monthly_revenue(mart(DETAIL)),
            "mart_payment_leakage": lambda: orders.payment_leakage(mart(DETAIL), self.analysis_date),
            "mart_hv_category_preference": lambda: products.hv_category_preference(
                *self.detail_and_profile(), r["order_items"], part("product_categories"), self._cut
            ),
            "mart_repeat_customer": lambda: customers.repeat_customer(r["orders"], r["customers"], mart(PROFILE)),
            "mart_review_by_segment": lambda: reviews.review_by_segment(
                r["orders"], r["customers"], part("reviews_by_order"), part("payments_by_order"), mart(PROFILE)
            ),
            "mart_mql_funnel": lambda: leads.mql_funnel(r["mql"], mart(ACQUISITION)),
            "mart_mql_monthly": lambda: leads.mql_monthly(r["mql"], mart(ACQUISITION)),
            "mart_lead_behaviour": lambda: leads.lead_behaviour(mart(ACQUISITION)),
        }
        return builders[name]()

    def mart(self, name: str) -> DataFrame:
        if name not in self._ready:
            self._ready[name] = self._store(self.define(name), name)
        return self._ready[name]

    def detail_and_profile(self) -> tuple[DataFrame, DataFrame]:
        """The order and the customer mart. Where both are still to be built, payments and customers are joined once for both."""
        if self._cut is not None and not self._ready.keys() & {DETAIL, PROFILE}:
            self.shared.add(FACTS)
        return self.mart(DETAIL), self.mart(PROFILE)


def run_all(marts: Marts, concurrent: int = 4) -> dict[str, DataFrame]:
    """Build every mart; independent ones share the cluster, ``concurrent`` at a time."""
    marts.shared |= set(PARTS)
    size_shuffles(marts.spark, marts.raw.values())
    built = {}
    with ThreadPoolExecutor(concurrent) as pool:
        list(pool.map(marts.part, PARTS))
        for step in STEPS:
            built |= dict(zip(step, pool.map(marts.mart, step)))
    return built


def folder_store(folder: str) -> Callable[[DataFrame, str], DataFrame]:
    """Store that fully refreshes ``folder/name`` with declared types and an update stamp."""
    return lambda df, name: write_mart(df, name, folder).drop("updated_at")


def bucketed_store(folder: str, buckets: int, database: str | None = None) -> Callable[[DataFrame, str], DataFrame]:
    """Store whose customer marts are bucketed by customer, so that joining them shuffles nothing."""

    def store(df: DataFrame, name: str) -> DataFrame:
        if "customer_unique_id" not in df.columns:
            return write_mart(df, name, folder).drop("updated_at")
        return write_bucketed(df, name, folder, "customer_unique_id", buckets, database).drop("updated_at")

    return store


def run_daily(
    spark: SparkSession,
    folder: str,
    store: Callable[[DataFrame, str], DataFrame],
    exporter: Callable[[DataFrame, str], None] | None = None,
    cfg: Config = Config(),
    analysis_date: Column | None = None,
) -> dict[str, int]:
    """The whole run over a folder of raw CSV files: presence, quality gate, load, marts, export.

    Each CSV file is read once: the gate counts while the inputs are loaded, and the marts read what was loaded. Stops
    before any mart is written if an input is missing or breaks a rule. Returns the rows of the checked inputs.
    Intermediate tables are removed at the end; ``store`` and ``exporter`` say where the marts go.
    """
    tune(spark)
    with run_folder(spark):
        raw, report = load(spark, lambda session: read_all_typed(session, folder))
        counts = passed(report)
        marts = Marts(raw, store, cfg, analysis_date, cut)
        built = run_all(marts)
        if exporter is not None:
            export_marts(built.items(), exporter)
    return counts
