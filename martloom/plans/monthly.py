"""The monthly marts, refreshed for the months that new raw files touch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame

from martloom.plans.marts import common, leads, orders, products
from martloom.plans.marts.leads import seller_acquisition
from martloom.sources.raw import finite_columns
from martloom.sources.refresh import Months, changed_order_months, in_months, months_of, newest_file, refresh_months, since

REVENUE, PRICES, LEADS = "mart_monthly_revenue", "mart_product_price_range", "mart_mql_monthly"
#: Raw inputs whose files are looked at.
INPUTS = ("orders", "order_payments", "order_items", "mql", "closed_deals")


def refresh(raw: dict[str, DataFrame], folder: str, moment: dt.datetime | None) -> tuple[dict[str, Months], dt.datetime | None]:
    """Bring the monthly marts in ``folder`` up to date with the raw files written after ``moment`` (None: all).

    Returns the months written per mart, and the moment to give next time: files written while this runs are later.
    Raw inputs only grow: a file that is replaced counts as new. Categories and customers are looked up as they are now.
    """
    newest = newest_file(*(raw[name] for name in INPUTS))
    clean = {name: finite_columns(df) for name, df in raw.items()}
    o, payments, items = raw["orders"], raw["order_payments"], raw["order_items"]

    def orders_of(months: Months) -> DataFrame:
        return clean["orders"].where(in_months("order_purchase_timestamp", months))

    # payments and items are added up per order before they meet the orders, and joins keep the orders of these months only

    def revenue(months: Months) -> DataFrame:
        paid = common.payments_by_order(clean["order_payments"])
        return orders.monthly_revenue(orders.order_payment_detail(orders_of(months), paid, clean["customers"], clean["order_items"]))

    def prices(months: Months) -> DataFrame:
        categories = common.product_categories(clean["products"], clean["category_translation"])
        return products.product_price_range(clean["order_items"], orders_of(months), categories)

    def contacts(months: Months) -> DataFrame:
        some = clean["mql"].where(in_months("first_contact_date", months))
        return leads.mql_monthly(some, seller_acquisition(clean["closed_deals"], clean["mql"]))

    touched = raw["mql"].where(since(moment)).select("mql_id", "first_contact_date")
    if moment is not None:  # without one all leads are new already
        won = raw["closed_deals"].where(since(moment)).select("mql_id").distinct()
        touched = touched.unionByName(raw["mql"].select("mql_id", "first_contact_date").join(won, "mql_id", "left_semi"))
    wanted: dict[str, tuple[Months, Callable[[Months], DataFrame]]] = {
        REVENUE: (changed_order_months(o, [payments, items], moment), revenue),
        PRICES: (changed_order_months(o, [items], moment), prices),
        LEADS: (months_of(touched, "first_contact_date"), contacts),
    }
    return {name: refresh_months(name, folder, months, build) for name, (months, build) in wanted.items()}, newest
