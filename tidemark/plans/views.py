"""Named views, so that dashboards can keep asking in SQL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tidemark.functions.times import AsOf
from tidemark.operators.state import current_rows
from tidemark.plans import customers as customer_plans
from tidemark.plans import health, products, sales


def analytics_views(
    logs: Mapping[str, DataFrame],
    live_tables: Mapping[str, DataFrame] | None = None,
    as_of: AsOf = None,
) -> dict[str, DataFrame]:
    """The analytic views by name, over change rows keyed ``customers``, ``products``, ``orders``.

    ``live_tables`` replaces the reduction of the whole log, for callers that
    keep a compacted state.
    """
    tables = live_tables or {name: current_rows(rows) for name, rows in logs.items()}
    orders, buyers, items = tables["orders"], tables["customers"], tables["products"]
    per_customer = customer_plans.customer_metrics(buyers, orders)
    per_product = products.product_performance(items, orders)
    # The names dashboards query.
    return {
        "daily_sales_summary": sales.daily_sales(orders),
        "monthly_sales_summary": sales.monthly_sales(orders),
        "customer_metrics": per_customer,
        "top_customers_by_orders": customer_plans.top_customers(per_customer),
        "product_performance": per_product,
        "top_selling_products": products.top_products(per_product),
        "recent_activity": health.recent_activity(orders, buyers, items),
        "hourly_orders_trend": sales.hourly_orders(orders, as_of),
        "data_freshness": health.data_freshness(logs, as_of),
        "customers_cdc": logs["customers"],
        "products_cdc": logs["products"],
        "orders_cdc": logs["orders"],
    }


def register_views(views: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """Make each frame a temporary view; returns the names."""
    names = []
    for name, frame in views.items():
        frame.createOrReplaceTempView(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    return names
