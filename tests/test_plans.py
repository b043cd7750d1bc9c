from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import bag, change, flat

from tidemark.functions.times import MICROS_PER_DAY, MICROS_PER_HOUR
from tidemark.operators import joins, ranking
from tidemark.plans import customers, health, products, quality, sales
from tidemark.plans.views import analytics_views, register_views
from tidemark.schemas import CUSTOMERS, ORDERS, PRODUCTS

DAY = MICROS_PER_DAY


@pytest.fixture(scope="module")
def shop(spark):
    """Customer 3 and product 30 have no orders; order 5 points at nobody."""
    buyers = flat(
        spark,
        CUSTOMERS,
        *(change(i, i, name=f"N{i}", email=f"n{i}@example.com", created_at=i * DAY) for i in (1, 2, 3)),
    )
    items = flat(
        spark,
        PRODUCTS,
        *(change(i, i, name=f"P{i}", price=Decimal(i), created_at=i * DAY) for i in (10, 20, 30)),
    )
    rows = [
        (1, 1, 10, 1, 0),
        (2, 1, 20, 2, DAY),
        (3, 2, 10, 4, DAY + 5 * MICROS_PER_HOUR),
        (4, 2, 10, 1, 40 * DAY),
        (5, 9, 90, 7, 40 * DAY),
    ]
    orders = flat(
        spark,
        ORDERS,
        *(change(i, i, customer_id=c, product_id=p, quantity=q, order_time=t) for i, c, p, q, t in rows),
    )
    return {"customers": buyers, "products": items, "orders": orders}


def keyed(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_daily_sales(shop):
    got = keyed(sales.daily_sales(shop["orders"]), "date")
    assert got[date(1970, 1, 2)] == {
        "date": date(1970, 1, 2),
        "total_orders": 2,
        "total_items_sold": 6,
        "unique_customers": 2,
        "unique_products_sold": 2,
        "avg_items_per_order": 3.0,
    }
    assert len(got) == 3


def test_daily_sales_of_the_last_days_count_whole_days(shop):
    # Thirty days before 10 February is 11 January.
    recent = sales.daily_sales_since(shop["orders"], datetime(1970, 2, 10, 23))
    assert [r["total_orders"] for r in recent.collect()] == [2]
    edge = sales.daily_sales_since(shop["orders"], datetime(1970, 2, 1, 23))
    assert keyed(edge, "date").keys() == {date(1970, 1, 2), date(1970, 2, 10)}


def test_monthly_sales(shop):
    got = keyed(sales.monthly_sales(shop["orders"]), "month")
    assert {m: r["total_orders"] for m, r in got.items()} == {197001: 3, 197002: 2}
    assert got[197001]["avg_items_per_order"] == 2.33


def test_hours_of_two_days_meet(spark):
    at = [20 * MICROS_PER_HOUR, DAY + 3 * MICROS_PER_HOUR, DAY + 20 * MICROS_PER_HOUR - 1]
    orders = flat(spark, ORDERS, *(change(i, 1, quantity=1, order_time=t) for i, t in enumerate(at)))
    got = keyed(sales.hourly_orders(orders, datetime(1970, 1, 2, 20)), "hour")
    assert {h: r["order_count"] for h, r in got.items()} == {20: 1, 3: 1, 19: 1}
    labels = sales.hourly_panel(orders, datetime(1970, 1, 2, 20)).select("hour_label")
    assert sorted(r[0] for r in labels.collect()) == ["19:00", "20:00", "3:00"]


def test_customer_metrics_leave_out_who_never_ordered(shop):
    got = keyed(customers.customer_metrics(shop["customers"], shop["orders"]), "customer_id")
    assert got.keys() == {1, 2}
    assert got[2] == {
        "customer_id": 2,
        "name": "N2",
        "email": "n2@example.com",
        "customer_since": datetime(1970, 1, 3),
        "total_orders": 2,
        "total_items_purchased": 5,
        "first_order_date": datetime(1970, 1, 2, 5),
        "last_order_date": datetime(1970, 2, 10),
        "avg_items_per_order": 2.5,
        "customer_lifespan_days": 39,
    }


def test_product_performance(shop):
    got = keyed(products.product_performance(shop["products"], shop["orders"]), "product_id")
    assert got.keys() == {10, 20}
    assert (got[10]["total_quantity_sold"], got[10]["unique_customers"]) == (6, 2)
    assert got[10]["price"] == Decimal("10.00")


def test_ties_at_the_cut_go_to_the_lower_id(shop):
    metrics = customers.customer_metrics(shop["customers"], shop["orders"])
    assert customers.top_customers(metrics, 1).first()["customer_id"] == 1
    assert customers.vip_customers(metrics, 1).first()["name"] == "N1"
    assert customers.top_customers_panel(metrics).columns[0] == "name"


def test_top_products(shop):
    performance = products.product_performance(shop["products"], shop["orders"])
    assert [r["product_id"] for r in products.top_products(performance, 1).collect()] == [10]
    plan = products.top_products(performance)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_histogram(shop):
    metrics = customers.customer_metrics(shop["customers"], shop["orders"])
    assert bag(customers.order_count_histogram(metrics)) == [(2, 2)]


def test_registrations_and_overview(shop):
    as_of = datetime(1970, 1, 4)
    trend = keyed(customers.registration_trend(shop["customers"], as_of, days=1), "date")
    assert trend.keys() == {date(1970, 1, 3), date(1970, 1, 4)}
    got = dict(bag(customers.customer_overview(shop["customers"], shop["orders"], datetime(1970, 1, 10))))
    # The seven days reach back to 3 January, when customer 2 came.
    assert got == {
        "Total Customers": 3,
        "Active Customers (with orders)": 3,
        "New Customers (Last 7d)": 2,
    }


def test_recent_activity_with_and_without_a_bound(shop):
    args = (shop["orders"], shop["customers"], shop["products"])
    assert keyed(health.recent_activity(*args), "activity_type")["orders"]["total_records"] == 5
    bounded = keyed(health.recent_activity(*args, since=datetime(1970, 1, 20)), "activity_type")
    assert bounded["orders"]["total_records"] == 2
    assert bounded["customers"] == {"activity_type": "customers", "total_records": 0, "last_activity": None}


def test_freshness_counts_every_version_and_minute_crossings(spark):
    log = flat(spark, ORDERS, change(1, 1_000), change(1, 59_000, deleted=1))
    got = health.data_freshness({"orders": log}, datetime(1970, 1, 1, 0, 1, 1)).first()
    assert (got["total_records"], got["minutes_since_last_update"]) == (2, 1)
    assert got["last_update"] == datetime(1970, 1, 1, 0, 0, 59)


def test_table_counts(shop):
    assert dict(bag(health.table_counts(shop))) == {"customers": 3, "products": 3, "orders": 5}


def test_enriched_orders_need_both_parents(shop):
    got = keyed(joins.enrich_orders(shop["orders"], shop["customers"], shop["products"]), "id")
    assert got.keys() == {1, 2, 3, 4}
    assert got[2]["total_amount"] == Decimal("40.00")
    assert (got[3]["customer_name"], got[3]["product_name"]) == ("N2", "P10")


def test_a_hot_customer_is_split_in_the_join(spark):
    """Half of all orders are one customer's; its partition is read in pieces."""
    orders = spark.range(200_000, numPartitions=8).select(
        F.xxhash64("id").alias("id"),
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 500).cast("long").alias("customer_id"),
        (F.col("id") % 50).alias("product_id"),
        F.lit(1).alias("quantity"),
        F.lit(0).cast("long").alias("order_time"),
    )
    name = F.concat(F.lit("n"), F.col("id"))
    buyers = spark.range(500).select("id", name.alias("name"), F.lit("e").alias("email"))
    items = spark.range(50).select("id", name.alias("name"), F.lit(1).cast("decimal(10,2)").alias("price"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = joins.enrich_orders(orders, buyers, items).select("id", "customer_name")
        assert len(rows.collect()) == 200_000
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_parents_without_orders(shop):
    lonely = joins.without_orders(shop["customers"], shop["orders"], "customer_id")
    assert [r["id"] for r in lonely.collect()] == [3]
    unsold = joins.delete_candidates(shop["products"], shop["orders"], "product_id", 2)
    assert [r["id"] for r in unsold.collect()] == [30]


def test_deletions_are_change_rows(shop):
    lonely = joins.without_orders(shop["customers"], shop["orders"], "customer_id")
    gone = joins.deletions(lonely, CUSTOMERS.columns, 99).first()
    assert (gone["id"], gone["name"], gone["_version"], gone["_deleted"]) == (3, None, 99, 1)


def test_deletable(shop):
    got = keyed(joins.deletable(shop["customers"], shop["orders"], "customer_id"), "id")
    assert {i: (r["order_count"], r["deletable"]) for i, r in got.items()} == {
        1: (2, False),
        2: (2, False),
        3: (0, True),
    }


def test_random_rows_can_be_repeated(shop):
    a = [r["id"] for r in ranking.random_rows(shop["orders"], 3, seed=1).collect()]
    assert a == [r["id"] for r in ranking.random_rows(shop["orders"], 3, seed=1).collect()]
    draws = {tuple(r["id"] for r in ranking.random_rows(shop["orders"], 3, seed=s).collect()) for s in range(6)}
    assert len(draws) > 1


def test_quality_checks_find_their_faults(spark, shop):
    copies = flat(spark, CUSTOMERS, change(1, 1, email="a"), change(1, 2, email="a"), change(2, 1, name="x"))
    assert bag(quality.duplicates(copies, "id")) == [(1, 2)]
    assert bag(quality.duplicates(copies, "email")) == [("a", 2)]
    assert bag(quality.null_counts({"customers": (copies, CUSTOMERS)})) == [
        ("customers", "email", 1),
        ("customers", "name", 2),
    ]
    broken = quality.orphans(
        shop["orders"],
        {"customers": ("customer_id", shop["customers"]), "products": ("product_id", shop["products"])},
    )
    assert bag(broken) == [(5, "customers", 9), (5, "products", 90)]


def test_views_answer_sql(spark, shop):
    views = analytics_views(shop, as_of=datetime(1970, 2, 10, 12))
    names = register_views(views)
    assert "daily_sales_summary" in names
    got = spark.sql(
        "SELECT product_name, total_quantity_sold FROM top_selling_products LIMIT 10"
    ).collect()
    assert [tuple(r) for r in got] == [("P10", 6), ("P20", 2)]
    total = spark.sql("SELECT count(*) FROM orders_cdc WHERE _deleted = 0").first()[0]
    assert total == 5
    assert spark.sql("SELECT sum(order_count) FROM hourly_orders_trend").first()[0] == 2


def test_views_over_a_kept_state(spark, shop):
    fewer = {**shop, "orders": shop["orders"].filter("id < 3")}
    views = analytics_views(shop, live_tables=fewer)
    assert views["daily_sales_summary"].count() == 2
    assert views["data_freshness"].filter("table_name = 'orders'").first()["total_records"] == 5
