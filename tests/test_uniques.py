import random
from datetime import date, datetime

from pyspark.sql import functions as F
from rows import bag, change, flat

from tidemark.functions.times import MICROS_PER_DAY
from tidemark.plans.sales import daily_sales, rollup_measures
from tidemark.plans.uniques import daily_bitmaps, merged, read_uniques, rebuild_uniques, roll_uniques, unique_counts
from tidemark.schemas import ORDERS

DICE = random.Random(3)
WIDE = [0, 1, 32_767, 32_768, 32_769, 65_536, 10**9, 10**12, None]
ROWS = [
    (i, DICE.choice(WIDE), DICE.randrange(5), DICE.choice([None, 1, 2]), DICE.choice([None, 0, 1, 8, 40]))
    for i in range(300)
]


def orders(spark, rows=ROWS):
    made = (
        change(i, 1, customer_id=c, product_id=p, quantity=q, order_time=None if d is None else d * MICROS_PER_DAY)
        for i, c, p, q, d in rows
    )
    return flat(spark, ORDERS, *made)


def want(period):
    found = {}
    for _, customer, product, _, day in ROWS:
        own = found.setdefault(None if day is None else period(day), (set(), set()))
        for values, value in zip(own, (customer, product)):
            if value is not None:
                values.add(value)
    return {k: (len(c), len(p)) for k, (c, p) in found.items()}


def test_bitmaps_of_days_merge_into_longer_periods(spark):
    days = daily_bitmaps(orders(spark))
    got = {r["date"]: (r["unique_customers"], r["unique_products"]) for r in unique_counts(days, "date").collect()}
    assert got == want(lambda day: date.fromordinal(date(1970, 1, 1).toordinal() + day))
    months = unique_counts(merged(days, F.month("date"))).collect()
    assert {r["period"]: tuple(r)[1:] for r in months} == want(lambda day: 1 if day < 31 else 2)


def test_a_day_done_again_replaces_its_bitmaps(spark, tmp_path):
    path = str(tmp_path / "uniques")
    rebuild_uniques(orders(spark), path)
    before = {r["date"]: r for r in unique_counts(read_uniques(spark, path), "date").collect()}
    roll_uniques(orders(spark, [(1, 7, 7, 1, 1), (2, 7, 8, 1, 1)]), path, datetime(1970, 1, 3))
    after = {r["date"]: r for r in unique_counts(read_uniques(spark, path), "date").collect()}
    again = after.pop(date(1970, 1, 2))
    assert (again["unique_customers"], again["unique_products"]) == (1, 2)
    del before[date(1970, 1, 2)]
    assert after == before
    roll_uniques(orders(spark, []), path, datetime(1970, 1, 3))
    assert date(1970, 1, 2) not in {r["date"] for r in read_uniques(spark, path).collect()}


def test_day_figures_need_no_expand(spark):
    rows = orders(spark)
    for figures in (daily_sales(rows), rollup_measures(rows)):
        plan = figures._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and plan.count("Generate") == 1
    plain = rows.groupBy(F.date_from_unix_date(F.floor(F.col("order_time") / MICROS_PER_DAY).cast("int")).alias("date")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("quantity").alias("total_items_sold"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("product_id").alias("unique_products_sold"),
        F.avg("quantity").alias("avg_items_per_order"),
    )
    assert bag(daily_sales(rows)) == bag(plain)
