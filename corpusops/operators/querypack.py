"""The ten embedded example queries on customer, orders, part, lineitem, nation and region.

Money is summed as ``decimal(18,2)``, so totals do not depend on the order of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusops.plans.scale import rank_within


def _money(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


def all_columns(table: DataFrame) -> DataFrame:
    return table.select("*")


def recent_orders(orders: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    start = F.lit(as_of).cast("timestamp_ntz") - F.make_interval(days=F.lit(days))
    return orders.where(F.col("o_orderdate") >= start)


def orders_per_customer(orders: DataFrame) -> DataFrame:
    return orders.groupBy("o_custkey").agg(F.count("*").alias("order_count"))


def monthly_average(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        (_money("o_totalprice") / F.count("o_totalprice")).alias("avg_amount")
    )


def spending(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Total per customer. Orders are summed per key before the join, so no hot customer reaches it."""
    totals = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(_money("o_totalprice").alias("total_amount"))
    return customers.join(totals, "c_custkey")


def customer_totals(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return spending(orders, customers).select("c_custkey", "c_name", "total_amount")


def above_average_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    totals = orders.groupBy("o_custkey").agg(_money("o_totalprice").alias("customer_total"))
    mean = totals.agg(F.sum(F.col("customer_total").cast("decimal(28,2)")).cast("double") / F.count("*"))
    return customer_totals(orders, customers).where(F.col("total_amount") > mean.scalar())


def rank_by_region(orders: DataFrame, customers: DataFrame, nations: DataFrame, regions: DataFrame) -> DataFrame:
    """Rank of each customer's spending inside the region; regions are not held in one task each."""
    places = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    placed = spending(orders, customers).join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = placed.select("c_custkey", "c_name", F.col("r_name").alias("region"), "total_amount")
    return rank_within(rows, ["region"], "total_amount", "c_custkey", "spending_rank")


def second_highest_order(orders: DataFrame) -> DataFrame:
    """Each customer's second order by amount. The rank limit is applied before the shuffle as well."""
    ranked = orders.withColumn(
        "rn", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    )
    return ranked.where("rn = 2").select("o_custkey", F.col("o_totalprice").alias("second_highest_amount"))


def top_products(lineitem: DataFrame, part: DataFrame, n: int = 10) -> DataFrame:
    """Products by quantity sold. Quantities are summed before the join, so it has one row per product."""
    sold = (
        lineitem.groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("total_sold"))
        .join(part.select("p_partkey", "p_name"), "p_partkey")
    )
    return sold.orderBy(F.desc("total_sold"), "p_partkey").limit(n).select("p_partkey", "p_name", "total_sold")


def monthly_growth(orders: DataFrame) -> DataFrame:
    """Revenue growth against the previous month that has orders; the window is over months."""
    revenue = orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        _money("o_totalprice").alias("revenue")
    )
    previous = F.lag("revenue").over(Window.orderBy("month"))
    growth = F.round(F.try_divide(F.col("revenue") - F.col("prev_revenue"), F.col("prev_revenue")) * 100, 2)
    return revenue.withColumn("prev_revenue", previous).where("prev_revenue IS NOT NULL").select(
        "month", "revenue", growth.alias("growth_rate_percent")
    )
