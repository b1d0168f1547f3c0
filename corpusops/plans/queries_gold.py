"""The ten example queries."""

from __future__ import annotations

from corpusops.operators import querypack as p
from corpusops.plans.registry import Registry, rounded

AS_OF = "1998-06-01"
MONEY = "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)"


def register(q: Registry) -> None:
    q.add("q0_all_columns", lambda t: p.all_columns(t("customer")), "SELECT * FROM customer")
    q.add(
        "q1_recent_orders", lambda t: p.recent_orders(t("orders"), AS_OF),
        f"SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAYS",
    )
    q.add(
        "q2_orders_per_customer", lambda t: p.orders_per_customer(t("orders")),
        "SELECT o_custkey, count(*) AS order_count FROM orders GROUP BY o_custkey",
    )
    q.add(
        "q3_monthly_average", lambda t: rounded(p.monthly_average(t("orders"))),
        f"SELECT strftime(o_orderdate, '%Y-%m') AS month, round({MONEY} / count(o_totalprice), 6) AS avg_amount FROM orders GROUP BY 1",
    )
    q.add(
        "q4_customer_totals", lambda t: p.customer_totals(t("orders"), t("customer")),
        f"""SELECT c_custkey, c_name, {MONEY} AS total_amount FROM customer JOIN orders ON c_custkey = o_custkey
            GROUP BY c_custkey, c_name""",
    )
    q.add(
        "q5_above_average", lambda t: p.above_average_customers(t("orders"), t("customer")),
        f"""SELECT c_custkey, c_name, {MONEY} AS total_amount FROM customer JOIN orders ON c_custkey = o_custkey
            GROUP BY c_custkey, c_name
            HAVING {MONEY} > (SELECT CAST(sum(CAST(total AS DECIMAL(28,2))) AS DOUBLE) / count(*)
                              FROM (SELECT {MONEY} AS total FROM orders GROUP BY o_custkey))""",
    )
    q.add(
        "q6_rank_by_region", lambda t: p.rank_by_region(t("orders"), t("customer"), t("nation"), t("region")),
        f"""SELECT c_custkey, c_name, r_name AS region, {MONEY} AS total_amount,
                   rank() OVER (PARTITION BY r_name ORDER BY {MONEY} DESC) AS spending_rank
            FROM customer JOIN orders ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey GROUP BY c_custkey, c_name, r_name""",
    )
    q.add(
        "q7_second_highest_order", lambda t: p.second_highest_order(t("orders")),
        """WITH ranked AS (SELECT o_custkey, o_totalprice,
                row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
           SELECT o_custkey, o_totalprice AS second_highest_amount FROM ranked WHERE rn = 2""",
    )
    q.add(
        "q8_top_products", lambda t: p.top_products(t("lineitem"), t("part")),
        """SELECT p_partkey, p_name, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_sold
           FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY p_partkey, p_name
           ORDER BY total_sold DESC, p_partkey LIMIT 10""",
    )
    q.add(
        "q9_monthly_growth", lambda t: p.monthly_growth(t("orders")),
        f"""WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, {MONEY} AS revenue FROM orders GROUP BY 1),
            l AS (SELECT month, revenue, lag(revenue) OVER (ORDER BY month) AS prev_revenue FROM m)
            SELECT month, revenue, round((revenue - prev_revenue) / prev_revenue * 100, 2) AS growth_rate_percent
            FROM l WHERE prev_revenue IS NOT NULL""",
    )
