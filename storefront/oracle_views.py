"""The domain views of ``storefront.sources.bindings`` as DuckDB SQL.

Used only by the independent SQL cross-check (``oracle_sql()``); each query
text is prefixed with the views it mentions, as common table expressions.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "sales": """
        SELECT o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS order_date,
               l.l_partkey AS product_id
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "menu": """
        SELECT p_partkey AS product_id, p_name AS product_name,
               CAST(p_retailprice AS DECIMAL(18,2)) AS price
        FROM part""",
    "members": """
        SELECT o_custkey AS customer_id, MIN(CAST(o_orderdate AS DATE)) AS join_date
        FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey""",
    "membership_periods": """
        SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS start_date,
               CASE WHEN o_orderkey % 40 <> 0
                    THEN CAST(o_orderdate AS DATE) + CAST(30 * (1 + o_orderkey % 6) AS INTEGER) END AS end_date
        FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "customer_orders": """
        SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, l.l_partkey AS pizza_id,
               CASE WHEN l.l_returnflag = 'A' AND l.l_linestatus = 'F' THEN ''
                    WHEN l.l_returnflag = 'A' AND l.l_linestatus = 'O' THEN 'null'
                    WHEN l.l_returnflag = 'R'
                      THEN CAST(l.l_linenumber AS VARCHAR) || ', ' || CAST(l.l_suppkey % 25 AS VARCHAR)
               END AS exclusions,
               CASE l.l_partkey % 4
                    WHEN 1 THEN ''
                    WHEN 2 THEN 'null'
                    WHEN 3 THEN CASE WHEN l.l_linenumber % 2 = 1 THEN CAST(l.l_suppkey % 25 AS VARCHAR)
                                     ELSE CAST(l.l_suppkey % 25 AS VARCHAR) || ', '
                                          || CAST(l.l_partkey % 25 AS VARCHAR) END
               END AS extras,
               o.o_orderdate + INTERVAL 1 MINUTE * CAST(o.o_orderkey % 1440 AS INTEGER) AS order_time
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "pizza_names": "SELECT p_partkey AS pizza_id, p_type AS pizza_name FROM part",
    "pizza_recipes": """
        SELECT p_partkey AS pizza_id,
               CAST(p_size % 25 AS VARCHAR) || CASE WHEN p_size % 5 = 0 THEN ',' ELSE ', ' END
               || CAST(p_partkey % 25 AS VARCHAR) AS toppings
        FROM part""",
    "pizza_toppings": "SELECT n_nationkey AS topping_id, n_name AS topping_name FROM nation",
    "runner_orders": """
        SELECT o_orderkey AS order_id, o_orderkey % 100 AS runner_id,
               o_orderdate + INTERVAL 1 MINUTE * CAST(o_orderkey % 1440 AS INTEGER)
                 + INTERVAL 1 MINUTE * CAST(10 + o_orderkey % 47 AS INTEGER) AS pickup_time,
               CASE WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'null' END
                    WHEN o_orderkey % 4 = 0 THEN CAST(5 + o_orderkey % 20 AS VARCHAR) || '.'
                                                 || CAST(o_orderkey % 10 AS VARCHAR) || 'km'
                    WHEN o_orderkey % 4 = 1 THEN CAST(5 + o_orderkey % 20 AS VARCHAR) || 'km'
                    WHEN o_orderkey % 4 = 2 THEN CAST(5 + o_orderkey % 20 AS VARCHAR) || '.'
                                                 || CAST(o_orderkey % 10 AS VARCHAR)
                    ELSE CAST(5 + o_orderkey % 20 AS VARCHAR)
               END AS distance,
               CASE WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'null' END
                    WHEN (o_orderkey // 4) % 5 = 0 THEN CAST(10 + o_orderkey % 40 AS VARCHAR) || ' minutes'
                    WHEN (o_orderkey // 4) % 5 = 1 THEN '1 minute'
                    WHEN (o_orderkey // 4) % 5 = 2 THEN CAST(10 + o_orderkey % 40 AS VARCHAR) || ' mins'
                    WHEN (o_orderkey // 4) % 5 = 3 THEN CAST(10 + o_orderkey % 40 AS VARCHAR)
                    ELSE CAST(10 + o_orderkey % 40 AS VARCHAR) || '.5 minutes'
               END AS duration,
               CASE WHEN o_orderstatus = 'P' THEN 'Restaurant Cancellation' END AS cancellation
        FROM orders""",
    "runners": """
        SELECT l_suppkey AS runner_id, MIN(CAST(l_shipdate AS DATE)) AS registration_date
        FROM lineitem GROUP BY l_suppkey""",
    "raw_ratings": """
        SELECT o_orderkey * 2 AS rating_key, o_orderkey AS order_id,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 100 END AS runner_id,
               o_custkey AS customer_id,
               CAST(CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 7 END AS INTEGER) AS rating,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'Fast and friendly' END AS comment,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL
                    ELSE o_orderdate + INTERVAL 1 MINUTE * CAST(o_orderkey % 1440 AS INTEGER)
                         + INTERVAL 1 HOUR * CAST(1 + o_orderkey % 24 AS INTEGER) END AS rating_time
        FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL
        SELECT o_orderkey * 2 + 1, o_orderkey, o_orderkey % 100, o_custkey,
               CAST(1 + (o_orderkey // 7) % 5 AS INTEGER),
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'Fast and friendly' END,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL
                    ELSE o_orderdate + INTERVAL 1 MINUTE * CAST(o_orderkey % 1440 AS INTEGER)
                         + INTERVAL 1 HOUR * CAST(1 + o_orderkey % 24 AS INTEGER) END
        FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 4 = 0""",
    "weekly_sales": """
        SELECT strftime(week_start, '%-d/%-m/%y') AS week_date, region, platform, segment,
               customer_type, CAST(COUNT(*) AS INTEGER) AS transactions,
               CAST(FLOOR(SUM(price)) AS BIGINT) AS sales
        FROM (
          SELECT CAST(date_trunc('week', o.o_orderdate) AS DATE) AS week_start,
                 r.r_name AS region,
                 CASE WHEN o.o_orderstatus = 'F' THEN 'Retail' ELSE 'Shopify' END AS platform,
                 CASE WHEN c.c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'F' || left(o.o_orderpriority, 1)
                      WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'C' || left(o.o_orderpriority, 1)
                      WHEN c.c_mktsegment = 'BUILDING' THEN left(o.o_orderpriority, 1)
                 END AS segment,
                 CASE WHEN c.c_acctbal < 5000 THEN 'New' ELSE 'Existing' END AS customer_type,
                 CAST(o.o_totalprice AS DECIMAL(18,2)) AS price
          FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
          JOIN nation n ON c.c_nationkey = n.n_nationkey
          JOIN region r ON n.n_regionkey = r.r_regionkey
        ) t
        GROUP BY week_start, region, platform, segment, customer_type""",
}

# Views defined over other views.
VIEWS["ratings"] = """
        SELECT rating_key AS rating_id, order_id, runner_id, customer_id, rating, comment,
               COALESCE(rating_time, TIMESTAMP '2002-01-01 00:00:00') AS rating_time
        FROM raw_ratings
        WHERE order_id IS NOT NULL AND runner_id IS NOT NULL AND customer_id IS NOT NULL
          AND rating IS NOT NULL AND rating BETWEEN 1 AND 5"""
VIEWS["clean_weekly_sales"] = """
        SELECT wd AS week_date,
               CAST(weekofyear(wd) AS BIGINT) AS week_number,
               CAST(month(wd) AS BIGINT) AS month_number,
               COALESCE(list_extract(['1996', '1997'], list_position(['1996', '1997'], CAST(year(wd) AS VARCHAR))), '1998')
                 AS calendar_year,
               COALESCE(MAP {'1': 'Young Adults', '2': 'Middle Aged', '3': 'Retirees', '4': 'Retirees'}[segment], 'Unknown')
                 AS age_band,
               COALESCE(MAP {'C': 'Couples', 'F': 'Families'}[left(segment, 1)], 'Unknown') AS demographic,
               CAST(sales // NULLIF(transactions, 0) AS DOUBLE) AS avg_transaction,
               region, platform, COALESCE(segment, 'Unknown') AS segment, customer_type,
               CAST(transactions AS BIGINT) AS transactions, CAST(sales AS BIGINT) AS sales
        FROM (SELECT {PARSE_SHORT_DATE} AS wd, * FROM weekly_sales) w"""

# 'd/M/yy' text to a date. DuckDB's %y puts 69 in the 1900s; the statements'
# dialect (and the Spark side) puts 00-69 in the 2000s and 70-99 in the 1900s.
_P = "CAST(try_strptime(week_date, '%d/%m/%y') AS DATE)"
PARSE_SHORT_DATE = f"CASE WHEN year({_P}) < 1970 THEN CAST({_P} + INTERVAL 100 YEAR AS DATE) ELSE {_P} END"
VIEWS["clean_weekly_sales"] = VIEWS["clean_weekly_sales"].replace("{PARSE_SHORT_DATE}", PARSE_SHORT_DATE)

_ORDER = list(VIEWS)
_DEPENDS = {name: [other for other in _ORDER if other != name
                   and re.search(rf"\b{other}\b", VIEWS[name])] for name in _ORDER}


def with_views(query: str) -> str:
    """Prefix ``query`` with the view definitions it (transitively) uses."""
    needed: list[str] = []

    def visit(name: str) -> None:
        for dep in _DEPENDS[name]:
            visit(dep)
        if name not in needed:
            needed.append(name)

    for name in _ORDER:
        if re.search(rf"\b{name}\b", query):
            visit(name)
    query = query.strip()
    if not needed:
        return query
    ctes = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in needed)
    if re.match(r"(?i)WITH\s", query):
        return f"WITH {ctes},\n{query[5:].lstrip()}"
    return f"WITH {ctes}\n{query}"
