"""DuckDB statements that answer the registered queries from the Parquet tables alone.

They are written from the metric definitions, take other routes than the Spark jobs where there is
a choice (money straight from lines to days, exact decimals, windows), and share only the mapping
of the test tables, stated once in the CTEs below.
"""

from __future__ import annotations

STATUSES = "('Shipped', 'Complete', 'Processing', 'Cancelled', 'Returned')"

# CTE name -> (body, CTEs it needs).
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "o0": ("""
        SELECT o_orderkey AS order_id, o_custkey AS user_id,
               CASE o_orderstatus
                    WHEN 'O' THEN 'Shipped'
                    WHEN 'F' THEN CASE o_orderpriority WHEN '1-URGENT' THEN 'Returned'
                                                       ELSE 'Complete' END
                    WHEN 'P' THEN CASE o_orderpriority WHEN '5-LOW' THEN 'Cancelled'
                                                       ELSE 'Processing' END END AS status,
               CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(o_orderkey % 24 AS INT)) AS placed
        FROM orders""", ()),
    "o1": ("""
        SELECT *, CASE WHEN status IN ('Shipped', 'Complete', 'Returned')
                       THEN placed + to_days(CAST(1 + order_id % 3 AS INT)) END AS shipped
        FROM o0""", ("o0",)),
    "o2": ("""
        SELECT *, CASE WHEN status IN ('Complete', 'Returned')
                       THEN shipped + to_days(CAST(1 + order_id % 5 AS INT)) END AS delivered
        FROM o1""", ("o1",)),
    "o": ("""
        SELECT *, CAST(placed AS DATE) AS day, status <> 'Cancelled' AS net_order,
               CASE WHEN status = 'Returned'
                    THEN delivered + to_days(CAST(1 + order_id % 14 AS INT)) END AS returned
        FROM o2""", ("o2",)),
    "p": ("""
        SELECT p_partkey AS product_id, trim(p_name) AS product_name, p_brand AS brand,
               p_type AS category, CASE WHEN p_size % 2 = 0 THEN 'Men' ELSE 'Women' END
               AS department, concat('SKU-', p_partkey) AS sku,
               round(CAST(p_retailprice AS DECIMAL(18, 2)) * 0.6, 2) AS cost,
               CAST(p_retailprice AS DECIMAL(18, 2)) AS retail,
               p_partkey % 25 AS center_id
        FROM part""", ()),
    "u": ("""
        SELECT c_custkey AS user_id, trim(c_name) AS first_name, c_mktsegment AS last_name,
               concat('user', c_custkey, '@example.com') AS email,
               CAST(18 + c_custkey % 58 AS INTEGER) AS age,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               n_name AS city, r_name AS state,
               lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postal_code,
               'United States' AS country,
               CAST(c_custkey % 180 AS DOUBLE) - 90 AS latitude,
               CAST(c_custkey % 360 AS DOUBLE) - 180 AS longitude,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Search' WHEN 'BUILDING' THEN 'Organic'
                    WHEN 'FURNITURE' THEN 'Facebook' WHEN 'HOUSEHOLD' THEN 'Email'
                    WHEN 'MACHINERY' THEN 'Display' END AS traffic_source,
               TIMESTAMP '1994-01-01 00:00:00' + to_days(CAST(c_custkey % 365 AS INT)) AS joined
        FROM customer
        LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""", ()),
    "l": ("""
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS line_id,
               line_id AS unit_id,
               o.*, l_partkey AS product_id, CAST(l_extendedprice AS DECIMAL(18, 2)) AS price,
               CAST(status NOT IN ('Cancelled') AS INT) AS g,
               CAST(status NOT IN ('Cancelled', 'Returned') AS INT) AS n,
               CAST(status IN ('Returned') AS INT) AS f,
               CAST(status IN ('Shipped', 'Complete') AS INT) AS r
        FROM lineitem JOIN o ON l_orderkey = order_id""", ("o",)),
    "lp": ("""
        SELECT l.*, p.* EXCLUDE (product_id), n * (price - cost) AS margin
        FROM l LEFT JOIN p ON l.product_id = p.product_id""", ("l", "p")),
    # Money per day, straight from lines.
    "money": ("""
        SELECT day, sum(price) AS gmv, sum(g * price) AS gross, sum(n * price) AS net,
               sum(r * price) AS recognized, sum(f * price) AS refunds, sum(margin) AS margin
        FROM lp GROUP BY day""", ("lp",)),
    "daily": ("""
        SELECT c.day, total_orders, net_orders, active_customers,
               coalesce(gmv, 0) AS gmv, coalesce(gross, 0) AS gross, coalesce(net, 0) AS net,
               coalesce(recognized, 0) AS recognized, coalesce(refunds, 0) AS refunds,
               coalesce(margin, 0) AS margin
        FROM (SELECT day, count(*) AS total_orders,
                     CAST(sum(CAST(net_order AS INT)) AS BIGINT) AS net_orders,
                     count(DISTINCT CASE WHEN net_order THEN user_id END) AS active_customers
              FROM o GROUP BY day) c
        LEFT JOIN money ON c.day = money.day""", ("o", "money")),
    "per_order": ("""
        SELECT order_id, count(*) AS items, sum(price) AS gmv, sum(g * price) AS gross,
               sum(n * price) AS net, sum(f * price) AS refunds, sum(r * price) AS recognized,
               sum(margin) AS margin
        FROM lp GROUP BY order_id""", ("lp",)),
    "cust": ("""
        SELECT u.*, coalesce(orders, 0) AS net_orders, coalesce(net, 0) AS net, first_day, last_day
        FROM u
        LEFT JOIN (SELECT user_id, CAST(sum(CAST(net_order AS INT)) AS BIGINT) AS orders,
                          min(day) FILTER (net_order) AS first_day,
                          max(day) FILTER (net_order) AS last_day
                   FROM o GROUP BY user_id) a ON u.user_id = a.user_id
        LEFT JOIN (SELECT user_id, sum(n * price) AS net FROM l GROUP BY user_id) m
               ON u.user_id = m.user_id""", ("u", "o", "l")),
    "prod": ("""
        SELECT p.*, coalesce(units, 0) AS units, coalesce(net, 0) AS net,
               coalesce(margin, 0) AS margin, coalesce(refunds, 0) AS refunds
        FROM p LEFT JOIN (SELECT product_id, CAST(sum(n) AS BIGINT) AS units,
                                 sum(n * price) AS net, sum(margin) AS margin,
                                 sum(f * price) AS refunds
                          FROM lp GROUP BY product_id) s ON p.product_id = s.product_id
        """, ("p", "lp")),
    "e": ("""
        SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN user_id END AS user_id,
               concat('s', user_id, '-', strftime(ts, '%Y%m%d')) AS session_id,
               CAST(1 + event_id % 10 AS INTEGER) AS sequence_number, event_type,
               ['Search', 'Organic', 'Facebook', 'Email', 'Display'][CAST(event_id % 5 AS INT) + 1]
               AS traffic_source,
               ['Chrome', 'Safari', 'Firefox', 'Edge'][CAST(event_id % 4 AS INT) + 1] AS browser,
               concat('/', event_type) AS uri, 'Springfield' AS city, 'IL' AS state,
               '01234' AS postal_code, '10.0.0.1' AS ip_address, ts
        FROM events""", ()),
    # The number of items that an order's header declares.
    "declared": ("""
        SELECT o_orderkey AS order_id, coalesce(items, 0) AS items
        FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS items FROM lineitem GROUP BY 1)
             ON l_orderkey = o_orderkey""", ()),
    "rule_days": ("SELECT *, recognized + (net - recognized) AS recon FROM daily", ("daily",)),
}


def _dollars(expression: str, alias: str) -> str:
    return f"CAST(round({expression}, 0) AS DOUBLE) AS {alias}"


def _cents(expression: str, alias: str) -> str:
    return f"CAST(round({expression}, 2) AS DOUBLE) AS {alias}"


def _rate(top: str, bottom: str, alias: str, digits: int = 6) -> str:
    return (
        f"CASE WHEN {bottom} > 0 THEN round(CAST({top} AS DOUBLE) / CAST({bottom} AS DOUBLE), "
        f"{digits}) END AS {alias}"
    )


# The same CTEs over the faulty feed, where they differ.
FAULTY: dict[str, tuple[str, tuple[str, ...]]] = {
    **CTES,
    "p": ("""
        SELECT * REPLACE (CASE WHEN product_id % 59 = 0 THEN -cost ELSE cost END AS cost,
                          CASE WHEN product_id % 53 <> 0 THEN retail END AS retail,
                          CASE WHEN product_id % 61 = 0 THEN center_id + 1000000000
                               ELSE center_id END AS center_id)
        FROM clean_p""", ("clean_p",)),
    "clean_p": CTES["p"],
    "u": ("""
        SELECT * REPLACE (CASE WHEN user_id % 47 <> 0 THEN joined END AS joined)
        FROM clean_u, LATERAL (SELECT unnest(CASE WHEN user_id % 113 = 5 THEN [1, 2]
                                             ELSE [1] END) AS again)""", ("clean_u",)),
    "clean_u": CTES["u"],
    "o": ("""
        SELECT * REPLACE (
                 CASE order_id % 83 WHEN 3 THEN user_id + 1000000000 WHEN 4 THEN NULL
                      ELSE user_id END AS user_id,
                 CASE WHEN order_id % 97 = 5 THEN 'Lost' ELSE status END AS status,
                 CASE WHEN order_id % 89 <> 1 THEN shipped END AS shipped,
                 CASE WHEN order_id % 31 = 2 THEN coalesce(returned, placed) ELSE returned END
                 AS returned)
        FROM clean_o""", ("clean_o",)),
    "clean_o": CTES["o"],
    "l": ("""
        SELECT *, CAST(status <> 'Cancelled' AS INT) AS g,
               CAST(status NOT IN ('Cancelled', 'Returned') AS INT) AS n,
               CAST(status = 'Returned' AS INT) AS f,
               CAST(status IN ('Shipped', 'Complete') AS INT) AS r
        FROM (SELECT CASE o.order_id % 67 WHEN 3 THEN NULL WHEN 4 THEN concat('line-', o.order_id)
                          ELSE concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) END
                     AS line_id,
                     concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS unit_id,
                     CASE WHEN o.order_id % 103 = 0 THEN o.order_id + 1000000000
                          ELSE o.order_id END AS order_id,
                     CASE WHEN o.order_id % 103 <> 0 THEN user_id END AS user_id,
                     CASE WHEN o.order_id % 103 <> 0 THEN day END AS day,
                     CASE WHEN o.order_id % 71 = 2 THEN 'Returned' ELSE status END AS status,
                     l_partkey AS product_id,
                     CASE l_partkey % 101 WHEN 1 THEN -price WHEN 2 THEN 1 WHEN 3 THEN NULL
                          ELSE price END AS price
              FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18, 2)) AS price FROM lineitem)
              JOIN o ON l_orderkey = o.order_id)""", ("o",)),
    "e": ("""
        SELECT * REPLACE (CASE event_id % 43 WHEN 1 THEN NULL WHEN 2 THEN event_id - 2
                               ELSE event_id END AS event_id,
                          CASE WHEN event_id % 37 <> 0 THEN ts END AS ts)
        FROM clean_e""", ("clean_e",)),
    "clean_e": CTES["e"],
    "declared": ("""
        SELECT order_id, items + CAST(order_id % 41 = 0 AS INT) AS items
        FROM clean_declared""", ("clean_declared",)),
    "clean_declared": CTES["declared"],
    # Days with more buyers than orders, and with a reconciliation that is off by one.
    "rule_days": ("""
        SELECT * REPLACE (CASE WHEN day(day) = 13 THEN net_orders + 1 ELSE active_customers END
                          AS active_customers,
                          CASE WHEN day(day) = 13 THEN recon + 1 ELSE recon END AS recon)
        FROM clean_rule_days""", ("clean_rule_days",)),
    "clean_rule_days": CTES["rule_days"],
}


def with_ctes(body: str, *names: str, ctes: dict | None = None) -> str:
    """Prefix a statement with the CTEs it needs, dependencies first."""
    ctes = ctes or CTES
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in ctes[name][1]:
            visit(needed)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    if not order:
        return body
    listed = ",\n".join(f"{name} AS ({ctes[name][0]})" for name in order)
    return f"WITH {listed}\n{body}"


KPI_MONEY = {"gmv": "gmv", "gross_revenue": "gross", "net_revenue": "net",
             "recognized_revenue": "recognized", "refunds": "refunds", "net_margin": "margin"}
KPI_RATES = ", ".join([
    _rate("net", "net_orders", "aov"), _rate("refunds", "gross", "refund_rate"),
    _rate("margin", "net", "net_margin_rate"),
])
ORDER_MONEY = {"gmv_amount": "gmv", "gross_amount": "gross", "net_amount": "net",
               "refund_amount": "refunds", "recognized_amount": "recognized",
               "net_margin_amount": "margin"}


def _staging() -> dict[str, str]:
    return {
        "stg_distribution_centers": """
            SELECT CAST(n_nationkey AS BIGINT) AS distribution_center_id,
                   concat(n_name, ' DC') AS distribution_center_name,
                   CAST(n_nationkey AS DOUBLE) AS latitude,
                   CAST(n_nationkey AS DOUBLE) * -2 AS longitude
            FROM nation""",
        "stg_products": with_ctes(f"""
            SELECT product_id, product_name, brand, category, department, sku,
                   CAST(cost AS DOUBLE) AS cost, CAST(retail AS DOUBLE) AS retail_price,
                   {_cents('retail - cost', 'unit_margin')}, center_id AS distribution_center_id
            FROM p""", "p"),
        "stg_users": with_ctes("SELECT * EXCLUDE (joined), joined AS created_at FROM u", "u"),
        "stg_orders": with_ctes("""
            SELECT order_id, user_id, status,
                   CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
                   CAST((SELECT count(*) FROM lineitem WHERE l_orderkey = order_id) AS INTEGER)
                   AS num_of_item,
                   placed AS created_at, shipped AS shipped_at, delivered AS delivered_at,
                   returned AS returned_at, status = 'Returned' AS is_returned,
                   status = 'Cancelled' AS is_cancelled
            FROM o""", "o"),
        "stg_order_items": with_ctes("""
            SELECT line_id AS order_item_id, order_id, user_id, product_id,
                   line_id AS inventory_item_id, status, CAST(price AS DOUBLE) AS sale_price,
                   placed AS created_at, shipped AS shipped_at, delivered AS delivered_at,
                   returned AS returned_at
            FROM l""", "l"),
        "stg_inventory_items": with_ctes("""
            SELECT line_id AS inventory_item_id, product_id, center_id AS distribution_center_id,
                   category AS product_category, product_name, brand AS product_brand,
                   department AS product_department, sku AS product_sku,
                   CAST(cost AS DOUBLE) AS cost, CAST(retail AS DOUBLE) AS retail_price,
                   placed - to_days(CAST(5 + order_id % 56 AS INT)) AS created_at,
                   CASE WHEN status <> 'Cancelled' THEN placed END AS sold_at
            FROM lp""", "lp"),
        "stg_events": with_ctes("SELECT * EXCLUDE (ts), ts AS created_at FROM e", "e"),
    }


def _layers() -> dict[str, str]:
    kpi_money = ", ".join(_cents(source, name) for name, source in KPI_MONEY.items())
    order_money = ", ".join(
        _cents(f"coalesce({source}, 0)", name) for name, source in ORDER_MONEY.items())
    return {
        "int_order_items_enriched": with_ctes(f"""
            SELECT line_id AS order_item_id, order_id, user_id, product_id, status,
                   CAST(price AS DOUBLE) AS sale_price, product_name, brand, category, department,
                   CAST(cost AS DOUBLE) AS product_cost, placed AS order_created_at,
                   day AS order_date, g = 1 AS is_gross, n = 1 AS is_net, f = 1 AS is_refund,
                   r = 1 AS is_recognized, {_cents('g * price', 'gross_amount')},
                   {_cents('n * price', 'net_amount')}, {_cents('f * price', 'refund_amount')},
                   {_cents('r * price', 'recognized_amount')},
                   {_cents('margin', 'net_margin_amount')}
            FROM lp""", "lp"),
        "int_orders_enriched": with_ctes(f"""
            SELECT o.order_id, user_id, status,
                   CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
                   CAST(coalesce(items, 0) AS INTEGER) AS num_of_item, placed AS created_at,
                   day AS order_date, shipped AS shipped_at, delivered AS delivered_at,
                   returned AS returned_at, status = 'Returned' AS is_returned,
                   status = 'Cancelled' AS is_cancelled, net_order AS is_net_order,
                   coalesce(items, 0) AS item_count, {order_money}
            FROM o LEFT JOIN per_order ON o.order_id = per_order.order_id""", "o", "per_order"),
        "fct_orders": with_ctes(f"""
            SELECT o.order_id, user_id, day AS order_date, placed AS created_at, status,
                   net_order AS is_net_order, status = 'Returned' AS is_returned,
                   status = 'Cancelled' AS is_cancelled, coalesce(items, 0) AS item_count,
                   {order_money},
                   shipped AS shipped_at, delivered AS delivered_at, returned AS returned_at
            FROM o LEFT JOIN per_order ON o.order_id = per_order.order_id""", "o", "per_order"),
        "revenue_ladder": with_ctes(f"""
            SELECT CAST(date_trunc('month', day) AS DATE) AS period, department, status,
                   count(*) AS line_count, CAST(sum(g) AS BIGINT) AS gross_lines,
                   CAST(sum(n) AS BIGINT) AS net_lines, CAST(sum(f) AS BIGINT) AS refund_lines,
                   CAST(sum(r) AS BIGINT) AS recognized_lines,
                   {_cents('sum(price)', 'gmv')}, {_cents('sum(g * price)', 'gross_revenue')},
                   {_cents('sum(n * price)', 'net_revenue')},
                   {_cents('sum(r * price)', 'recognized_revenue')},
                   {_cents('sum(f * price)', 'refunds')}, {_cents('sum(margin)', 'net_margin')}
            FROM lp GROUP BY ALL""", "lp"),
        "dim_customers": with_ctes(f"""
            SELECT user_id, first_name, last_name, email, age, gender, city, state, country,
                   traffic_source, joined AS signed_up_at, net_orders AS lifetime_net_orders,
                   {_cents('net', 'lifetime_net_revenue')}, first_day AS first_order_date,
                   last_day AS most_recent_order_date, net_orders > 1 AS is_repeat_customer,
                   CASE net_orders WHEN 0 THEN 'never_purchased' WHEN 1 THEN 'one_time'
                        ELSE 'repeat' END AS customer_segment
            FROM cust""", "cust"),
        "dim_products": with_ctes(f"""
            SELECT product_id, product_name, brand, category, department, sku,
                   CAST(cost AS DOUBLE) AS cost, CAST(retail AS DOUBLE) AS retail_price,
                   {_cents('retail - cost', 'unit_margin')}, center_id AS distribution_center_id,
                   units AS units_sold_net, {_cents('net', 'net_revenue')},
                   {_cents('margin', 'net_margin')}, {_cents('refunds', 'refunds')}
            FROM prod""", "prod"),
        "fct_daily_kpis": with_ctes(f"""
            SELECT day AS order_date, total_orders, net_orders, active_customers, {kpi_money},
                   {KPI_RATES}
            FROM daily""", "daily"),
        "fct_revenue_recognition": with_ctes(f"""
            SELECT day AS order_date, {_cents('recognized', 'recognized_revenue')},
                   {_cents('net - recognized', 'processing_deferred')},
                   {_cents('net', 'net_revenue_mgmt')}, {_cents('refunds', 'refunds')},
                   {_cents('gross', 'gross_revenue')}, {_cents('net', 'recon_check')}
            FROM daily""", "daily"),
        "order_kpis_monthly": with_ctes(f"""
            SELECT period, status, total_orders, net_orders, active_customers, {kpi_money},
                   {KPI_RATES}
            FROM (SELECT CAST(date_trunc('month', day) AS DATE) AS period, status,
                         count(*) AS total_orders, count(*) FILTER (net_order) AS net_orders,
                         count(DISTINCT CASE WHEN net_order THEN user_id END)
                         AS active_customers,
                         {', '.join(f'coalesce(sum({c}), 0) AS {c}' for c in KPI_MONEY.values())}
                  FROM o LEFT JOIN per_order ON o.order_id = per_order.order_id
                  GROUP BY ALL)""", "o", "per_order"),
    }


def _business() -> dict[str, str]:
    def ranked(dim: str, source: str, limit: str = "", where: str = "") -> str:
        return with_ctes(f"""
            SELECT {dim}, {_dollars('sum(net)', 'net_revenue')} FROM {source} {where}
            GROUP BY {dim} ORDER BY net_revenue DESC, {dim} {limit}""", source)

    monthly = f"""
        SELECT strftime(day, '%Y-%m') AS month, {_dollars('sum(net)', 'net_revenue')},
               {_dollars('sum(recognized)', 'recognized_revenue')},
               CAST(sum(net_orders) AS BIGINT) AS net_orders
        FROM daily {{where}} GROUP BY 1"""
    totals = "(SELECT sum(net) AS net, sum(recognized) AS recognized, sum(gmv) AS gmv, " \
             "sum(refunds) AS refunds, sum(gross) AS gross, sum(margin) AS margin, " \
             "CAST(sum(net_orders) AS BIGINT) AS net_orders, min(day) AS first_day, " \
             "max(day) AS last_day FROM daily)"
    people = "(SELECT count(*) FILTER (net_orders > 0) AS purchasers, " \
             "count(*) FILTER (net_orders > 1) AS repeaters FROM cust)"
    return {
        "headline_kpis": with_ctes(f"""
            SELECT {_dollars('net', 'net_revenue')}, {_dollars('recognized', 'recognized_revenue')},
                   {_dollars('gmv', 'gmv')}, net_orders, {_rate('net', 'net_orders', 'aov', 2)},
                   {_rate('refunds', 'gross', 'refund_rate', 4)}
            FROM {totals}""", "daily"),
        "monthly_revenue_trend": with_ctes(f"""
            SELECT CAST(date_trunc('month', day) AS DATE) AS month,
                   {_dollars('sum(net)', 'net_revenue')},
                   {_dollars('sum(recognized)', 'recognized_revenue')}
            FROM daily GROUP BY 1""", "daily"),
        "monthly_recognition": with_ctes(f"""
            SELECT CAST(date_trunc('month', day) AS DATE) AS month,
                   {_dollars('sum(recognized)', 'recognized')},
                   {_dollars('sum(net - recognized)', 'deferred_processing')},
                   {_dollars('sum(refunds)', 'refunds')}
            FROM daily GROUP BY 1""", "daily"),
        "revenue_by_category": ranked("category", "prod"),
        "top_categories": ranked("category", "prod", "LIMIT 12", "WHERE category IS NOT NULL"),
        "revenue_by_department": ranked("department", "prod", "", "WHERE department IS NOT NULL"),
        "top_brands": ranked("brand", "prod", "LIMIT 10", "WHERE brand IS NOT NULL"),
        "revenue_by_traffic_source": ranked(
            "traffic_source", "cust", "", "WHERE traffic_source IS NOT NULL"),
        "repeat_purchase_rate": with_ctes(f"""
            SELECT purchasers, repeaters AS repeat_customers,
                   {_rate('repeaters', 'purchasers', 'repeat_rate', 3)}
            FROM {people}""", "cust"),
        "orders_by_status": with_ctes("SELECT status, count(*) AS orders FROM o GROUP BY 1", "o"),
        "top_customers_ltv": with_ctes(f"""
            SELECT user_id, city, state, net_orders AS lifetime_net_orders, {_cents('net', 'ltv')}
            FROM cust ORDER BY net DESC, user_id LIMIT 50""", "cust"),
        "customer_segments": with_ctes(f"""
            SELECT CASE WHEN net_orders = 0 THEN 'never_purchased' WHEN net_orders = 1
                        THEN 'one_time' ELSE 'repeat' END AS customer_segment,
                   count(*) AS customers, CAST(sum(net_orders) AS BIGINT) AS net_orders,
                   {_cents('sum(net)', 'net_revenue')}
            FROM cust GROUP BY 1""", "cust"),
        "customer_segments_as_of": with_ctes(f"""
            SELECT CASE WHEN orders = 0 THEN 'never_purchased' WHEN orders = 1
                        THEN 'one_time' ELSE 'repeat' END AS customer_segment,
                   count(*) AS customers, CAST(sum(orders) AS BIGINT) AS net_orders,
                   {_cents('sum(net)', 'net_revenue')}
            FROM (SELECT u.user_id, coalesce(a.orders, 0) AS orders, coalesce(m.net, 0) AS net
                  FROM u
                  LEFT JOIN (SELECT user_id, count(*) FILTER (net_order) AS orders FROM o
                             WHERE day < DATE '1996-01-01' GROUP BY 1) a ON a.user_id = u.user_id
                  LEFT JOIN (SELECT user_id, sum(n * price) AS net FROM l
                             WHERE day < DATE '1996-01-01' GROUP BY 1) m ON m.user_id = u.user_id)
            GROUP BY 1""", "u", "o", "l"),
        "top_three_categories": ranked("category", "prod", "LIMIT 3", "WHERE category IS NOT NULL"),
        "dashboard_kpis": with_ctes(f"""
            SELECT {_cents('net', 'net_revenue')}, {_cents('gmv', 'gmv')},
                   {_cents('recognized', 'recognized_revenue')}, {_cents('refunds', 'refunds')},
                   net_orders, {_rate('net', 'net_orders', 'aov')}, purchasers,
                   {_rate('repeaters', 'purchasers', 'repeat_rate')},
                   {_rate('refunds', 'gross', 'refund_rate')},
                   {_rate('margin', 'net', 'net_margin_rate')},
                   CAST(first_day AS VARCHAR) AS date_min, CAST(last_day AS VARCHAR) AS date_max
            FROM {totals} CROSS JOIN {people}""", "daily", "cust"),
        "dashboard_monthly": with_ctes(monthly.format(where=""), "daily"),
        "monthly_by_year": with_ctes(
            monthly.format(where="WHERE day >= DATE '1997-01-01' AND day < DATE '1998-01-01'"),
            "daily"),
        "dashboard_payload": with_ctes(f"""
            SELECT section, CAST(row_number() OVER (PARTITION BY section ORDER BY
                   CASE WHEN section = 'monthly' THEN label END,
                   CASE WHEN section = 'by_status' THEN orders ELSE net_revenue END DESC, label)
                   AS INTEGER) AS position, label, orders, net_revenue, recognized_revenue,
                   net_orders, gmv, refunds, aov, purchasers, repeat_rate, refund_rate,
                   net_margin_rate, date_min, date_max
            FROM (
                SELECT 'kpis' AS section, NULL AS label, CAST(NULL AS BIGINT) AS orders,
                       {_cents('net', 'net_revenue')},
                       {_cents('recognized', 'recognized_revenue')}, net_orders,
                       {_cents('gmv', 'gmv')}, {_cents('refunds', 'refunds')},
                       {_rate('net', 'net_orders', 'aov')}, purchasers,
                       {_rate('repeaters', 'purchasers', 'repeat_rate')},
                       {_rate('refunds', 'gross', 'refund_rate')},
                       {_rate('margin', 'net', 'net_margin_rate')},
                       CAST(first_day AS VARCHAR) AS date_min,
                       CAST(last_day AS VARCHAR) AS date_max
                FROM {totals} CROSS JOIN {people}
                UNION ALL BY NAME
                SELECT 'monthly' AS section, strftime(day, '%Y-%m') AS label,
                       {_dollars('sum(net)', 'net_revenue')},
                       {_dollars('sum(recognized)', 'recognized_revenue')},
                       CAST(sum(net_orders) AS BIGINT) AS net_orders
                FROM daily GROUP BY 2
                UNION ALL BY NAME
                (SELECT 'by_category' AS section, category AS label,
                        {_dollars('sum(net)', 'net_revenue')}
                 FROM prod GROUP BY 2 ORDER BY net_revenue DESC, category LIMIT 12)
                UNION ALL BY NAME
                SELECT 'by_department' AS section, department AS label,
                       {_dollars('sum(net)', 'net_revenue')}
                FROM prod GROUP BY 2
                UNION ALL BY NAME
                SELECT 'by_traffic' AS section, traffic_source AS label,
                       {_dollars('sum(net)', 'net_revenue')}
                FROM cust GROUP BY 2
                UNION ALL BY NAME
                (SELECT 'top_brands' AS section, brand AS label,
                        {_dollars('sum(net)', 'net_revenue')}
                 FROM prod GROUP BY 2 ORDER BY net_revenue DESC, brand LIMIT 10)
                UNION ALL BY NAME
                SELECT 'by_status' AS section, status AS label, count(*) AS orders
                FROM o GROUP BY 2)
            """, "daily", "prod", "cust", "o"),
        "quality_report_json": _quality()["quality_report"],
        "dashboard_years": with_ctes(
            "SELECT DISTINCT CAST(year(day) AS INTEGER) AS year FROM o", "o"),
    }


# Contract entries: table -> (relation, CTEs, key, required columns); a column is (name, SQL).
CONTRACT = {
    "raw.distribution_centers": ("nation", (), ("id", "n_nationkey"), ()),
    "raw.products": ("part", (), ("id", "p_partkey"), ()),
    "raw.users": ("u", ("u",), ("id", "user_id"), ()),
    "raw.orders": ("o", ("o",), ("order_id", "order_id"), ()),
    "raw.order_items": ("l", ("l",), ("id", "line_id"), ()),
    "raw.inventory_items": ("l", ("l",), ("id", "unit_id"), ()),
    "raw.events": ("e", ("e",), ("id", "event_id"), ()),
    "stg_distribution_centers": ("nation", (), ("distribution_center_id", "n_nationkey"), ()),
    "stg_products": ("p", ("p",), ("product_id", "product_id"), (("retail_price", "retail"),)),
    "stg_users": ("u", ("u",), ("user_id", "user_id"), (("created_at", "joined"),)),
    "stg_orders": ("o", ("o",), ("order_id", "order_id"),
                   (("user_id", "user_id"), ("created_at", "placed"))),
    "stg_order_items": ("l", ("l",), ("order_item_id", "line_id"),
                        (("order_id", "order_id"), ("sale_price", "price"))),
    "stg_inventory_items": ("l", ("l",), ("inventory_item_id", "unit_id"), ()),
    "stg_events": ("e", ("e",), ("event_id", "event_id"), (("created_at", "ts"),)),
    "dim_customers": ("u", ("u",), ("user_id", "user_id"), ()),
    "dim_products": ("p", ("p",), ("product_id", "product_id"), ()),
    "fct_orders": ("o", ("o",), ("order_id", "order_id"), (("user_id", "user_id"),)),
    "fct_revenue_recognition": ("daily", ("daily",), ("order_date", "day"),
                                (("recognized_revenue", "recognized"),)),
    "fct_daily_kpis": ("daily", ("daily",), ("order_date", "day"),
                       (("net_revenue", "net"), ("net_orders", "net_orders"))),
}


def _report(suite: str, table: str, check: str, column: str, counts: str, ok: str = "") -> str:
    """One report row; ``counts`` selects ``evaluated`` and ``violations``."""
    return f"""
        SELECT '{suite}' AS suite, '{table}' AS table_name, '{check}' AS check_name,
               '{column}' AS column_name, {ok or 'violations = 0'} AS success,
               CAST(evaluated AS BIGINT) AS evaluated, CAST(violations AS BIGINT) AS violations
        FROM ({counts})"""


def _null_counts(relation: str, column: str) -> str:
    return f"SELECT count(*) AS evaluated, count(*) - count({column}) AS violations FROM {relation}"


def _bad_counts(relation: str, column: str, bad: str) -> str:
    return (f"SELECT count({column}) AS evaluated, coalesce(sum(CAST({bad} AS INT)), 0) "
            f"AS violations FROM {relation}")


def _rule_counts(relation: str, holds: str) -> str:
    return (f"SELECT count(*) AS evaluated, count(*) FILTER (NOT ({holds})) AS violations "
            f"FROM {relation}")


def _duplicate_values(relation: str, column: str) -> str:
    return (f"SELECT count({column}) AS evaluated, (SELECT count(*) FROM (SELECT {column} FROM "
            f"{relation} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) "
            f"AS violations FROM {relation}")


def _duplicate_rows(relation: str, column: str) -> str:
    return (f"SELECT count({column}) AS evaluated, coalesce((SELECT sum(n) FROM (SELECT count(*) "
            f"AS n FROM {relation} WHERE {column} IS NOT NULL GROUP BY {column}) WHERE n > 1), 0) "
            f"AS violations FROM {relation}")


def _orphans(child: str, column: str, parent: str, key: str) -> str:
    return (f"SELECT count({column}) AS evaluated, count(*) FILTER ({column} IS NOT NULL AND "
            f"{column} NOT IN (SELECT {key} FROM {parent})) AS violations FROM {child}")


SEGMENTS_KNOWN = """
    SELECT count(segment) AS evaluated,
           count(*) FILTER (segment NOT IN ('never_purchased', 'one_time', 'repeat')) AS violations
    FROM (SELECT CASE WHEN net_orders = 0 THEN 'never_purchased' WHEN net_orders = 1
                      THEN 'one_time' WHEN net_orders > 1 THEN 'repeat' ELSE '?' END AS segment
          FROM cust)"""
LADDER = "gmv >= gross AND gross >= net"


def _values_suite() -> list[str]:
    """The value suites with the bands the registered report uses."""
    def row(table, check, column, counts, ok=""):
        return _report("values", table, check, column, counts, ok)

    rated = ("(SELECT *, CASE WHEN gross > 0 THEN refunds / gross END AS rr, "
             "CASE WHEN net > 0 THEN margin / net END AS mr FROM daily)")
    return [
        row("stg_order_items", "not_null", "order_item_id", _null_counts("l", "line_id")),
        row("stg_order_items", "unique", "order_item_id", _duplicate_rows("l", "line_id")),
        row("stg_order_items", "not_null", "sale_price", _null_counts("l", "price")),
        row("stg_order_items", "between", "sale_price",
            _bad_counts("l", "price", "price < 0 OR price > 200000")),
        row("stg_order_items", "accepted_values", "status",
            _bad_counts("l", "status", f"status NOT IN {STATUSES}")),
        row("fct_daily_kpis", "not_null", "order_date", _null_counts("daily", "day")),
        row("fct_daily_kpis", "unique", "order_date", _duplicate_rows("daily", "day")),
        row("fct_daily_kpis", "not_null", "net_revenue", _null_counts("daily", "net")),
        row("fct_daily_kpis", "between", "net_revenue", _bad_counts("daily", "net", "net < 0")),
        row("fct_daily_kpis", "between", "net_orders",
            _bad_counts("daily", "net_orders", "net_orders < 0")),
        row("fct_daily_kpis", "between", "active_customers",
            _bad_counts("daily", "active_customers", "active_customers < 0")),
        row("fct_daily_kpis", "between", "refund_rate",
            _bad_counts(rated, "rr", "rr NOT BETWEEN 0 AND 1")),
        row("fct_daily_kpis", "between", "net_margin_rate",
            _bad_counts(rated, "mr", "mr NOT BETWEEN 0 AND 1")),
        row("fct_daily_kpis", "between_mostly", "net_revenue",
            _bad_counts("daily", "net", "net NOT BETWEEN 0 AND 50000000"),
            "(evaluated - violations) >= 0.99 * evaluated"),
        row("fct_daily_kpis", "rule:ladder_order", "net_revenue", _rule_counts("daily", LADDER)),
        row("fct_daily_kpis", "rule:recognized_le_net", "recognized_revenue",
            _rule_counts("daily", "recognized <= net + 0.01")),
        row("fct_daily_kpis", "rule:active_le_orders", "active_customers",
            _rule_counts("daily", "active_customers <= net_orders")),
        row("dim_customers", "not_null", "user_id", _null_counts("cust", "user_id")),
        row("dim_customers", "unique", "user_id", _duplicate_rows("cust", "user_id")),
        row("dim_customers", "between", "lifetime_net_orders",
            _bad_counts("cust", "net_orders", "net_orders < 0")),
        row("dim_customers", "accepted_values", "customer_segment",
            SEGMENTS_KNOWN),
        row("fct_revenue_recognition", "not_null", "order_date", _null_counts("daily", "day")),
        row("fct_revenue_recognition", "unique", "order_date", _duplicate_rows("daily", "day")),
        row("fct_revenue_recognition", "between", "recognized_revenue",
            _bad_counts("daily", "recognized", "recognized < 0")),
        row("fct_revenue_recognition", "rule:finance_recon", "recon_check",
            _rule_counts("daily", "abs(net - (recognized + (net - recognized))) <= 0.01")),
    ]


def _quality(ctes: dict | None = None) -> dict[str, str]:
    """The checks of the quality layer over one set of CTEs."""
    everything = ("l", "p", "u", "e", "daily")
    not_null, unique = [], []
    for table, (relation, _, key, required) in CONTRACT.items():
        unique.append(_report("contract", table, "unique", key[0],
                              _duplicate_values(relation, key[1])))
        for name, column in (key, *required):
            not_null.append(_report("contract", table, "not_null", name,
                                    _null_counts(relation, column)))
    bad_status = f"status NOT IN {STATUSES}"
    accepted = [
        _report("contract", "raw.orders", "accepted_values", "status",
                _bad_counts("o", "status", bad_status)),
        _report("contract", "stg_orders", "accepted_values", "status",
                _bad_counts("o", "status", bad_status)),
        _report("contract", "dim_customers", "accepted_values", "customer_segment",
                SEGMENTS_KNOWN),
        _report("contract", "fct_orders", "accepted_values", "status",
                _bad_counts("o", "status", bad_status)),
    ]
    references = [
        _report("contract", "raw.products", "relationships", "distribution_center_id",
                _orphans("p", "center_id", "nation", "n_nationkey")),
        _report("contract", "raw.orders", "relationships", "user_id",
                _orphans("o", "user_id", "u", "user_id")),
        _report("contract", "raw.order_items", "relationships", "order_id",
                _orphans("l", "order_id", "orders", "o_orderkey")),
        _report("contract", "fct_orders", "relationships", "user_id",
                _orphans("o", "user_id", "u", "user_id")),
    ]

    def one(body, *names):
        return with_ctes(body, *names, ctes=ctes)

    def stack(rows, *names):
        return one("\nUNION ALL\n".join(rows), *names)

    def values(table, check, column, counts):
        return one(_report("values", table, check, column, counts), "rule_days")

    rated = ("(SELECT *, CASE WHEN gross > 0 THEN refunds / gross END AS rr, "
             "CASE WHEN net > 0 THEN margin / net END AS mr FROM daily)")
    between = [
        ("stg_order_items", "sale_price", _bad_counts("l", "price", "price < 0 OR price > 50000")),
        ("fct_daily_kpis", "net_revenue", _bad_counts("daily", "net", "net < 0")),
        ("fct_daily_kpis", "active_customers",
         _bad_counts("daily", "active_customers", "active_customers < 0")),
        ("fct_daily_kpis", "refund_rate", _bad_counts(rated, "rr", "rr NOT BETWEEN 0 AND 1")),
        ("fct_daily_kpis", "net_margin_rate", _bad_counts(rated, "mr", "mr NOT BETWEEN 0 AND 1")),
        ("fct_daily_kpis", "net_orders", _bad_counts("daily", "net_orders", "net_orders < 5")),
        ("dim_customers", "lifetime_net_orders",
         _bad_counts("cust", "net_orders", "net_orders > 12")),
    ]
    duplicates = [
        ("stg_order_items", "order_item_id", "l", "line_id"),
        ("fct_daily_kpis", "order_date", "daily", "day"),
        ("dim_customers", "user_id", "u", "user_id"),
        ("fct_revenue_recognition", "order_date", "daily", "day"),
        ("stg_orders", "user_id", "o", "user_id"),
    ]
    mostly = [
        _report(suite, "stg_order_items", "between_mostly", "sale_price",
                _bad_counts("l", "price", f"price NOT BETWEEN 0 AND {high}"),
                "(evaluated - violations) >= 0.99 * evaluated")
        for suite, high in (("values", 104200), ("values_tight", 90000))
    ]
    # The corrupted tables, and what a check finds before and after.
    after = {
        "negative_price": "(SELECT * REPLACE (CASE WHEN line_id = (SELECT min(line_id) FROM l) "
                          "THEN -42 ELSE price END AS price) FROM l)",
        "null_date": "(SELECT * REPLACE (CASE WHEN day <> (SELECT min(day) FROM daily) "
                     "THEN day END AS day) FROM daily)",
        "rate_above_one": "(SELECT day, CASE WHEN day = (SELECT min(day) FROM daily) THEN 1.5 "
                          "WHEN gross > 0 THEN CAST(refunds / gross AS DOUBLE) END AS rr "
                          "FROM daily)",
        "duplicate_key": "(SELECT CASE WHEN user_id = (SELECT min(user_id) FROM u WHERE user_id > "
                         "(SELECT min(user_id) FROM u)) THEN (SELECT min(user_id) FROM u) "
                         "ELSE user_id END AS user_id FROM u)",
    }
    rates = "(SELECT CASE WHEN gross > 0 THEN CAST(refunds / gross AS DOUBLE) END AS rr FROM daily)"
    counted = {
        ("negative_price", "stg_order_items", "not_null", "sale_price", "l"):
            lambda r: _null_counts(r, "price"),
        ("negative_price", "stg_order_items", "between", "sale_price", "l"):
            lambda r: _bad_counts(r, "price", "price < 0 OR price > 200000"),
        ("null_date", "fct_daily_kpis", "not_null", "order_date", "daily"):
            lambda r: _null_counts(r, "day"),
        ("null_date", "fct_daily_kpis", "unique", "order_date", "daily"):
            lambda r: _duplicate_rows(r, "day"),
        ("rate_above_one", "fct_daily_kpis", "between", "refund_rate", rates):
            lambda r: _bad_counts(r, "rr", "rr NOT BETWEEN 0 AND 1"),
        ("duplicate_key", "dim_customers", "not_null", "user_id", "u"):
            lambda r: _null_counts(r, "user_id"),
        ("duplicate_key", "dim_customers", "unique", "user_id", "u"):
            lambda r: _duplicate_rows(r, "user_id"),
    }
    detected = [
        f"""SELECT '{defect}' AS defect, '{table}' AS table_name, '{check}' AS check_name,
                   '{column}' AS column_name, b.violations = 0 AS passed_before,
                   a.violations = 0 AS passed_after,
                   CAST(a.violations AS BIGINT) AS violations_after,
                   b.violations = 0 AND a.violations > 0 AS caught
            FROM ({counts(relation)}) b CROSS JOIN ({counts(after[defect])}) a"""
        for (defect, table, check, column, relation), counts in counted.items()
    ]
    lifecycle = [
        f"""SELECT '{column}_at' AS column_name, count(*) AS evaluated,
                   count(*) FILTER (status IN ({needs}) AND {column} IS NULL) AS missing,
                   count(*) FILTER (status NOT IN ({needs}) AND {column} IS NOT NULL)
                   AS unexpected
            FROM o"""
        for column, needs in (("shipped", "'Shipped', 'Complete', 'Returned'"),
                              ("delivered", "'Complete', 'Returned'"),
                              ("returned", "'Returned'"))
    ]
    recon = _rule_counts("rule_days", "abs(net - recon) <= 0.01")
    return {
        "dq_not_null": stack(not_null, *everything),
        "dq_unique": stack(unique, *everything),
        "dq_accepted_values": stack(accepted, "o", "cust"),
        "dq_relationships": stack(references, "o", "p", "l", "u"),
        "dq_unique_rows": stack(
            [_report("values", t, "unique", c, _duplicate_rows(r, k)) for t, c, r, k in duplicates],
            "l", "daily", "u", "o"),
        "dq_between": stack(
            [_report("values", t, "between", c, counts) for t, c, counts in between],
            "l", "daily", "cust"),
        "dq_between_mostly": stack(mostly, "l"),
        "dq_negative_price": one(
            _report("singular", "stg_order_items", "rule:non_negative_price", "sale_price",
                    _rule_counts("l", "price >= 0")), "l"),
        "dq_revenue_reconciles": one(
            _report("singular", "fct_revenue_recognition", "rule:revenue_reconciles",
                    "recon_check", recon), "rule_days"),
        "rule_ladder_order": values("fct_daily_kpis", "rule:ladder_order", "net_revenue",
                                    _rule_counts("rule_days", LADDER)),
        "rule_recognized_le_net": values(
            "fct_daily_kpis", "rule:recognized_le_net", "recognized_revenue",
            _rule_counts("rule_days", "recognized <= net + 0.01")),
        "rule_active_le_orders": values(
            "fct_daily_kpis", "rule:active_le_orders", "active_customers",
            _rule_counts("rule_days", "active_customers <= net_orders")),
        "rule_finance_recon": values("fct_revenue_recognition", "rule:finance_recon",
                                     "recon_check", recon),
        "quality_report": stack(_values_suite(), "l", "daily", "cust"),
        "defect_detection": stack(detected, "l", "daily", "u"),
        "dq_status_agreement": one("""
            SELECT count(*) AS compared_lines,
                   coalesce(sum(CAST(l.status <> o.status AS INT)), 0)::BIGINT AS mismatches
            FROM l JOIN o ON l.order_id = o.order_id""", "l"),
        "dq_conditional_null": stack(lifecycle, "o"),
        "dq_mart_raw_recon": one("""
            SELECT CAST(raw AS DOUBLE) AS raw_total, CAST(mart AS DOUBLE) AS mart_total,
                   CAST(raw - mart AS DOUBLE) AS diff
            FROM (SELECT sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS raw FROM lineitem)
            CROSS JOIN (SELECT sum(gmv) AS mart FROM daily)""", "daily"),
        "dq_price_ge_cost": one("""
            SELECT count(*) AS evaluated, count(*) FILTER (price < cost) AS below_cost,
                   count(*) FILTER (cost < 0) AS negative_cost
            FROM l JOIN p ON l.product_id = p.product_id""", "l", "p"),
        "dq_item_count": one("""
            SELECT count(*) AS evaluated,
                   count(*) FILTER (items <> coalesce(lines, 0)) AS violations,
                   CAST(sum(items) AS BIGINT) AS declared_items
            FROM declared d LEFT JOIN (SELECT order_id, count(*) AS lines FROM l GROUP BY 1) x
                 ON x.order_id = d.order_id""", "declared", "l"),
        "negative_price_rows": one(
            "SELECT line_id AS order_item_id, CAST(price AS DOUBLE) AS sale_price "
            "FROM l WHERE price < 0", "l"),
        "unreconciled_days": one("""
            SELECT day AS order_date, CAST(net AS DOUBLE) AS net_revenue_mgmt,
                   CAST(recon AS DOUBLE) AS recon_check, CAST(abs(net - recon) AS DOUBLE) AS diff
            FROM rule_days WHERE abs(net - recon) > 0.01""", "rule_days"),
        "offending_days": one(f"""
            SELECT 'ladder_order' AS rule, day AS order_date FROM rule_days WHERE NOT ({LADDER})
            UNION ALL SELECT 'recognized_le_net', day FROM rule_days
                      WHERE NOT (recognized <= net + 0.01)
            UNION ALL SELECT 'active_le_orders', day FROM rule_days
                      WHERE NOT (active_customers <= net_orders)
            UNION ALL SELECT 'finance_recon', day FROM rule_days
                      WHERE NOT (abs(net - recon) <= 0.01)""", "rule_days"),
    }


def _drop_alert(days: int, sigmas: int) -> str:
    return with_ctes(f"""
        SELECT day AS order_date, {_cents('net', 'net_revenue')}, history_days,
               round(m, 6) AS mean_net_revenue, round(s, 6) AS stddev_net_revenue,
               coalesce(CAST(net AS DOUBLE) < m - {sigmas} * s, false) AS is_drop
        FROM (SELECT day, net, count(net) OVER w AS history_days,
                     avg(CAST(net AS DOUBLE)) OVER w AS m,
                     stddev_samp(CAST(net AS DOUBLE)) OVER w AS s
              FROM daily
              WINDOW w AS (ORDER BY day RANGE BETWEEN INTERVAL {days} DAYS PRECEDING
                           AND INTERVAL 1 DAYS PRECEDING))""", "daily")


def _metrics() -> dict[str, str]:
    month = "CAST(date_trunc('month', day) AS DATE)"
    return {
        "refund_rate_by_count": with_ctes(f"""
            SELECT returned_items, shipped_items,
                   {_rate('returned_items', 'shipped_items', 'refund_rate')}
            FROM (SELECT CAST(sum(f) AS BIGINT) AS returned_items,
                         CAST(sum(f + r) AS BIGINT) AS shipped_items FROM l)""", "l"),
        "monthly_aov": with_ctes(f"""
            SELECT month, {_cents('net', 'net_revenue')}, net_orders,
                   {_rate('net', 'net_orders', 'aov')}
            FROM (SELECT {month} AS month, sum(net) AS net,
                         CAST(sum(net_orders) AS BIGINT) AS net_orders
                  FROM daily GROUP BY 1)""", "daily"),
        "monthly_active_customers": with_ctes(f"""
            SELECT {month} AS month, count(DISTINCT user_id) FILTER (net_order)
                   AS active_customers FROM o GROUP BY 1""", "o"),
        "monthly_repeat_rate": with_ctes(f"""
            SELECT month, active_customers, repeat_customers,
                   {_rate('repeat_customers', 'active_customers', 'repeat_rate')}
            FROM (SELECT month, count(DISTINCT user_id) AS active_customers,
                         count(DISTINCT CASE WHEN so_far >= 2 THEN user_id END)
                         AS repeat_customers
                  FROM (SELECT {month} AS month, user_id,
                               count(*) OVER (PARTITION BY user_id ORDER BY {month}) AS so_far
                        FROM o WHERE net_order)
                  GROUP BY month)""", "o"),
        "category_growth": with_ctes(f"""
            SELECT a.category, a.month, {_cents('a.net', 'net_revenue')},
                   {_cents('b.net', 'prior_net_revenue')},
                   CASE WHEN b.net > 0
                        THEN round(CAST(a.net AS DOUBLE) / CAST(b.net AS DOUBLE) - 1, 6) END
                   AS growth
            FROM months a LEFT JOIN months b
                 ON a.category = b.category AND a.month = b.month + INTERVAL 1 MONTH""", "lp")
        .replace("\n            SELECT a.category", f""",
            months AS (SELECT category, {month} AS month, sum(n * price) AS net
                       FROM lp GROUP BY ALL)
            SELECT a.category""", 1),
        "recognition_by_ship_date": with_ctes(f"""
            SELECT CAST(shipped AS DATE) AS ship_date, count(*) AS lines,
                   {_cents('sum(price)', 'recognized_revenue')}
            FROM l WHERE r = 1 AND shipped IS NOT NULL GROUP BY 1""", "l"),
        "revenue_drop_alert": _drop_alert(28, 3),
        "revenue_drop_alert_tight": _drop_alert(7, 1),
        "event_funnel_daily": with_ctes(f"""
            SELECT CAST(ts AS DATE) AS event_date, event_type, count(*) AS events,
                   count(DISTINCT user_id) AS users,
                   count(*) FILTER (user_id IS NULL) AS anonymous_events,
                   {_rate('count(*) FILTER (user_id IS NULL)', 'count(*)', 'anonymous_share')}
            FROM e GROUP BY ALL""", "e"),
        "daily_conversion": with_ctes(f"""
            SELECT event_date, users, purchasing_users,
                   {_rate('purchasing_users', 'users', 'conversion_rate')}
            FROM (SELECT CAST(ts AS DATE) AS event_date, count(DISTINCT user_id) AS users,
                         count(DISTINCT user_id) FILTER (event_type = 'purchase')
                         AS purchasing_users
                  FROM e WHERE user_id IS NOT NULL GROUP BY 1)""", "e"),
    }


def _warehouse() -> str:
    """Rows of every exported table and the sum of one of its columns."""
    contents = {
        "distribution_centers": ("nation", "n_nationkey"), "products": ("p", "retail"),
        "users": ("u", "age"), "orders": ("declared", "items"), "order_items": ("l", "price"),
        "inventory_items": ("lp", "cost"), "events": ("e", "sequence_number"),
    }
    tables = [(layer, f"{prefix}{name}", relation, column)
              for layer, prefix in (("raw", ""), ("staging", "stg_"))
              for name, (relation, column) in contents.items()]
    tables += [
        ("intermediate", "int_order_items_enriched", "lp", "n * price"),
        ("intermediate", "int_orders_enriched", "declared", "items"),
        ("marts", "fct_orders", "o", "(SELECT sum(gmv) FROM daily) / (SELECT count(*) FROM o)"),
        ("marts", "dim_customers", "cust", "net"), ("marts", "dim_products", "prod", "net"),
        ("marts", "fct_daily_kpis", "daily", "net"),
        ("marts", "fct_revenue_recognition", "daily", "recognized"),
    ]
    return "\nUNION ALL\n".join(
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, count(*) AS rows, "
        f"round(CAST(sum({column}) AS DOUBLE), 2) AS content FROM {relation}"
        for layer, name, relation, column in tables)


def _faulty() -> dict[str, str]:
    """The quality layer over the faulty feed."""
    found = _quality(FAULTY)
    names = ("dq_not_null", "dq_unique", "dq_accepted_values", "dq_relationships",
             "dq_negative_price", "dq_revenue_reconciles", "rule_ladder_order",
             "rule_recognized_le_net", "rule_active_le_orders", "rule_finance_recon",
             "dq_status_agreement", "dq_conditional_null", "dq_price_ge_cost", "dq_item_count",
             "negative_price_rows", "unreconciled_days", "offending_days")
    return {f"faulty_{name}": found[name] for name in names}


def _sources(marts: dict[str, str], staging: dict[str, str]) -> dict[str, str]:
    tables = {"distribution_centers": "nation", "products": "part", "users": "customer",
              "orders": "orders", "order_items": "lineitem", "inventory_items": "lineitem",
              "events": "events"}
    batch = "TIMESTAMP '2024-02-01 06:00:00'"
    hours = {"distribution_centers": 25, "products": 27, "users": 49, "orders": 26,
             "order_items": 48, "inventory_items": 1, "events": 1}
    newest = "CASE WHEN count(*) > 0 THEN {batch} - INTERVAL {age} HOUR END"
    fresh = [
        f"""SELECT '{name}' AS table_name, newest AS max_loaded_at,
                   CASE WHEN newest IS NULL OR {batch} - newest > INTERVAL 48 HOUR THEN 'error'
                        WHEN {batch} - newest > INTERVAL 26 HOUR THEN 'warn' ELSE 'pass' END
                   AS status
            FROM (SELECT {newest.format(batch=batch, age=hours[name])} AS newest FROM {source})"""
        for name, source in tables.items()
    ]
    created = {
        "distribution_centers": "SELECT first AS day FROM nation, clock",
        "products": "SELECT first AS day FROM part, clock",
        "users": "SELECT CAST(joined AS DATE) AS day FROM u",
        "orders": "SELECT day FROM o",
        "order_items": "SELECT day FROM l",
        "inventory_items": "SELECT day FROM stocked",
        "events": "SELECT CAST(ts AS DATE) AS day FROM events",
    }
    # A table is landed on the morning after the newest of its days, from the first load on.
    landed = "CAST(greatest(max(day), any_value(first)) AS TIMESTAMP) + INTERVAL 30 HOUR"
    skipped = with_ctes("", "o", "l", "u") + """,
        stocked AS (SELECT CAST(placed - to_days(CAST(5 + order_id % 56 AS INT)) AS DATE) AS day
                    FROM l),
        clock AS (SELECT coalesce(max(day), DATE '2024-02-01') - 1 AS first, first + 3 AS last
                  FROM stocked),
        landings AS (""" + "\nUNION ALL\n".join(
            f"SELECT '{name}' AS table_name, {landed} AS max_loaded_at "
            f"FROM ({days}) CROSS JOIN clock WHERE day <= last" for name, days in created.items()
        ) + """)
        SELECT table_name, max_loaded_at,
               CASE WHEN max_loaded_at IS NULL THEN 'error'
                    WHEN CAST(last AS TIMESTAMP) + INTERVAL 30 HOUR - max_loaded_at
                         > INTERVAL 48 HOUR THEN 'error'
                    WHEN CAST(last AS TIMESTAMP) + INTERVAL 30 HOUR - max_loaded_at
                         > INTERVAL 26 HOUR THEN 'warn' ELSE 'pass' END AS status
        FROM landings CROSS JOIN clock"""
    parity = [
        f"""SELECT '{name}' AS table_name, raw_rows, staged_rows, raw_rows = staged_rows AS matches
            FROM (SELECT count(*) AS raw_rows FROM {source})
            CROSS JOIN (SELECT count(*) AS staged_rows FROM ({staging[f'stg_{name}']}))"""
        for name, source in tables.items()
    ]
    counts = " + ".join(f"(SELECT count(*) FROM {t})" for t in tables.values())
    mart_rows = with_ctes("""
        SELECT 'fct_orders' AS mart, count(*) AS rows FROM orders
        UNION ALL SELECT 'dim_customers', count(*) FROM customer
        UNION ALL SELECT 'dim_products', count(*) FROM part
        UNION ALL SELECT 'fct_daily_kpis', count(DISTINCT day) FROM o
        UNION ALL SELECT 'fct_revenue_recognition', count(DISTINCT day) FROM o""", "o")
    return {
        "csv_scan": staging["stg_order_items"],
        "raw_audit": "\nUNION ALL\n".join(
            f"SELECT '{name}' AS table_name, count(*) AS rows, {batch} AS first_loaded_at, "
            f"{batch} AS last_loaded_at, count(*) AS rows_with_source FROM {source}"
            for name, source in tables.items()),
        "load_report": "\nUNION ALL\n".join(
            f"SELECT '{name}' AS table_name, count(*) AS rows, 'loaded' AS status, "
            f"{batch} AS loaded_at FROM {source}"
            for name, source in tables.items()),
        "source_freshness": "\nUNION ALL\n".join(fresh),
        "freshness_after_skipped_loads": skipped,
        "dq_row_parity": "\nUNION ALL\n".join(parity),
        "load_health": with_ctes(f"""
            SELECT concat('run-', day) AS run_id, {batch} + to_days(CAST(day AS INT)) AS loaded_at,
                   n - day * lost AS rows, CAST(7 AS BIGINT) AS tables_loaded,
                   CAST(0 AS BIGINT) AS tables_skipped,
                   CASE WHEN day = 1 THEN -lost END AS rows_change
            FROM (SELECT {counts} AS n,
                         (SELECT count(*) FROM o WHERE status = 'Cancelled') AS lost)
            CROSS JOIN (VALUES (0), (1)) AS runs(day)""", "o"),
        "export_marts": mart_rows,
        "publish_gate": with_ctes(f"""
            SELECT mart, rows, CASE WHEN mart IN ('fct_orders', 'fct_daily_kpis')
                   THEN {_cents('gmv', 'gmv').removesuffix(' AS gmv')} END AS gmv,
                   'closed' AS retry
            FROM (SELECT 'fct_orders' AS mart, count(*) AS rows FROM orders
                  UNION ALL SELECT 'dim_customers', count(*) FROM customer
                  UNION ALL SELECT 'dim_products', count(*) FROM part
                  UNION ALL SELECT 'fct_daily_kpis', count(DISTINCT day) FROM o
                  UNION ALL SELECT 'fct_revenue_recognition', count(DISTINCT day) FROM o)
            CROSS JOIN (SELECT sum(gmv) AS gmv FROM daily)""", "daily"),
        "export_warehouse": with_ctes(_warehouse(), "l", "lp", "u", "p", "e", "o", "prod", "cust",
                                      "daily", "declared"),
        "to_utc": """
            SELECT o_orderkey,
                   CASE o_orderkey % 3 WHEN 0 THEN o_orderdate
                        WHEN 1 THEN o_orderdate + INTERVAL 5 HOUR
                        ELSE o_orderdate - INTERVAL 5 HOUR - INTERVAL 30 MINUTE END AS utc_time
            FROM orders""",
        "customers_no_pii":
            "SELECT * EXCLUDE (first_name, last_name, email) FROM (" + marts["dim_customers"] + ")",
        "marketing_view": marts["fct_daily_kpis"],
        "finance_view": marts["fct_revenue_recognition"],
    }


def _upkeep(staging: dict[str, str], marts: dict[str, str]) -> dict[str, str]:
    """What tables hold after increments, versions and refreshes, from the whole tables."""
    late = "EXISTS (SELECT 1 FROM o WHERE date_trunc('month', o.day) = " \
           "date_trunc('month', m.order_date) AND o.day >= DATE '1998-01-01' AND o.order_id % 7 < 2)"
    periods = {"month": "CAST(date_trunc('month', day) AS DATE)",
               "quarter": "CAST(date_trunc('quarter', day) AS DATE)",
               "year": "CAST(date_trunc('year', day) AS DATE)", "all": "CAST(NULL AS DATE)"}
    return {
        "incremental_landing": f"""
            SELECT *, CASE WHEN order_id % 4 = 0 THEN TIMESTAMP '2024-02-02 06:00:00'
                           ELSE TIMESTAMP '2024-02-01 06:00:00' END AS loaded_at
            FROM ({staging['stg_orders']})""",
        # Days that end before the latest event less one day are closed. What comes with a later
        # drop counts unless its day was closed by the drops before.
        "event_counts_stream": """
            WITH seconds AS (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events),
            middle AS (SELECT CAST(floor((min(s) + max(s)) / 2) AS BIGINT) AS m FROM seconds),
            dealt AS (
              SELECT ts, event_type, CAST(ts AS DATE) AS day,
                     CASE WHEN event_id % 10 = 0 THEN 3 WHEN event_id % 10 = 1 OR s >= m THEN 2
                          ELSE 1 END AS part
              FROM seconds CROSS JOIN middle),
            marks AS (
              SELECT max(ts) FILTER (part < 2) - INTERVAL 1 DAY AS second,
                     max(ts) FILTER (part < 3) - INTERVAL 1 DAY AS third,
                     max(ts) - INTERVAL 1 DAY AS last FROM dealt)
            SELECT day, event_type, count(*) AS events
            FROM dealt CROSS JOIN marks
            WHERE day + INTERVAL 1 DAY <= last
              AND NOT coalesce(part = 2 AND day + INTERVAL 1 DAY <= second, false)
              AND NOT coalesce(part = 3 AND day + INTERVAL 1 DAY <= third, false)
            GROUP BY day, event_type""",
        # The fourth version is the one that forgot the first: it reads like the third.
        "raw_snapshots": with_ctes("""
            SELECT version, count(*) AS rows, CAST(sum(items) AS BIGINT) AS items,
                   any_value(TIMESTAMP '2024-02-01 06:00:00' + to_days(CAST(part AS INT)))
                   AS loaded_at
            FROM declared CROSS JOIN (VALUES (CAST(2 AS BIGINT), 1), (3, 2), (4, 2))
                 AS versions(version, part)
            WHERE order_id % 3 <> part
            GROUP BY version""", "declared"),
        "concurrent_publications": with_ctes(f"""
            SELECT run_id, count(*) AS orders, {_cents('sum(coalesce(gmv, 0))', 'gmv')},
                   CAST(2 AS BIGINT) AS versions
            FROM (SELECT 'all' AS run_id, order_id FROM o UNION ALL
                  SELECT 'even', order_id FROM o WHERE order_id % 2 = 0) r
            LEFT JOIN per_order USING (order_id)
            GROUP BY run_id""", "o", "per_order"),
        "changed_days_kpis": with_ctes(
            f"SELECT m.*, {late} AS refreshed FROM ({marts['fct_daily_kpis']}) m", "o"),
        "changed_days_recognition": with_ctes(
            f"SELECT m.*, {late} AS refreshed FROM ({marts['fct_revenue_recognition']}) m", "o"),
        "bucketed_orders": marts["int_orders_enriched"],
        "bucketed_customers": marts["dim_customers"],
        "active_customers_by_period": with_ctes("\nUNION ALL\n".join(
            f"SELECT '{grain}' AS grain, {period} AS period, "
            "count(DISTINCT user_id) AS active_customers FROM o WHERE net_order GROUP BY ALL"
            for grain, period in periods.items()), "o"),
        "renamed_contacts":
            "SELECT user_id, country, customer_segment FROM (" + marts["dim_customers"] + ")",
    }


def statements() -> dict[str, str]:
    """DuckDB SQL by query name."""
    staging, layers = _staging(), _layers()
    clean = {name: sql for name, sql in _quality().items()
             if name not in ("negative_price_rows", "unreconciled_days", "offending_days")}
    return {**staging, **layers, **_business(), **clean, **_faulty(), **_metrics(),
            **_sources(layers, staging), **_upkeep(staging, layers),
            "marts_checked_while_written":
            f"SELECT * FROM ({clean['quality_report']}) WHERE table_name NOT LIKE 'stg%'"}
