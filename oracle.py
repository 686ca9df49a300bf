"""Reference SQL for the queries, for DuckDB over the same test tables.

``HEAD`` maps the test tables to the shop's tables. ``VIEWS`` holds what the queries share, each with
the views it reads. ``sql(body, view, ...)`` puts the needed ones in front of a query.
"""

from __future__ import annotations

AS_OF = "DATE '2001-08-01'"
START = "TIMESTAMP '1996-01-01 00:00:00'"
RUN_TS = "TIMESTAMP '2001-08-01 02:00:00'"

# name -> (views it reads, SQL)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "users": ((), """
        SELECT c_custkey AS id, lower(replace(c_name, '#', '_')) || '@example.com' AS email,
            split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
            CASE c_nationkey % 8 WHEN 0 THEN 'FRA' WHEN 1 THEN 'usa' WHEN 2 THEN 'DEU' WHEN 3 THEN 'esp'
                WHEN 4 THEN 'GBR' WHEN 5 THEN 'ita' WHEN 6 THEN 'CAN' ELSE 'aus' END AS country,
            CASE WHEN c_custkey % 50 = 7 THEN NULL WHEN c_mktsegment = 'AUTOMOBILE' THEN 'premium'
                WHEN c_mktsegment = 'MACHINERY' THEN 'enterprise' ELSE 'freemium' END AS plan_type,
            f AS created_at, CASE WHEN c_custkey % 10 >= 3 THEN l END AS last_login, c_acctbal >= 0 AS is_active
        FROM customer LEFT JOIN (SELECT o_custkey, MIN(o_orderdate) AS f, MAX(o_orderdate) AS l
            FROM orders GROUP BY o_custkey) d ON o_custkey = c_custkey"""),
    "products": ((), """
        SELECT p_partkey AS id, CAST(p_partkey % 100 + 1 AS INT) AS merchant_id, p_name AS name,
            p_brand || ' ' || p_type AS description, p_type AS category,
            CAST(p_retailprice AS DECIMAL(12,2)) AS price, p_size AS stock_quantity,
            f AS created_at, l AS updated_at
        FROM part LEFT JOIN (SELECT l_partkey, MIN(l_shipdate) AS f, MAX(l_shipdate) AS l
            FROM lineitem GROUP BY l_partkey) d ON l_partkey = p_partkey"""),
    "shop_orders": (("users",), """
        SELECT o_orderkey AS id, o_custkey AS user_id, o_orderdate AS created_at,
            CASE WHEN o_orderkey % 97 = 0 THEN CAST(0 AS DECIMAL(12,2))
                ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS total_amount,
            CASE WHEN o_orderkey % 20 = 0 THEN 'cancelled' WHEN o_orderstatus = 'F' THEN 'delivered'
                WHEN o_orderstatus = 'P' THEN 'pending' WHEN o_orderkey % 2 = 0 THEN 'shipped' ELSE 'paid' END AS status,
            country,
            CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Stripe' WHEN '2' THEN 'PayPal'
                ELSE 'credit_card' END AS payment_method
        FROM orders LEFT JOIN users u ON u.id = o_custkey"""),
    "order_items": ((), """
        SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                l_shipdate, l_quantity) AS id,
            l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity,
            CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
            CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(l_quantity AS INT) AS DECIMAL(12,2)) AS line_total
        FROM lineitem JOIN part ON p_partkey = l_partkey"""),
    "shop_events": ((), """
        SELECT event_id AS id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE user_id END AS user_id,
            CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
                WHEN 'signup' THEN 'checkout_start' ELSE event_type END AS event_type,
            ts AS event_ts, props AS metadata FROM events"""),
    "crm_contacts": ((), """
        SELECT s_suppkey AS id, lower(replace(s_name, '#', '_')) || '@example.com' AS email,
            split_part(s_name, '#', 1) AS first_name, split_part(s_name, '#', 2) AS last_name,
            CASE s_suppkey % 4 WHEN 0 THEN 'organic' WHEN 1 THEN 'paid_ads' WHEN 2 THEN 'referral'
                ELSE 'email_campaign' END AS source,
            'CAMP_' || CAST(1000 + s_suppkey % 9000 AS STRING) AS campaign_id, f AS created_at,
            s_suppkey % 5 < 2 AS converted, CASE WHEN s_suppkey % 5 < 2 THEN l END AS converted_at
        FROM supplier LEFT JOIN (SELECT l_suppkey, MIN(l_shipdate) AS f, MAX(l_shipdate) AS l
            FROM lineitem GROUP BY l_suppkey) d ON l_suppkey = s_suppkey"""),
    # Orders with their state of completion, as every model reads them.
    "heads": (("shop_orders",), """
        SELECT *, status IN ('paid', 'shipped', 'delivered') AS done FROM shop_orders"""),
    "bought": (("heads",), """
        SELECT user_id, MIN(created_at) AS first_order_date, MAX(created_at) AS last_order_date,
            CAST(COUNT(DISTINCT id) AS BIGINT) AS total_orders,
            CAST(SUM(total_amount) AS DECIMAL(22,2)) AS lifetime_value
        FROM heads WHERE done GROUP BY user_id"""),
    "dim_customers": (("users", "bought"), f"""
        SELECT id AS customer_key, email, first_name, last_name, first_name || ' ' || last_name AS full_name,
            upper(country) AS country_code,
            CASE WHEN plan_type IN ('premium', 'enterprise') THEN 'Premium' ELSE 'Freemium' END
                AS customer_segment,
            plan_type, is_active, created_at AS registration_date, last_login, first_order_date, last_order_date,
            coalesce(total_orders, 0) AS total_orders,
            CAST(coalesce(lifetime_value, 0) AS DECIMAL(22,2)) AS lifetime_value,
            CASE WHEN last_order_date IS NULL THEN 'No Purchase'
                WHEN date_diff('day', CAST(last_order_date AS DATE), {AS_OF}) > 90 THEN 'Churned'
                WHEN date_diff('day', CAST(last_order_date AS DATE), {AS_OF}) > 30 THEN 'At Risk'
                ELSE 'Active' END AS customer_status,
            {RUN_TS} AS _dbt_updated_at
        FROM users LEFT JOIN bought ON user_id = id"""),
    "sold": (("order_items",), """
        SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold,
            CAST(SUM(line_total) AS DECIMAL(22,2)) AS total_revenue,
            CAST(COUNT(DISTINCT order_id) AS BIGINT) AS total_orders
        FROM order_items GROUP BY product_id"""),
    "dim_products": (("products", "sold"), f"""
        SELECT id AS product_key, name AS product_name, description AS product_description,
            category AS product_category, merchant_id, price AS current_price, stock_quantity AS current_stock,
            coalesce(total_quantity_sold, 0) AS total_quantity_sold,
            CAST(coalesce(total_revenue, 0) AS DECIMAL(22,2)) AS total_revenue,
            coalesce(total_orders, 0) AS total_orders,
            CASE WHEN total_revenue IS NOT NULL THEN 'Active' ELSE 'No Sales' END AS product_status,
            created_at AS product_created_at, updated_at AS product_updated_at, {RUN_TS} AS _dbt_updated_at
        FROM products LEFT JOIN sold ON product_id = id"""),
    "fact_orders": (("heads", "order_items"), f"""
        SELECT i.id AS order_item_key, h.id AS order_key, user_id AS customer_key, product_id AS product_key,
            CAST(created_at AS DATE) AS date_key, status AS order_status, country AS country_code,
            payment_method, created_at AS order_timestamp, quantity AS quantity_sold, unit_price,
            line_total AS line_revenue, total_amount AS order_total,
            CAST(line_total * CAST(0.2 AS DECIMAL(2,1)) AS DECIMAL(14,3)) AS estimated_margin,
            CAST(done AS INT) AS is_completed, CAST(status = 'cancelled' AS INT) AS is_cancelled
        FROM heads h JOIN order_items i ON i.order_id = h.id
        WHERE created_at >= {START}"""),
    "done_lines": (("fact_orders",), "SELECT * FROM fact_orders WHERE is_completed = 1"),
    "mart_sales_overview": (("done_lines", "dim_products", "dim_customers"), """
        SELECT date_key AS sale_date, l.country_code, product_category, customer_segment,
            CAST(COUNT(DISTINCT order_key) AS BIGINT) AS total_orders,
            CAST(COUNT(DISTINCT l.customer_key) AS BIGINT) AS unique_customers,
            CAST(SUM(quantity_sold) AS BIGINT) AS total_quantity,
            CAST(SUM(line_revenue) AS DECIMAL(22,2)) AS total_revenue,
            CAST(SUM(estimated_margin) AS DECIMAL(24,3)) AS total_margin,
            CAST(SUM(order_total) AS DOUBLE) / COUNT(order_total) AS avg_order_value,
            CAST(SUM(line_revenue) AS DOUBLE) / COUNT(DISTINCT order_key) AS revenue_per_order,
            CAST(SUM(estimated_margin) AS DOUBLE) / nullif(CAST(SUM(line_revenue) AS DOUBLE), 0) AS margin_rate
        FROM done_lines l JOIN dim_products p ON p.product_key = l.product_key
            JOIN dim_customers c ON c.customer_key = l.customer_key
        GROUP BY date_key, l.country_code, product_category, customer_segment"""),
    "customer_metrics": (("done_lines",), f"""
        SELECT customer_key, MAX(order_timestamp) AS last_order_date,
            CAST(date_diff('day', CAST(MAX(order_timestamp) AS DATE), {AS_OF}) AS BIGINT) AS days_since_last_order,
            CAST(COUNT(DISTINCT order_key) AS BIGINT) AS total_orders,
            CAST(date_diff('day', CAST(MIN(order_timestamp) AS DATE), CAST(MAX(order_timestamp) AS DATE)) AS BIGINT)
                AS customer_lifespan_days,
            CAST(SUM(line_revenue) AS DECIMAL(22,2)) AS lifetime_value,
            CAST(SUM(order_total) AS DOUBLE) / COUNT(order_total) AS avg_order_value,
            MIN(order_timestamp) AS first_order_date
        FROM done_lines GROUP BY customer_key"""),
    "rfm_scores": (("customer_metrics",), """
        SELECT *,
            CAST(ntile(5) OVER (ORDER BY days_since_last_order NULLS LAST, customer_key NULLS LAST) AS INT)
                AS recency_score,
            CAST(ntile(5) OVER (ORDER BY total_orders DESC NULLS FIRST, customer_key NULLS LAST) AS INT)
                AS frequency_score,
            CAST(ntile(5) OVER (ORDER BY lifetime_value DESC NULLS FIRST, customer_key NULLS LAST) AS INT)
                AS monetary_score
        FROM customer_metrics"""),
    "rfm_segments": (("rfm_scores",), """
        SELECT *, recency_score + frequency_score + monetary_score AS rfm_total_score,
            CASE WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'Champions'
                WHEN recency_score >= 3 AND frequency_score >= 3 THEN 'Loyal Customers'
                WHEN recency_score >= 4 AND frequency_score <= 2 THEN 'Promising'
                WHEN recency_score >= 3 AND monetary_score >= 3 THEN 'Potential Loyalists'
                WHEN recency_score <= 2 AND frequency_score >= 3 THEN 'At Risk'
                WHEN recency_score <= 2 AND monetary_score >= 4 THEN 'Cant Lose Them'
                WHEN recency_score <= 2 THEN 'Hibernating'
                ELSE 'Others' END AS rfm_segment
        FROM rfm_scores"""),
    "mart_customer_ltv": (("rfm_segments", "dim_customers"), """
        SELECT customer_key, email, full_name, country_code, customer_segment, customer_status,
            s.last_order_date, days_since_last_order, s.total_orders, customer_lifespan_days, s.lifetime_value,
            avg_order_value, s.first_order_date, recency_score, frequency_score, monetary_score,
            rfm_total_score, rfm_segment,
            CASE WHEN days_since_last_order <= 90 THEN 'Low' WHEN days_since_last_order <= 180 THEN 'Medium'
                ELSE 'High' END AS churn_risk
        FROM rfm_segments s JOIN dim_customers USING (customer_key)"""),
    "product_metrics": (("done_lines", "dim_products"), """
        SELECT l.product_key, product_name, product_category,
            CAST(COUNT(DISTINCT order_key) AS BIGINT) AS total_orders,
            CAST(SUM(quantity_sold) AS BIGINT) AS total_quantity_sold,
            CAST(SUM(line_revenue) AS DECIMAL(22,2)) AS total_revenue,
            CAST(SUM(unit_price) AS DOUBLE) / COUNT(unit_price) AS avg_unit_price,
            CAST(SUM(estimated_margin) AS DECIMAL(24,3)) AS total_margin,
            CAST(SUM(estimated_margin) AS DOUBLE) / nullif(CAST(SUM(line_revenue) AS DOUBLE), 0) AS margin_rate,
            MIN(order_timestamp) AS first_sale_date, MAX(order_timestamp) AS last_sale_date
        FROM done_lines l JOIN dim_products p ON p.product_key = l.product_key
        GROUP BY l.product_key, product_name, product_category"""),
    "ranked": (("product_metrics",), """
        SELECT *, row_number() OVER o AS revenue_rank,
            CAST(SUM(total_revenue) OVER (o ROWS UNBOUNDED PRECEDING) AS DECIMAL(32,2)) AS cumulative_revenue,
            CAST((SELECT SUM(total_revenue) FROM product_metrics) AS DECIMAL(32,2)) AS total_revenue_all
        FROM product_metrics
        WINDOW o AS (ORDER BY total_revenue DESC NULLS FIRST, product_key NULLS LAST)"""),
    "abc": (("ranked",), """
        SELECT *, CAST(total_revenue AS DOUBLE) / CAST(nullif(total_revenue_all, 0) AS DOUBLE) AS revenue_pct,
            CAST(cumulative_revenue AS DOUBLE) / CAST(nullif(total_revenue_all, 0) AS DOUBLE)
                AS cumulative_revenue_pct,
            CASE WHEN cumulative_revenue_pct <= 0.8::DOUBLE THEN 'A'
                WHEN cumulative_revenue_pct <= 0.95::DOUBLE THEN 'B' ELSE 'C' END AS abc_class,
            CASE WHEN revenue_rank <= 10 THEN 'Top 10' WHEN revenue_rank <= 50 THEN 'Top 50'
                ELSE 'Long Tail' END AS performance_tier
        FROM ranked"""),
    "mart_product_performance": (("abc",), """
        SELECT product_key, product_name, product_category, total_orders, total_quantity_sold, total_revenue,
            avg_unit_price, total_margin, margin_rate, first_sale_date, last_sale_date, revenue_rank,
            revenue_pct, cumulative_revenue_pct, abc_class, performance_tier
        FROM abc"""),
}


# The generated tables. A drawn number is the first 60 bits of a hash of the key and the stream.
DAY = 86400


def draw(n, key: str, stream: int) -> str:
    return f"(CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{stream}'), 1, 15) AS BIGINT) % ({n}))"


def choice(values: str, key: str, stream: int) -> str:
    listed = values.split()
    return f"({listed})[CAST({draw(len(listed), key, stream)} AS INT) + 1]"


def ago(seconds: str) -> str:
    return f"({RUN_TS} - to_seconds({seconds}))"


VIEWS |= {
    "gen_users": ((), f"""
        SELECT c_custkey AS id, 'user_' || c_custkey || '@example.com' AS email,
            'first_' || c_custkey % 1000 AS first_name, 'last_' || c_custkey AS last_name,
            {choice('FRA USA DEU ESP GBR ITA CAN AUS', 'c_custkey', 0)} AS country,
            CASE WHEN {draw(100, 'c_custkey', 1)} >= 70 THEN {choice('freemium premium enterprise', 'c_custkey', 2)}
                ELSE 'freemium' END AS plan_type,
            {ago(draw(730 * DAY, 'c_custkey', 3))} AS created_at,
            CASE WHEN {draw(100, 'c_custkey', 4)} >= 30 THEN {ago(draw(30 * DAY, 'c_custkey', 5))} END AS last_login,
            {draw(100, 'c_custkey', 6)} < 95 AS is_active
        FROM customer"""),
    "gen_products": ((), f"""
        SELECT p_partkey AS id, CAST({draw(100, 'p_partkey', 0)} + 1 AS INT) AS merchant_id,
            'product_' || p_partkey AS name, 'description of product ' || p_partkey AS description,
            {choice('Electronics Fashion Home Books Sports Beauty Toys', 'p_partkey', 1)} AS category,
            CAST(CAST({draw(49501, 'p_partkey', 2)} + 500 AS DECIMAL(12,2)) * 0.01::DECIMAL(3,2) AS DECIMAL(12,2)) AS price,
            CAST({draw(1001, 'p_partkey', 3)} AS INT) AS stock_quantity,
            {ago(draw(365 * DAY, 'p_partkey', 4))} AS created_at, {RUN_TS} AS updated_at
        FROM part"""),
    "goods": (("gen_products",), """
        SELECT id AS product_id, price, row_number() OVER (ORDER BY id) - 1 AS position, COUNT(*) OVER () AS n
        FROM gen_products"""),
    "lines": (("goods",), f"""
        SELECT o_orderkey AS order_id, unnest(range(least({draw(5, 'o_orderkey', 0)} + 1, n))) AS line, n
        FROM orders CROSS JOIN (SELECT COUNT(*) AS n FROM goods)"""),
    "gen_order_items": (("goods", "lines"), f"""
        SELECT order_id * 5 + line + 1 AS id, order_id, product_id,
            CAST({draw(3, 'order_id * 5 + line', 3)} + 1 AS INT) AS quantity, price AS unit_price,
            CAST(price * CAST({draw(3, 'order_id * 5 + line', 3)} + 1 AS INT) AS DECIMAL(12,2)) AS line_total
        FROM lines l JOIN goods g ON g.position = ({draw('l.n', 'order_id', 1)}
            + line * ({draw('greatest(1, (l.n - 1) // 5)', 'order_id', 2)} + 1)) % l.n"""),
    "buyers": (("gen_users",), """
        SELECT id AS user_id, country, row_number() OVER (ORDER BY id) - 1 AS position
        FROM gen_users WHERE is_active"""),
    "gen_orders": (("buyers", "gen_order_items"), f"""
        SELECT o_orderkey AS id, user_id, {ago(draw(180 * DAY, 'o_orderkey', 3))} AS created_at,
            (SELECT CAST(SUM(line_total) AS DECIMAL(12,2)) FROM gen_order_items i WHERE i.order_id = o_orderkey)
                AS total_amount,
            CASE WHEN {draw(100, 'o_orderkey', 5)} >= 95 THEN 'cancelled'
                WHEN {draw(100, 'o_orderkey', 5)} >= 70 THEN 'delivered'
                WHEN {draw(100, 'o_orderkey', 5)} >= 45 THEN 'shipped'
                WHEN {draw(100, 'o_orderkey', 5)} >= 5 THEN 'paid' ELSE 'pending' END AS status,
            country, {choice('stripe paypal credit_card', 'o_orderkey', 6)} AS payment_method
        FROM orders JOIN buyers
            ON position = {draw('(SELECT COUNT(*) FROM buyers)', 'o_orderkey', 4)}"""),
    "visitors": (("gen_users",), """
        SELECT id AS visitor, row_number() OVER (ORDER BY id) - 1 AS position FROM gen_users"""),
    "gen_events": (("visitors", "goods"), f"""
        SELECT event_id AS id, visitor AS user_id, kind AS event_type,
            {ago(draw(90 * DAY, 'event_id', 7))} AS event_ts,
            CASE kind WHEN 'page_view' THEN '{{"page_url":"/page/' || {draw(1000, 'event_id', 3)} || '","device":"'
                    || {choice('mobile desktop tablet', 'event_id', 4)} || '"}}'
                WHEN 'add_to_cart' THEN '{{"product_id":' || product_id || ',"quantity":'
                    || {draw(3, 'event_id', 6)} + 1 || '}}'
                ELSE '{{}}' END AS metadata
        FROM (SELECT event_id, {choice('page_view add_to_cart checkout_start purchase error', 'event_id', 2)} AS kind,
                CASE WHEN {draw(100, 'event_id', 0)} >= 10
                    THEN {draw('(SELECT COUNT(*) FROM visitors)', 'event_id', 1)} END AS pick,
                {draw('(SELECT COUNT(*) FROM goods)', 'event_id', 5)} AS cart
            FROM events) LEFT JOIN visitors ON visitors.position = pick
            LEFT JOIN goods ON goods.position = cart"""),
    "gen_crm_contacts": ((), f"""
        SELECT s_suppkey AS id, 'contact_' || s_suppkey || '@example.com' AS email,
            'first_' || s_suppkey % 1000 AS first_name, 'last_' || s_suppkey AS last_name,
            {choice('organic paid_ads referral email_campaign', 's_suppkey', 0)} AS source,
            'CAMP_' || {draw(9000, 's_suppkey', 1)} + 1000 AS campaign_id,
            {ago(draw(365 * DAY, 's_suppkey', 2))} AS created_at,
            {draw(100, 's_suppkey', 3)} < 40 AS converted,
            CASE WHEN {draw(100, 's_suppkey', 3)} < 40
                THEN {ago(draw(draw(365 * DAY, 's_suppkey', 2) + ' + 1', 's_suppkey', 4))} END AS converted_at
        FROM supplier"""),
}


def _with(names, seen: dict[str, str]) -> dict[str, str]:
    for name in names:
        if name not in seen:
            needs, body = VIEWS[name]
            _with(needs, seen)
            seen[name] = body
    return seen


def sql(body: str, *views: str) -> str:
    """A query with the views it names, each after the ones it reads. A view is computed once."""
    if not views:
        return body
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({b})" for n, b in _with(views, {}).items())
    return f"WITH {ctes}\n{body}"


def view(name: str, columns: str = "*") -> str:
    return sql(f"SELECT {columns} FROM {name}", name)
