"""Independent SQL for every registered query, in DuckDB's dialect over the given tables."""

from __future__ import annotations

# Fixed values, written out here so that the SQL shares nothing with what it checks.
CITIES = (
    ('New York', 'US', 40.71, -74.01),
    ('London', 'UK', 51.51, -0.13),
    ('Tokyo', 'JP', 35.68, 139.69),
    ('Sydney', 'AU', -33.87, 151.21),
    ('Paris', 'FR', 48.86, 2.35),
    ('Berlin', 'DE', 52.52, 13.4),
    ('Mumbai', 'IN', 19.08, 72.88),
    ('Toronto', 'CA', 43.65, -79.38),
    ('Colombo', 'LK', 6.93, 79.85),
    ('Dubai', 'AE', 25.2, 55.27),
    ('Singapore', 'SG', 1.35, 103.82),
    ('Sao Paulo', 'BR', -23.55, -46.63),
    ('Cairo', 'EG', 30.04, 31.24),
    ('Seoul', 'KR', 37.57, 126.98),
    ('Moscow', 'RU', 55.76, 37.62),
)
WEATHER_CODES = {
    0: 'Clear sky',
    1: 'Mainly clear',
    2: 'Partly cloudy',
    3: 'Overcast',
    45: 'Foggy',
    48: 'Rime fog',
    51: 'Light drizzle',
    53: 'Moderate drizzle',
    55: 'Dense drizzle',
    61: 'Slight rain',
    63: 'Moderate rain',
    65: 'Heavy rain',
    71: 'Slight snow',
    73: 'Moderate snow',
    75: 'Heavy snow',
    80: 'Slight showers',
    81: 'Moderate showers',
    82: 'Violent showers',
    95: 'Thunderstorm',
    96: 'Thunderstorm with hail',
}
MAJOR_CURRENCIES = ('EUR', 'GBP', 'JPY', 'AUD', 'CAD', 'CHF', 'CNY', 'INR', 'KRW', 'BRL', 'SGD', 'NZD', 'MXN', 'ZAR', 'SEK')


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def hu(x: str, places: int = 2) -> str:
    """Round half away from zero on doubles."""
    s = dbl(str(10**places))
    return f"(sign({dbl(x)}) * floor(abs({dbl(x)}) * {s} + {dbl('0.5')}) / {s} + {dbl('0')})"


def div(a: str, b: str) -> str:
    return f"({dbl(a)} / NULLIF({dbl(b)}, {dbl('0')}))"


def pct(a: str, b: str, places: int = 1) -> str:
    return hu(f"{div(a, b)} * {dbl('100')}", places)


def avg(a: str, n: str, places: int = 2) -> str:
    return hu(div(a, n), places)


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def int_(x: str) -> str:
    return f"CAST({x} AS INTEGER)"


# The star as common table expressions.
STAR = {
    "signup": "SELECT o_custkey AS customer_id, CAST(min(o_orderdate) AS DATE) AS signup_date FROM orders GROUP BY o_custkey",
    "dim_customers": """
        SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
               lower(replace(c_name, '#', '.')) || '@example.com' AS email, n_name AS country, r_name AS city,
               c_mktsegment AS age_group, signup_date
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
        LEFT JOIN signup ON signup.customer_id = c_custkey""",
    "dim_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS subcategory,
               CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST('0.60' AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS cost_price
        FROM part""",
    "dim_date": """
        SELECT CAST(date_diff('day', DATE '1995-01-01', d) + 1 AS BIGINT) AS date_id, d AS full_date,
               CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
               monthname(d) AS month_name, CAST(weekofyear(d) AS INTEGER) AS week,
               CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
               CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""",
    "dim_channels": """
        SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS channel_id, o_orderpriority AS channel_name,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Direct' ELSE 'Online' END AS channel_type
        FROM orders""",
    "fact_lines": """
        SELECT l_orderkey AS sale_id, o_custkey AS customer_id, l_partkey AS product_id,
               CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) + 1 AS BIGINT) AS date_id,
               CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS channel_id, CAST(l_quantity AS INTEGER) AS quantity,
               unit_price, cost_price, CAST(l_discount AS DECIMAL(4,2)) AS discount,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS total_amount
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN dim_products ON l_partkey = product_id""",
    "fact_sales": """
        SELECT sale_id, customer_id, product_id, date_id, channel_id, quantity, unit_price, discount, total_amount,
               CAST(total_amount - CAST(quantity * cost_price AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS profit
        FROM fact_lines""",
    "fact_user_activity": """
        SELECT user_id * 100000 + date_diff('day', DATE '1995-01-01', CAST(ts AS DATE)) + 1 AS activity_id,
               user_id AS customer_id, CAST(date_diff('day', DATE '1995-01-01', CAST(ts AS DATE)) + 1 AS BIGINT) AS date_id,
               user_id % 5 + 1 AS channel_id,
               CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / CAST(1000000 AS DOUBLE)) AS INTEGER) AS session_duration_sec,
               CAST(count(*) FILTER (WHERE event_type = 'view') AS INTEGER) AS pages_viewed,
               CAST(count(*) FILTER (WHERE event_type IN ('click', 'purchase')) AS INTEGER) AS actions_taken,
               CASE WHEN count(*) = 1 THEN 1 ELSE 0 END AS bounce
        FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    "sent": """
        SELECT event_id, CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
                         WHEN 'purchase' THEN 'purchase' WHEN 'signup' THEN 'search' WHEN 'error' THEN 'logout' END AS event_type,
               user_id AS customer_id, ts AS event_time, ts AS processing_time,
               CASE user_id % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile' ELSE 'api' END AS channel,
               '/page/' || json_extract_string(props, '$.k') AS page, 'sess_' || user_id AS session_id,
               CASE WHEN event_type = 'purchase' THEN value END AS value,
               CAST((CAST(event_id AS HUGEINT) * 2850178706419532849) % 4611686018427387847 AS BIGINT) AS arrival
        FROM events""",
    "stream_events": """
        SELECT * FROM sent UNION ALL
        SELECT * REPLACE (arrival + 4611686018427387847 AS arrival) FROM sent WHERE event_id % 10 = 0""",
}


def star(query: str, **more: str) -> str:
    """`query` after the star tables and further common table expressions."""
    parts = {**STAR, **more}
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items()) + "\n" + query


MONTH = "d.year, d.month, d.month_name"
BY_DATE = "fact_sales s JOIN dim_date d USING (date_id)"
MONTHLY = f"""
    SELECT {MONTH}, sum(total_amount) AS amount, sum(profit) AS gain FROM {BY_DATE} GROUP BY {MONTH}"""
SEGMENT_TIERS = (3000000, 2000000, 1500000)


def tier_sql(x: str) -> str:
    p, g, s = SEGMENT_TIERS
    return f"CASE WHEN {x} >= {p} THEN 'Platinum' WHEN {x} >= {g} THEN 'Gold' WHEN {x} >= {s} THEN 'Silver' ELSE 'Bronze' END"


SUMMARY = f"""
    SELECT c.customer_id, first_name || ' ' || last_name AS full_name, country, age_group,
           count(DISTINCT s.sale_id) AS total_orders, {dbl('sum(s.total_amount)')} AS lifetime_value,
           {avg('sum(a.session_duration_sec)', 'count(a.session_duration_sec)', 0)} AS avg_session_sec,
           {avg('sum(a.pages_viewed)', 'count(a.pages_viewed)', 1)} AS avg_pages_viewed
    FROM dim_customers c LEFT JOIN fact_sales s ON c.customer_id = s.customer_id
    LEFT JOIN fact_user_activity a ON c.customer_id = a.customer_id
    GROUP BY c.customer_id, full_name, country, age_group"""

PERFORMANCE = f"""
    SELECT p.product_id, product_name, category, subcategory, count(s.sale_id) AS times_sold,
           {big('sum(s.quantity)')} AS total_units_sold, {dbl('sum(s.total_amount)')} AS total_revenue,
           {dbl('sum(s.profit)')} AS total_profit, {pct('sum(s.profit)', 'sum(s.total_amount)')} AS profit_margin_pct
    FROM dim_products p LEFT JOIN fact_sales s ON p.product_id = s.product_id
    GROUP BY p.product_id, product_name, category, subcategory"""

RFM_RAW = """
    SELECT c.customer_id, first_name || ' ' || last_name AS customer_name, country,
           CAST(date_diff('day', max(full_date), DATE '2001-08-01') AS INTEGER) AS recency_days,
           count(DISTINCT sale_id) AS frequency, sum(total_amount) AS monetary
    FROM dim_customers c JOIN fact_sales s ON c.customer_id = s.customer_id JOIN dim_date d USING (date_id)
    GROUP BY c.customer_id, customer_name, country"""
RFM_SCORED = """
    SELECT *, CAST(ntile(5) OVER (ORDER BY recency_days DESC, customer_id) AS INTEGER) AS r_score,
           CAST(ntile(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS f_score,
           CAST(ntile(5) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS m_score
    FROM rfm_raw"""
RFM = f"""
    SELECT customer_id, customer_name, country, recency_days, frequency, {dbl('monetary')} AS monetary,
           r_score, f_score, m_score, r_score + f_score + m_score AS rfm_total,
           CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
                WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customers'
                WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customers'
                WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
                WHEN r_score <= 2 AND f_score <= 2 THEN 'Lost' ELSE 'Potential Loyalists' END AS rfm_segment
    FROM rfm_scored"""
RFM_PARTS = {"rfm_raw": RFM_RAW, "rfm_scored": RFM_SCORED, "rfm": RFM}

PARETO_PARTS = {
    "bought": """
        SELECT c.customer_id, first_name || ' ' || last_name AS name, sum(total_amount) AS amount
        FROM fact_sales s JOIN dim_customers c ON s.customer_id = c.customer_id GROUP BY c.customer_id, name""",
    "ranked": """
        SELECT *, sum(amount) OVER (ORDER BY amount DESC) AS running, sum(amount) OVER () AS everything,
               row_number() OVER (ORDER BY amount DESC, customer_id) AS rank_num, count(*) OVER () AS n
        FROM bought""",
    "pareto": f"""
        SELECT rank_num, customer_id, name, {dbl('amount')} AS revenue, {dbl('running')} AS cumulative_revenue,
               {hu(div('running', 'everything') + ' * ' + dbl('100'), 1)} AS cumulative_pct,
               {pct('rank_num', 'n')} AS customer_percentile,
               CASE WHEN {div('running', 'everything')} <= {dbl('0.8')} THEN 'Top 80% Revenue'
                    ELSE 'Bottom 20% Revenue' END AS pareto_group
        FROM ranked""",
}

CLV = f"""
    SELECT customer_id, name, country, total_purchases, {dbl('amount')} AS total_spent, avg_purchase_value,
           active_months, lifespan_days, {hu(div('total_purchases', 'active_months'))} AS purchase_freq_monthly,
           {hu('avg_purchase_value * ' + div('total_purchases', 'active_months') + ' * ' + dbl('24'))} AS predicted_clv_24m
    FROM metrics WHERE total_purchases > 1"""
METRICS = f"""
    SELECT c.customer_id, first_name || ' ' || last_name AS name, country, count(DISTINCT sale_id) AS total_purchases,
           sum(total_amount) AS amount, {avg('sum(total_amount)', 'count(total_amount)')} AS avg_purchase_value,
           CAST(date_diff('day', min(full_date), max(full_date)) AS INTEGER) AS lifespan_days,
           count(DISTINCT strftime(full_date, '%Y-%m')) AS active_months
    FROM dim_customers c JOIN fact_sales s ON c.customer_id = s.customer_id JOIN dim_date d USING (date_id)
    GROUP BY c.customer_id, name, country"""

SALES_SQL = {
    "v_monthly_sales": star(f"""
        SELECT {MONTH}, category, channel_name, count(sale_id) AS total_orders, {big('sum(quantity)')} AS total_units,
               {dbl('sum(total_amount)')} AS total_revenue, {dbl('sum(profit)')} AS total_profit,
               {avg('sum(total_amount)', 'count(total_amount)')} AS avg_order_value
        FROM {BY_DATE} JOIN dim_products p ON s.product_id = p.product_id JOIN dim_channels ch ON s.channel_id = ch.channel_id
        GROUP BY {MONTH}, category, channel_name"""),
    "v_customer_summary": star(SUMMARY),
    "v_customer_summary_true_value": star(f"""
        SELECT v.* REPLACE ({dbl('t.amount')} AS lifetime_value) FROM ({SUMMARY}) v
        LEFT JOIN (SELECT customer_id, sum(total_amount) AS amount FROM fact_sales GROUP BY customer_id) t
        ON v.customer_id = t.customer_id"""),
    "v_product_performance": star(PERFORMANCE),
    "products_by_category": star(f"""
        SELECT v.category, count(*) AS products, {avg('sum(p.unit_price)', 'count(p.unit_price)')} AS avg_unit_price,
               {hu(div('sum(CAST(v.profit_margin_pct * 10 AS BIGINT))', 'count(v.profit_margin_pct)') + ' / ' + dbl('10'), 1)} AS avg_margin_pct
        FROM ({PERFORMANCE}) v JOIN dim_products p ON v.product_id = p.product_id GROUP BY v.category"""),
    "overview": star(f"""
        SELECT {dbl('sum(total_amount)')} AS total_revenue, {dbl('sum(profit)')} AS total_profit, count(*) AS total_orders,
               (SELECT count(*) FROM dim_customers) AS total_customers, (SELECT count(*) FROM dim_products) AS total_products,
               {avg('sum(total_amount)', 'count(total_amount)')} AS avg_order_value,
               (SELECT count(*) FROM fact_user_activity) AS total_sessions,
               (SELECT {pct('sum(bounce)', 'count(*)')} FROM fact_user_activity) AS bounce_rate
        FROM fact_sales"""),
    "monthly_sales": star(f"""
        SELECT {MONTH}, count(sale_id) AS orders, {dbl('sum(total_amount)')} AS revenue, {dbl('sum(profit)')} AS profit,
               count(DISTINCT customer_id) AS unique_customers
        FROM {BY_DATE} GROUP BY {MONTH} ORDER BY year, month"""),
    "landed_schema_versions": """
        SELECT * FROM (VALUES
            ('v0', 'customer_id', 'same'), ('v0', 'email', 'same'), ('v0', 'credit', 'widened'), ('v0', 'phone', 'missing'),
            ('v1', 'customer_id', 'same'), ('v1', 'email', 'same'), ('v1', 'credit', 'widened'), ('v1', 'phone', 'missing'), ('v1', 'city', 'added'),
            ('v2', 'customer_id', 'same'), ('v2', 'email', 'same'), ('v2', 'credit', 'changed'), ('v2', 'phone', 'missing')) t(version, field, verdict)""",
    "landed_in_declared_schema": star("""
        SELECT customer_id, email, CASE WHEN customer_id % 3 = 0 THEN CAST(customer_id AS DOUBLE) ELSE customer_id + CAST(0.5 AS DOUBLE) END AS credit,
               CAST(NULL AS VARCHAR) AS phone
        FROM dim_customers WHERE customer_id % 3 < 2"""),
    "landed_in_other_schema": star("""
        SELECT customer_id, 'credit: double became STRING' AS problem FROM dim_customers WHERE customer_id % 3 = 2"""),
    "approximate_reach": star("""
        SELECT CAST(year * 100 + month AS BIGINT) AS year_month, CAST(NULL AS BIGINT) AS channel_id, count(DISTINCT customer_id) AS unique_customers,
               TRUE AS within_error
        FROM fact_sales JOIN dim_date USING (date_id) GROUP BY 1
        UNION ALL SELECT NULL, channel_id, count(DISTINCT customer_id), TRUE FROM fact_sales GROUP BY channel_id
        UNION ALL SELECT NULL, NULL, count(DISTINCT customer_id), TRUE FROM fact_sales"""),
    "sales_by_category": star(f"""
        SELECT category, count(sale_id) AS orders, {dbl('sum(total_amount)')} AS revenue, {dbl('sum(profit)')} AS profit,
               {pct('sum(profit)', 'sum(total_amount)')} AS margin_pct
        FROM fact_sales s JOIN dim_products p ON s.product_id = p.product_id GROUP BY category ORDER BY revenue DESC"""),
    "sales_by_channel": star(f"""
        SELECT channel_name, channel_type, count(sale_id) AS orders, {dbl('sum(total_amount)')} AS revenue,
               {avg('sum(total_amount)', 'count(total_amount)')} AS avg_order_value
        FROM fact_sales s JOIN dim_channels ch ON s.channel_id = ch.channel_id
        GROUP BY ch.channel_id, channel_name, channel_type ORDER BY revenue DESC"""),
    "sales_by_country": star(f"""
        SELECT country, count(DISTINCT c.customer_id) AS customers, count(sale_id) AS orders, {dbl('sum(total_amount)')} AS revenue
        FROM fact_sales s JOIN dim_customers c ON s.customer_id = c.customer_id GROUP BY country ORDER BY revenue DESC"""),
    "sales_by_country_top": star(f"""
        SELECT country, count(DISTINCT c.customer_id) AS customers, count(sale_id) AS orders, {dbl('sum(total_amount)')} AS revenue
        FROM fact_sales s JOIN dim_customers c ON s.customer_id = c.customer_id GROUP BY country
        ORDER BY revenue DESC, country LIMIT 10"""),
    "daily_pattern": star(f"""
        SELECT day_name, day_of_week, count(sale_id) AS orders, {dbl('sum(total_amount)')} AS revenue,
               {avg('sum(total_amount)', 'count(total_amount)')} AS avg_order
        FROM {BY_DATE} GROUP BY day_name, day_of_week ORDER BY day_of_week"""),
    "top_products": star(f"""
        SELECT p.product_id, product_name, category, {big('sum(quantity)')} AS units_sold,
               {dbl('sum(total_amount)')} AS revenue, {dbl('sum(profit)')} AS profit
        FROM fact_sales s JOIN dim_products p ON s.product_id = p.product_id
        GROUP BY p.product_id, product_name, category ORDER BY sum(total_amount) DESC, p.product_id LIMIT 10"""),
    "customer_segments": star(f"""
        SELECT segment, count(*) AS customer_count, {avg('sum(lv)', 'count(*)')} AS avg_ltv,
               {avg('sum(orders)', 'count(*)', 1)} AS avg_orders
        FROM (SELECT {tier_sql('lv')} AS segment, * FROM (
            SELECT c.customer_id, coalesce(sum(total_amount), 0) AS lv, count(sale_id) AS orders
            FROM dim_customers c LEFT JOIN fact_sales s ON c.customer_id = s.customer_id GROUP BY c.customer_id))
        GROUP BY segment ORDER BY avg_ltv DESC"""),
    "customer_segments_view": star(f"""
        SELECT segment, count(*) AS customer_count,
               {avg('sum(CAST(lifetime_value AS DECIMAL(20,2)))', 'count(lifetime_value)')} AS avg_ltv,
               {avg('sum(total_orders)', 'count(*)', 1)} AS avg_orders
        FROM (SELECT {tier_sql('lifetime_value')} AS segment, * FROM ({SUMMARY})) GROUP BY segment ORDER BY avg_ltv DESC"""),
    "engagement_by_channel": star(f"""
        SELECT channel_name, count(activity_id) AS sessions,
               {avg('sum(session_duration_sec)', 'count(session_duration_sec)', 0)} AS avg_duration_sec,
               {avg('sum(pages_viewed)', 'count(pages_viewed)', 1)} AS avg_pages, {pct('sum(bounce)', 'count(*)')} AS bounce_rate_pct
        FROM fact_user_activity a JOIN dim_channels ch ON a.channel_id = ch.channel_id
        GROUP BY ch.channel_id, channel_name ORDER BY sessions DESC"""),
    "customers_by_country": star(
        "SELECT country, count(*) AS customers FROM dim_customers GROUP BY country ORDER BY customers DESC, country"),
}

LAG = "lag(amount) OVER (ORDER BY year, month)"
THREE = "OVER (ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
NEAR = "OVER (ORDER BY full_date ROWS BETWEEN 15 PRECEDING AND 15 FOLLOWING)"

ADVANCED_SQL = {
    "monthly_trend": star(f"""
        SELECT year, month, month_name, {dbl('amount')} AS revenue, {dbl('gain')} AS profit,
               {dbl('sum(amount) OVER (ORDER BY year, month)')} AS cumulative_revenue,
               {hu(div(f'sum(amount) {THREE}', f'count(amount) {THREE}'))} AS moving_avg_3m,
               {dbl(f'amount - {LAG}')} AS mom_change, {pct(f'(amount - {LAG})', LAG)} AS mom_pct_change,
               rank() OVER (ORDER BY amount DESC) AS revenue_rank
        FROM monthly ORDER BY year, month""", monthly=MONTHLY),
    "cohort_retention": star(f"""
        SELECT a.cohort_month, z.cohort_size, a.months_since_first, a.active_customers,
               {pct('a.active_customers', 'z.cohort_size')} AS retention_pct
        FROM active a JOIN (SELECT cohort_month, max(active_customers) AS cohort_size FROM active
                            WHERE months_since_first = 0 GROUP BY cohort_month) z ON a.cohort_month = z.cohort_month
        WHERE a.months_since_first <= 12 ORDER BY a.cohort_month, a.months_since_first""",
        first_buy="""
            SELECT c.customer_id, strftime(signup_date, '%Y-%m') AS cohort_month, min(full_date) AS first_date
            FROM dim_customers c JOIN fact_sales s ON c.customer_id = s.customer_id JOIN dim_date d USING (date_id)
            GROUP BY c.customer_id, cohort_month""",
        active="""
            SELECT cohort_month, CAST(date_diff('day', first_date, full_date) // 30 AS INTEGER) AS months_since_first,
                   count(DISTINCT f.customer_id) AS active_customers
            FROM first_buy f JOIN fact_sales s ON f.customer_id = s.customer_id JOIN dim_date d USING (date_id)
            GROUP BY cohort_month, months_since_first"""),
    "rfm": star("SELECT * FROM rfm", **RFM_PARTS),
    "rfm_summary": star(f"""
        SELECT rfm_segment, count(*) AS customer_count, {avg('sum(CAST(monetary AS DECIMAL(20,2)))', 'count(*)')} AS avg_monetary,
               {avg('sum(frequency)', 'count(*)', 1)} AS avg_frequency, {avg('sum(recency_days)', 'count(*)', 0)} AS avg_recency_days
        FROM rfm GROUP BY rfm_segment ORDER BY avg_monetary DESC""", **RFM_PARTS),
    "market_basket": star(f"""
        SELECT product_id_a, product_id_b, p1.product_name AS product_a, p2.product_name AS product_b,
               p1.category AS category_a, p2.category AS category_b, co_occurrence, unique_customers,
               {pct('co_occurrence', '(SELECT count(DISTINCT sale_id) FROM fact_sales)', 2)} AS support_pct
        FROM pairs JOIN dim_products p1 ON product_id_a = p1.product_id JOIN dim_products p2 ON product_id_b = p2.product_id
        ORDER BY co_occurrence DESC, product_id_a, product_id_b LIMIT 20""",
        pairs="""
            SELECT s1.product_id AS product_id_a, s2.product_id AS product_id_b, count(*) AS co_occurrence,
                   count(DISTINCT s1.customer_id) AS unique_customers
            FROM fact_sales s1 JOIN fact_sales s2 ON s1.customer_id = s2.customer_id AND s1.date_id = s2.date_id
                 AND s1.product_id < s2.product_id
            GROUP BY s1.product_id, s2.product_id HAVING count(*) >= 3"""),
    "pareto": star("SELECT * FROM pareto", **PARETO_PARTS),
    "pareto_sampled": star("""
        SELECT rank_num, customer_percentile, cumulative_pct FROM pareto, (SELECT max(rank_num) AS n FROM pareto)
        WHERE (rank_num - 1) % greatest(1, n // 100) = 0 OR rank_num = n ORDER BY rank_num""", **PARETO_PARTS),
    "ts_decompose": star(f"""
        SELECT full_date, daily_revenue, trend_component, seasonal_component,
               {hu('daily_revenue - trend_component - seasonal_component')} AS residual
        FROM (SELECT full_date, {dbl('amount')} AS daily_revenue,
                     {hu(div(f'sum(amount) {NEAR}', f'count(amount) {NEAR}'))} AS trend_component,
                     {hu(div('sum(amount) OVER (PARTITION BY day_of_week)', 'count(amount) OVER (PARTITION BY day_of_week)'))} AS seasonal_component
              FROM (SELECT full_date, day_of_week, sum(total_amount) AS amount FROM {BY_DATE} GROUP BY full_date, day_of_week))
        ORDER BY full_date"""),
    "clv": star(f"SELECT * FROM ({CLV}) ORDER BY predicted_clv_24m DESC, customer_id LIMIT 50", metrics=METRICS),
    "clv_all": star(CLV, metrics=METRICS),
    "channel_attribution": star(f"""
        SELECT channel_name, channel_type, conversions, {dbl('amount')} AS attributed_revenue, unique_customers,
               avg_order_value, {dbl('gain')} AS attributed_profit, {pct('amount', 'sum(amount) OVER ()')} AS revenue_share_pct,
               {pct('conversions', 'sum(conversions) OVER ()')} AS conversion_share_pct,
               {pct('gain', 'amount')} AS profit_margin_pct, rank() OVER (ORDER BY amount DESC) AS revenue_rank,
               rank() OVER (ORDER BY {div('gain', 'amount')} DESC) AS efficiency_rank
        FROM (SELECT channel_name, channel_type, count(sale_id) AS conversions, sum(total_amount) AS amount,
                     count(DISTINCT customer_id) AS unique_customers,
                     {avg('sum(total_amount)', 'count(total_amount)')} AS avg_order_value, sum(profit) AS gain
              FROM fact_sales s JOIN dim_channels ch ON s.channel_id = ch.channel_id
              GROUP BY ch.channel_id, channel_name, channel_type)
        ORDER BY amount DESC"""),
    "revenue_forecast": star(f"""
        SELECT CAST((first + x) // 12 AS INTEGER) AS year, CAST((first + x) % 12 + 1 AS INTEGER) AS month,
               {hu('intercept + slope * x', 0)} AS forecast_revenue
        FROM (SELECT first, slope, intercept, last + step AS x FROM (
                SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, max(x) AS last, min(m) AS first
                FROM (SELECT m, y, m - min(m) OVER () AS x FROM (
                    SELECT year * 12 + month - 1 AS m, {dbl('amount')} AS y FROM monthly))),
              (SELECT unnest([1, 2, 3]) AS step))""", monthly=MONTHLY),
    "churn_risk": star(f"""
        SELECT customer_id, purchase_days, recency_days, {hu('gap', 1)} AS mean_gap_days,
               CASE WHEN gap IS NULL THEN 'Unknown' WHEN {div('recency_days', 'gap')} > 3 THEN 'High'
                    WHEN {div('recency_days', 'gap')} > {dbl('1.5')} THEN 'Medium' ELSE 'Low' END AS churn_risk
        FROM (SELECT customer_id, count(*) AS purchase_days,
                     CAST(date_diff('day', max(full_date), DATE '2001-08-01') AS INTEGER) AS recency_days,
                     {div("date_diff('day', min(full_date), max(full_date))", 'count(*) - 1')} AS gap
              FROM (SELECT DISTINCT customer_id, full_date FROM {BY_DATE}) GROUP BY customer_id)
        WHERE customer_id IN (SELECT customer_id FROM dim_customers)"""),
}


def check(category: str, name: str, status: str, severity: str, details: str, source: str) -> str:
    return (f"SELECT '{category}' AS category, {name} AS \"check\", {status} AS status, {severity} AS severity, "
            f"{details} AS details FROM {source}")


def fixed(x: str, places: int) -> str:
    return f"printf('%.{places}f', {hu(x, places)})"


def txt(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def complete_sql(table: str, column: str, text: bool) -> str:
    missing = f"{column} IS NULL" + (f" OR {column} = ''" if text else "")
    share = f"coalesce({pct('missing', 'n', 2)}, {dbl('0')})"
    return check(
        "Completeness", f"'{table}.{column} null check'",
        f"CASE WHEN {share} = 0 THEN 'PASS' WHEN {share} < 5 THEN 'WARN' ELSE 'FAIL' END",
        f"CASE WHEN {share} = 0 THEN 'INFO' WHEN {share} < 5 THEN 'MEDIUM' ELSE 'HIGH' END",
        f"missing || '/' || n || ' nulls (' || {txt(share)} || '%)'",
        f"(SELECT count(*) AS n, count(*) FILTER (WHERE {missing}) AS missing FROM {table})")


def unique_sql(table: str, column: str) -> str:
    return check(
        "Uniqueness", f"'{table}.{column} uniqueness'", "CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END",
        "CASE WHEN n > 0 THEN 'HIGH' ELSE 'INFO' END", "n || ' duplicates found'",
        f"(SELECT count({column}) - count(DISTINCT {column}) AS n FROM {table})")


def orphan_sql(child: str, key: str, parent: str, parent_key: str) -> str:
    return check(
        "Referential Integrity", f"'{child}.{key} -> {parent}.{parent_key}'", "CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END",
        "CASE WHEN n > 0 THEN 'CRITICAL' ELSE 'INFO' END", "n || ' orphan records'",
        f"(SELECT count(*) AS n FROM {child} c LEFT JOIN {parent} p ON c.{key} = p.{parent_key} WHERE p.{parent_key} IS NULL)")


def rule_sql(name: str, table: str, violation: str, on_fail: str, details: str, severity: str | None = None) -> str:
    name = name.replace("'", "''")
    return check(
        "Business Rules", f"'{name}'", f"CASE WHEN n = 0 THEN 'PASS' ELSE '{on_fail}' END",
        f"'{severity}'" if severity else "CASE WHEN n > 0 THEN 'HIGH' ELSE 'INFO' END", f"n || ' {details}'",
        f"(SELECT count(*) FILTER (WHERE {violation}) AS n FROM {table})")


TEXT = {"first_name", "last_name", "email", "country", "city", "age_group", "product_name", "category", "subcategory"}
COMPLETENESS = " UNION ALL ".join(
    complete_sql(table, column, column in TEXT)
    for table, columns in {
        "dim_customers": ["first_name", "last_name", "email", "country", "city", "age_group"],
        "dim_products": ["product_name", "category", "subcategory", "unit_price", "cost_price"],
        "fact_sales": ["customer_id", "product_id", "date_id", "quantity", "total_amount", "profit"],
        "fact_user_activity": ["customer_id", "date_id", "session_duration_sec", "pages_viewed"],
    }.items() for column in columns)
UNIQUENESS = " UNION ALL ".join(unique_sql(*pair) for pair in [
    ("dim_customers", "customer_id"), ("dim_customers", "email"), ("dim_products", "product_id"),
    ("fact_sales", "sale_id"), ("fact_user_activity", "activity_id")])
INTEGRITY = " UNION ALL ".join(orphan_sql(child, key, parent, key) for child, key, parent in [
    ("fact_sales", "customer_id", "dim_customers"), ("fact_sales", "product_id", "dim_products"),
    ("fact_sales", "date_id", "dim_date"), ("fact_sales", "channel_id", "dim_channels"),
    ("fact_user_activity", "customer_id", "dim_customers"), ("fact_user_activity", "date_id", "dim_date"),
    ("fact_user_activity", "channel_id", "dim_channels")])

IQR_BOUNDS = f"""
    SELECT count(*) AS rows, any_value(q1) AS q1, any_value(q3) AS q3, any_value(lo) AS lower_bound, any_value(hi) AS upper_bound,
           count(*) FILTER (WHERE total_amount < lo OR total_amount > hi) AS outliers
    FROM (SELECT {dbl('total_amount')} AS total_amount FROM fact_sales),
         (SELECT q1, q3, q1 - {dbl('1.5')} * (q3 - q1) AS lo, q3 + {dbl('1.5')} * (q3 - q1) AS hi
          FROM (SELECT {dbl('min(total_amount) FILTER (WHERE i = n // 4)')} AS q1,
                       {dbl('min(total_amount) FILTER (WHERE i = 3 * n // 4)')} AS q3
                FROM (SELECT total_amount, row_number() OVER (ORDER BY total_amount) - 1 AS i, count(*) OVER () AS n FROM fact_sales)))"""
IQR_PCT = pct("outliers", "rows", 2)
IQR = check(
    "Outliers", "'Sales amount IQR outliers'", f"CASE WHEN {IQR_PCT} > 5 THEN 'WARN' ELSE 'PASS' END",
    f"CASE WHEN {IQR_PCT} > 5 THEN 'MEDIUM' ELSE 'INFO' END",
    f"outliers || ' outliers (' || {txt(IQR_PCT)} || '%), bounds=[' || {fixed('lower_bound', 2)} || ', ' || {fixed('upper_bound', 2)} || ']'",
    f"({IQR_BOUNDS})")
ZSCORE = check(
    "Outliers", "'Session duration Z-score outliers (|z|>3)'", f"CASE WHEN n > rows * {dbl('0.01')} THEN 'WARN' ELSE 'PASS' END",
    "'MEDIUM'", f"n || ' outliers (mean=' || {fixed('m', 0)} || 's, std=' || {fixed('sd', 0)} || 's)'",
    f"""(SELECT count(*) AS rows, any_value(m) AS m, any_value(sd) AS sd,
                count(*) FILTER (WHERE abs({div('session_duration_sec - m', 'sd')}) > 3) AS n
         FROM fact_user_activity, (SELECT avg(session_duration_sec) AS m, stddev_pop(session_duration_sec) AS sd FROM fact_user_activity))""")
CV = check(
    "Distribution", "'Category sales distribution (CV)'", "CASE WHEN cv < 50 THEN 'PASS' ELSE 'WARN' END", "'MEDIUM'",
    f"'CV=' || {fixed('cv', 1)} || '% across ' || k || ' categories'",
    f"""(SELECT count(*) AS k, {div('stddev_pop(n)', 'avg(n)')} * {dbl('100')} AS cv FROM (
         SELECT category, count(*) AS n FROM fact_sales s JOIN dim_products p ON s.product_id = p.product_id GROUP BY category))""")
HHI = check(
    "Distribution", "'Revenue concentration (HHI index)'", "CASE WHEN hhi < 2500 THEN 'PASS' ELSE 'WARN' END", "'INFO'",
    f"'HHI=' || {fixed('hhi', 0)} || ' (>2500=concentrated, <1500=diverse)'",
    f"""(SELECT sum(pow({div('amount', 'everything')}, 2)) * 10000 AS hhi FROM (
         SELECT country, sum(total_amount) AS amount, sum(sum(total_amount)) OVER () AS everything
         FROM fact_sales s JOIN dim_customers c ON s.customer_id = c.customer_id GROUP BY country))""")
BENFORD = check(
    "Distribution", "'Benford''s Law compliance (sales amounts)'", "CASE WHEN gap < 0.05 THEN 'PASS' ELSE 'WARN' END", "'INFO'",
    f"'Max digit deviation=' || {fixed('gap', 4)} || ' (threshold=0.05)'",
    f"""(SELECT max(abs({div('coalesce(n, 0)', 'everything')} - log10(1 + {dbl('1')} / d))) AS gap
         FROM (SELECT unnest(range(1, 10)) AS d)
         LEFT JOIN (SELECT CAST(regexp_extract(CAST(total_amount AS VARCHAR), '[1-9]') AS BIGINT) AS digit, count(*) AS n
                    FROM fact_sales WHERE total_amount > 0 GROUP BY digit) ON d = digit
         CROSS JOIN (SELECT count(*) AS everything FROM fact_sales WHERE total_amount > 0))""")
COVERAGE = check(
    "Temporal", "'Sales date coverage'", f"CASE WHEN {pct('covered', 'days')} > 90 THEN 'PASS' ELSE 'WARN' END", "'MEDIUM'",
    f"covered || '/' || days || ' dates covered (' || {txt(pct('covered', 'days'))} || '%)'",
    f"(SELECT count(DISTINCT full_date) AS covered, (SELECT count(*) FROM dim_date) AS days FROM {BY_DATE})")
WEEKEND = check(
    "Temporal", "'Weekend sales ratio'", "'PASS'", "'INFO'", f"{txt(pct('w', 'n'))} || '% of sales on weekends (expected ~28.6%)'",
    f"(SELECT count(*) FILTER (WHERE is_weekend = 1) AS w, count(*) AS n FROM {BY_DATE})")
RULES = " UNION ALL ".join([
    rule_sql("No negative sale amounts", "fact_sales", "total_amount < 0", "FAIL", "negative sales found"),
    rule_sql("Positive sale quantities", "fact_sales", "quantity <= 0", "FAIL", "zero/negative quantities"),
    rule_sql("Product margin validation (cost < price)", "dim_products", "cost_price >= unit_price", "WARN", "products with cost >= price"),
    rule_sql("Bounce sessions page view check (<= 3)", "fact_user_activity", "bounce = 1 AND pages_viewed > 3", "WARN",
             "bounce sessions with >3 pages", "MEDIUM"),
])
AUDIT = " UNION ALL ".join([COMPLETENESS, UNIQUENESS, INTEGRITY, IQR, ZSCORE, CV, HHI, BENFORD, COVERAGE, WEEKEND, RULES])


def profile_sql(table: str, column: str) -> str:
    d = f"({dbl(column)} - m)"
    return f"""
        SELECT '{table}.{column}' AS "column", count({column}) AS count, {hu(f'min({column})')} AS min, {hu(f'max({column})')} AS max,
               any_value(m) AS mean, {hu(f'median({dbl(column)})')} AS median, {hu(f'sqrt(avg({d} * {d}))')} AS std,
               {hu(f'sum({column})')} AS total,
               coalesce({hu(div(f'avg({d} * {d} * {d})', f'pow(sqrt(avg({d} * {d})), 3)'), 3)}, {dbl('0')}) AS skewness
        FROM {table}, (SELECT {avg(f'sum({column})', f'count({column})')} AS m FROM {table})"""


PROFILES = " UNION ALL ".join(profile_sql(t, c) for t, c in [
    ("fact_sales", "total_amount"), ("fact_sales", "quantity"), ("fact_sales", "profit"), ("fact_sales", "discount"),
    ("fact_user_activity", "session_duration_sec"), ("fact_user_activity", "pages_viewed")])
VALIDATE = " UNION ALL ".join(
    f"SELECT '{name}' AS \"check\", {dbl(value)} AS value, CASE WHEN {value} IS NULL THEN 'WARN' ELSE 'PASS' END AS status FROM {source}"
    for name, value, source in [
        ("Customers count", "count(*)", "dim_customers"), ("Products count", "count(*)", "dim_products"),
        ("Sales count", "count(*)", "fact_sales"), ("Activities count", "count(*)", "fact_user_activity"),
        ("Total revenue", "sum(total_amount)", "fact_sales"), ("Total profit", "sum(profit)", "fact_sales"),
        ("Orphan sales (should be 0)", "count(*)", "fact_sales WHERE customer_id NOT IN (SELECT customer_id FROM dim_customers)"),
        ("Avg session duration", avg("sum(session_duration_sec)", "count(session_duration_sec)", 0), "fact_user_activity")])

QUALITY_SQL = {
    "completeness": star(COMPLETENESS),
    "completeness_documents": " UNION ALL ".join(
        complete_sql("documents", c, c != "n_chars") for c in ["text", "lang", "source", "n_chars"]),
    "uniqueness": star(UNIQUENESS),
    "referential_integrity": star(INTEGRITY),
    "referential_integrity_labels": orphan_sql("labels", "doc_id", "documents", "doc_id"),
    "iqr_bounds": star(IQR_BOUNDS),
    "outliers": star(f"{IQR} UNION ALL {ZSCORE}"),
    "category_cv": star(CV),
    "hhi_concentration": star(HHI),
    "benford": star(BENFORD),
    "date_coverage": star(COVERAGE),
    "weekend_ratio": star(WEEKEND),
    "business_rules": star(RULES),
    "email_rules": star(" UNION ALL ".join([
        rule_sql("dim_customers.email contains @", "dim_customers", "email NOT LIKE '%@%'", "FAIL", "addresses without @"),
        rule_sql("dim_customers.email address format", "dim_customers",
                 r"NOT coalesce(regexp_matches(email, '^[^@\s]+@[^@\s]+\.[^@\s]+$'), false)", "FAIL", "malformed addresses")])),
    "profile_numeric": star(PROFILES),
    "audit": star(AUDIT),
    "quality_report_json": star(AUDIT),
    "audit_summary": star(f"""
        SELECT count(*) AS total_checks, count(*) FILTER (WHERE status = 'PASS') AS passed,
               count(*) FILTER (WHERE status = 'WARN') AS warnings, count(*) FILTER (WHERE status = 'FAIL') AS failures,
               {pct("count(*) FILTER (WHERE status = 'PASS')", 'count(*)')} AS score
        FROM ({AUDIT})"""),
    "checks_by_category": star(f"SELECT category, count(*) AS checks FROM ({AUDIT}) GROUP BY category"),
    "post_load_validate": star(VALIDATE),
    "distribution_drift": f"""
        SELECT category, n_before, n_after, {hu('(q - p) * ln(q / p)', 6)} AS psi
        FROM (SELECT category, n_before, n_after, {div('n_before', 'sum(n_before) OVER ()')} AS p,
                     {div('n_after', 'sum(n_after) OVER ()')} AS q
              FROM (SELECT l_returnflag AS category, count(*) FILTER (WHERE l_shipdate < TIMESTAMP '1998-06-01') AS n_before,
                           count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '1998-06-01') AS n_after
                    FROM lineitem GROUP BY l_returnflag))""",
}


def title_sql(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '(\\p{{L}}+|\\P{{L}}+)'), "
            f"lambda r: upper(substr(r, 1, 1)) || lower(substr(r, 2))), '')")


LANDED = """
    SELECT l_orderkey AS sale_id, l_suppkey AS customer_id, l_partkey AS product_id, CAST(l_linenumber AS BIGINT) AS date_id,
           CAST(1 AS BIGINT) AS channel_id, l_returnflag, CAST(l_quantity AS INTEGER) AS quantity, unit_price, cost_price,
           CAST(l_discount AS DECIMAL(4,2)) AS discount, CAST(l_tax AS DECIMAL(18,2)) AS profit
    FROM lineitem LEFT JOIN dim_products ON l_partkey = product_id"""
SALE_TOTAL = "CAST(quantity * unit_price * (1 - discount) AS DECIMAL(18,2))"
LOADED = " UNION ALL ".join(
    f"SELECT 'loaded' AS phase, '{t}' AS table_name, count(*) AS rows FROM {t}"
    for t in ["dim_customers", "dim_products", "dim_date", "dim_channels", "fact_sales", "fact_user_activity"])

LOAD_SQL = {
    "build_dim_date": star("SELECT * FROM dim_date"),
    "clean_customers": star(f"""
        SELECT customer_id, {title_sql("age_group || ' o''' || first_name")} AS first_name,
               {title_sql("country || '-' || city")} AS last_name, email, {title_sql('country')} AS country,
               {title_sql('city')} AS city, age_group, signup_date
        FROM dim_customers"""),
    "clean_sales": star(f"""
        SELECT * EXCLUDE (l_returnflag, cost_price) REPLACE (CAST(unit_price AS DECIMAL(16,6)) AS unit_price, CAST(discount AS DECIMAL(8,6)) AS discount),
               {SALE_TOTAL} AS total_amount FROM landed WHERE l_returnflag <> 'R'""", landed=LANDED),
    "quarantined_sales": star("""
        SELECT * EXCLUDE (l_returnflag, cost_price) REPLACE (
                 CAST(NULL AS INTEGER) AS quantity, CAST(unit_price AS DECIMAL(16,6)) AS unit_price, CAST(discount AS DECIMAL(8,6)) AS discount),
               CAST(NULL AS DECIMAL(18,2)) AS total_amount, 'quantity' AS problem
        FROM landed WHERE l_returnflag = 'R'""", landed=LANDED),
    "derive_sale_amounts": star(f"""
        SELECT sale_id, product_id, quantity, unit_price, discount, cost_price, total_amount,
               CAST(total_amount - CAST(quantity * cost_price AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS profit
        FROM (SELECT *, {SALE_TOTAL} AS total_amount FROM landed)""", landed=LANDED),
    "read_back_sales": star("""
        SELECT sale_id, customer_id, product_id, date_id, channel_id, quantity, CAST(unit_price AS DECIMAL(16,6)) AS unit_price,
               CAST(discount AS DECIMAL(8,6)) AS discount, """ + SALE_TOTAL + """ AS total_amount, profit FROM fact_sales"""),
    "quarantined_customers": star("""
        SELECT 'record' AS problem, customer_id, CAST(NULL AS VARCHAR) AS email FROM dim_customers WHERE customer_id % 3 = 0 UNION ALL
        SELECT 'customer_id', NULL, email FROM dim_customers WHERE customer_id % 3 = 1 AND customer_id % 5 = 0"""),
    "full_refresh_load": star(LOADED),
    "etl_run_log": star(f"{LOADED} UNION ALL {LOADED.replace(chr(39) + 'loaded', chr(39) + 'extracted')} UNION ALL " + " UNION ALL ".join(
        f"SELECT 'quarantined', '{t}', 0" for t in ["dim_customers", "dim_products", "dim_date", "dim_channels", "fact_sales", "fact_user_activity"])),
    "create_if_absent": star(LOADED.replace("'loaded' AS phase, ", "") + " UNION ALL SELECT 'stream_windows', 0"),
    "materialize_views": star(f"""
        SELECT 'materialized' AS phase, 'v_customer_summary' AS table_name, count(*) AS rows FROM dim_customers UNION ALL
        SELECT 'materialized', 'v_product_performance', count(*) FROM dim_products UNION ALL
        SELECT 'materialized', 'v_monthly_sales', count(DISTINCT (year, month, category, channel_id))
        FROM {BY_DATE} JOIN dim_products p ON s.product_id = p.product_id"""),
    **{f"kept_{name}": SALES_SQL[name] for name in ("v_monthly_sales", "v_customer_summary", "v_product_performance")},
    "load_star_from_csv": star(VALIDATE.replace("fact_sales", "reloaded").replace("dim_customers", "known"), reloaded=f"""
        SELECT * REPLACE ({SALE_TOTAL} AS total_amount) FROM fact_sales""",
        known="SELECT * FROM dim_customers"),
}

INITIAL = """
    SELECT c.* EXCLUDE (signup_date), TIMESTAMP '1990-01-01' AS effective_from, TIMESTAMP '9999-12-31' AS effective_to,
           1 AS is_current, 1 AS version, 'INSERT' AS change_type
    FROM dim_customers c"""
# Changes chain per customer: carry city and age group forward, drop changes without effect, number the rest.
HISTORY_PARTS = {
    "initial": INITIAL,
    "changes": """
        SELECT o_custkey AS customer_id, o_orderdate AS changed_at, o_orderkey,
               CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS city,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS age_group
        FROM orders""",
    "steps": """
        SELECT customer_id, city, age_group, effective_from AS moment, -1 AS seq FROM initial UNION ALL
        SELECT customer_id, city, age_group, changed_at, o_orderkey FROM changes
        WHERE customer_id IN (SELECT customer_id FROM initial)""",
    "filled": """
        SELECT customer_id, moment, seq, last_value(city IGNORE NULLS) OVER w AS city, last_value(age_group IGNORE NULLS) OVER w AS age_group
        FROM steps WINDOW w AS (PARTITION BY customer_id ORDER BY moment, seq ROWS UNBOUNDED PRECEDING)""",
    "compared": """
        SELECT *, lag(city) OVER w AS old_city, lag(age_group) OVER w AS old_age FROM filled
        WINDOW w AS (PARTITION BY customer_id ORDER BY moment, seq)""",
    "effective": """
        SELECT *, CAST(row_number() OVER w AS INTEGER) AS version, lead(moment) OVER w AS next_at FROM compared
        WHERE seq = -1 OR city IS DISTINCT FROM old_city OR age_group IS DISTINCT FROM old_age
        WINDOW w AS (PARTITION BY customer_id ORDER BY moment, seq)""",
    "history": """
        SELECT i.* REPLACE (e.city AS city, e.age_group AS age_group, e.moment AS effective_from,
                            coalesce(e.next_at, TIMESTAMP '9999-12-31') AS effective_to,
                            CASE WHEN e.next_at IS NULL THEN 1 ELSE 0 END AS is_current, e.version AS version,
                            CASE WHEN e.version = 1 THEN 'INSERT' ELSE 'UPDATE' END AS change_type)
        FROM effective e JOIN initial i ON e.customer_id = i.customer_id""",
}


def json_pairs(city: str, age: str) -> str:
    pair = lambda k, v: f"'\"{k}\":' || to_json({v})"
    both = f"{pair('city', city)} || ',' || {pair('age_group', age)}"
    return (f"'{{' || CASE WHEN city IS DISTINCT FROM old_city AND age_group IS DISTINCT FROM old_age THEN {both} "
            f"WHEN city IS DISTINCT FROM old_city THEN {pair('city', city)} ELSE {pair('age_group', age)} END || '}}'")


LATEST = """
    SELECT customer_id, max_by(city, (changed_at, o_orderkey)) FILTER (WHERE city IS NOT NULL) AS new_city,
           max_by(age_group, (changed_at, o_orderkey)) FILTER (WHERE age_group IS NOT NULL) AS new_age
    FROM changes GROUP BY customer_id"""
CHANGES = f"""
        SELECT customer_id AS record_id, 'UPDATE' AS change_type,
               concat_ws(',', CASE WHEN city IS DISTINCT FROM old_city THEN 'city' END,
                         CASE WHEN age_group IS DISTINCT FROM old_age THEN 'age_group' END) AS changed_fields,
               {json_pairs('old_city', 'old_age')} AS old_values, {json_pairs('city', 'age_group')} AS new_values, moment AS changed_at
        FROM effective WHERE version > 1"""
HISTORY_SQL = {
    "scd2_initial_load": star("SELECT * FROM initial", initial=INITIAL),
    "scd2_initial_load_products": star("""
        SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, CAST(cost_price AS DOUBLE) AS cost_price),
               TIMESTAMP '1990-01-01' AS effective_from, TIMESTAMP '9999-12-31' AS effective_to,
               1 AS is_current, 1 AS version, 'INSERT' AS change_type
        FROM dim_products"""),
    "scd2_apply_changes": star("SELECT * FROM history", **HISTORY_PARTS),
    "scd_change_log": star(CHANGES, **HISTORY_PARTS),
    "stored_change_log": star(
        f"SELECT 'dim_customers' AS table_name, * REPLACE (CAST(record_id AS VARCHAR) AS record_id) FROM ({CHANGES})", **HISTORY_PARTS),
    "scd2_late_applied": star("SELECT * FROM history", **HISTORY_PARTS),
    "spliced_change_log": star(
        f"SELECT 'dim_customers' AS table_name, * REPLACE (CAST(record_id AS VARCHAR) AS record_id) FROM ({CHANGES})", **HISTORY_PARTS),
    "scd_current": star("SELECT * FROM history WHERE is_current = 1", **HISTORY_PARTS),
    "scd_history": star("SELECT * FROM history WHERE customer_id = 1 ORDER BY version", **HISTORY_PARTS),
    "scd_as_of": star("""
        SELECT * FROM history WHERE effective_from <= TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-01-01' < effective_to""",
        **HISTORY_PARTS),
    "scd_join_as_of": star("""
        SELECT o_orderkey, o_custkey AS customer_id, o_orderdate AS ordered_at, version
        FROM orders LEFT JOIN history ON o_custkey = customer_id AND effective_from <= o_orderdate AND o_orderdate < effective_to""",
        **HISTORY_PARTS),
    "scd1_apply": star("""
        SELECT c.* EXCLUDE (signup_date) REPLACE (coalesce(new_city, city) AS city, coalesce(new_age, age_group) AS age_group)
        FROM dim_customers c LEFT JOIN latest l ON c.customer_id = l.customer_id""", changes=HISTORY_PARTS["changes"], latest=LATEST),
    "scd3_apply": star("""
        SELECT c.* EXCLUDE (signup_date) REPLACE (coalesce(new_city, city) AS city, coalesce(new_age, age_group) AS age_group),
               CASE WHEN new_city <> city THEN city END AS previous_city,
               CASE WHEN new_age <> age_group THEN age_group END AS previous_age_group
        FROM dim_customers c LEFT JOIN latest l ON c.customer_id = l.customer_id""", changes=HISTORY_PARTS["changes"], latest=LATEST),
}

UNIQUE_EVENTS = "SELECT * FROM sent"
FIGURES = f"""
    count(*) AS total_events, coalesce({dbl('sum(CAST(value AS DECIMAL(18,2)))')}, 0) AS total_revenue,
    count(DISTINCT customer_id) AS unique_customers, count(*) FILTER (WHERE event_type = 'page_view') AS page_views,
    count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
    count(*) FILTER (WHERE event_type = 'add_to_cart') AS add_to_cart, count(*) FILTER (WHERE event_type = 'search') AS searches"""


def windows_sql(width: str, source: str = "sent") -> str:
    return f"SELECT time_bucket(INTERVAL '{width}', event_time) AS window_start, {FIGURES} FROM {source} GROUP BY window_start"


LATE = """
    SELECT *, lag(event_time) OVER (ORDER BY arrival, event_id) AS watermark,
           coalesce(event_time < lag(event_time) OVER (ORDER BY arrival, event_id), false) AS is_late
    FROM sent"""
STORED = """
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, customer_id, event_time, processing_time, channel, page, session_id, value
    FROM sent"""
EVENT_SQL = {
    "dedup_events": star("SELECT * FROM sent"),
    "window_aggregate": star(windows_sql("10 seconds")),
    "window_aggregate_sliding": star(windows_sql("1 hour", """(
        SELECT s.* REPLACE (date_trunc('hour', event_time) - k * INTERVAL 1 HOUR AS event_time)
        FROM sent s, (SELECT unnest([0, 1]) AS k))""")),
    "events_by_type": star("""
        SELECT date_trunc('hour', event_time) AS window_start, event_type, count(*) AS events FROM sent GROUP BY window_start, event_type"""),
    "events_by_channel": star("""
        SELECT date_trunc('hour', event_time) AS window_start, channel, count(*) AS events FROM sent GROUP BY window_start, channel"""),
    "minute_bucket": star("""
        SELECT date_trunc('minute', event_time) + to_seconds(second(event_time) // 25 * 25) AS window_start, count(*) AS events
        FROM sent GROUP BY window_start"""),
    "late_events": star(LATE),
    "all_windows": star(windows_sql("1 minute") + " ORDER BY window_start"),
    "stream_windows_latest": star(windows_sql("10 seconds") + " ORDER BY window_start DESC LIMIT 50"),
    "stream_summary": star(f"""
        SELECT (SELECT count(*) FROM sent) AS processed, (SELECT count(*) FROM stream_events) - (SELECT count(*) FROM sent) AS duplicates,
               (SELECT count(*) FILTER (WHERE is_late) FROM ({LATE})) AS late_events, count(*) AS windows,
               {hu('sum(CAST(total_revenue AS DECIMAL(18,2)))')} AS total_revenue, max(unique_customers) AS peak_customers
        FROM ({windows_sql('10 seconds')})"""),
    "insert_ignore": star("SELECT * FROM sent WHERE channel <> 'web'"),
    "upsert_replace": star("""
        SELECT * FROM mobile UNION ALL SELECT * FROM web WHERE window_start NOT IN (SELECT window_start FROM mobile)""",
        web=windows_sql("1 hour", "sent WHERE channel <> 'mobile'"),
        mobile=windows_sql("1 hour", "sent WHERE channel = 'mobile'")),
    "stream_events_sink": star(STORED),
    "stream_events_sink_bounded": star(STORED),
    "stream_events_by_slot": star(STORED),
    "stream_windows_by_slot": star(windows_sql("10 minutes")),
    "stream_windows_sink": star(windows_sql("10 minutes")),
    "stored_stream_windows": star(windows_sql("10 minutes")),
    "stream_lateness": star(f"SELECT count(*) AS processed, count(*) FILTER (WHERE is_late) AS late_events FROM ({LATE.replace('arrival, event_id', 'arrival, CAST(event_id AS VARCHAR)')})"),
    "stream_lateness_in_batches": star(f"SELECT count(*) AS processed, count(*) FILTER (WHERE is_late) AS late_events FROM ({LATE.replace('arrival, event_id', 'arrival, CAST(event_id AS VARCHAR)')})"),
    "stream_windows_in_batches": star(windows_sql("10 minutes")),
    "window_maps": star("""
        SELECT a.window_start, events_by_type, channels FROM (
          SELECT window_start, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS events_by_type
          FROM (SELECT window_start, event_type, count(*) AS n FROM cells GROUP BY ALL) GROUP BY window_start) a
        JOIN (SELECT window_start, string_agg(channel || '=' || n, ',' ORDER BY channel) AS channels
              FROM (SELECT window_start, channel, count(*) AS n FROM cells GROUP BY ALL) GROUP BY window_start) b ON a.window_start = b.window_start""",
        cells="SELECT time_bucket(INTERVAL '1 hour', event_time) AS window_start, event_type, channel FROM sent"),
}

INGESTED = "TIMESTAMP '2024-01-01' AS ingested_at"
CRYPTO = f"""
    SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS symbol, p_name AS name, p_retailprice AS current_price_usd,
           p_size * {dbl('1000')} AS market_cap, p_size * {dbl('10')} AS total_volume,
           {dbl('p_partkey % 21 - 10')} AS price_change_24h, {dbl('p_partkey % 21 - 10')} / 4 AS price_change_pct_24h,
           p_retailprice AS high_24h, p_retailprice AS low_24h, {dbl('p_size')} AS circulating_supply,
           CAST(p_partkey + 1 AS INTEGER) AS rank, p_type AS last_updated, {INGESTED}
    FROM part"""
COUNTRIES = f"""
    SELECT c_name AS name, n_name AS official_name, CASE WHEN filled THEN c_mktsegment || ', ' || n_name ELSE '' END AS capital,
           CASE WHEN filled THEN r_name ELSE '' END AS region, n_name AS subregion, CAST(floor(c_acctbal) AS BIGINT) AS population,
           {dbl('floor(c_acctbal / 10)')} AS area, CASE WHEN filled THEN c_mktsegment ELSE '' END AS languages,
           CASE WHEN filled THEN n_name || ' (' || r_name || ')' ELSE '' END AS currencies, c_mktsegment AS flag_emoji,
           CASE WHEN filled THEN {dbl('c_nationkey')} ELSE 0 END AS latitude, {dbl('0')} AS longitude,
           CASE WHEN filled THEN r_name ELSE '' END AS timezone, {INGESTED}
    FROM (SELECT *, c_custkey % 4 <> 0 AS filled FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
CITY_ROWS = ", ".join(
    f"({i}, '{name}', '{country}', CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE))"
    for i, (name, country, lat, lon) in enumerate(CITIES))
CODE_ROWS = ", ".join(f"({code}, '{text}')" for code, text in WEATHER_CODES.items())
WEATHER = f"""
    SELECT city, country, latitude, longitude, value AS temperature_c, value / 2 AS wind_speed_kmh, {dbl('k')} AS humidity_pct,
           k AS weather_code, coalesce(description, 'Code ' || k) AS weather_desc,
           strftime(ts, '%Y-%m-%dT%H:%M') AS measured_at, {INGESTED}
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
    JOIN (VALUES {CITY_ROWS}) c(position, city, country, latitude, longitude) ON user_id % 20 = position
    LEFT JOIN (VALUES {CODE_ROWS}) w(code, description) ON k = code"""
RATES = f"""
    SELECT 'USD' AS base_currency, target_currency, rate, strftime(ts, '%Y-%m-%d') AS rate_date, {INGESTED}
    FROM (SELECT ts, upper(substr(event_type, 1, 3)) AS target_currency, value AS rate FROM events UNION ALL
          SELECT ts, 'EUR', value * 2 FROM events)"""
GITHUB = f"""
    SELECT CAST(doc_id AS VARCHAR) AS repo_name, source || '/' || doc_id AS full_name, substr(text, 1, 200) AS description,
           nullif(lang, 'en') AS language, n_chars AS stars, n_chars % 97 AS forks, doc_id % 7 AS open_issues, doc_id AS watchers,
           source AS created_at, source AS updated_at, source AS html_url, {INGESTED}
    FROM documents"""
LIVE_SQL = {
    "flatten_crypto": CRYPTO,
    "flatten_countries": COUNTRIES,
    "flatten_weather": WEATHER,
    "flatten_exchange_rates": RATES,
    "flatten_github": GITHUB,
    "crypto_ranked": f"SELECT * EXCLUDE (id, ingested_at) FROM ({CRYPTO}) ORDER BY rank, name LIMIT 30",
    "crypto_summary": f"""
        SELECT count(*) AS total_coins, {hu('sum(market_cap)', 0)} AS total_market_cap, {hu('sum(total_volume)', 0)} AS total_volume_24h,
               {hu('avg(price_change_pct_24h)')} AS avg_change_pct, count(*) FILTER (WHERE price_change_pct_24h > 0) AS gainers,
               count(*) FILTER (WHERE price_change_pct_24h <= 0) AS losers
        FROM ({CRYPTO})""",
    "countries_ranked": f"""
        SELECT * EXCLUDE (official_name, timezone, ingested_at) FROM ({COUNTRIES}) WHERE population > 0 ORDER BY population DESC, name""",
    "countries_by_region": f"""
        SELECT region, count(*) AS country_count, {big('sum(population)')} AS total_population, {hu('sum(area)', 0)} AS total_area,
               {avg('sum(population)', 'count(population)', 0)} AS avg_population
        FROM ({COUNTRIES}) WHERE region <> '' AND population > 0 GROUP BY region ORDER BY total_population DESC""",
    "weather_current": f"""
        SELECT city, country, temperature_c, wind_speed_kmh, humidity_pct, weather_desc, measured_at FROM ({WEATHER}) ORDER BY city""",
    "exchange_rates": f"SELECT target_currency, rate, rate_date FROM ({RATES}) ORDER BY target_currency",
    "exchange_rates_major": f"""
        SELECT target_currency, rate, rate_date FROM ({RATES}) WHERE target_currency IN ({', '.join(repr(c) for c in MAJOR_CURRENCIES)})
        ORDER BY target_currency""",
    "github_ranked": f"""
        SELECT * EXCLUDE (created_at, updated_at, ingested_at) FROM ({GITHUB}) ORDER BY stars DESC, full_name""",
    "github_by_language": f"""
        SELECT coalesce(language, 'Unknown') AS language, count(*) AS repo_count, {big('sum(stars)')} AS total_stars,
               {big('sum(forks)')} AS total_forks, {avg('sum(stars)', 'count(stars)', 0)} AS avg_stars
        FROM ({GITHUB}) GROUP BY language ORDER BY total_stars DESC""",
    "lineage_summary": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS task_id, o_orderpriority AS description, o_orderstatus AS status, 1 AS attempt,
               CASE WHEN o_orderstatus <> 'P' THEN o_totalprice ELSE {dbl('0')} END AS duration_sec, CAST(NULL AS VARCHAR) AS error
        FROM orders""",
    "ingested_crypto": f"SELECT * EXCLUDE (ingested_at) FROM ({CRYPTO})",
    "ingestion_log": """
        SELECT 'CoinGecko' AS source, 'SUCCESS' AS status, count(*) AS records_count, false AS failed, true AS in_order FROM part
        UNION ALL SELECT 'GitHub', 'FAILED', 0, true, true""",
}
LIVE_SQL["read_lineage"] = LIVE_SQL["lineage_summary"]


def oracle_sql() -> dict[str, str]:
    return {**SALES_SQL, **ADVANCED_SQL, **QUALITY_SQL, **LOAD_SQL, **HISTORY_SQL, **EVENT_SQL, **LIVE_SQL}
