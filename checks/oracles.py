"""DuckDB SQL that computes what each registered query should return."""

from __future__ import annotations

from tillscope.testbind import KEYS, REPEATED, SPOILED

# Month, ISO weekday (0: any), first and last day of the month, and name of each holiday.
HOLIDAY_VALUES = """
    (1, 0, 1, 1, 'Año Nuevo'), (2, 1, 1, 7, 'Día de la Constitución'),
    (3, 1, 15, 21, 'Natalicio de Benito Juárez'), (5, 0, 1, 1, 'Día del Trabajo'),
    (9, 0, 16, 16, 'Día de la Independencia'), (11, 1, 15, 21, 'Día de la Revolución'),
    (12, 0, 24, 24, 'Nochebuena'), (12, 0, 25, 25, 'Navidad'), (12, 0, 31, 31, 'Fin de Año')"""


def _calendar(days: str) -> str:
    return f"""
SELECT d AS cal_date, day(d) AS day, isodow(d) AS iso_weekday, rpad(dayname(d), 9, ' ') AS day_name,
       weekofyear(d) AS iso_week, month(d) AS month, rpad(monthname(d), 9, ' ') AS month_name,
       quarter(d) AS quarter, year(d) AS year, isodow(d) >= 6 AS is_weekend,
       h.name IS NOT NULL AS is_holiday, h.name AS holiday_name,
       'Q' || quarter(d) || '-' || year(d) AS fiscal_period
FROM ({days}) AS days
LEFT JOIN (VALUES {HOLIDAY_VALUES}) AS h(m, w, d1, d2, name)
  ON h.m = month(d) AND day(d) BETWEEN h.d1 AND h.d2 AND (h.w = 0 OR h.w = isodow(d))"""


FIXED_DAYS = "SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d"
DATA_DAYS = """SELECT CAST(unnest(generate_series(
    (SELECT date_trunc('year', min(sale_date)) FROM sales),
    (SELECT date_trunc('year', max(sale_date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY FROM sales),
    INTERVAL 1 DAY)) AS DATE) AS d"""

STAR = f"""
products AS (
  SELECT p_partkey AS product_id, 'SKU' || p_partkey AS sku, p_name AS product_name, p_brand AS brand,
         p_type AS category, 'S' || (p_size % 5) AS subcategory,
         CAST(p_retailprice AS DECIMAL(12,2)) AS list_price
  FROM part),
stores AS (
  SELECT store_id, 'T' || store_id AS store_code, n_name || ' ' || segment AS store_name, segment AS chain,
         CASE store_id % 4 WHEN 0 THEN 'Super' WHEN 1 THEN 'Express' WHEN 2 THEN 'Hiper' ELSE 'Convenience' END AS format,
         r_name AS region, n_name AS city, CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS postal_code,
         CAST(50 + (store_id * 37) % 4951 AS INTEGER) AS floor_area_m2
  FROM (SELECT CAST(n_nationkey AS BIGINT) * 5 + i AS store_id, * FROM nation
        JOIN region ON n_regionkey = r_regionkey
        CROSS JOIN (VALUES (0, 'AUTOMOBILE'), (1, 'BUILDING'), (2, 'FURNITURE'), (3, 'HOUSEHOLD'), (4, 'MACHINERY'))
                   AS s(i, segment))),
sales AS (
  SELECT *, CAST(quantity AS DECIMAL(10,0)) * unit_price * (100 - discount_pct) AS net_x100
  FROM (SELECT l_orderkey * 8 + l_linenumber AS sale_id, l_partkey AS product_id,
               CAST(c_nationkey AS BIGINT) * 5 + CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1
                 WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END AS store_id,
               CAST(o_orderdate AS DATE) AS sale_date,
               lpad(CAST(8 + l_orderkey % 14 AS VARCHAR), 2, '0') || ':00:00' AS sale_time,
               CAST(l_orderkey AS VARCHAR) AS ticket_id, CAST(l_quantity AS INTEGER) AS quantity,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price,
               CAST(CAST(round(l_discount * 100) AS INTEGER) AS DECIMAL(5,2)) AS discount_pct,
               CAST(CAST(round(l_tax * 100) AS INTEGER) AS DECIMAL(5,2)) AS tax_pct,
               CASE left(o_orderpriority, 1) WHEN '1' THEN 'online' WHEN '2' THEN 'mobile' ELSE 'in-store' END AS channel,
               l_suppkey AS seller_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)),
moves AS (
  SELECT product_id, store_id, CAST(date_trunc('month', sale_date) AS DATE) AS snapshot_date,
         CAST(SUM(quantity) AS INTEGER) AS stock_out,
         year(date_trunc('month', sale_date)) * 12 + month(date_trunc('month', sale_date)) AS ym
  FROM sales GROUP BY ALL),
inventory AS (
  SELECT inventory_id, product_id, store_id, snapshot_date, final_stock + stock_out - stock_in AS opening_stock,
         final_stock, stock_in, stock_out, unit_cost, CAST(final_stock * unit_cost AS DECIMAL(15,2)) AS stock_value
  FROM (SELECT (product_id * 125 + store_id) * 100000 + ym AS inventory_id, product_id, store_id, snapshot_date,
               stock_out, least(stock_out, CAST((product_id * 7 + store_id * 13 + ym * 5) % 60 AS INTEGER)) AS stock_in,
               CASE WHEN h <= 10 THEN 0 WHEN h <= 30 THEN h - 10 ELSE (h - 30) * 20 END AS final_stock,
               CAST(CAST((CAST(round(p_retailprice * 100) AS BIGINT) * 7 + 5) // 10 AS DECIMAL(12,0))
                    * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS unit_cost
        FROM (SELECT *, CAST((product_id * 11 + store_id * 3 + ym * 17) % 120 AS INTEGER) AS h FROM moves)
        JOIN part ON p_partkey = product_id)),
calendar AS ({_calendar(FIXED_DAYS)}),
data_calendar AS ({_calendar(DATA_DAYS)})"""

TYPES = {"i": "BIGINT", "d": "DOUBLE", "s": "VARCHAR", "t": "DATE", "b": "BOOLEAN"}


def query(columns: str, body: str, with_also: str = "") -> str:
    """Star CTEs, then ``body`` with its columns cast; ``columns`` is 'name:type ...'."""
    parts = [c.split(":") for c in columns.split()]
    select = ", ".join(f'CAST("{name}" AS {TYPES[kind]}) AS "{name}"' for name, kind in parts)
    more = f",\n{with_also}" if with_also else ""
    return f"WITH {STAR}{more}\nSELECT {select}\nFROM ({body}) AS r"


# Exact net amount, and as double.
NET = "CAST(CAST(SUM(net_x100) AS DECIMAL(28,4)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(31,6))"
NET_D = f"CAST({NET} AS DOUBLE)"
LINE = f"{NET_D} / COUNT(net_x100)"
AS_OF = "DATE '2001-07-31'"
Y2000 = "BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'"
Q4 = "BETWEEN DATE '2000-10-01' AND DATE '2000-12-31'"


def pct(now: str, before: str) -> str:
    now, before = f"CAST({now} AS DOUBLE)", f"CAST({before} AS DOUBLE)"
    return f"round(({now} - {before}) / nullif({before}, 0) * 100, 2)"


ORACLES: dict[str, str] = {}

ORACLES["q1_1_daily_sales_by_chain"] = query(
    "sale_date:t chain:s tickets:i units:i net_sales:d avg_line_value:d",
    f"""SELECT sale_date, chain, COUNT(DISTINCT ticket_id) AS tickets, SUM(quantity) AS units,
               {NET} AS net_sales, {LINE} AS avg_line_value
        FROM sales JOIN stores USING (store_id) JOIN calendar ON cal_date = sale_date
        WHERE sale_date {Y2000} GROUP BY sale_date, chain""")
ORACLES["q1_2_weekly_sales_trend"] = query(
    "year:i iso_week:i chain:s net_sales:d active_stores:i tickets:i",
    f"""SELECT year, iso_week, chain, {NET} AS net_sales, COUNT(DISTINCT store_id) AS active_stores,
               COUNT(DISTINCT ticket_id) AS tickets
        FROM sales JOIN stores USING (store_id) JOIN calendar ON cal_date = sale_date
        WHERE sale_date >= {AS_OF} - 84 GROUP BY year, iso_week, chain""")


def store_average(condition: str) -> str:
    return f"""SELECT store_id, chain, store_name, format, region, {NET} AS net_sales,
       COUNT(DISTINCT sale_date) AS active_days, {NET_D} / COUNT(DISTINCT sale_date) AS avg_daily_sale
       FROM sales JOIN stores USING (store_id) WHERE sale_date {condition} GROUP BY ALL"""


ORACLES["q1_3_store_ranking"] = query(
    "chain:s store_id:i store_name:s format:s region:s net_sales:d avg_daily_sale:d chain_rank:i percentile:d",
    f"""SELECT * EXCLUDE active_days, RANK() OVER (PARTITION BY chain ORDER BY avg_daily_sale DESC) AS chain_rank,
               PERCENT_RANK() OVER (PARTITION BY chain ORDER BY avg_daily_sale) AS percentile
        FROM ({store_average(Q4)})""")
ORACLES["q2_1_top_products"] = query(
    "product_id:i category:s brand:s product_name:s units:i net_sales:d avg_price:d stores:i sale_days:i",
    f"""SELECT product_id, category, brand, product_name, SUM(quantity) AS units, {NET} AS net_sales,
               CAST(SUM(unit_price) AS DOUBLE) / COUNT(unit_price) AS avg_price,
               COUNT(DISTINCT store_id) AS stores, COUNT(DISTINCT sale_date) AS sale_days
        FROM sales JOIN products USING (product_id) JOIN calendar ON cal_date = sale_date
        WHERE quarter = 4 AND year = 2000 GROUP BY ALL ORDER BY net_sales DESC, product_id LIMIT 20""")
ORACLES["q2_2_top_products_by_region"] = query(
    "region:s category:s product_name:s net_sales:d units:i region_rank:i",
    f"""SELECT *, ROW_NUMBER() OVER (PARTITION BY region ORDER BY net_sales DESC, category, product_name) AS region_rank
        FROM (SELECT region, category, product_name, {NET} AS net_sales, SUM(quantity) AS units
              FROM sales JOIN products USING (product_id) JOIN stores USING (store_id)
              WHERE sale_date >= DATE '2001-07-01' GROUP BY ALL) QUALIFY region_rank <= 10""")
ORACLES["q2_3_sales_by_channel"] = query(
    "category:s subcategory:s channel:s products_sold:i units:i net_sales:d avg_line_value:d",
    f"""SELECT category, subcategory, channel, COUNT(DISTINCT product_id) AS products_sold, SUM(quantity) AS units,
               {NET} AS net_sales, {LINE} AS avg_line_value
        FROM sales JOIN products USING (product_id) WHERE sale_date {Y2000} GROUP BY ALL""")

TICKETS = """tickets AS (SELECT ticket_id, COUNT(*) AS items, SUM(net_x100) AS ticket_x100
             FROM sales WHERE ticket_id IS NOT NULL GROUP BY ticket_id)"""


def ticket_week(mean: str) -> str:
    return query(
        "year:i iso_week:i format:s tickets:i net_sales:d net_per_ticket:d avg_items:d",
        f"""SELECT year, iso_week, format, COUNT(DISTINCT ticket_id) AS tickets, {NET} AS net_sales,
                   {NET_D} / COUNT(DISTINCT ticket_id) AS net_per_ticket, {mean} AS avg_items
            FROM sales JOIN tickets USING (ticket_id) JOIN stores USING (store_id) JOIN calendar ON cal_date = sale_date
            WHERE sale_date {Y2000} GROUP BY year, iso_week, format""", TICKETS)


ORACLES["q3_1_weekly_ticket_by_format"] = ticket_week("CAST(SUM(items) AS DOUBLE) / COUNT(*)")
ORACLES["q3_1_weekly_ticket_by_format_per_ticket"] = query(
    "year:i iso_week:i format:s tickets:i net_sales:d net_per_ticket:d avg_items:d",
    f"""SELECT year, iso_week, format, COUNT(*) AS tickets,
               CAST(CAST(SUM(n) AS DECIMAL(28,4)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(31,6)) AS net_sales,
               CAST(CAST(SUM(n) AS DECIMAL(28,4)) * CAST(0.01 AS DECIMAL(3,2)) AS DOUBLE) / COUNT(*) AS net_per_ticket,
               CAST(SUM(items) AS DOUBLE) / COUNT(*) AS avg_items
        FROM (SELECT ticket_id, year, iso_week, format, SUM(net_x100) AS n
              FROM sales JOIN stores USING (store_id) JOIN calendar ON cal_date = sale_date
              WHERE sale_date {Y2000} GROUP BY ALL) JOIN tickets USING (ticket_id)
        GROUP BY year, iso_week, format""", TICKETS)
ORACLES["q3_2_monthly_ticket_by_region"] = query(
    "year:i month:i month_name:s region:s tickets:i net_sales:d net_per_ticket:d median_ticket:d",
    f"""SELECT year, month, month_name, region, COUNT(DISTINCT ticket_id) AS tickets, {NET} AS net_sales,
               {NET_D} / COUNT(DISTINCT ticket_id) AS net_per_ticket,
               quantile_cont(CAST(ticket_x100 AS DOUBLE), 0.5) / 100 AS median_ticket
        FROM sales JOIN tickets USING (ticket_id) JOIN stores USING (store_id) JOIN calendar ON cal_date = sale_date
        WHERE sale_date {Y2000} GROUP BY year, month, month_name, region""", TICKETS)
ORACLES["q3_3_hourly_tickets"] = query(
    "hour:i format:s tickets:i net_sales:d net_per_ticket:d",
    f"""SELECT CAST(left(sale_time, 2) AS INTEGER) AS hour, format, COUNT(DISTINCT ticket_id) AS tickets,
               {NET} AS net_sales, {NET_D} / COUNT(DISTINCT ticket_id) AS net_per_ticket
        FROM sales JOIN stores USING (store_id)
        WHERE sale_date BETWEEN DATE '2000-11-01' AND DATE '2000-11-30' AND ticket_id IS NOT NULL AND sale_time IS NOT NULL
        GROUP BY ALL""")

LATEST = """SELECT product_id, store_id, MAX(snapshot_date) AS snapshot_date,
            arg_max(final_stock, snapshot_date) AS final_stock, arg_max(unit_cost, snapshot_date) AS unit_cost
            FROM inventory {where} GROUP BY product_id, store_id"""


def label(ratio: str) -> str:
    return f"""CASE WHEN final_stock = 0 THEN 'SIN_STOCK' WHEN {ratio} < 7 THEN 'STOCK_BAJO'
               WHEN {ratio} > 60 THEN 'SOBRESTOCK' ELSE 'NORMAL' END"""


MEAN_QTY = "CAST(SUM(quantity) AS DOUBLE) / COUNT(quantity)"
ORACLES["q4_1_stock_alerts"] = query(
    "product_id:i store_id:i category:s brand:s product_name:s chain:s store_name:s current_stock:i "
    "avg_daily_sales:d days_of_supply:d snapshot_date:t alert:s",
    f"""SELECT *, final_stock AS current_stock,
               CASE WHEN avg_daily_sales > 0 THEN final_stock / avg_daily_sales END AS days_of_supply,
               {label('final_stock / nullif(avg_daily_sales, 0)')} AS alert
        FROM ({LATEST.format(where='')}) JOIN products USING (product_id) JOIN stores USING (store_id)
        LEFT JOIN (SELECT product_id, store_id, {MEAN_QTY} AS avg_daily_sales FROM sales
                   WHERE sale_date >= {AS_OF} - 2500 GROUP BY product_id, store_id HAVING COUNT(*) >= 2)
             USING (product_id, store_id)
        WHERE snapshot_date >= {AS_OF} - 365""")
ORACLES["q4_2_inventory_turnover"] = query(
    "category:s format:s avg_inventory:d cost_of_sales:d turnover:d days_of_inventory:d",
    f"""SELECT *, CASE WHEN avg_inventory > 0 THEN cost_of_sales / avg_inventory ELSE 0 END AS turnover,
               CASE WHEN cost_of_sales > 0 THEN avg_inventory / cost_of_sales * 365 ELSE 0 END AS days_of_inventory
        FROM (SELECT category, format,
                     CAST(SUM(final_stock * unit_cost) AS DOUBLE) / COUNT(final_stock * unit_cost) AS avg_inventory,
                     CAST(SUM(quantity * unit_cost) AS DOUBLE) AS cost_of_sales
              FROM inventory i JOIN sales s ON i.product_id = s.product_id AND i.store_id = s.store_id
                   AND i.snapshot_date = s.sale_date
              JOIN products p ON p.product_id = i.product_id JOIN stores t ON t.store_id = i.store_id
              WHERE snapshot_date {Y2000} GROUP BY category, format)""")
ORACLES["q4_3_stockout_frequency"] = query(
    "category:s brand:s region:s format:s snapshots:i stockouts:i low_stock:i stockout_rate_pct:d low_stock_rate_pct:d",
    f"""SELECT category, brand, region, format, COUNT(*) AS snapshots, COUNT(*) FILTER (final_stock = 0) AS stockouts,
               COUNT(*) FILTER (final_stock < 5) AS low_stock,
               round(COUNT(*) FILTER (final_stock = 0) / CAST(COUNT(*) AS DOUBLE) * 100, 2) AS stockout_rate_pct,
               round(COUNT(*) FILTER (final_stock < 5) / CAST(COUNT(*) AS DOUBLE) * 100, 2) AS low_stock_rate_pct
        FROM inventory JOIN products USING (product_id) JOIN stores USING (store_id)
        WHERE snapshot_date {Y2000} GROUP BY category, brand, region, format HAVING COUNT(*) >= 3""")
ORACLES["q5_1_seasonality_index"] = query(
    "category:s month:i month_name:s net_sales:d category_mean:d seasonality_index:d",
    f"""SELECT *, CAST(SUM(net_sales) OVER (PARTITION BY category) AS DOUBLE)
                  / COUNT(net_sales) OVER (PARTITION BY category) AS category_mean,
               CAST(net_sales AS DOUBLE) / category_mean AS seasonality_index
        FROM (SELECT category, month, month_name, {NET} AS net_sales
              FROM sales JOIN products USING (product_id) JOIN calendar ON cal_date = sale_date
              WHERE year BETWEEN 1998 AND 2000 GROUP BY ALL)""")


def holiday(factor: str) -> str:
    return query(
        "holiday_name:s sale_date:t day_name:s holiday_sales:d regular_mean:d lift_factor:d",
        f"""SELECT holiday_name, sale_date, day_name, CAST(net AS DOUBLE) * {factor} AS holiday_sales,
                   m AS regular_mean, CAST(net AS DOUBLE) * {factor} / m AS lift_factor
            FROM (SELECT holiday_name, sale_date, day_name, {NET} AS net
                  FROM sales JOIN calendar ON cal_date = sale_date
                  WHERE is_holiday AND year BETWEEN 1998 AND 2000 GROUP BY ALL),
                 (SELECT CAST(SUM(net) AS DOUBLE) / COUNT(net) AS m, COUNT(*) AS r
                  FROM (SELECT sale_date, {NET} AS net FROM sales JOIN calendar ON cal_date = sale_date
                        WHERE NOT is_holiday AND NOT is_weekend AND year BETWEEN 1998 AND 2000 GROUP BY sale_date))""")


ORACLES["q5_2_holiday_impact"] = holiday("r")
ORACLES["q5_2_holiday_impact_corrected"] = holiday("1")

PERIOD = """SELECT {net} AS s, CAST(COUNT(DISTINCT ticket_id) AS DOUBLE) AS t, {line} AS l
            FROM sales WHERE sale_date BETWEEN {a} AND {b}"""
NOW = PERIOD.format(net=NET_D, line=LINE, a=f"{AS_OF} - 30", b=AS_OF)
BEFORE = PERIOD.format(net=NET_D, line=LINE, a=f"{AS_OF} - 60", b=f"{AS_OF} - 30")
ORACLES["kpi1_sales_vs_previous"] = query(
    "kpi:s current_value:d previous_value:d change_pct:d",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS kpi, n.{c} AS current_value, b.{c} AS previous_value, {pct(f'n.{c}', f'b.{c}')} AS change_pct
            FROM now_period n, before_period b"""
        for name, c in (("Ventas Netas", "s"), ("Transacciones", "t"), ("Ticket Promedio", "l"))),
    f"now_period AS ({NOW}), before_period AS ({BEFORE})")
ORACLES["kpi2_top_bottom_stores"] = query(
    "group:s chain:s store_id:i store_name:s format:s region:s net_sales:d avg_daily_sale:d",
    """SELECT 'TOP_5' AS "group", * FROM (SELECT * FROM st ORDER BY avg_daily_sale DESC, store_id LIMIT 5)
       UNION ALL SELECT 'BOTTOM_5', * FROM (SELECT * FROM st ORDER BY avg_daily_sale, store_id LIMIT 5)""",
    f"st AS (SELECT * FROM ({store_average(f'BETWEEN {AS_OF} - 30 AND {AS_OF}')}) WHERE active_days >= 3)")
ORACLES["kpi3_category_matrix"] = query(
    "category:s active_products:i units:i net_sales:d avg_price:d sales_share_pct:d",
    f"""SELECT *, CAST(net_sales AS DOUBLE) / CAST(SUM(net_sales) OVER () AS DOUBLE) * 100 AS sales_share_pct
        FROM (SELECT category, COUNT(DISTINCT product_id) AS active_products, SUM(quantity) AS units, {NET} AS net_sales,
                     CAST(SUM(unit_price) AS DOUBLE) / COUNT(unit_price) AS avg_price
              FROM sales JOIN products USING (product_id) WHERE sale_date BETWEEN {AS_OF} - 90 AND {AS_OF}
              GROUP BY category)""")
ORACLES["kpi4_channel_performance"] = query(
    "channel:s tickets:i units:i net_sales:d avg_line_value:d share_pct:d",
    f"""SELECT *, CAST(net_sales AS DOUBLE) / CAST(SUM(net_sales) OVER () AS DOUBLE) * 100 AS share_pct
        FROM (SELECT channel, COUNT(DISTINCT ticket_id) AS tickets, SUM(quantity) AS units, {NET} AS net_sales,
                     {LINE} AS avg_line_value
              FROM sales WHERE sale_date BETWEEN {AS_OF} - 30 AND {AS_OF} AND ticket_id IS NOT NULL GROUP BY channel)""")
HEALTH = f"""SELECT category, COUNT(*) AS positions, COUNT(*) FILTER (final_stock = 0) AS stockouts,
       COUNT(*) FILTER (final_stock < 10) AS low_stock,
       CAST(SUM(final_stock * unit_cost) AS DOUBLE) / COUNT(*) AS avg_stock_value,
       round(COUNT(*) FILTER (final_stock = 0) / CAST(COUNT(*) AS DOUBLE) * 100, 2) AS stockout_rate_pct,
       round(COUNT(*) FILTER (final_stock < 10) / CAST(COUNT(*) AS DOUBLE) * 100, 2) AS low_stock_rate_pct
       FROM inventory JOIN products USING (product_id) WHERE snapshot_date >= {AS_OF} - 31 GROUP BY category"""
ORACLES["kpi5_inventory_health"] = query(
    "category:s positions:i stockouts:i low_stock:i avg_stock_value:d stockout_rate_pct:d low_stock_rate_pct:d", HEALTH)

ORACLES["a1_category_affinity"] = query(
    "category_a:s category_b:s co_occurrences:i avg_joint_value:d affinity_rank:i",
    f"""SELECT category_a, category_b, co_occurrences, avg_joint_value,
               RANK() OVER (ORDER BY co_occurrences DESC) AS affinity_rank
        FROM (SELECT a.category AS category_a, b.category AS category_b, COUNT(*) AS co_occurrences,
                     CAST(CAST(SUM(a.v + b.v) AS DECIMAL(28,4)) * CAST(0.01 AS DECIMAL(3,2)) AS DOUBLE) / COUNT(a.v + b.v)
                       AS avg_joint_value
              FROM basket a JOIN basket b ON a.ticket_id = b.ticket_id AND a.category < b.category
              GROUP BY ALL HAVING COUNT(*) >= 100)
        ORDER BY co_occurrences DESC, category_a, category_b LIMIT 20""",
    f"""basket AS (SELECT ticket_id, category, product_name, SUM(net_x100) AS v
        FROM sales JOIN products USING (product_id) WHERE sale_date {Q4} AND ticket_id IS NOT NULL GROUP BY ALL)""")
ORACLES["a2_weekly_trend"] = query(
    "category:s region:s year:i iso_week:i net_sales:d moving_avg_12:d week_growth_pct:d year_growth_pct:d",
    f"""SELECT *, {pct('net_sales', 'w1')} AS week_growth_pct, {pct('net_sales', 'w52')} AS year_growth_pct
        FROM (SELECT *, LAG(net_sales, 1) OVER w AS w1, LAG(net_sales, 52) OVER w AS w52,
                     CAST(SUM(net_sales) OVER m AS DOUBLE) / COUNT(net_sales) OVER m AS moving_avg_12
              FROM (SELECT category, region, year, iso_week, {NET} AS net_sales
                    FROM sales JOIN products USING (product_id) JOIN stores USING (store_id)
                    JOIN calendar ON cal_date = sale_date WHERE year BETWEEN 1998 AND 2000 GROUP BY ALL)
              WINDOW w AS (PARTITION BY category, region ORDER BY year, iso_week),
                     m AS (PARTITION BY category, region ORDER BY year, iso_week
                           ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))
        WHERE year = 2000""")
ORACLES["a3_price_elasticity"] = query(
    "product_id:i category:s brand:s product_name:s month:t avg_price:d volume:i elasticity:d",
    f"""SELECT *, round((CAST(volume AS DOUBLE) - v0) / v0 / nullif((avg_price - p0) / p0, 0), 2) AS elasticity
        FROM (SELECT *, LAG(avg_price) OVER w AS p0, CAST(LAG(volume) OVER w AS DOUBLE) AS v0
              FROM (SELECT product_id, date_trunc('month', sale_date) AS month,
                           CAST(SUM(unit_price) AS DOUBLE) / COUNT(unit_price) AS avg_price, SUM(quantity) AS volume
                    FROM sales WHERE sale_date {Y2000} GROUP BY ALL HAVING COUNT(DISTINCT store_id) >= 2)
              WINDOW w AS (PARTITION BY product_id ORDER BY month))
        JOIN products USING (product_id) WHERE p0 IS NOT NULL AND abs(avg_price - p0) > 0.5""")
ORACLES["a4_store_segments"] = query(
    "chain:s format:s region:s stores:i avg_sales:d avg_line_value:d avg_net_per_m2:d segment:s",
    """SELECT chain, format, region, COUNT(*) AS stores, CAST(SUM(net_sales) AS DOUBLE) / COUNT(*) AS avg_sales,
              list_reduce(list_sort(list(line)), lambda x, y: x + y) / COUNT(*) AS avg_line_value,
              list_reduce(list_sort(list(area)), lambda x, y: x + y) / COUNT(*) AS avg_net_per_m2,
              CASE WHEN qs = 4 AND ql = 4 THEN 'PREMIUM' WHEN qs = 4 AND qa = 4 THEN 'HIGH_PERFORMANCE'
                   WHEN qs >= 3 THEN 'STRONG' WHEN qs = 2 THEN 'AVERAGE' ELSE 'UNDERPERFORMING' END AS segment
       FROM (SELECT *, NTILE(4) OVER (ORDER BY net_sales, store_id) AS qs, NTILE(4) OVER (ORDER BY line, store_id) AS ql,
                    NTILE(4) OVER (ORDER BY area, store_id) AS qa FROM metrics)
       GROUP BY chain, format, region, qs, ql, qa""",
    f"""metrics AS (SELECT store_id, chain, format, region, {NET} AS net_sales, {LINE} AS line,
        {NET_D} / floor_area_m2 AS area FROM sales JOIN stores USING (store_id)
        WHERE sale_date {Y2000} AND ticket_id IS NOT NULL GROUP BY store_id, chain, format, region, floor_area_m2
        HAVING COUNT(DISTINCT sale_date) >= 15)""")
ORACLES["a5_store_cohort"] = query(
    "chain:s month:t active_stores:i avg_sales_per_store:d tickets:i stores_month_before:i retention_pct:d",
    f"""SELECT *, LAG(active_stores) OVER w AS stores_month_before,
               round(CAST(active_stores AS DOUBLE) / LAG(active_stores) OVER w * 100, 2) AS retention_pct
        FROM (SELECT chain, month, COUNT(DISTINCT store_id) AS active_stores,
                     CAST(SUM(net) AS DOUBLE) / COUNT(net) AS avg_sales_per_store, SUM(t) AS tickets
              FROM (SELECT store_id, chain, date_trunc('month', sale_date) AS month, {NET} AS net,
                           COUNT(DISTINCT ticket_id) AS t
                    FROM sales JOIN stores USING (store_id) WHERE sale_date {Y2000} AND ticket_id IS NOT NULL GROUP BY ALL)
              GROUP BY chain, month)
        WINDOW w AS (PARTITION BY chain ORDER BY month)""")

# Summary tables and what reads them.
M1_COLUMNS = "sale_date:t year:i month:i month_name:s day_name:s chain:s format:s region:s"
M1 = f"""SELECT sale_date, year, month, month_name, day_name, chain, format, region,
         COUNT(DISTINCT ticket_id) AS tickets, SUM(quantity) AS units, {NET} AS net_sales
         FROM sales JOIN stores USING (store_id) JOIN calendar ON cal_date = sale_date GROUP BY ALL"""
ORACLES["m1_daily_summary"] = query(f"{M1_COLUMNS} tickets:i units:i net_sales:d", M1)
M2 = """SELECT *, RANK() OVER (PARTITION BY category, month ORDER BY net_sales DESC) AS category_month_rank
        FROM (SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month, product_id, product_name, category, brand,
                     SUM(quantity) AS units, {net} AS net_sales, COUNT(DISTINCT sale_date) AS sale_days,
                     CAST(SUM(quantity) AS DOUBLE) / COUNT(DISTINCT sale_date) AS units_per_sale_day
              FROM sales JOIN products USING (product_id) GROUP BY ALL)""".format(net=NET)
M2_COLUMNS = "month:t product_id:i product_name:s category:s brand:s units:i net_sales:d"
ORACLES["m2_product_performance"] = query(f"{M2_COLUMNS} category_month_rank:i", M2)
M3 = f"""SELECT region, product_id, category, brand, product_name, CAST(date_trunc('month', sale_date) AS DATE) AS month,
         {NET} AS net_sales, SUM(quantity) AS units, COUNT(DISTINCT store_id) AS stores,
         COUNT(DISTINCT ticket_id) AS tickets
         FROM sales JOIN products USING (product_id) JOIN stores USING (store_id)
         WHERE sale_date >= DATE '2001-01-01' GROUP BY ALL"""
ORACLES["m3_regional_performance"] = query(
    "region:s product_id:i category:s brand:s product_name:s month:t net_sales:d units:i stores:i tickets:i", M3)
M4 = f"""SELECT *, CAST(final_stock * unit_cost AS DECIMAL(15,2)) AS stock_value
         FROM ({LATEST.format(where=f'WHERE snapshot_date >= {AS_OF} - 365')})"""
M5 = f"""SELECT product_id, store_id, {MEAN_QTY} AS avg_daily_sales, COUNT(DISTINCT sale_date) AS sales_days,
         SUM(quantity) AS total_quantity, MAX(sale_date) AS last_sale_date
         FROM sales WHERE sale_date >= {AS_OF} - 2500 GROUP BY product_id, store_id HAVING COUNT(DISTINCT sale_date) >= 2"""


def supply(latest: str, recent: str) -> str:
    compared = "final_stock / coalesce(mean, 1)"
    return f"""SELECT *, coalesce(mean, 0) AS avg_daily_sales, CASE WHEN mean > 0 THEN final_stock / mean END AS days_of_supply,
        {label(compared)} AS alert,
        CASE WHEN final_stock = 0 THEN 1 WHEN {compared} < 7 THEN 2 WHEN {compared} > 60 THEN 3 ELSE 4 END AS priority
        FROM ({latest}) JOIN products USING (product_id) JOIN stores USING (store_id)
        LEFT JOIN (SELECT product_id, store_id, avg_daily_sales AS mean, last_sale_date FROM ({recent}))
             USING (product_id, store_id)"""


ALERT_COLUMNS = ("product_id:i store_id:i category:s brand:s product_name:s chain:s store_name:s region:s final_stock:i "
                 "avg_daily_sales:d days_of_supply:d alert:s snapshot_date:t")
ORACLES["m4_latest_inventory"] = query(
    "product_id:i store_id:i snapshot_date:t final_stock:i unit_cost:d stock_value:d", M4)
ORACLES["m5_recent_sales"] = query(
    "product_id:i store_id:i avg_daily_sales:d sales_days:i total_quantity:i last_sale_date:t", M5)
ORACLES["m6_inventory_alerts"] = query(f"{ALERT_COLUMNS} last_sale_date:t priority:i", supply(M4, M5))
ORACLES["e1_daily_sales_by_chain_quarter"] = query(
    "sale_date:t chain:s tickets:i units:i net_sales:d avg_line_value:d",
    f"""SELECT sale_date, chain, COUNT(DISTINCT ticket_id) AS tickets, SUM(quantity) AS units,
               {NET} AS net_sales, {LINE} AS avg_line_value
        FROM sales JOIN stores USING (store_id) WHERE sale_date {Q4} GROUP BY sale_date, chain""")
MONTH_NOW = f"""SELECT region, product_id, category, brand, product_name, {NET} AS net_sales, SUM(quantity) AS units,
                COUNT(DISTINCT store_id) AS stores
                FROM sales JOIN products USING (product_id) JOIN stores USING (store_id)
                WHERE sale_date >= DATE '2001-07-01' GROUP BY ALL"""
RANKED = """SELECT *, ROW_NUMBER() OVER (PARTITION BY region ORDER BY net_sales DESC, product_id) AS region_rank
            FROM ({m3}) WHERE month = DATE '2001-07-01' AND net_sales > 1000""".format(m3=M3)
E2_COLUMNS = "region:s product_id:i category:s brand:s product_name:s net_sales:d units:i stores:i region_rank:i"
ORACLES["e2a_regional_ranking"] = query(
    E2_COLUMNS,
    f"""SELECT *, ROW_NUMBER() OVER (PARTITION BY region ORDER BY net_sales DESC, product_id) AS region_rank
        FROM ({MONTH_NOW}) WHERE net_sales > 1000""")
ORACLES["e2b_regional_ranking_fast"] = query(E2_COLUMNS, f"{RANKED} QUALIFY region_rank <= 10")
ORACLES["e3a_inventory_alerts_full"] = query(ALERT_COLUMNS, supply(LATEST.format(where=""), M5))
ORACLES["e3b_critical_alerts"] = query(
    f"{ALERT_COLUMNS} last_sale_date:t priority:i",
    f"SELECT * FROM ({supply(M4, M5)}) WHERE alert IN ('SIN_STOCK', 'STOCK_BAJO')")
ORACLES["r1_daily_kpis"] = query(
    "sale_date:t chain:s net_sales:d tickets:i net_per_ticket:d",
    f"""SELECT sale_date, chain, SUM(net_sales) AS net_sales, SUM(tickets) AS tickets,
               CAST(SUM(net_sales) AS DOUBLE) / SUM(tickets) AS net_per_ticket
        FROM ({M1}) WHERE sale_date >= {AS_OF} - 7 AND chain = 'BUILDING' GROUP BY sale_date, chain""")
ORACLES["r2_top_in_category_region"] = query(
    "product_id:i product_name:s brand:s units:i net_sales:d",
    f"""SELECT * FROM ({M3}) WHERE month = DATE '2001-07-01' AND category = 'ECONOMY' AND region = 'ASIA'
        QUALIFY RANK() OVER (ORDER BY net_sales DESC) <= 5""")
for _name in ("e2b_regional_ranking", "e3b_critical_alerts", "r1_daily_kpis", "r2_top_in_category_region"):
    ORACLES[f"{_name}_served"] = ORACLES["e2b_regional_ranking_fast" if _name.startswith("e2b") else _name]
ORACLES["r3_ticket_by_format"] = query(
    "format:s avg_line_value:d net_per_ticket:d units_per_ticket:d",
    f"""SELECT format, {LINE} AS avg_line_value, {NET_D} / COUNT(DISTINCT ticket_id) AS net_per_ticket,
               CAST(SUM(quantity) AS DOUBLE) / COUNT(DISTINCT ticket_id) AS units_per_ticket
        FROM sales JOIN stores USING (store_id)
        WHERE sale_date BETWEEN DATE '2001-01-01' AND DATE '2001-03-31' GROUP BY format""")
ORACLES["r4_alerts_for_chain"] = query(
    "product_id:i store_id:i store_name:s product_name:s final_stock:i alert:s",
    f"""SELECT * FROM ({supply(M4, M5)}) WHERE alert IN ('SIN_STOCK', 'STOCK_BAJO') AND chain = 'FURNITURE'""")



def status(**summaries: tuple[str, str]) -> str:
    """Name, rows and age of summaries; each is given as (SQL, date column or '')."""
    rows = []
    for name, (body, column) in summaries.items():
        newest = f"CAST(MAX({column}) AS DATE)" if column else "CAST(NULL AS DATE)"
        rows.append(f"SELECT '{name}' AS name, COUNT(*) AS rows, {newest} AS newest_data, "
                    f"{AS_OF} - {newest} AS days_behind FROM ({body})")
    return query("name:s rows:i newest_data:t days_behind:i", " UNION ALL ".join(rows))


STATUS = {
    "daily_sales": (M1, "sale_date"),
    "product_months": (M2, "month"),
    "product_performance": (M2, "month"),
    "regional_performance": (M3, "month"),
    "store_performance": ("SELECT DISTINCT store_id FROM sales", ""),
    "latest_inventory": (M4, "snapshot_date"),
    "recent_sales": (M5, "last_sale_date"),
    "inventory_alerts": (supply(M4, M5), "snapshot_date"),
    "daily_sales_by_category": ("SELECT DISTINCT sale_date, chain, format, region, category FROM sales JOIN stores USING (store_id) "
                                "JOIN products USING (product_id)", "sale_date"),
    "product_velocity_months": (M2, "month"),
    "product_velocity": (M2, "month"),
}


def status_of(*names: str) -> str:
    return status(**{name: STATUS[name] for name in names})


ORACLES["m7_rebuild"] = ORACLES["m1_daily_summary"]
ORACLES["m8_refresh_sales_summaries"] = ORACLES["m2_product_performance"]
ORACLES["m9_refresh_regional"] = ORACLES["m3_regional_performance"]
ORACLES["m10_refresh_inventory"] = ORACLES["m6_inventory_alerts"]
ORACLES["m11_refresh_beside_readers"] = ORACLES["m1_daily_summary"]
ORACLES["m12_refresh_status"] = status_of("store_performance")
ORACLES["x9_summary_stats"] = status_of(*STATUS)
ORACLES["x12_freshness"] = status_of("daily_sales", "regional_performance")
ORACLES["v6_list_summaries"] = query(
    "name:s version:i",
    """SELECT name, 1 AS version FROM (VALUES ('inventory_alerts'), ('latest_inventory'), ('recent_sales')) AS x(name)""")
ORACLES["v9_profile_files"] = query(
    "file:s records:i a_byte_a_row:b",
    "SELECT 'lineitem.parquet' AS file, COUNT(*) AS records, true AS a_byte_a_row FROM lineitem")
ORACLES["v8_table_sizes"] = query(
    "table_name:s record_count:i a_byte_a_row:b",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS record_count, true AS a_byte_a_row FROM {t}"
        for t in ("lineitem", "orders", "customer", "part", "supplier", "nation", "region")))
ORACLES["x13_daily_change"] = query(
    f"{M1_COLUMNS} tickets:i units:i net_sales:d net_sales_before:d tickets_before:i change_pct:d",
    f"""SELECT a.*, b.net_sales AS net_sales_before, b.tickets AS tickets_before, {pct("a.net_sales", "b.net_sales")} AS change_pct
        FROM ({M1}) a LEFT JOIN ({M1}) b
          ON b.sale_date = a.sale_date - 1 AND a.chain = b.chain AND a.format = b.format AND a.region = b.region""")

# Sources, sinks and keys.
PRODUCT_FILE = "product_id:i sku:s product_name:s brand:s category:s subcategory:s list_price:d"
STORE_FILE = ("store_id:i store_code:s store_name:s chain:s format:s region:s city:s state:s floor_area_m2:i opened_on:t")
SALES_FILE = ("product_id:i store_id:i sale_date:t sale_time:s ticket_id:s quantity:i unit_price:d discount_pct:d channel:s")
INVENTORY_FILE = ("product_id:i store_id:i snapshot_date:t opening_stock:i final_stock:i stock_in:i stock_out:i unit_cost:d")
ORACLES["s1_read_products"] = query(PRODUCT_FILE, "SELECT * FROM products")
ORACLES["s2_read_stores"] = query(STORE_FILE, "SELECT *, CAST(NULL AS DATE) AS opened_on FROM stores")
ORACLES["s3_read_sales"] = query(SALES_FILE, "SELECT * FROM sales")
ORACLES["s4_read_inventory"] = query(INVENTORY_FILE, "SELECT * FROM inventory")
ORACLES["s5_with_defaults"] = query(
    "sale_id:i discount_pct:d tax_pct:d channel:s has_created_at:b",
    "SELECT sale_id, 0 AS discount_pct, 16 AS tax_pct, 'in-store' AS channel, true AS has_created_at FROM sales")
ORACLES["s6_with_inventory_value"] = query(
    "inventory_id:i stock_value:d",
    "SELECT inventory_id, CAST(final_stock * unit_cost AS DECIMAL(15,2)) AS stock_value FROM inventory")
ORACLES["s7_write_sales"] = query(
    "sale_year:i lines:i units:i net_sales:d",
    f"SELECT year(sale_date) AS sale_year, COUNT(*) AS lines, SUM(quantity) AS units, {NET} AS net_sales FROM sales GROUP BY 1")
ORACLES["s8_catch_all_years"] = query(
    "sale_year:i lines:i outside_calendar:i",
    """SELECT year(d) AS sale_year, COUNT(*) AS lines, COUNT(*) FILTER (d > DATE '2001-12-31') AS outside_calendar
       FROM (SELECT sale_date + 365 AS d FROM sales) GROUP BY 1""")
ORACLES["s9_write_table"] = query(INVENTORY_FILE, "SELECT * FROM inventory")
ORACLES["s10_write_csv"] = query(SALES_FILE, "SELECT * FROM sales")
ORACLES["s11_clear_and_reload"] = query(
    "stage:s table_name:s record_count:i",
    """SELECT 'cleared' AS stage, t AS table_name, CASE t WHEN 'calendar' THEN 2557 ELSE 0 END AS record_count
       FROM (VALUES ('products'), ('stores'), ('calendar'), ('sales'), ('inventory')) AS x(t)
       UNION ALL SELECT 'reloaded', 'products', COUNT(*) FROM products
       UNION ALL SELECT 'reloaded', 'stores', COUNT(*) FROM stores
       UNION ALL SELECT 'reloaded', 'calendar', COUNT(*) FROM calendar
       UNION ALL SELECT 'reloaded', 'sales', COUNT(*) FROM sales
       UNION ALL SELECT 'reloaded', 'inventory', COUNT(*) FROM inventory""")
ORACLES["s12_assign_keys"] = query(
    "kind:s rows:i distinct_keys:i above_start:i",
    """SELECT k AS kind, n AS rows, n AS distinct_keys, n AS above_start
       FROM (SELECT COUNT(*) AS n FROM sales), (VALUES ('plain')) AS x(k)""")
ORACLES["s12_assign_dense_keys"] = query(
    "rows:i distinct_keys:i first_key:i last_key:i",
    "SELECT COUNT(*) AS rows, COUNT(*) AS distinct_keys, 1001 AS first_key, 1000 + COUNT(*) AS last_key FROM products")
ORACLES["s13_key_status"] = query(
    "table_name:s next_id:i max_id:i is_free:b",
    """SELECT 'products' AS table_name, MAX(product_id) + 1 AS next_id, MAX(product_id) AS max_id, true AS is_free FROM products
       UNION ALL SELECT 'stores', MAX(store_id) + 1, MAX(store_id), true FROM stores""")

ORACLES["s14_analyze"] = query(
    "column_name:s rows:i least:s greatest:s nulls:i",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS rows, MIN({c})::VARCHAR AS least, MAX({c})::VARCHAR AS greatest, "
        f"COUNT(*) - COUNT({c}) AS nulls FROM sales" for c in ("product_id", "store_id", "sale_date")))
ORACLES["s14_estimates"] = query(
    "filter_name:s rows:i estimate_holds:b",
    """SELECT 'sales before 1997' AS filter_name, COUNT(*) AS rows, true AS estimate_holds FROM sales WHERE sale_date < DATE '1997-01-01'
       UNION ALL SELECT 'sales of a quarter', COUNT(*), true FROM sales WHERE sale_date BETWEEN DATE '2000-10-01' AND DATE '2000-12-31'
       UNION ALL SELECT 'low product ids', COUNT(*), true FROM sales WHERE product_id <= 100
       UNION ALL SELECT 'low stock', COUNT(*), true FROM inventory WHERE final_stock < 20""")
# What the columns of the stored sales table say of themselves.
SALES_NOTES = {
    "sale_id": "Line key, unique together with the date", "product_id": "Product sold", "store_id": "Selling store",
    "sale_date": "Day of sale", "sale_time": "Time of sale as HH:mm:ss",
    "ticket_id": "Groups the lines of one transaction", "quantity": "Units", "unit_price": "Price per unit",
    "discount_pct": "Discount in percent", "tax_pct": "Tax in percent", "channel": "in-store, online, mobile or phone",
}
ORACLES["s15_descriptions"] = query(
    "col_name:s comment:s filled:i",
    " UNION ALL ".join(f"SELECT '{c}' AS col_name, '{note}' AS comment, COUNT({c}) AS filled FROM sales"
                       for c, note in SALES_NOTES.items())
    + " UNION ALL SELECT 'seller_id', 'Seller', COUNT(*) FROM sales")
ORACLES["x10_append_year"] = query(
    "sale_year:i lines:i keys:i new_keys:i sellers:i",
    """SELECT year(sale_date) AS sale_year, COUNT(*) AS lines, COUNT(*) AS keys,
              COUNT(*) FILTER (year(sale_date) = 2001) AS new_keys, 0 AS sellers FROM sales GROUP BY 1""")
ORACLES["x11_archive_year"] = query(
    "place:s sale_year:i lines:i",
    """SELECT CASE year(sale_date) WHEN 1995 THEN 'archive' ELSE 'current' END AS place, year(sale_date) AS sale_year,
              COUNT(*) AS lines FROM sales GROUP BY ALL""")
# The ids of a file's snapshots are new ones; everything else is as given.
ORACLES["x10_append_inventory"] = query(
    INVENTORY_FILE + " stock_value:d is_new:b",
    """SELECT * EXCLUDE (stock_value), CAST(final_stock * unit_cost AS DECIMAL(15,2)) AS stock_value,
              year(snapshot_date) = 2001 AS is_new FROM inventory""")
ORACLES["x10_append_twice"] = query(
    "table_name:s year:i rows:i file_lines:i",
    """SELECT 'sales' AS table_name, year(sale_date) AS year, COUNT(*) AS rows, (SELECT COUNT(*) FROM sales) AS file_lines
       FROM sales GROUP BY 2
       UNION ALL
       SELECT 'inventory', year(snapshot_date), COUNT(*), (SELECT COUNT(*) FROM inventory) FROM inventory GROUP BY 2""")
ORACLES["x10_rejects_of_loads"] = query(
    "load:i rule_id:s rejected_rows:i stored_rows:i",
    """SELECT 2 AS load, 'DQ4' AS rule_id, COUNT(*) FILTER (year(snapshot_date) = 2000) AS rejected_rows,
              COUNT(*) AS stored_rows FROM inventory""")
ORACLES["m1_refresh_after_append"] = ORACLES["m1_daily_summary"]
ORACLES["m1_rewritten_months"] = query(
    "year:i month:i rewritten:b rows:i",
    f"""SELECT year, month, sale_date >= DATE '2001-05-01' AS rewritten, COUNT(*) AS rows FROM ({M1}) GROUP BY ALL""")
ORACLES["m2_refresh_after_append"] = ORACLES["m2_product_performance"]
ORACLES["m3_refresh_after_append"] = ORACLES["m3_regional_performance"]
ORACLES["m4_maintained_positions"] = ORACLES["m4_latest_inventory"]
ORACLES["e3a_inventory_alerts_of_positions"] = ORACLES["e3a_inventory_alerts_full"]
ORACLES["q3_1_weekly_ticket_of_buckets"] = ORACLES["q3_1_weekly_ticket_by_format"]
ORACLES["q3_2_monthly_ticket_of_buckets"] = ORACLES["q3_2_monthly_ticket_by_region"]
ORACLES["s9_read_one_month"] = query(
    "table_name:s day:t rows:i folders:i",
    """SELECT 'sales' AS table_name, sale_date AS day, COUNT(*) AS rows, 1 AS folders FROM sales
       WHERE sale_date BETWEEN DATE '2000-11-01' AND DATE '2000-11-30' GROUP BY 2
       UNION ALL
       SELECT 'inventory', snapshot_date, COUNT(*), 1 FROM inventory
       WHERE snapshot_date BETWEEN DATE '2000-11-01' AND DATE '2000-11-30' GROUP BY 2""")
# The last interval of a pair runs to the end of the last year with a sale or a snapshot.
ORACLES["x3_cost_intervals"] = query(
    "product_id:i store_id:i unit_cost:d valid_from:t valid_to:t cost_year:i",
    """SELECT product_id, store_id, unit_cost, greatest(a, make_date(y, 1, 1)) AS valid_from,
              least(b, make_date(y, 12, 31)) AS valid_to, y AS cost_year
       FROM (SELECT *, unnest(range(year(a), year(b) + 1)) AS y
             FROM (SELECT product_id, store_id, unit_cost, snapshot_date AS a,
                          coalesce(lead(snapshot_date) OVER (PARTITION BY product_id, store_id ORDER BY snapshot_date) - 1,
                                   (SELECT make_date(max(year(sale_date)), 12, 31) FROM sales)) AS b
                   FROM inventory WHERE unit_cost IS NOT NULL))""")

# Calendar over the years of the data, with the lines sold per day.
CALENDAR_SALES = """SELECT c.*, coalesce(n, 0) AS lines FROM data_calendar c
                    LEFT JOIN (SELECT sale_date, COUNT(*) AS n FROM sales GROUP BY 1) ON sale_date = cal_date"""


def calendar_query(columns: str, where: str = "") -> str:
    return query(f"cal_date:t {columns} lines:i", f"SELECT * FROM ({CALENDAR_SALES}) {where}")


ORACLES["c1_date_series"] = query("cal_date:t lines:i", CALENDAR_SALES)
ORACLES["c2_date_parts"] = calendar_query("day:i month:i quarter:i year:i")
ORACLES["c3_iso_weekday"] = calendar_query("iso_weekday:i")
ORACLES["c4_iso_week"] = calendar_query("iso_week:i year:i")
ORACLES["c5_padded_names"] = calendar_query("day_name:s month_name:s")
ORACLES["c6_weekend_flag"] = calendar_query("is_weekend:b")
ORACLES["c7_fiscal_period"] = calendar_query("fiscal_period:s")
FIXED = "('Año Nuevo', 'Día del Trabajo', 'Día de la Independencia', 'Nochebuena', 'Navidad', 'Fin de Año')"
ORACLES["c8_fixed_holidays"] = calendar_query("holiday_name:s is_holiday:b", f"WHERE holiday_name IN {FIXED}")
ORACLES["c9_floating_holidays"] = calendar_query(
    "holiday_name:s is_holiday:b", f"WHERE is_holiday AND holiday_name NOT IN {FIXED}")
ORACLES["c10_calendar_summary"] = query(
    "year:i days:i weekend_days:i holidays:i",
    """SELECT year, COUNT(*) AS days, COUNT(*) FILTER (is_weekend) AS weekend_days,
              COUNT(*) FILTER (is_holiday) AS holidays FROM data_calendar GROUP BY year""")
ORACLES["c11_holiday_list"] = query(
    "year:i cal_date:t holiday_name:s day_name:s", "SELECT * FROM data_calendar WHERE is_holiday")

# Load validation.
ORACLES["v1_orphan_sales"] = query(
    "check_type:s orphans:i",
    """SELECT 'Orphaned sales records' AS check_type, COUNT(*) AS orphans FROM spoiled_sales s
       WHERE NOT EXISTS (SELECT 1 FROM spoiled_products p WHERE p.product_id = s.product_id)""", "{spoiled}")
ORACLES["v2_orphan_inventory"] = query(
    "check_type:s orphans:i",
    """SELECT 'Orphaned inventory records' AS check_type, COUNT(*) AS orphans FROM spoiled_inventory i
       WHERE NOT EXISTS (SELECT 1 FROM spoiled_products p WHERE p.product_id = i.product_id)""", "{spoiled}")
COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS record_count FROM {t}"
    for t in ("products", "stores", "calendar", "sales", "inventory"))
ORACLES["v3_table_counts"] = query("table_name:s record_count:i", COUNTS)
ORACLES["s11_readers_beside_changes"] = ORACLES["v3_table_counts"]
ORACLES["v4_date_span"] = query(
    "first_date:t last_date:t distinct_dates:i",
    """SELECT MIN(sale_date) AS first_date, MAX(sale_date) AS last_date, COUNT(DISTINCT sale_date) AS distinct_dates
       FROM sales""")
ORACLES["v5_daily_net_by_chain"] = query(
    "sale_date:t chain:s net_sales:d",
    f"""SELECT sale_date, chain, {NET} AS net_sales FROM sales JOIN stores USING (store_id)
        WHERE sale_date {Q4} GROUP BY ALL""")
ORACLES["v7_summary_row_count"] = query(
    "table_name:s record_count:i", f"SELECT 'daily_sales' AS table_name, COUNT(*) AS record_count FROM ({M1})")

# Documented metrics.
CHANNEL_NET = "CAST(CAST(coalesce(SUM(net_x100) FILTER (channel = '{c}'), 0) AS DECIMAL(28,4)) * CAST(0.01 AS DECIMAL(3,2)) AS DOUBLE)"
ORACLES["x1_store_performance"] = query(
    "store_id:i store_name:s chain:s format:s region:s units:i tickets:i net_sales:d net_per_ticket:d net_per_m2:d "
    "share_in_store_pct:d share_online_pct:d share_mobile_pct:d share_phone_pct:d share_other_pct:d",
    f"""SELECT store_id, store_name, chain, format, region, SUM(quantity) AS units, COUNT(DISTINCT ticket_id) AS tickets,
               {NET} AS net_sales, {NET_D} / COUNT(DISTINCT ticket_id) AS net_per_ticket,
               {NET_D} / floor_area_m2 AS net_per_m2, """ + ", ".join(
        f"round({CHANNEL_NET.format(c=c)} / {NET_D} * 100, 2) AS share_{c.replace('-', '_')}_pct"
        for c in ("in-store", "online", "mobile", "phone")) +
    ", 0.0 AS share_other_pct FROM sales JOIN stores USING (store_id) GROUP BY store_id, store_name, chain, format, region, floor_area_m2")
ORACLES["x2_store_vs_chain"] = query(
    "chain:s store_id:i store_name:s net_sales:d chain_mean:d position:s",
    f"""SELECT *, CAST(SUM(net_sales) OVER c AS DOUBLE) / COUNT(*) OVER c AS chain_mean,
               CASE WHEN CAST(net_sales AS DOUBLE) > chain_mean THEN 'above'
                    WHEN CAST(net_sales AS DOUBLE) < chain_mean THEN 'below' ELSE 'equal' END AS position
        FROM ({store_average(Q4)}) WINDOW c AS (PARTITION BY chain)""")
ORACLES["x3_margin"] = query(
    "category:s month:t units:i uncosted_units:i net_sales:d cost:d margin:d margin_per_cost:d",
    f"""SELECT *, CAST(margin AS DOUBLE) / CAST(cost AS DOUBLE) AS margin_per_cost
        FROM (SELECT category, date_trunc('month', sale_date) AS month, SUM(quantity) AS units,
                     coalesce(SUM(quantity) FILTER (unit_cost IS NULL), 0) AS uncosted_units, {NET} AS net_sales,
                     SUM(quantity * unit_cost) AS cost,
                     CAST(CAST(SUM(net_x100) FILTER (unit_cost IS NOT NULL) AS DECIMAL(28,4)) * CAST(0.01 AS DECIMAL(3,2))
                          AS DECIMAL(31,6)) - SUM(quantity * unit_cost) AS margin
              FROM (SELECT s.*, i.unit_cost FROM sales s ASOF LEFT JOIN inventory i ON s.product_id = i.product_id
                    AND s.store_id = i.store_id AND s.sale_date >= i.snapshot_date)
              JOIN products USING (product_id) WHERE sale_date {Y2000} GROUP BY category, month)""")
ORACLES["x3_margin_of_intervals"] = ORACLES["x3_margin"]
ORACLES["x4_sales_by_weekday"] = query(
    "quarter:i iso_weekday:i day_name:s days:i units:i net_sales:d avg_daily_sale:d",
    f"""SELECT quarter, iso_weekday, day_name, COUNT(DISTINCT sale_date) AS days, SUM(quantity) AS units,
               {NET} AS net_sales, {NET_D} / COUNT(DISTINCT sale_date) AS avg_daily_sale
        FROM sales JOIN calendar ON cal_date = sale_date WHERE year BETWEEN 1998 AND 2000
        GROUP BY quarter, iso_weekday, day_name""")
ORACLES["x5_gross_sales"] = query(
    "chain:s gross_sales:d net_sales:d discount_value:d",
    f"""SELECT *, gross_sales - net_sales AS discount_value
        FROM (SELECT chain, CAST(SUM(quantity * unit_price) AS DECIMAL(31,6)) AS gross_sales, {NET} AS net_sales
              FROM sales JOIN stores USING (store_id) WHERE sale_date {Y2000} GROUP BY chain)""")
ORACLES["x6_low_stock_share"] = query("category:s positions:i low_stock:i low_stock_rate_pct:d", HEALTH)
ORACLES["x7_product_velocity"] = query(
    f"{M2_COLUMNS} sale_days:i units_per_sale_day:d category_month_rank:i", M2)
ORACLES["x8_daily_summary_by_category"] = query(
    f"{M1_COLUMNS} category:s tickets:i units:i net_sales:d",
    f"""SELECT sale_date, year, month, month_name, day_name, chain, format, region, category,
         COUNT(DISTINCT ticket_id) AS tickets, SUM(quantity) AS units, {NET} AS net_sales
         FROM sales JOIN stores USING (store_id) JOIN products USING (product_id)
         JOIN calendar ON cal_date = sale_date GROUP BY ALL""")

ORACLES["x8_by_category_large_catalogue"] = ORACLES["x8_daily_summary_by_category"].replace(
    "FROM sales JOIN stores", "FROM (SELECT * REPLACE (CASE WHEN sale_id % 3 = 0 THEN 1 ELSE product_id END AS product_id) FROM sales) "
    "JOIN stores")


# Quality rules over the star with known faults.
def _spoiled(table: str) -> str:
    """CTE with the faults of ``testbind.SPOILED`` applied in order."""
    key, faults = KEYS[table], SPOILED[table][1]
    by_column: dict[str, str] = {}
    for column, divisor, remainder, value in faults:
        before = by_column.get(column, column)
        by_column[column] = f"CASE WHEN {key} % {divisor} = {remainder} THEN {value} ELSE {before} END"
    changed = ", ".join(f"{expression} AS {column}" for column, expression in by_column.items())
    copies = f"unnest(CASE WHEN {key} % {REPEATED[table]} = 0 THEN [0, 1] ELSE [0] END) AS copy_number"
    return f"spoiled_{table} AS (SELECT * REPLACE ({changed}), {copies} FROM {table})"


AFFINITY_ALL = """SELECT category_a, category_b, co_occurrences, avg_joint_value,
               RANK() OVER (ORDER BY co_occurrences DESC) AS affinity_rank
        FROM (SELECT a.category AS category_a, b.category AS category_b, COUNT(*) AS co_occurrences,
                     CAST(CAST(SUM(a.v + b.v) AS DECIMAL(28,4)) * CAST(0.01 AS DECIMAL(3,2)) AS DOUBLE) / COUNT(a.v + b.v)
                       AS avg_joint_value
              FROM basket a JOIN basket b ON a.ticket_id = b.ticket_id AND a.category < b.category GROUP BY ALL)"""
SPOILED_STAR = ", ".join([*(_spoiled(t) for t in SPOILED), "spoiled_calendar AS (SELECT * FROM calendar)"])
ORACLES["a1_category_affinity_with_nulls"] = query(
    "category_a:s category_b:s co_occurrences:i avg_joint_value:d affinity_rank:i", AFFINITY_ALL,
    SPOILED_STAR + f""", basket AS (
        SELECT ticket_id, category, product_name, SUM(quantity * unit_price * (100 - discount_pct)) AS v
        FROM spoiled_sales s JOIN (
            SELECT product_id, any_value(product_name) AS product_name,
                   any_value(CASE WHEN product_id % 31 <> 3 THEN category END) AS category
            FROM spoiled_products WHERE product_id IS NOT NULL GROUP BY product_id) p USING (product_id)
        WHERE sale_date {Y2000} AND ticket_id IS NOT NULL GROUP BY ALL)""")
for name in ("v1_orphan_sales", "v2_orphan_inventory"):
    ORACLES[name] = ORACLES[name].replace("{spoiled}", SPOILED_STAR)


# The rules as the data model states them, written down here apart from the engine's own list.
NOT_NULL = {
    "products": "sku product_name brand category",
    "stores": "store_code store_name chain format region city",
    "calendar": "day iso_weekday day_name iso_week month month_name quarter year is_weekend",
    "sales": "product_id store_id sale_date quantity unit_price",
    "inventory": "product_id store_id snapshot_date opening_stock final_stock",
}
LONGEST = {
    "products": {"sku": 50, "product_name": 200, "brand": 100, "category": 50, "subcategory": 50},
    "stores": {"store_code": 20, "store_name": 200, "chain": 100, "format": 50, "region": 50, "city": 100, "state": 50,
               "postal_code": 10},
    "calendar": {"day_name": 20, "month_name": 20, "holiday_name": 100, "fiscal_period": 10},
    "sales": {"ticket_id": 50, "channel": 20},
}
ROW_CONDITIONS = [
    *(("DQ5", t, f"{c} required", f"{c} IS NOT NULL") for t, columns in NOT_NULL.items() for c in columns.split()),
    ("DQ6", "products", "list_price not negative", "list_price >= 0"),
    ("DQ7", "stores", "floor_area_m2 positive", "floor_area_m2 > 0"),
    ("DQ8", "sales", "quantity positive", "quantity > 0"),
    ("DQ9", "sales", "unit_price not negative", "unit_price >= 0"),
    ("DQ10", "sales", "discount_pct 0 to 100", "discount_pct >= 0 AND discount_pct <= 100"),
    ("DQ11", "sales", "tax_pct not negative", "tax_pct >= 0"),
    ("DQ12", "inventory", "opening_stock not negative", "opening_stock >= 0"),
    ("DQ12", "inventory", "final_stock not negative", "final_stock >= 0"),
    ("DQ13", "inventory", "stock_in not negative", "stock_in >= 0"),
    ("DQ13", "inventory", "stock_out not negative", "stock_out >= 0"),
    ("DQ14", "inventory", "unit_cost not negative", "unit_cost >= 0"),
    ("DQ15", "products", "product_name not blank", "trim(product_name) <> ''"),
    ("DQ16", "stores", "store_name not blank", "trim(store_name) <> ''"),
    ("DQ17", "sales", "channel known", "channel IN ('in-store', 'online', 'mobile', 'phone')"),
    ("DQ18", "inventory", "stock balance", "final_stock = opening_stock + stock_in - stock_out"),
    *(("DQ21", t, f"{c} at most {n}", f"length({c}) <= {n}") for t, limits in LONGEST.items() for c, n in limits.items()),
]
UNIQUE = [  # rule, table, columns, whether a missing value counts
    ("DQ1", "products", ("product_id",), True), ("DQ1", "stores", ("store_id",), True),
    ("DQ1", "calendar", ("cal_date",), True), ("DQ1", "sales", ("sale_id", "sale_date"), True),
    ("DQ1", "inventory", ("inventory_id",), True), ("DQ2", "products", ("sku",), False),
    ("DQ3", "stores", ("store_code",), False),
    ("DQ4", "inventory", ("product_id", "store_id", "snapshot_date"), False),
]
REFERENCES = [
    (rule, table, column, target, target_column)
    for table, day in (("sales", "sale_date"), ("inventory", "snapshot_date"))
    for rule, column, target, target_column in (
        ("DQ19", "product_id", "products", "product_id"), ("DQ19", "store_id", "stores", "store_id"),
        ("DQ20", day, "calendar", "cal_date"))
]
DAYS = {"sales": "sale_date", "inventory": "snapshot_date"}


def _rule_select(rule_id: str, table: str, name: str, count: str) -> str:
    return f"SELECT '{rule_id}' AS rule_id, '{table}' AS table_name, '{name}' AS rule, coalesce(({count}), 0) AS violations"


def quality_parts(rule_id: str) -> list[str]:
    parts = [
        _rule_select(rule_id, table, name, f"SELECT COUNT(*) FROM spoiled_{table} WHERE NOT ({condition})")
        for rule, table, name, condition in ROW_CONDITIONS if rule == rule_id]
    for _, table, columns, primary in (k for k in UNIQUE if k[0] == rule_id):
        listed = ", ".join(columns)
        missing = " OR ".join(f"{c} IS NULL" for c in columns)
        parts.append(_rule_select(
            rule_id, table, f"unique({listed})",
            f"SELECT SUM(CASE WHEN {missing} THEN {'n' if primary else '0'} ELSE n - 1 END) "
            f"FROM (SELECT {listed}, COUNT(*) AS n FROM spoiled_{table} GROUP BY ALL)"))
    parts += [
        _rule_select(rule_id, table, f"{column} in {target}",
                     f"SELECT COUNT(*) FROM spoiled_{table} WHERE {column} IS NOT NULL AND {column} NOT IN "
                     f"(SELECT {target_column} FROM spoiled_{target} WHERE {target_column} IS NOT NULL)")
        for rule, table, column, target, target_column in REFERENCES if rule == rule_id]
    if rule_id == "DQ22":
        parts += [
            _rule_select(rule_id, t, f"{c} inside the calendar",
                         f"SELECT COUNT(*) FROM spoiled_{t} WHERE {c} NOT BETWEEN "
                         f"(SELECT MIN(cal_date) FROM calendar) AND (SELECT MAX(cal_date) FROM calendar)")
            for t, c in DAYS.items()]
    return parts


def quality_query(rule_ids: list[str]) -> str:
    parts = [part for rule_id in rule_ids for part in quality_parts(rule_id)]
    return query("rule_id:s table_name:s rule:s violations:i", " UNION ALL ".join(parts), SPOILED_STAR)


RULE_IDS = [f"DQ{number}" for number in range(1, 23)]
for rule_id in RULE_IDS:
    ORACLES[f"{rule_id.lower()}_rule"] = quality_query([rule_id])
ORACLES["dq_all_rules"] = quality_query(RULE_IDS)


def _flags(table: str, targets: dict[str, str]) -> str:
    """Boolean column per rule id: row rules of the file's columns, then references."""
    broken: dict[str, list[str]] = {}
    for rule_id, of, _, condition in ROW_CONDITIONS:
        # A file has no tax column; the default passes.
        if of == table and "tax_pct" not in condition and "postal_code" not in condition:
            broken.setdefault(rule_id, []).append(f"coalesce(NOT ({condition}), false)")
    for rule_id, of, column, target, target_column in REFERENCES:
        if of == table and target in targets:
            broken.setdefault(rule_id, []).append(
                f"({column} IS NOT NULL AND {column} NOT IN (SELECT {target_column} FROM {targets[target]}))")
    return ", ".join(f"({' OR '.join(tests)}) AS {rule_id}" for rule_id, tests in broken.items())


def _loaded(table: str, keys: dict[str, tuple[str, ...]], targets: dict[str, str]) -> tuple[str, list[str]]:
    """CTEs ending in ``stored_<table>``, and the selects that count rejected rows per rule."""
    flags = _flags(table, targets)
    ids = [part.rsplit(" AS ", 1)[1] for part in flags.split(", ") if " AS DQ" in part]
    ctes = [f"flagged_{table} AS (SELECT *, {flags} FROM spoiled_{table})",
            f"good_{table}_0 AS (SELECT * FROM flagged_{table} WHERE NOT ({' OR '.join(ids)}))"]
    counts = [f"SELECT '{table}' AS table_name, '{i}' AS rule_id, COUNT(*) AS rejected_rows FROM flagged_{table} WHERE {i}"
              for i in ids]
    for step, (rule_id, key) in enumerate(keys.items()):
        columns = ", ".join(key)
        ctes.append(f"counted_{table}_{step} AS (SELECT *, COUNT(*) OVER (PARTITION BY {columns}) AS n_{step} "
                    f"FROM good_{table}_{step})")
        bad = f"n_{step} > 1" + (f" OR {key[0]} IS NULL" if rule_id == "DQ1" else "")
        ctes.append(f"good_{table}_{step + 1} AS (SELECT * FROM counted_{table}_{step} WHERE NOT ({bad}))")
        counts.append(f"SELECT '{table}', '{rule_id}', COUNT(*) FROM counted_{table}_{step} WHERE {bad}")
    ctes.append(f"stored_{table} AS (SELECT * FROM good_{table}_{len(keys)})")
    return ", ".join(ctes), counts


def load_query() -> str:
    stored = {"products": "stored_products", "stores": "stored_stores", "calendar": "calendar"}
    steps = [
        _loaded("products", {"DQ1": ("product_id",), "DQ2": ("sku",)}, {}),
        _loaded("stores", {"DQ1": ("store_id",), "DQ3": ("store_code",)}, {}),
        _loaded("sales", {}, stored),
        _loaded("inventory", {"DQ4": ("product_id", "store_id", "snapshot_date")}, stored),
    ]
    counts = " UNION ALL ".join(c for _, selects in steps for c in selects)
    return query("table_name:s rule_id:s rejected_rows:i", f"SELECT * FROM ({counts}) WHERE rejected_rows > 0",
                 ", ".join([SPOILED_STAR, *(ctes for ctes, _ in steps)]))


ORACLES["x10_load_pipeline"] = load_query()
