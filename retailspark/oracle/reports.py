"""Report oracles: each fact is summed up once by the key it is asked for, and dimensions only name the sums."""

from retailspark.oracle.views import over_clean
from retailspark.schemas import CUSTOMER_TYPES, SEGMENT_NAMES, STATUS_NAMES

LOW_STOCK = 450
LOW, HIGH = 1_000_000, 3_000_000

SUMS = """
line_sums AS (
  SELECT order_id, count(*) AS lines, sum(quantity) AS units FROM v_order_items GROUP BY order_id),
product_sums AS (
  SELECT product_id, sum(quantity) AS units, sum(total_price) AS revenue, count(total_price) AS priced,
         sum(CAST(list_price AS DECIMAL(24,8))) AS prices, count(list_price) AS listed
  FROM v_order_items GROUP BY product_id),
ledger AS (
  SELECT o.*, CAST(order_total AS DECIMAL(18,4)) AS total, coalesce(lines, 0) AS lines, units,
         CAST(order_total AS DECIMAL(18,4)) * CAST(coalesce(lines, 0) AS DECIMAL(9,0)) AS line_total
  FROM v_orders o LEFT JOIN line_sums USING (order_id)),
shelf AS (
  SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units, count(store_id) AS stores
  FROM v_stocks GROUP BY product_id),
short AS (
  SELECT * FROM v_products ANTI JOIN (SELECT product_id FROM shelf WHERE units >= {low}) USING (product_id)),
active AS (SELECT * FROM v_staffs WHERE active = 1)
""".format(low=LOW_STOCK)


def _sql(body: str) -> str:
    return over_clean("", SUMS) + body


def _per(total: str, n: str) -> str:
    """A mean as DOUBLE; NULL over nothing."""
    return f"CASE WHEN {n} <> 0 THEN CAST({total} AS DOUBLE) / {n} END"


def _labels(column: str, names: dict, otherwise: str = "NULL") -> str:
    """A name for each code, through a map rather than a chain of conditions."""
    pairs = ", ".join(f"{code}: '{name}'" for code, name in names.items())
    return f"coalesce(MAP {{{pairs}}}[{column}], {otherwise})"


def _orders_by(key: str, where: str = "TRUE") -> str:
    """Order-grain sums by a column of the orders."""
    return f"""(
  SELECT {key} AS k, count(DISTINCT order_id) AS orders, sum(total) AS revenue, count(total) AS totals,
         count(DISTINCT customer_id) AS customers, min(order_date) AS first_day, max(order_date) AS last_day
  FROM ledger WHERE {where} GROUP BY {key})"""


def _lines_by(key: str) -> str:
    """Line-grain sums by a column of the orders: an order's total counts once for each of its lines."""
    return f"""(
  SELECT {key} AS k, count(DISTINCT order_id) AS orders, sum(line_total) AS revenue, CAST(sum(lines) AS BIGINT) AS totals,
         CAST(sum(units) AS BIGINT) AS units, count(DISTINCT customer_id) AS customers,
         min(order_date) AS first_day, max(order_date) AS last_day
  FROM ledger WHERE lines > 0 GROUP BY {key})"""


def _best_sellers(more: str = "") -> str:
    return _sql(f"""
SELECT product_id, product_name, brand_name, category_name, CAST(units AS BIGINT) AS total_quantity_sold,
       CAST(revenue AS DOUBLE) AS total_revenue, {_per('prices', 'listed')} AS avg_selling_price{more}
FROM v_products SEMI JOIN
     (SELECT product_id FROM product_sums JOIN v_products USING (product_id) ORDER BY units DESC, product_id LIMIT 10)
     USING (product_id)
JOIN product_sums USING (product_id)""")


_PRODUCT_ORDERS = """,
       (SELECT count(DISTINCT i.order_id) FROM v_order_items i WHERE i.product_id = v_products.product_id) AS number_of_orders"""


def _best_customers(columns: str, more: str = "") -> str:
    return _sql(f"""
SELECT {columns}, orders AS total_orders, CAST(revenue AS DOUBLE) AS total_spent,
       {_per('revenue', 'totals')} AS avg_order_value{more}
FROM {_orders_by('customer_id')} b JOIN v_customers ON customer_id = k
QUALIFY row_number() OVER (ORDER BY CAST(revenue AS DOUBLE) DESC, customer_id) <= 5""")


def _by_group(dim: str, key: str, name: str) -> str:
    """Product sums rolled up to a group's name."""
    return _sql(f"""
SELECT {name}, CAST(sum(products) AS BIGINT) AS number_of_products, CAST(sum(units) AS BIGINT) AS total_quantity_sold,
       CAST(sum(revenue) AS DOUBLE) AS total_revenue
FROM (SELECT {key}, count(*) AS products, sum(units) AS units, sum(revenue) AS revenue
      FROM product_sums JOIN v_products USING (product_id) GROUP BY {key}) JOIN (SELECT {key}, {name} FROM {dim}) USING ({key})
GROUP BY {name}""")


def _by_group_full(dim: str, key: str, name: str) -> str:
    return _sql(f"""
SELECT {key}, n.{name}, products AS number_of_products, CAST(units AS BIGINT) AS total_quantity_sold,
       CAST(revenue AS DOUBLE) AS total_revenue, {_per('revenue', 'priced')} AS avg_transaction_value,
       reach AS total_orders
FROM (SELECT {key}, count(*) AS products, sum(units) AS units, sum(revenue) AS revenue, sum(priced) AS priced
      FROM product_sums JOIN v_products USING (product_id) GROUP BY {key})
JOIN (SELECT {key}, count(*) AS reach
      FROM (SELECT DISTINCT {key}, order_id FROM v_order_items JOIN v_products USING (product_id)) GROUP BY {key})
     USING ({key})
JOIN (SELECT {key}, {name} FROM {dim}) n USING ({key})""")


# Months are counted from the year 0, and written out again at the end.
_MONTH_KEY = "year(order_date) * 12 + month(order_date) - 1"
_MONTH = """CAST(k // 12 AS INTEGER) AS order_year, CAST(k % 12 + 1 AS INTEGER) AS order_month,
       monthname(make_date(k // 12, k % 12 + 1, 1)) AS month_name"""

_MONTHLY = f"""
SELECT {_MONTH}, orders AS total_orders, CAST(revenue AS DOUBLE) AS total_revenue, units AS total_items_sold
FROM {_lines_by(_MONTH_KEY)} WHERE k IS NOT NULL"""

_SHORT = """
SELECT product_id, product_name, brand_name, category_name, list_price, units AS total_stock
FROM short LEFT JOIN shelf USING (product_id)"""

_HELD = """(
  SELECT store_id, product_id, quantity, quantity * CAST(list_price AS DECIMAL(28,8)) AS worth
  FROM v_stocks SEMI JOIN v_stores USING (store_id) JOIN v_products USING (product_id))"""

_INVENTORY = f"""
SELECT store_name, city, count(DISTINCT product_id) AS unique_products,
       CAST(sum(quantity) AS BIGINT) AS total_inventory_units, CAST(sum(worth) AS DOUBLE) AS total_inventory_value
FROM {_HELD} JOIN v_stores USING (store_id) GROUP BY ALL"""

_STAFF_NAME = "first_name || ' ' || last_name AS staff_name"

_STAFF = f"""
SELECT staff_id, {_STAFF_NAME}, store_name, coalesce(orders, 0) AS total_orders_handled,
       CAST(revenue AS DOUBLE) AS total_sales_revenue, {_per('revenue', 'totals')} AS avg_order_value
FROM active LEFT JOIN (SELECT store_id, store_name FROM v_stores) USING (store_id)
LEFT JOIN {_orders_by('staff_id')} ON k = staff_id"""


def _spenders(columns: str, more: str = "") -> str:
    none, low, medium, high = SEGMENT_NAMES
    return f"""
SELECT {columns}, 0 AS total_orders, 0.0::DOUBLE AS total_spent, 0.0::DOUBLE AS avg_order_value{more.replace('@', 'NULL')},
       '{none}' AS customer_segment
FROM v_customers ANTI JOIN v_orders USING (customer_id)
UNION ALL
SELECT {columns}, orders, coalesce(CAST(revenue AS DOUBLE), 0), coalesce({_per('revenue', 'totals')}, 0){
    more.replace('@ AS ', '')},
       ['{low}', '{medium}', '{high}'][1 + (revenue >= {LOW} OR revenue IS NULL)::INT + (revenue > {HIGH} OR revenue IS NULL)::INT]
FROM v_customers JOIN {_orders_by('customer_id')} ON k = customer_id"""


_SPEND = _spenders("customer_id, full_name, city, state")


def _idle(columns: str) -> str:
    return _sql(f"SELECT {columns} FROM v_customers WHERE customer_id NOT IN (SELECT customer_id FROM v_orders)")


_STATUS = "(SELECT order_status, count(*) AS n, sum(total) AS revenue, count(total) AS totals FROM ledger GROUP BY 1)"
_SHARE = "CAST(CAST(n * 100.0::DOUBLE / (SELECT count(*) FROM v_orders) AS DECIMAL(5,2)) AS DOUBLE)"
_STATUS_ROWS = f"""
SELECT order_status, {_labels('order_status', STATUS_NAMES)} AS status_name, n AS order_count,
       CAST(revenue AS DOUBLE) AS total_revenue, {_SHARE} AS percentage FROM {_STATUS}"""

_KPIS = f"""
SELECT CAST(revenue AS DOUBLE) AS total_revenue, orders AS total_orders,
       coalesce({_per('revenue', 'orders')}, 0) AS avg_order_value,
       (SELECT count(*) FROM v_customers) AS total_customers
FROM (SELECT sum(total) AS revenue, count(*) AS orders FROM ledger SEMI JOIN v_stores USING (store_id))"""

_CATEGORY = """(
  SELECT category_name, sum(revenue) AS revenue FROM product_sums JOIN v_products USING (product_id) GROUP BY 1)"""

ORACLES = {
    "rpt_top_products": _best_sellers(),
    "rpt_top_products_full": _best_sellers(_PRODUCT_ORDERS),
    "rpt_top_customers": _best_customers("customer_id, full_name, city, state"),
    "rpt_top_customers_full": _best_customers(
        "customer_id, full_name, email, city, state", ", last_day AS last_order_date"
    ),
    "rpt_store_revenue": _sql(f"""
SELECT store_id, store_name, city, orders AS total_orders, CAST(revenue AS DOUBLE) AS total_revenue,
       {_per('revenue', 'totals')} AS avg_order_value
FROM {_orders_by('store_id')} JOIN v_stores ON store_id = k"""),
    "rpt_store_revenue_linegrain": _sql(f"""
SELECT store_id, store_name, city, state, orders AS total_orders, CAST(revenue AS DOUBLE) AS total_revenue,
       {_per('revenue', 'totals')} AS avg_order_value, units AS total_items_sold
FROM {_lines_by('store_id')} JOIN v_stores ON store_id = k"""),
    "rpt_category": _by_group("v_categories", "category_id", "category_name"),
    "rpt_category_full": _by_group_full("v_categories", "category_id", "category_name"),
    "rpt_brand": _by_group("v_brands", "brand_id", "brand_name"),
    "rpt_brand_full": _by_group_full("v_brands", "brand_id", "brand_name"),
    "rpt_monthly": _sql(_MONTHLY),
    "rpt_monthly_linegrain": _sql(f"""
SELECT {_MONTH}, orders AS total_orders, CAST(revenue AS DOUBLE) AS total_revenue,
       {_per('revenue', 'totals')} AS avg_order_value, units AS total_items_sold, customers AS unique_customers
FROM {_lines_by(_MONTH_KEY)} WHERE k IS NOT NULL"""),
    "rpt_monthly_ordergrain": _sql(f"""
SELECT {_MONTH}, orders AS total_orders, CAST(revenue AS DOUBLE) AS total_revenue, items AS total_items_sold
FROM {_orders_by(_MONTH_KEY, 'lines > 0')}
JOIN (SELECT {_MONTH_KEY} AS k, CAST(sum(units) AS BIGINT) AS items FROM ledger GROUP BY 1) USING (k)
WHERE k IS NOT NULL"""),
    "rpt_low_stock": _sql(_SHORT),
    "rpt_low_stock_detail": _sql("""
SELECT product_id, product_name, brand_name, category_name, list_price, units AS total_stock_across_stores,
       coalesce(stores, 0) AS number_of_stores_stocking, coalesce(listed, ': ') AS stock_by_store
FROM short LEFT JOIN shelf USING (product_id)
LEFT JOIN (SELECT product_id, array_to_string(list(store_name || ': ' || quantity ORDER BY store_name, quantity), ', ') AS listed
           FROM v_stocks JOIN v_stores USING (store_id) GROUP BY product_id) USING (product_id)"""),
    "rpt_store_inventory": _sql(_INVENTORY),
    "rpt_store_inventory_full": _sql(f"""
SELECT store_id, store_name, city, state, kinds AS unique_products_stocked, units AS total_inventory_units,
       units // counted AS avg_stock_per_product, worth AS total_inventory_value
FROM (SELECT store_id, count(DISTINCT product_id) AS kinds, CAST(sum(quantity) AS BIGINT) AS units,
             count(quantity) AS counted, CAST(sum(worth) AS DOUBLE) AS worth FROM {_HELD} GROUP BY store_id)
JOIN v_stores USING (store_id)"""),
    "rpt_staff": _sql(_STAFF),
    "rpt_staff_full": _sql(f"""
SELECT staff_id, {_STAFF_NAME}, email, store_name, store_city, coalesce(orders, 0) AS total_orders_handled,
       CAST(revenue AS DOUBLE) AS total_sales_revenue, {_per('revenue', 'totals')} AS avg_order_value,
       coalesce(customers, 0) AS unique_customers_served, first_day AS first_order_date, last_day AS last_order_date
FROM active LEFT JOIN (SELECT store_id, store_name, city AS store_city FROM v_stores) USING (store_id)
LEFT JOIN {_orders_by('staff_id')} ON k = staff_id"""),
    "rpt_best_staff": _sql(f"""
SELECT * FROM ({_STAFF}) WHERE total_orders_handled > 0
QUALIFY row_number() OVER (ORDER BY total_sales_revenue DESC, staff_id) = 1"""),
    "rpt_best_staff_linegrain": _sql(f"""
SELECT staff_id, {_STAFF_NAME}, email, store_name, orders AS total_orders_handled,
       CAST(revenue AS DOUBLE) AS total_sales_revenue, {_per('revenue', 'totals')} AS avg_order_value,
       units AS total_items_sold, customers AS unique_customers_served, {_per('revenue', 'orders')} AS revenue_per_order,
       {_per('orders', "date_diff('day', first_day, last_day)")} AS avg_orders_per_day
FROM active JOIN {_lines_by('staff_id')} ON k = staff_id
LEFT JOIN (SELECT store_id, store_name FROM v_stores) USING (store_id)
QUALIFY row_number() OVER (ORDER BY CAST(revenue AS DOUBLE) DESC, staff_id) = 1"""),
    "rpt_customers_no_orders": _idle("customer_id, full_name, email, city, state"),
    "rpt_customers_no_orders_full": _idle("customer_id, full_name, email, phone, city, state, zip_code"),
    "rpt_customer_spending": _sql(_SPEND),
    "rpt_customer_spending_full": _sql(_spenders(
        "customer_id, full_name, email, city, state", ", @ AS first_day, @ AS last_day"
    ).replace("NULL AS first_day", "NULL AS first_order_date").replace("NULL AS last_day", "NULL AS last_order_date")),
    "rpt_spend_overall": _sql(f"""
SELECT everyone AS total_customers, buyers AS customers_with_orders, everyone - buyers AS customers_without_orders,
       CAST(revenue AS DOUBLE) AS total_revenue, {_per('revenue', 'totals')} AS avg_order_value,
       {_per('revenue', 'buyers')} AS avg_spending_per_customer
FROM (SELECT count(*) AS everyone FROM v_customers),
     (SELECT count(*) AS buyers, sum(revenue) AS revenue, CAST(sum(totals) AS BIGINT) AS totals
      FROM {_orders_by('customer_id')} SEMI JOIN v_customers ON k = customer_id)"""),
    "rpt_retention": _sql(f"""
SELECT {_labels('least(orders, 4)', CUSTOMER_TYPES)} AS customer_type, count(*) AS number_of_customers,
       {_per('sum(revenue)', 'count(revenue)')} AS avg_total_spent,
       CAST(sum(orders) // count(*) AS BIGINT) AS avg_orders_per_customer
FROM {_orders_by('customer_id')} SEMI JOIN v_customers ON k = customer_id GROUP BY 1"""),
    "rpt_status": _sql(_STATUS_ROWS),
    "rpt_status_full": _sql(f"""
SELECT order_status, {_labels('order_status', STATUS_NAMES, "'Unknown'")} AS status_name, n AS order_count,
       CAST(revenue AS DOUBLE) AS total_revenue, {_per('revenue', 'totals')} AS avg_order_value,
       {_SHARE} AS percentage_of_total FROM {_STATUS}"""),
    "rpt_kpis": _sql(_KPIS),
    "rpt_kpi_labels": _sql(f"""
SELECT '$' || format('{{:,.2f}}', total_revenue) AS total_revenue, format('{{:,}}', total_orders) AS total_orders,
       '$' || format('{{:,.2f}}', avg_order_value) AS avg_order_value,
       format('{{:,}}', total_customers) AS total_customers FROM ({_KPIS})"""),
    "rpt_series_monthly": _sql(f"""
SELECT strftime(make_date(order_year, order_month, 1), '%Y-%m') AS year_month, total_revenue, total_orders
FROM ({_MONTHLY})"""),
    "rpt_segment_share": _sql(f"""
SELECT customer_segment, n AS customers, round(n * 100.0 / (SELECT count(*) FROM v_customers), 1) AS share_pct
FROM (SELECT customer_segment, count(*) AS n FROM ({_SPEND}) GROUP BY 1)"""),
    "rpt_category_share": _sql(f"""
SELECT category_name, CAST(revenue AS DOUBLE) AS total_revenue,
       round(CAST(revenue AS DOUBLE) * 100.0 / CAST((SELECT sum(revenue) FROM product_sums) AS DOUBLE), 1) AS share_pct
FROM {_CATEGORY}"""),
    "rpt_status_labels": _sql(f"""
SELECT order_status, status_name, order_count,
       order_count || chr(10) || '(' || CAST(percentage AS VARCHAR) || '%)' AS label
FROM ({_STATUS_ROWS})"""),
    "rpt_low_stock_alert": _sql(f"""
SELECT product_id, product_name, brand_name, category_name, coalesce(total_stock, 0) AS stock_level, list_price,
       (SELECT count(*) FROM short) AS alert_count
FROM ({_SHORT}) QUALIFY row_number() OVER (ORDER BY total_stock NULLS FIRST, product_id) <= 10"""),
    "rpt_inactive_count": _sql("SELECT count(*) AS inactive_customers FROM v_customers ANTI JOIN v_orders USING (customer_id)"),
    "rpt_series_staff": _sql(f"SELECT staff_id, staff_name, total_sales_revenue FROM ({_STAFF})"),
    "rpt_series_brand": _sql("""
SELECT brand_name, CAST(sum(revenue) AS DOUBLE) AS total_revenue
FROM product_sums JOIN v_products USING (product_id) GROUP BY brand_name"""),
    "rpt_series_inventory": _sql(f"SELECT store_name, city, total_inventory_units, total_inventory_value FROM ({_INVENTORY})"),
}
