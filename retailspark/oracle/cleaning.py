"""Cleaning and enrichment oracles."""

from retailspark.oracle.views import over_clean, over_dirty

NUMERIC = r"\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*"


def num(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '{NUMERIC}') THEN TRY_CAST({x} AS DOUBLE) END"


def whole(x: str) -> str:
    return f"CAST(trunc({num(x)}) AS BIGINT)"


def parsed(x: str) -> str:
    formats = [
        "%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y/%m/%d", "%b %d, %Y", "%d-%b-%Y", "%m-%d-%Y", "%m/%d/%Y", "%d/%m/%Y",
    ]
    short = f"WHEN {x} SIMILAR TO '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2}}' THEN try_strptime({x}, '%m/%d/%y')"
    compact = f"WHEN {x} SIMILAR TO '[0-9]{{8}}' THEN try_strptime({x}, '%Y%m%d')"
    return f"CASE {short} {compact} ELSE coalesce(" + ", ".join(f"try_strptime({x}, '{f}')" for f in formats) + ") END"


def repaired(x: str, mode: str = "repair") -> str:
    t = parsed(x)
    if mode == "null":
        return f"CASE WHEN year({t}) >= 1900 THEN {t} END"
    shift = f"1000 * ((2025 - year({t})) // 1000)"
    return (
        f"CASE WHEN year({t}) >= 1900 THEN {t}"
        f" WHEN year({t}) + {shift} BETWEEN 1900 AND 2025"
        f" THEN {t} + to_years(CAST({shift} AS INTEGER)) END"
    )


def filled(x: str, value: str = "Unknown") -> str:
    return f"coalesce({x}, '{value}')"


def digits(x: str) -> str:
    return rf"nullif(regexp_replace({x}, '[^0-9]', '', 'g'), '')"


FIRST_PHONE = "trim(split_part({}, ',', 1))"

ITEM_CHECKS = [
    ("missing order_id", "order_id IS NULL"),
    ("missing product_id", "product_id IS NULL"),
    ("missing item_id", "item_id IS NULL"),
    *[
        (f"invalid {c}", f"({num(c)}) IS NULL")
        for c in ("order_id", "item_id", "product_id", "quantity", "list_price", "discount")
    ],
    ("quantity out of range", f"NOT ({whole('quantity')} > 0)"),
]
ITEM_REASON = "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, c in ITEM_CHECKS) + " END"

RECIPES = {
    "brands": f"""
SELECT {whole('brand_id')} AS brand_id, {filled('brand_name')} AS brand_name
FROM (SELECT DISTINCT * FROM d_brands)""",
    "categories": f"""
SELECT {whole('category_id')} AS category_id, {filled('category_name')} AS category_name
FROM (SELECT DISTINCT * FROM d_categories)""",
    "products": f"""
SELECT {whole('product_id')} AS product_id, product_name, {whole('brand_id')} AS brand_id,
       {whole('category_id')} AS category_id, coalesce({whole('model_year')}, 0) AS model_year,
       {num('list_price')} AS list_price
FROM (SELECT DISTINCT * FROM d_products)
WHERE product_id IS NOT NULL AND product_name IS NOT NULL AND {num('list_price')} >= 0""",
    "customers": f"""
SELECT {whole('customer_id')} AS customer_id, {filled('first_name')} AS first_name,
       {filled('last_name')} AS last_name,
       {digits(FIRST_PHONE.format(filled('phone')))} AS phone,
       {filled('email', 'unknown@email.com')} AS email, {filled('street')} AS street,
       {filled('city')} AS city, {filled('state')} AS state, {filled('zip_code', '00000')} AS zip_code,
       {filled('first_name')} || ' ' || {filled('last_name')} AS full_name
FROM (SELECT DISTINCT * FROM d_customers) WHERE customer_id IS NOT NULL""",
    "orders": f"""
SELECT {whole('order_id')} AS order_id, {whole('customer_id')} AS customer_id,
       {whole('order_status')} AS order_status, {repaired('order_date')} AS order_date,
       {repaired('required_date')} AS required_date, {repaired('shipped_date')} AS shipped_date,
       {whole('store_id')} AS store_id, {whole('staff_id')} AS staff_id
FROM (SELECT DISTINCT * FROM d_orders) WHERE order_id IS NOT NULL AND customer_id IS NOT NULL""",
    "order_items": f"""
SELECT {whole('order_id')} AS order_id, {whole('item_id')} AS item_id,
       {whole('product_id')} AS product_id, {whole('quantity')} AS quantity,
       {num('list_price')} AS list_price, {num('discount')} AS discount
FROM (SELECT DISTINCT * FROM d_order_items) WHERE ({ITEM_REASON}) IS NULL""",
    "staffs": f"""
SELECT {whole('staff_id')} AS staff_id, {filled('first_name')} AS first_name,
       {filled('last_name')} AS last_name, {filled('email', 'unknown@email.com')} AS email,
       {digits(filled('phone'))} AS phone, {whole('active')} AS active,
       {whole('store_id')} AS store_id, {whole(filled('manager_id', '0'))} AS manager_id
FROM (SELECT DISTINCT * FROM d_staffs)
WHERE ({num('staff_id')}) IS NOT NULL AND ({num('store_id')}) IS NOT NULL
  AND ({num('active')}) IS NOT NULL AND ({num(filled('manager_id', '0'))}) IS NOT NULL""",
    "stores": f"""
SELECT {whole('store_id')} AS store_id, {filled('store_name')} AS store_name,
       {digits(filled('phone'))} AS phone, {filled('email', 'unknown@email.com')} AS email,
       {filled('street')} AS street, {filled('city')} AS city, {filled('state')} AS state,
       {filled('zip_code', '00000')} AS zip_code
FROM (SELECT DISTINCT * FROM d_stores) WHERE store_id IS NOT NULL""",
    "stocks": f"""
SELECT {whole('store_id')} AS store_id, {whole('product_id')} AS product_id,
       coalesce({whole('quantity')}, 0) AS quantity
FROM (SELECT DISTINCT * FROM d_stocks)
WHERE store_id IS NOT NULL AND product_id IS NOT NULL AND coalesce({whole('quantity')}, 0) >= 0""",
}

ROW_DELTA = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, (SELECT count(*) FROM d_{name}) AS rows_before,"
    f" (SELECT count(*) FROM ({sql})) AS rows_after"
    for name, sql in RECIPES.items()
)

SAFE_ITEMS = f"""
SELECT {whole('order_id')} AS order_id, {whole('item_id')} AS item_id,
       {whole('product_id')} AS product_id, {whole('quantity')} AS quantity,
       {num('list_price')} AS list_price, {num('discount')} AS discount
FROM d_order_items
WHERE {' AND '.join(f'({num(c)}) IS NOT NULL' for c in
      ('order_id', 'item_id', 'product_id', 'quantity', 'list_price', 'discount'))}"""

CUSTOMER_FILLED = f"""
SELECT customer_id, {filled('first_name')} AS first_name, {filled('last_name')} AS last_name,
       {filled('phone')} AS phone, {filled('email', 'unknown@email.com')} AS email,
       {filled('street')} AS street, {filled('city')} AS city, {filled('state')} AS state,
       {filled('zip_code', '00000')} AS zip_code FROM d_customers"""

ORDER_TOTALS = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CAST(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 WHEN 'F' THEN 4 END AS BIGINT) AS order_status,
       o_orderdate AS order_date, CAST(c_nationkey AS BIGINT) AS store_id,
       coalesce(CAST(sum(i.total_price) AS DOUBLE), 0) AS order_total,
       count(i.order_id) AS line_count, CAST(coalesce(sum(i.quantity), 0) AS BIGINT) AS unit_count
FROM orders LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN v_order_items i ON i.order_id = o_orderkey GROUP BY ALL"""

# What is left of a moment in each of the twelve forms: the day, the day and minute, the first of the month, and so on.
_KEPT = ["day", "day", "day", "minute", "month", "second", "minute", "day", "day", "second", "hour", "second"]
DATE_FORMS = (
    "SELECT o_orderkey AS order_id, CASE o_orderkey % 12 "
    + " ".join(f"WHEN {i} THEN date_trunc('{part}', t)" for i, part in enumerate(_KEPT))
    + " END::TIMESTAMP AS order_date FROM (SELECT o_orderkey, o_orderdate::TIMESTAMP + to_hours(o_orderkey % 24)"
    " + to_minutes(o_orderkey % 60) AS t FROM orders)"
)

ORACLES = {
    "cln_date_forms": DATE_FORMS,
    "cln_unread_dates": over_dirty(" UNION ALL ".join(
        f"SELECT 'orders' AS table_name, '{c}' AS column_name,"
        f" (SELECT count(*) FROM d_orders WHERE {c} IS NOT NULL AND {parsed(c)} IS NULL) AS unread"
        for c in ("order_date", "required_date", "shipped_date")
    )),
    "cln_standardise_names": over_dirty(
        "SELECT * RENAME (order_date AS orderdate) FROM d_orders"
    ),
    "cln_dedup": over_dirty("SELECT DISTINCT * FROM d_customers"),
    "cln_drop_null_keys": over_dirty(
        "SELECT * FROM d_products WHERE product_id IS NOT NULL AND product_name IS NOT NULL"
    ),
    "cln_fill_defaults": over_dirty(CUSTOMER_FILLED),
    "cln_cast_strict": over_dirty(f"""
SELECT {whole('product_id')} AS product_id, product_name, {whole('brand_id')} AS brand_id,
       {whole('category_id')} AS category_id, coalesce({whole('model_year')}, 0) AS model_year,
       {num('list_price')} AS list_price FROM d_products"""),
    "cln_safe_numeric": over_dirty(SAFE_ITEMS),
    "cln_quarantine": over_dirty(f"""
SELECT * FROM (SELECT *, {ITEM_REASON} AS rejected_because FROM (SELECT DISTINCT * FROM d_order_items))
WHERE rejected_because IS NOT NULL"""),
    "cln_finite": over_dirty(
        "SELECT staff_id, CAST(active AS DOUBLE) AS active FROM d_staffs"
        " WHERE isfinite(CAST(active AS DOUBLE))"
    ),
    "cln_range_filter": over_dirty(
        f"SELECT * FROM ({SAFE_ITEMS}) WHERE list_price >= 0 AND quantity > 0"
    ),
    "cln_full_name": over_dirty(
        f"SELECT customer_id, first_name || ' ' || last_name AS full_name FROM ({CUSTOMER_FILLED})"
    ),
    "cln_first_phone": over_dirty(
        f"SELECT customer_id, {FIRST_PHONE.format('phone')} AS phone FROM d_customers"
    ),
    "cln_phone_digits": over_dirty(
        f"SELECT customer_id, {digits(FIRST_PHONE.format(filled('phone')))} AS phone FROM d_customers"
    ),
    "cln_date_repair": over_dirty(f"""
SELECT order_id, {repaired('order_date')} AS order_date, {repaired('required_date')} AS required_date,
       {repaired('shipped_date')} AS shipped_date FROM d_orders"""),
    "cln_date_repair_null": over_dirty(f"""
SELECT order_id, {repaired('order_date', 'null')} AS order_date,
       {repaired('required_date', 'null')} AS required_date,
       {repaired('shipped_date', 'null')} AS shipped_date FROM d_orders"""),
    "cln_invalid_dates": over_dirty(f"""
SELECT count(*) AS invalid_dates FROM ({RECIPES['orders']})
WHERE order_date IS NULL OR required_date IS NULL"""),
    "cln_row_delta": over_dirty(ROW_DELTA),
    **{f"cln_{name}": over_dirty(sql) for name, sql in RECIPES.items()},
    "enr_products": over_clean("""
SELECT product_id, product_name, CASE WHEN product_id % 6 = 0 THEN brand_id + 1000 ELSE brand_id END AS brand_id,
       category_id, list_price, CASE WHEN product_id % 6 <> 0 THEN brand_name END AS brand_name, category_name
FROM v_products"""),
    "enr_gated": over_clean("""
SELECT 'products' AS table_name, FALSE AS derived, count(*) AS row_count,
       CAST(sum(CAST(list_price AS DECIMAL(28,4))) AS DOUBLE) AS total FROM v_products
UNION ALL SELECT 'order_items', TRUE, count(*), CAST(sum(CAST(total_price AS DECIMAL(28,4))) AS DOUBLE) FROM v_order_items
UNION ALL SELECT 'orders', TRUE, count(*), CAST(sum(CAST(order_total AS DECIMAL(28,4))) AS DOUBLE) FROM v_orders"""),
    "enr_item_total": over_dirty(
        f"SELECT *, quantity * list_price * (1 - discount) AS total_price FROM ({RECIPES['order_items']})"
    ),
    "enr_order_total": over_clean(ORDER_TOTALS),
    "enr_summary": over_clean(f"""
SELECT (SELECT CAST(sum(total_price) AS DOUBLE) FROM v_order_items) AS total_revenue,
       (SELECT CAST(sum(CAST(order_total AS DECIMAL(18,4))) AS DOUBLE) / count(*) FROM ({ORDER_TOTALS})) AS avg_order_value"""),
}
