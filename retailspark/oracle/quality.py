"""Profiling oracles. The SQL is generated per table and column from the raw column lists."""

from retailspark.oracle.cleaning import RECIPES, num, parsed
from retailspark.oracle.views import over_clean, over_dirty

COLUMNS = {
    "brands": ["brand_id", "brand_name"],
    "categories": ["category_id", "category_name"],
    "stores": [
        "store_id", "store_name", "phone", "email", "street", "city", "state", "zip_code",
    ],
    "staffs": [
        "staff_id", "first_name", "last_name", "email", "phone", "active", "store_id",
        "manager_id",
    ],
    "products": [
        "product_id", "product_name", "brand_id", "category_id", "model_year", "list_price",
    ],
    "customers": [
        "customer_id", "first_name", "last_name", "phone", "email", "street", "city", "state",
        "zip_code",
    ],
    "orders": [
        "order_id", "customer_id", "order_status", "order_date", "required_date",
        "shipped_date", "store_id", "staff_id",
    ],
    "order_items": [
        "order_id", "item_id", "product_id", "quantity", "list_price", "discount",
    ],
    "stocks": ["store_id", "product_id", "quantity"],
}


def pct(part: str, base: str) -> str:
    return f"coalesce(round({part} * 100.0 / nullif({base}, 0), 2), 0.0)"


def rows(t: str) -> str:
    return f"(SELECT count(*) FROM d_{t})"


def where(t: str, condition: str) -> str:
    return f"(SELECT count(*) FROM d_{t} WHERE {condition})"


def extra(t: str) -> str:
    return f"({rows(t)} - (SELECT count(*) FROM (SELECT DISTINCT * FROM d_{t})))"


def union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


DUPLICATES = union(
    [
        f"SELECT '{t}' AS table_name, n > 0 AS needed, n AS count, {pct('n', rows(t))} AS pct"
        f" FROM (SELECT {extra(t)} AS n)"
        for t in COLUMNS
    ]
)

MISSING = (
    "SELECT * FROM ("
    + union(
        [
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, {where(t, f'{c} IS NULL')} AS count,"
            f" {pct(where(t, f'{c} IS NULL'), rows(t))} AS pct"
            for t, cols in COLUMNS.items()
            for c in cols
        ]
    )
    + ") WHERE count > 0"
)


def text_type(t: str, c: str) -> str:
    """The type a text column amounts to; integers with gaps count as double."""
    no_int = where(t, rf"{c} IS NOT NULL AND NOT regexp_full_match({c}, '\s*[+-]?[0-9]+\s*')")
    no_num = where(t, f"{c} IS NOT NULL AND ({num(c)}) IS NULL")
    gaps = where(t, f"{c} IS NULL")
    return (
        f"CASE WHEN {no_int} = 0 AND {gaps} = 0 THEN 'bigint'"
        f" WHEN {no_num} = 0 THEN 'double' ELSE 'string' END"
    )


def type_rows(strict: bool) -> str:
    parts = []
    for t, cols in COLUMNS.items():
        for c in cols:
            if c.endswith("id"):
                parts.append((t, c, text_type(t, c), "int", "<> 'bigint'"))
            elif "price" in c:
                parts.append((t, c, text_type(t, c), "float", "NOT IN ('bigint', 'double')"))
            elif "date" in c:
                parts.append((t, c, "'string'", "datetime", "<> ''"))
    return (
        "SELECT * FROM ("
        + union(
            [
                f"SELECT table_name, column_name, current_type, expected_type FROM (SELECT '{t}' AS table_name,"
                f" '{c}' AS column_name, {current} AS current_type, '{kind}' AS expected_type)"
                f" WHERE current_type {bad}"
                for t, c, current, kind, bad in parts
            ]
        )
        + ")"
    )


# Expected by reading the rules: a 32-bit nation_id passes the lenient rule only.
STRICT_EXTRA = (
    "\nUNION ALL SELECT 'renamed_nation', 'nation_id', 'int', 'int' FROM nation"
    " HAVING count(n_nationkey) > 0"
)

RULES = [
    ("products", "negative_prices", "list_price", f"({num('list_price')}) < 0"),
    ("order_items", "negative_quantities", "quantity", f"({num('quantity')}) < 0"),
    ("order_items", "zero_quantities", "quantity", f"({num('quantity')}) = 0"),
    (
        "order_items",
        "invalid_discounts",
        "discount",
        f"(({num('discount')}) < 0 OR ({num('discount')}) > 1)",
    ),
    ("customers", "multiple_phones", "phone", "contains(phone, ',')"),
]


def rule_rows(table: str) -> str:
    parts = [
        f"SELECT '{t}' AS table_name, '{issue}' AS issue, {where(t, cond)} AS count,"
        f" {pct(where(t, cond), rows(t))} AS pct"
        for t, issue, _, cond in RULES
        if t == table
    ]
    full_name = (
        f"\nUNION ALL SELECT 'customers', 'missing_full_name', {rows('customers')}, NULL"
        if table == "customers"
        else ""
    )
    return f"SELECT * FROM ({union(parts)}) WHERE count > 0{full_name}"


def _details(check: str, body: str) -> str:
    return f"SELECT '{check}' AS check_name, * FROM ({body})"


def findings() -> str:
    types = (
        "SELECT table_name, column_name, CAST(NULL AS VARCHAR) AS issue, 1 AS count,"
        " CAST(NULL AS DOUBLE) AS pct, current_type, expected_type"
        f" FROM ({type_rows(False)})"
    )
    missing = (
        "SELECT table_name, column_name, NULL AS issue, count, pct,"
        f" NULL AS current_type, NULL AS expected_type FROM ({MISSING})"
    )
    rule_columns = " ".join(f"WHEN issue = '{i}' THEN '{c}'" for _, i, c, _ in RULES)
    quality = (
        f"SELECT table_name, CASE {rule_columns} ELSE 'full_name' END AS column_name, issue,"
        " count, pct, NULL AS current_type, NULL AS expected_type FROM ("
        + union([f"({rule_rows(t)})" for t in ("products", "order_items", "customers")])
        + ")"
    )
    details = union(
        [_details("types", types), _details("missing", missing), _details("quality", quality)]
    )
    every = union([f"SELECT '{t}' AS table_name" for t in COLUMNS])
    checks = union(
        [
            f"SELECT table_name, '{check}' AS check_name FROM ({every}){only}"
            for check, only in [
                ("names", ""),
                ("missing", ""),
                ("types", ""),
                ("quality", " WHERE table_name IN ('products', 'order_items', 'customers')"),
            ]
        ]
    )
    return f"""
WITH details AS ({details}), checks AS ({checks})
SELECT table_name, check_name, column_name, issue, TRUE AS needed, CAST(count AS BIGINT) AS count, pct,
       current_type, expected_type FROM details
UNION ALL
SELECT c.table_name, c.check_name, NULL, NULL, count(d.column_name) > 0, count(d.column_name), NULL, NULL, NULL
FROM checks c LEFT JOIN details d ON c.table_name = d.table_name AND c.check_name = d.check_name
GROUP BY c.table_name, c.check_name
UNION ALL
SELECT table_name, 'duplicates', NULL, NULL, needed, count, pct, NULL, NULL FROM ({DUPLICATES})"""


FINDINGS = findings()
SUMMARIES = f"SELECT * FROM ({FINDINGS}) WHERE column_name IS NULL"
LABEL = """CASE check_name WHEN 'names' THEN 'columns' WHEN 'duplicates' THEN 'duplicates (' || count || ')'
 WHEN 'missing' THEN 'missing (' || count || ' cols)' WHEN 'types' THEN 'types (' || count || ' cols)'
 ELSE 'quality' END"""


EXTRA = {"products": ", list_price * 1e-12 AS tiny, CAST(NULL AS DOUBLE) AS void"}


def digits(x: str) -> str:
    """Nine significant digits."""
    return f"CAST(printf('%.8e', {x}) AS DOUBLE)"


def describe(table: str, column: str) -> str:
    c = f"CAST({column} AS DOUBLE)"
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, count({column}) AS value_count,"
        f" {digits(f'avg({c})')} AS mean, {digits(f'stddev_samp({c})')} AS std, min({c}) AS min_value,"
        + ", ".join(
            f" {digits(f'quantile_cont({c}, {q})')} AS q{int(q * 100)}" for q in (0.25, 0.5, 0.75)
        )
        + f", max({c}) AS max_value FROM (SELECT *{EXTRA.get(table, '')} FROM v_{table})"
    )


NUMERIC = {
    "products": ["product_id", "list_price", "tiny", "void"],
    "order_items": ["order_id", "product_id", "quantity", "list_price", "discount"],
    "stocks": ["store_id", "product_id", "quantity"],
}

ITEMS = (
    "(SELECT l_orderkey AS order_id, CASE WHEN l_partkey % 70 = 0 THEN l_partkey + 1000000"
    " ELSE l_partkey END AS product_id FROM lineitem)"
)
RELATIONSHIPS = [
    ("products", "brand_id", "brands", "brand_id"),
    ("products", "category_id", "categories", "category_id"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("orders", "store_id", "stores", "store_id"),
    ("orders", "staff_id", "staffs", "staff_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("stocks", "store_id", "stores", "store_id"),
    ("stocks", "product_id", "products", "product_id"),
]


def orphan_row(child: str, key: str, parent: str, parent_key: str) -> str:
    source = ITEMS if child == "order_items" else f"v_{child}"
    lost = (
        f"SELECT DISTINCT {key} AS k FROM {source} WHERE {key} IS NOT NULL AND {key} NOT IN"
        f" (SELECT {parent_key} FROM v_{parent})"
    )
    return (
        f"SELECT '{child}.{key} -> {parent}.{parent_key}' AS relationship,"
        f" (SELECT count(*) FROM ({lost})) AS orphaned_keys,"
        f" coalesce((SELECT string_agg(k, ', ' ORDER BY k) FROM (SELECT k FROM ({lost}) ORDER BY k LIMIT 5)), '')"
        " AS examples"
    )


def table_score(t: str) -> str:
    cells = " + ".join(where(t, f"{c} IS NULL") for c in COLUMNS[t])
    return (
        f"SELECT '{t}' AS table_name, greatest(0, round(100.0"
        f" - least(({cells}) * 100.0 / ({rows(t)} * {len(COLUMNS[t])}.0), 30.0)"
        f" - least({extra(t)} * 100.0 / {rows(t)}, 20.0), 2)) AS score"
    )


NA = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN',"
    " '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)
# Tokens take the place of the value, and all of them mean missing.
NA_ROWS = """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS full_name,
       CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS segment FROM customer"""

TRANSFORMS = """
SELECT 'enrich_products' AS transformation, TRUE AS needed, 'brand_name, category_name' AS missing_columns,
       (SELECT count(*) FROM d_products) AS rows_affected
UNION ALL SELECT 'calculate_item_total', TRUE, 'total_price', (SELECT count(*) FROM d_order_items)
UNION ALL SELECT 'calculate_order_total', TRUE, 'order_total', (SELECT count(*) FROM d_orders)"""

GATED = union(
    [
        f"SELECT '{t}' AS table_name, {'FALSE' if t == 'stores' else 'TRUE'} AS was_cleaned,"
        f" (SELECT count(*) FROM ({sql})) AS row_count"
        for t, sql in RECIPES.items()
    ]
)

ORACLES = {
    "src_table_shapes": over_clean(
        union(
            [
                f"SELECT '{t}' AS table_name, (SELECT count(*) FROM v_{t}) AS row_count,"
                f" (SELECT count(*) FROM (DESCRIBE SELECT * FROM v_{t})) + {more} AS column_count"
                for t, more in [(t, 2 if t == "orders" else 0) for t in COLUMNS]
            ]
        )
    ),
    "src_na_normalise": NA_ROWS,
    "dq_column_names": over_dirty("""
SELECT 'orders' AS table_name, 'Order ID' AS column_name, 'uppercase' AS issue, TRUE AS needed,
       count(order_id) AS count FROM d_orders
UNION ALL SELECT 'orders', 'Order ID', 'spaces', TRUE, count(order_id) FROM d_orders
UNION ALL SELECT 'orders', 'OrderDate', 'uppercase', TRUE, count(order_date) FROM d_orders
UNION ALL SELECT 'orders', 'customer id', 'spaces', TRUE, count(customer_id) FROM d_orders
UNION ALL SELECT 'orders', NULL, NULL, TRUE, 4"""),
    "dq_duplicates": over_dirty(DUPLICATES),
    "dq_duplicate_groups": over_dirty(
        "SELECT *, count(*) AS copies FROM d_customers GROUP BY ALL HAVING count(*) > 1"
    ),
    "dq_duplicate_sample": over_dirty("""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id) AS copy,
                      count(*) OVER (PARTITION BY customer_id) AS copies FROM d_customers)
WHERE copies > 1 ORDER BY customer_id, copy LIMIT 4"""),
    "dq_missing": over_dirty(MISSING),
    "dq_missing_advice": over_dirty(f"""
SELECT *, CASE WHEN pct > 50 THEN 'mostly_empty'
               WHEN column_name LIKE '%phone%' OR column_name LIKE '%email%' THEN 'use_placeholder'
               WHEN column_name LIKE '%price%' THEN 'use_median'
               ELSE 'inspect' END AS advice FROM ({MISSING})"""),
    "dq_types": over_dirty(type_rows(False)),
    "dq_types_strict": over_dirty(type_rows(True) + STRICT_EXTRA),
    "dq_negative_price": over_dirty(rule_rows("products")),
    "dq_item_rules": over_dirty(rule_rows("order_items")),
    "dq_multi_phone": over_dirty(rule_rows("customers")),
    "dq_date_order": over_dirty(f"""
SELECT count(*) AS orders, count(*) FILTER (WHERE {parsed('required_date')} < {parsed('order_date')})
  AS date_issues FROM d_orders"""),
    "dq_ranges": over_dirty(f"""
SELECT 'products' AS table_name, 'list_price' AS column_name, min({num('list_price')}) AS min_value,
       max({num('list_price')}) AS max_value FROM d_products
UNION ALL SELECT 'order_items', 'discount', min({num('discount')}), max({num('discount')}) FROM d_order_items"""),
    "dq_describe": over_clean(
        union([describe(t, c) for t, cols in NUMERIC.items() for c in cols])
    ),
    "dq_orphans": over_clean(union([orphan_row(*r) for r in RELATIONSHIPS])),
    "dq_nunique": over_clean("""
SELECT 'products' AS table_name, 'brand_id' AS column_name, count(DISTINCT brand_id) AS distinct_values FROM v_products
UNION ALL SELECT 'products', 'category_id', count(DISTINCT category_id) FROM v_products
UNION ALL SELECT 'products', 'category_name', count(DISTINCT category_name) FROM v_products
UNION ALL SELECT 'products', 'void', 0
UNION ALL SELECT 'orders', 'customer_id', count(DISTINCT o_custkey) FROM orders"""),
    "dq_value_counts": over_clean("""
SELECT 'orders' AS table_name, 'order_status' AS column_name, CAST(order_status AS VARCHAR) AS value,
       count(*) AS count FROM v_orders WHERE order_status IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'customers', 'state', state, count(*) FROM v_customers GROUP BY ALL"""),
    "dq_transforms_needed": over_dirty(TRANSFORMS),
    "dq_findings": over_dirty(f"SELECT * FROM ({FINDINGS})"),
    "dq_gates": over_dirty(f"""
SELECT CASE WHEN check_name = 'names' THEN 'column_standardization' ELSE 'data_cleaning' END AS step,
       bool_or(needed) AS needed FROM ({SUMMARIES}) GROUP BY 1
UNION ALL SELECT 'data_transformation', bool_or(needed) FROM ({TRANSFORMS})"""),
    "dq_score": over_dirty(f"""
SELECT count(*) AS total_checks, count(*) FILTER (WHERE NOT needed) AS passed_checks,
       round(count(*) FILTER (WHERE NOT needed) * 100.0 / count(*), 2) AS quality_score
FROM ({SUMMARIES})"""),
    "dq_table_score": over_dirty(f"""
SELECT *, CASE WHEN score >= 90 THEN 'Excellent' WHEN score >= 70 THEN 'Good'
               WHEN score >= 50 THEN 'Fair' ELSE 'Poor' END AS band
FROM ({union([table_score(t) for t in COLUMNS])})"""),
    "dq_issue_summary": over_dirty(f"""
SELECT table_name, coalesce(string_agg(CASE WHEN needed THEN {LABEL} END, ', '
         ORDER BY CASE WHEN needed THEN {LABEL} END), 'Clean') AS issues
FROM ({SUMMARIES}) GROUP BY table_name"""),
    "cln_gated": over_dirty(GATED),
}
