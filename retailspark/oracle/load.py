"""Source, sink and load oracles."""

from retailspark.oracle import reports
from retailspark.oracle.cleaning import RECIPES, num, parsed
from retailspark.oracle.quality import COLUMNS, ITEMS, RELATIONSHIPS, union
from retailspark.oracle.views import over_clean, over_dirty

ORDER = [
    "brands", "categories", "stores", "staffs", "products", "customers", "orders",
    "order_items", "stocks",
]
CLEAN_COLUMNS = {**{t: len(c) for t, c in COLUMNS.items()}, "customers": 10}

KINDS = {
    "int": [
        "brand_id", "category_id", "store_id", "staff_id", "product_id", "customer_id",
        "order_id", "item_id", "active", "manager_id", "model_year", "order_status", "quantity",
    ],
    "float": ["list_price", "discount"],
    "time": ["order_date", "required_date", "shipped_date"],
}
LENGTHS = {
    "brand_name": 255, "category_name": 255, "store_name": 255, "phone": 25, "email": 255,
    "street": 255, "city": 255, "state": 10, "zip_code": 10, "product_name": 255,
}
TARGET_COLUMNS = {
    "brands": 2, "categories": 2, "stores": 8, "staffs": 8, "products": 8, "customers": 10,
    "orders": 9, "order_items": 7, "stocks": 3,
}


def _lost(t: str, c: str) -> str:
    if c in KINDS["time"]:
        value = parsed(c)
    elif c in KINDS["int"] + KINDS["float"]:
        value = f"({num(c)})"
    else:
        return "0"
    return f"(SELECT count(*) FROM d_{t} WHERE {c} IS NOT NULL AND {value} IS NULL)"


def _too_long(t: str, c: str) -> str:
    limit = LENGTHS.get(c)
    if c in ("first_name", "last_name"):
        limit = 50 if t == "staffs" else 255
    return f"(SELECT count(*) FROM d_{t} WHERE length({c}) > {limit})" if limit else "0"


def _conformance(t: str) -> str:
    lost = " + ".join(_lost(t, c) for c in COLUMNS[t])
    long = " + ".join(_too_long(t, c) for c in COLUMNS[t])
    return (
        f"SELECT '{t}' AS table_name, CAST({TARGET_COLUMNS[t]} AS BIGINT) AS column_count,"
        f" (SELECT count(*) FROM d_{t}) AS row_count, {lost} AS lost_values, {long} AS too_long"
    )


def _pk(t: str, key: str) -> str:
    return (
        f"SELECT '{t}' AS table_name, '{key}' AS key_columns, count(*) FILTER (WHERE n > 1) AS repeated_keys,"
        f" CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows, CAST(0 AS BIGINT) AS null_key_rows"
        f" FROM (SELECT {key}, count(*) AS n FROM v_{t} GROUP BY ALL)"
    )


def _fk(child: str, key: str, parent: str, parent_key: str) -> str:
    source = ITEMS if child == "order_items" else f"v_{child}"
    return (
        f"SELECT '{child}.{key} -> {parent}.{parent_key}' AS reference, count(*) AS violating_rows,"
        f" count(DISTINCT {key}) AS violating_keys FROM {source} WHERE {key} IS NOT NULL"
        f" AND {key} NOT IN (SELECT {parent_key} FROM v_{parent})"
    )


FILES = {
    "top_products": "rpt_top_products",
    "top_customers": "rpt_top_customers",
    "revenue_by_store": "rpt_store_revenue",
    "revenue_by_category": "rpt_category",
    "monthly_sales": "rpt_monthly",
    "store_inventory": "rpt_store_inventory",
    "staff_orders": "rpt_staff",
    "best_staff": "rpt_best_staff",
    "revenue_by_brand": "rpt_brand",
    "order_status_dist": "rpt_status",
}


def _total(table: str) -> str:
    return " + ".join(f"(SELECT count(*) FROM {table.format(t)})" for t in ORDER)


COUNTS = union(
    [f"SELECT '{n}' AS report, (SELECT count(*) FROM ({reports.ORACLES[q]})) AS row_count"
     for n, q in FILES.items()]
    + [
        "SELECT 'low_stock_products', (SELECT count(*) FROM part WHERE p_partkey NOT IN"
        " (SELECT l_partkey FROM lineitem GROUP BY l_partkey HAVING sum(l_quantity) >= 10))",
        "SELECT 'customers_no_orders', (SELECT count(*) FROM supplier) + (SELECT count(*) FROM customer"
        " WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))",
        "SELECT 'customer_spending', (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier)",
    ]
)

ACCENTED = "'[À-ÿ]'"

ORACLES = {
    "src_csv_load": over_dirty(
        union(
            [
                f"SELECT '{t}' AS table_name, (SELECT count(*) FROM d_{t}) AS row_count,"
                f" CAST({len(c)} AS BIGINT) AS column_count, TRUE AS found"
                for t, c in COLUMNS.items()
            ]
            + ["SELECT 'suppliers', 0, 0, FALSE"]
        )
    ),
    "src_encoding_probe": f"""
SELECT 'UTF-8' AS written_as, 'UTF-8' AS read_as, count(*) AS row_count,
       count(*) FILTER (WHERE regexp_matches(text, {ACCENTED})) AS accented_rows FROM documents
UNION ALL
SELECT 'ISO-8859-1', 'ISO-8859-1', count(*),
       count(*) FILTER (WHERE regexp_matches(text, {ACCENTED})) FROM documents""",
    "src_mixed_folder": f"""
SELECT lang, count(*) AS row_count, count(*) FILTER (WHERE regexp_matches(text, {ACCENTED})) AS accented_rows,
       CAST(sum(length(text)) AS BIGINT) AS chars, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS lines
FROM documents GROUP BY lang""",
    "src_cleaned_required": over_dirty(
        union(
            [
                f"SELECT '{t}' AS table_name, (SELECT count(*) FROM ({RECIPES[t]})) AS row_count,"
                f" CAST({CLEAN_COLUMNS[t]} AS BIGINT) AS column_count"
                for t in ORDER
            ]
        )
    ),
    "snk_cleaned_roundtrip": over_dirty(RECIPES["orders"]),
    "snk_reports_nonempty": f"SELECT *, row_count > 0 AS written FROM ({COUNTS})",
    "snk_schema_conform": over_dirty(union([_conformance(t) for t in ORDER])),
    "snk_append": over_dirty(
        union(
            [
                f"SELECT {i} AS position, '{t}' AS table_name, n AS rows_appended, n AS rows_after,"
                f" TRUE AS ok, NULL AS error FROM (SELECT count(*) AS n FROM ({RECIPES[t]}))"
                for i, t in enumerate(ORDER, 1)
            ]
        )
    ),
    "load_reconcile": over_dirty(
        union(
            [
                f"SELECT '{t}' AS table_name, n AS source_rows, n AS target_rows, TRUE AS ok"
                f" FROM (SELECT count(*) AS n FROM ({RECIPES[t]}))"
                for t in ORDER
            ]
        )
    ),
    # Two brands share a key: the log says what was refused, and nothing came after it.
    "load_refused": """
SELECT 1 AS position, 'brands' AS table_name, CAST(0 AS BIGINT) AS rows_appended, FALSE AS ok, TRUE AS has_cause""",
    # Of nine tables the eighth has orphans. Table by table the seven before it stay; as a whole nothing does.
    "load_orphans": over_clean(union(
        [
            f"SELECT {whole} AS whole, {i} AS position, '{t}' AS table_name,"
            f" CAST({'0' if whole == 'TRUE' or i == 8 else 'n'} AS BIGINT) AS rows_appended,"
            f" {'FALSE' if whole == 'TRUE' or i == 8 else 'TRUE'} AS ok,"
            f" CAST({'0' if whole == 'TRUE' or i == 8 else 'n'} AS BIGINT) AS rows_left,"
            f" {repr('order_items.product_id -> products.product_id') if i == 8 else 'NULL'} AS broken"
            f" FROM (SELECT count(*) AS n FROM v_{t}"
            f"{' WHERE staff_id IS NOT NULL' if t == 'orders' else ''})"
            for whole in ("FALSE", "TRUE") for i, t in enumerate(ORDER[:8], 1)
        ]
    )),
    "job_strict_run": "SELECT unnest(['check', 'transform', 'load', 'report']) AS stage, TRUE AS ok, TRUE AS quiet",
    "job_stage_log": over_dirty(f"""
SELECT stage, TRUE AS ok, CASE WHEN stage IN ('check', 'transform') THEN {_total('d_{}')} ELSE cleaned END AS rows_in,
       CASE WHEN stage IN ('transform', 'load') THEN cleaned END AS rows_out, TRUE AS wrote_rows, TRUE AS timed
FROM (SELECT {' + '.join(f'(SELECT count(*) FROM ({RECIPES[t]}))' for t in ORDER)} AS cleaned),
     (SELECT unnest(['check', 'transform', 'load', 'report']) AS stage)"""),
    "load_pk_violations": over_clean(
        union(
            [
                _pk(t, key)
                for t, key in [
                    ("brands", "brand_id"), ("categories", "category_id"), ("stores", "store_id"),
                    ("staffs", "staff_id"), ("products", "product_id"),
                    ("customers", "customer_id"), ("orders", "order_id"),
                    ("order_items", "order_id, item_id"), ("stocks", "store_id, product_id"),
                ]
            ]
        )
    ),
    "load_fk_violations": over_clean(
        union([_fk(*r) for r in [*RELATIONSHIPS, ("staffs", "store_id", "stores", "store_id")]])
    ),
    "load_notnull_violations": over_dirty(
        union(
            [
                f"SELECT '{t}' AS table_name, '{c}' AS column_name,"
                f" (SELECT count(*) FROM d_{t} WHERE {c} IS NULL) AS null_rows"
                for t, c in [
                    ("brands", "brand_name"), ("categories", "category_name"),
                    ("products", "product_name"),
                ]
            ]
        )
    ),
}
