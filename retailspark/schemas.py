"""The nine retail tables: target columns, keys, references and name rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {
    "int": T.LongType(),
    "float": T.DoubleType(),
    "text": T.StringType(),
    "time": T.TimestampNTZType(),
}


@dataclass(frozen=True)
class Table:
    """One target table.

    ``columns`` maps a name to ``(kind, max_length)``; ``max_length`` only
    applies to text. ``references`` maps a column to ``(table, column)``.
    """

    name: str
    columns: dict[str, tuple[str, int | None]]
    key: tuple[str, ...]
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    not_null: tuple[str, ...] = ()
    derived: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c, _TYPES[kind]) for c, (kind, _) in self.columns.items()]
        )

    @property
    def raw_columns(self) -> list[str]:
        """Columns expected in a raw file, before any enrichment."""
        return [c for c in self.columns if c not in self.derived]

    @property
    def lengths(self) -> dict[str, int]:
        return {c: n for c, (kind, n) in self.columns.items() if kind == "text" and n}


def _int():
    return ("int", None)


def _float():
    return ("float", None)


def _time():
    return ("time", None)


def _text(n):
    return ("text", n)


_ADDRESS = {
    "street": _text(255),
    "city": _text(255),
    "state": _text(10),
    "zip_code": _text(10),
}

# Listed parents first, so loading in this order never breaks a reference.
TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        Table(
            "brands",
            {"brand_id": _int(), "brand_name": _text(255)},
            key=("brand_id",),
            not_null=("brand_name",),
        ),
        Table(
            "categories",
            {"category_id": _int(), "category_name": _text(255)},
            key=("category_id",),
            not_null=("category_name",),
        ),
        Table(
            "stores",
            {
                "store_id": _int(),
                "store_name": _text(255),
                "phone": _text(25),
                "email": _text(255),
                **_ADDRESS,
            },
            key=("store_id",),
        ),
        Table(
            "staffs",
            {
                "staff_id": _int(),
                "first_name": _text(50),
                "last_name": _text(50),
                "email": _text(255),
                "phone": _text(25),
                "active": _int(),
                "store_id": _int(),
                "manager_id": _int(),
            },
            key=("staff_id",),
            references={"store_id": ("stores", "store_id")},
        ),
        Table(
            "products",
            {
                "product_id": _int(),
                "product_name": _text(255),
                "brand_id": _int(),
                "category_id": _int(),
                "model_year": _int(),
                "list_price": _float(),
                "brand_name": _text(255),
                "category_name": _text(255),
            },
            key=("product_id",),
            references={
                "brand_id": ("brands", "brand_id"),
                "category_id": ("categories", "category_id"),
            },
            not_null=("product_name",),
            derived=("brand_name", "category_name"),
        ),
        Table(
            "customers",
            {
                "customer_id": _int(),
                "first_name": _text(255),
                "last_name": _text(255),
                "phone": _text(25),
                "email": _text(255),
                **_ADDRESS,
                "full_name": _text(510),
            },
            key=("customer_id",),
            derived=("full_name",),
        ),
        Table(
            "orders",
            {
                "order_id": _int(),
                "customer_id": _int(),
                "order_status": _int(),
                "order_date": _time(),
                "required_date": _time(),
                "shipped_date": _time(),
                "store_id": _int(),
                "staff_id": _int(),
                "order_total": _float(),
            },
            key=("order_id",),
            references={
                "customer_id": ("customers", "customer_id"),
                "store_id": ("stores", "store_id"),
                "staff_id": ("staffs", "staff_id"),
            },
            derived=("order_total",),
        ),
        Table(
            "order_items",
            {
                "order_id": _int(),
                "item_id": _int(),
                "product_id": _int(),
                "quantity": _int(),
                "list_price": _float(),
                "discount": _float(),
                "total_price": _float(),
            },
            key=("order_id", "item_id"),
            references={
                "order_id": ("orders", "order_id"),
                "product_id": ("products", "product_id"),
            },
            derived=("total_price",),
        ),
        Table(
            "stocks",
            {"store_id": _int(), "product_id": _int(), "quantity": _int()},
            key=("store_id", "product_id"),
            references={
                "store_id": ("stores", "store_id"),
                "product_id": ("products", "product_id"),
            },
        ),
    )
}

# Child -> parent pairs the exploratory profile checks. staffs.store_id is a
# load constraint only.
RELATIONSHIPS: list[tuple[str, str, str, str]] = [
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

# The text tokens the pandas CSV reader takes for missing.
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Order status codes and their names.
STATUS_NAMES = {1: "Pending", 2: "Processing", 3: "Rejected", 4: "Completed"}

# Customers by what they spent (nothing ordered, below, within and above two bounds).
SEGMENT_NAMES = ("No Orders", "Low Spender", "Medium Spender", "High Spender")

# Customers by number of orders; 4 stands for more.
CUSTOMER_TYPES = {
    1: "One-time Customer", 2: "Occasional Customer", 3: "Occasional Customer", 4: "Repeat Customer",
}

# Fills used by the cleaning recipes.
UNKNOWN = "Unknown"
UNKNOWN_EMAIL = "unknown@email.com"
UNKNOWN_ZIP = "00000"
