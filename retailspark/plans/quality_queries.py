"""Registered profiling queries, most of them over the untidy tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from retailspark.operators import profile, recipes
from retailspark.plans.query import Query
from retailspark.schemas import RELATIONSHIPS, TABLES
from retailspark.sources import dirt, files, starschema


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _each(check, names=None, **options) -> Query:
    """The check on every untidy table."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        tables = dirt.dirty_tables(spark, folder)
        return union_all([check(tables[n], n, **options) for n in names or TABLES])

    return query


def _details(check, names=None, **options) -> Query:
    """The column-level findings of the check on every untidy table."""

    def query(spark, folder):
        found = _each(check, names, **options)(spark, folder)
        return found.filter(F.col("column_name").isNotNull())

    return query


def findings(spark: SparkSession, folder: str) -> DataFrame:
    tables = dirt.dirty_tables(spark, folder)
    return profile.profile({n: tables[n] for n in TABLES}, nullable_int_is_drift=True)


def column_names(spark, folder):
    found = profile.column_names(dirt.misnamed_orders(spark, folder), "orders")
    return found.select("table_name", "column_name", "issue", "needed", "count")


def duplicates(spark, folder):
    found = _each(profile.duplicates)(spark, folder)
    return found.select("table_name", "needed", "count", "pct")


def duplicate_groups(spark, folder):
    return profile.duplicate_groups(dirt.customers(spark, folder))


def duplicate_sample(spark, folder):
    return profile.duplicate_sample(dirt.customers(spark, folder))


def missing(spark, folder):
    found = _details(profile.missing)(spark, folder)
    return found.select("table_name", "column_name", "count", "pct")


def missing_advice(spark, folder):
    return profile.missing_advice(_details(profile.missing)(spark, folder))


def _typed(strict: bool) -> Query:
    def query(spark, folder):
        tables = dict(dirt.dirty_tables(spark, folder))
        frames = [
            profile.types(dirt.VIEWS[n](spark, folder), n, strict, nullable_int_is_drift=True)
            for n in TABLES
        ]
        # A typed table next to the text ones: its 32-bit keys only fail the strict rules.
        frames.append(profile.types(starschema.source(spark, folder, "nation"), "nation", strict))
        renamed = starschema.source(spark, folder, "nation").withColumnRenamed(
            "n_nationkey", "nation_id"
        )
        frames.append(profile.types(renamed, "renamed_nation", strict))
        found = union_all(frames).filter(F.col("column_name").isNotNull())
        return found.select("table_name", "column_name", "current_type", "expected_type")

    return query


def _issues(table: str) -> Query:
    def query(spark, folder):
        found = profile.quality(dirt.VIEWS[table](spark, folder), table)
        return found.filter(F.col("column_name").isNotNull()).select(
            "table_name", "issue", "count", "pct"
        )

    return query


def date_order(spark, folder):
    return profile.date_order(dirt.orders(spark, folder))


def ranges(spark, folder):
    return profile.ranges(
        dirt.products(spark, folder), "products", ["list_price"]
    ).unionByName(profile.ranges(dirt.order_items(spark, folder), "order_items", ["discount"]))


NUMERIC = {
    "products": ["product_id", "list_price", "tiny", "void"],
    "order_items": ["order_id", "product_id", "quantity", "list_price", "discount"],
    "stocks": ["store_id", "product_id", "quantity"],
}


def describe(spark, folder):
    tables = starschema.retail_tables(spark, folder)
    # A column of tiny values, and one without any.
    tables["products"] = tables["products"].withColumns(
        {"tiny": F.col("list_price") * 1e-12, "void": F.lit(None).cast("double")}
    )
    found = union_all([profile.describe(tables[n], n, c) for n, c in NUMERIC.items()])
    # Means depend on the order of addition in their last digits.
    digits = {c: F.format_string("%.8e", c).cast("double") for c in ("mean", "std", "q25", "q50", "q75")}
    return found.withColumns({c: F.when(F.col(c).isNotNull(), v) for c, v in digits.items()})


def orphans(spark, folder):
    tables = starschema.retail_tables(spark, folder)
    tables["order_items"] = dirt.orphaned_items(spark, folder)
    return union_all(
        [
            profile.orphans(tables[child], child, key, tables[parent], parent, parent_key)
            for child, key, parent, parent_key in RELATIONSHIPS
        ]
    )


def distinct_counts(spark, folder):
    tables = starschema.retail_tables(spark, folder)
    return union_all(
        [
            profile.distinct_counts(
                tables["products"].withColumn("void", F.lit(None).cast("string")),
                "products",
                ["brand_id", "category_id", "category_name", "void"],
            ),
            profile.distinct_counts(
                starschema.plain_orders(spark, folder), "orders", ["customer_id"]
            ),
        ]
    )


def value_counts(spark, folder):
    orders = starschema.plain_orders(spark, folder)
    customers = starschema.customers(spark, folder)
    return profile.value_counts(orders, "orders", "order_status").unionByName(
        profile.value_counts(customers, "customers", "state")
    )


def shapes(spark, folder):
    tables = starschema.retail_tables(spark, folder)
    return profile.shapes({n: tables[n] for n in TABLES})


def na_normalise(spark, folder):
    return files.normalise_na(dirt.tokenised_customers(spark, folder))


def transforms_needed(spark, folder):
    tables = dirt.dirty_tables(spark, folder)
    return profile.transforms_needed({n: tables[n] for n in ("products", "order_items", "orders")})


def gates(spark, folder):
    return profile.gates(findings(spark, folder), transforms_needed(spark, folder))


def score(spark, folder):
    return profile.score(findings(spark, folder))


def table_score(spark, folder):
    return _each(profile.table_score)(spark, folder)


def issue_summary(spark, folder):
    return profile.issue_summary(findings(spark, folder))


def gated_cleaning(spark, folder):
    """Row counts after a cleaning run that skips the tables the profile calls clean."""
    tables = dirt.dirty_tables(spark, folder)
    # Stores lose their flaws, so that one table is skipped.
    tables["stores"] = recipes.clean_table("stores", tables["stores"]).clean.fillna("0")
    named = {n: tables[n] for n in TABLES}
    # One row per table reaches the driver.
    flags = profile.table_gates(profile.profile(named)).collect()
    needed = {row.table_name: row.needs_cleaning for row in flags}
    # Rows that stay are counted by digest, without moving the rows.
    kept = [
        recipes.stage_table(n, df).delta(n).select("table_name", F.col("rows_after").alias("row_count"))
        if needed.get(n, True) else profile.shapes({n: df}).select("table_name", "row_count")
        for n, df in named.items()
    ]
    counts = union_all(kept)
    chosen = F.lit(False)
    for name, flag in needed.items():
        chosen = F.when(F.col("table_name") == name, flag).otherwise(chosen)
    return counts.select("table_name", chosen.alias("was_cleaned"), "row_count")


QUERIES: dict[str, Query] = {
    "src_table_shapes": shapes,
    "src_na_normalise": na_normalise,
    "dq_column_names": column_names,
    "dq_duplicates": duplicates,
    "dq_duplicate_groups": duplicate_groups,
    "dq_duplicate_sample": duplicate_sample,
    "dq_missing": missing,
    "dq_missing_advice": missing_advice,
    "dq_types": _typed(False),
    "dq_types_strict": _typed(True),
    "dq_negative_price": _issues("products"),
    "dq_item_rules": _issues("order_items"),
    "dq_multi_phone": _issues("customers"),
    "dq_date_order": date_order,
    "dq_ranges": ranges,
    "dq_describe": describe,
    "dq_orphans": orphans,
    "dq_nunique": distinct_counts,
    "dq_value_counts": value_counts,
    "dq_transforms_needed": transforms_needed,
    "dq_findings": findings,
    "dq_gates": gates,
    "dq_score": score,
    "dq_table_score": table_score,
    "dq_issue_summary": issue_summary,
    "cln_gated": gated_cleaning,
}
