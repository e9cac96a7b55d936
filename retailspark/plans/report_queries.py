"""Registered report queries over the retail views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retailspark.plans import reports
from retailspark.plans.query import Query
from retailspark.sources import starschema

# At the volume of the star schema nearly every customer passes the default bounds.
SEGMENTS = (1_000_000, 3_000_000)
# About two thirds of what a product has in stock on average.
LOW_STOCK = 450


def _report(fn, **params) -> Query:
    """A report over the retail views."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        tables = starschema.retail_tables(spark, folder)
        return fn(tables, **params)

    return query


QUERIES: dict[str, Query] = {
    "rpt_top_products": _report(reports.top_products),
    "rpt_top_products_full": _report(reports.top_products_full),
    "rpt_top_customers": _report(reports.top_customers),
    "rpt_top_customers_full": _report(reports.top_customers_full),
    "rpt_store_revenue": _report(reports.store_revenue),
    "rpt_store_revenue_linegrain": _report(reports.store_revenue_linegrain),
    "rpt_category": _report(reports.category),
    "rpt_category_full": _report(reports.category_full),
    "rpt_brand": _report(reports.brand),
    "rpt_brand_full": _report(reports.brand_full),
    "rpt_monthly": _report(reports.monthly),
    "rpt_monthly_linegrain": _report(reports.monthly_linegrain),
    "rpt_monthly_ordergrain": _report(reports.monthly_ordergrain),
    "rpt_low_stock": _report(reports.low_stock, low_stock_below=LOW_STOCK),
    "rpt_low_stock_detail": _report(reports.low_stock_detail, low_stock_below=LOW_STOCK),
    "rpt_store_inventory": _report(reports.store_inventory),
    "rpt_store_inventory_full": _report(reports.store_inventory_full),
    "rpt_staff": _report(reports.staff),
    "rpt_staff_full": _report(reports.staff_full),
    "rpt_best_staff": _report(reports.best_staff),
    "rpt_best_staff_linegrain": _report(reports.best_staff_linegrain),
    "rpt_customers_no_orders": _report(reports.customers_no_orders),
    "rpt_customers_no_orders_full": _report(reports.customers_no_orders_full),
    "rpt_customer_spending": _report(
        reports.customer_spending, segment_bounds=SEGMENTS
    ),
    "rpt_customer_spending_full": _report(
        reports.customer_spending_full, segment_bounds=SEGMENTS
    ),
    "rpt_spend_overall": _report(reports.spend_overall),
    "rpt_retention": _report(reports.retention),
    "rpt_status": _report(reports.status),
    "rpt_status_full": _report(reports.status_full),
    "rpt_kpis": _report(reports.kpis),
    "rpt_kpi_labels": _report(reports.kpi_labels),
    "rpt_series_monthly": _report(reports.series_monthly),
    "rpt_segment_share": _report(reports.segment_share, segment_bounds=SEGMENTS),
    "rpt_category_share": _report(reports.category_share),
    "rpt_status_labels": _report(reports.status_labels),
    "rpt_low_stock_alert": _report(reports.low_stock_alert, low_stock_below=LOW_STOCK),
    "rpt_inactive_count": _report(reports.inactive_count),
    "rpt_series_staff": _report(reports.series_staff),
    "rpt_series_brand": _report(reports.series_brand),
    "rpt_series_inventory": _report(reports.series_inventory),
}
