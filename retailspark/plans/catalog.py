"""Every registered query, by name."""

from __future__ import annotations

from retailspark.plans import cleaning_queries, load_queries, quality_queries, report_queries
from retailspark.plans.query import Query

QUERIES: dict[str, Query] = {
    **report_queries.QUERIES,
    **quality_queries.QUERIES,
    **cleaning_queries.QUERIES,
    **load_queries.QUERIES,
}
