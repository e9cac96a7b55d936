"""Independent SQL for the queries, run by DuckDB on the same source tables."""

from retailspark.oracle import cleaning, load, quality, reports

ORACLES: dict[str, str] = {
    **reports.ORACLES,
    **cleaning.ORACLES,
    **quality.ORACLES,
    **load.ORACLES,
}
