"""Data quality checks and KPI summaries."""
