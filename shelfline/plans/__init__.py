"""The published reports and metric queries."""
