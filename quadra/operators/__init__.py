"""Extracts, dashboard reports and data-quality reports (DataFrame -> DataFrame)."""
