"""Spark jobs and reports for hourly and daily counter data."""
